import os

import pytest

from hitscope.operators.sessions import SESSION_COLUMNS, sessionize
from hitscope.operators.routing import PLAIN_HOSTS
from hitscope.plans.sql import register_views, sessionize_sql
from hitscope.sinks import tables
from hitscope.streaming.incremental import run_incremental

from .helpers import hits, ranges, rows_of

ROWS = [("a", 0, "/1", 1), ("a", 0, "/2", 2), ("a", 1800, "/3", 3), ("a", 1900, "/4", 4), ("b", 5, "/x", 5)]


@pytest.mark.parametrize("tie_break", ["event_id", None])
def test_sql_form_equals_dataframe_form(spark, tie_break):
    cols = ["event_id", "session_time_difference", "is_new_session", "session_id", "page_count"]
    h = hits(spark, ROWS)
    a = rows_of(sessionize_sql(spark, h, 1800, tie_break), cols)
    b = rows_of(sessionize(h, 1800, tie_break=tie_break), cols)
    assert a == b
    assert set(SESSION_COLUMNS) <= set(sessionize_sql(spark, h, 1800, tie_break).columns)


def test_register_views(spark):
    names = register_views({"page": hits(spark, ROWS)}, prefix="t")
    assert spark.sql(f"SELECT COUNT(*) AS n FROM {names['page']}").first()["n"] == 5


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_incremental_stream_processes_only_new_files(spark, tmp_out):
    src, out, ckpt = (os.path.join(tmp_out, d) for d in ("src", "out", "ckpt"))
    rng = ranges(spark, [(16909056, 16909311, "au", "Australia")] + [(i * 70000, i * 70000 + 9, "xx", f"X{i}") for i in range(300)])
    line = '1.2.3.4 - - [01/Jul/1995:00:00:{s:02d} -0400] "GET /a.html HTTP/1.0" 200 10'
    _write(f"{src}/d1/log1.txt", [line.format(s=i) for i in range(5)] + ["bad line"])
    run_incremental(spark, f"{src}/*", rng, out, ckpt, PLAIN_HOSTS)
    assert spark.read.parquet(out).count() == 5
    _write(f"{src}/d2/log2.txt", [line.format(s=i) for i in range(3)])
    run_incremental(spark, f"{src}/*", rng, out, ckpt, PLAIN_HOSTS)
    run_incremental(spark, f"{src}/*", rng, out, ckpt, PLAIN_HOSTS)
    back = spark.read.parquet(out)
    assert back.count() == 8
    assert {r["country"] for r in back.collect()} == {"Australia"}
    # its readers list the stream's files only, so a batch day written beside them would be lost
    with pytest.raises(ValueError):
        tables.write_partitioned(back, out)
