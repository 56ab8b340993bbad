"""A log stored by (host, chunk) buckets: same rows, no exchange of hits."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from hitscope.operators import geo
from hitscope.operators.sessions import LAYOUT, SESSION_COLUMNS, sessionize, sessionize_bucketed
from hitscope.sinks import tables

from .helpers import hits, ranges
from .test_incremental import _random_hits

COLS = ["event_id", *SESSION_COLUMNS]


@pytest.fixture
def db(spark, tmp_out):
    name = f"bucketed_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_out}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _text(df, cols):
    return sorted(str(tuple(r[c] for c in cols)) for r in df.select(*cols).collect())


@pytest.mark.parametrize("gap, width", [(1800, 600), (21600, 600), (600, 600), (60, 7)])
def test_sessions_of_a_bucketed_log(spark, db, gap, width):
    h = hits(spark, _random_hits(gap))
    tables.save_bucketed_log(h, f"{db}.log", 5, width, ["datetime", "event_id"], tie_break="event_id")
    log, found = tables.read_bucketed_log(spark, f"{db}.log")
    assert found == width
    got = sessionize_bucketed(log, found, gap, tie_break="event_id")
    assert got.columns == [*h.columns, *SESSION_COLUMNS]
    assert _text(got, COLS) == _text(sessionize(h, gap, tie_break="event_id"), COLS)


def test_layout_faults_are_errors(spark, db):
    h = hits(spark, [("a", 5, "/x", 1)])
    tables.save_bucketed_log(h, f"{db}.log", 2, 600)
    log, width = tables.read_bucketed_log(spark, f"{db}.log")
    with pytest.raises(ValueError, match="wider than the gap"):
        sessionize_bucketed(log, width, gap=599)
    h.write.saveAsTable(f"{db}.plain")
    with pytest.raises(ValueError, match="not stored by host"):
        tables.read_bucketed_log(spark, f"{db}.plain")


def test_an_empty_bucketed_log(spark, db):
    tables.save_bucketed_log(hits(spark, []), f"{db}.log", 3)
    log, width = tables.read_bucketed_log(spark, f"{db}.log")
    assert sessionize_bucketed(log, width).collect() == []
    assert geo.tag_country_bucketed(log.drop("country"), ranges(spark, []), LAYOUT, host="encrypted_host").count() == 0


def test_countries_of_a_bucketed_log(spark, db):
    names = ["1.0.0.7", "1.0.0.200", "2.0.0.1", "www.x.de", "y.zz", "odd host", None]
    h = hits(spark, [(names[k % 7], 1000 * k, "/x", k) for k in range(60)] + [("1.0.0.7", None, "/n", 99)]).drop("country")
    r = ranges(spark, [(16777216, 16777300, "de", "Germany"), (16777216, 16777470, "fr", "France"), (33554432, 33554440, "us", None)])
    tables.save_bucketed_log(h, f"{db}.log", 4, tie_break="event_id")
    log, _ = tables.read_bucketed_log(spark, f"{db}.log")
    for overlap in ("all", "smallest"):
        cols = [*h.columns, "country"]
        got = geo.tag_country_bucketed(log, r, LAYOUT, overlap, host="encrypted_host")
        assert _text(got, cols) == _text(geo.tag_country(h, r, overlap, host="encrypted_host"), cols)


def _hits_exchanged(df, column):
    """Exchanges of the plan, without broadcasts, whose rows have ``column``."""
    node = df._jdf.queryExecution().executedPlan().toString()
    jvm_plans = re.findall(r"Exchange hashpartitioning\([^\n]*\n([^\n]*)", node)
    return [p for p in jvm_plans if re.search(rf"\b{column}#", p)]


def test_no_exchange_of_hits(spark, db):
    h = hits(spark, [("hot" if k % 3 else f"h{k % 40}", k * 11, f"/{k % 9}", k) for k in range(6000)])
    tables.save_bucketed_log(h, f"{db}.log", 16, 600, ["datetime", "event_id"], tie_break="event_id")
    log, width = tables.read_bucketed_log(spark, f"{db}.log")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s = sessionize_bucketed(log, width, tie_break="event_id")
        plan = s._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Bucketed: true") == 2 and "SortAggregate" not in plan and "SortMergeJoin" in plan
        # two exchanges: the chunks' first rows by host, and back by host and chunk
        assert plan.count("Exchange hashpartitioning") == 2
        assert not _hits_exchanged(s, "country")
        assert len(_hits_exchanged(sessionize(h, tie_break="event_id"), "country")) == 1  # the helper sees them
        t = geo.tag_country_bucketed(log.drop("country"), ranges(spark, []), LAYOUT, host="encrypted_host")
        assert not _hits_exchanged(t, "event_id")
        assert t.count() == 6000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # the hot host lies in many buckets, and a bucket is one file
    files = log.select("encrypted_host", F.col("_metadata.file_name").alias("f"))
    assert files.where("encrypted_host = 'hot'").select("f").distinct().count() > 10
    assert files.select("f").distinct().count() <= 16
