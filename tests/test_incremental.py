"""Runs that go on from carried state, and sinks that merge by key or by file."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitscope.operators import insights
from hitscope.operators.sessions import SESSION_COLUMNS, sessionize, sessionize_from
from hitscope.plans import daily
from hitscope.plans.sql import register_functions, sessionize_sql
from hitscope.sinks import tables

from .helpers import hits, rows_of

DAY = 86400
COLS = ["event_id", *SESSION_COLUMNS]


def _random_hits(seed, days=4):
    """A busy host, few others, hosts without a name, hits without a time or a
    url, sessions that cross midnight, equal times."""
    rnd = random.Random(seed)
    rows, i = [], 0
    for d in range(days):
        for _ in range(120):
            host = rnd.choice(["hot"] * 6 + ["a", "b", f"only{d}", None])
            base = rnd.choice([rnd.randrange(DAY), DAY - rnd.randrange(600), rnd.randrange(600)])
            rows.append((host, d * DAY + base, rnd.choice(["/x", "/y", None]), i))
            i += 1
    rows += [(rnd.choice(["hot", "a", "late"]), None, "/n", i + k) for k in range(9)]
    return rows


def _frame(spark, rows):
    h = hits(spark, rows)
    return h.withColumns({"year": F.year("datetime"), "month": F.month("datetime"), "day": F.dayofmonth("datetime")})


@pytest.mark.parametrize("gap, tie", [(1800, "event_id"), (21600, "event_id"), (60, "event_id"), (1800, None)])
def test_days_from_state_equal_one_run(spark, gap, tie):
    rows = _random_hits(gap)
    if tie is None:  # equal times are peers: they may not differ in the page
        rows = [(h, t, "/same", i) for h, t, _, i in rows]
    whole = sorted(map(str, rows_of_any(sessionize(_frame(spark, rows), gap=gap, tie_break=tie))))
    state, parts = None, []
    for d in range(-1, 4):
        mine = [r for r in rows if (r[1] is None if d < 0 else r[1] is not None and r[1] // DAY == d)]
        out, state = sessionize_from(_frame(spark, mine), state, gap=gap, tie_break=tie)
        parts += rows_of_any(out)
        state = spark.createDataFrame(state.collect(), state.schema)
    assert sorted(map(str, parts)) == whole
    assert state.count() == len({r[0] for r in rows})


def rows_of_any(df):
    return [tuple(r[c] for c in COLS) for r in df.select(*COLS).collect()]


def test_an_empty_day_keeps_the_state(spark):
    out, state = sessionize_from(_frame(spark, [("a", 5, "/x", 1), ("a", 9, "/y", 2)]), None, tie_break="event_id")
    first = state.collect()
    out, state = sessionize_from(_frame(spark, []), spark.createDataFrame(first, state.schema), tie_break="event_id")
    assert out.count() == 0 and state.collect() == first
    assert tuple(first[0]) == ("=a", 1704067209, 0, "/x", 2)


def _store(spark, tmp_out, rows, runs, tie="event_id"):
    log, store = os.path.join(tmp_out, "log"), os.path.join(tmp_out, "store")
    full = _frame(spark, rows).withColumns({c: F.lit(None).cast("string") for c in ("request",)}).withColumns(
        {"http_response_code": F.lit(200), "bytes": F.lit(1).cast("bigint")}
    )
    tables.write_partitioned(full, log)
    for first, last in runs:
        daily.run_days(spark, spark.read.parquet(log), store, first, last, tie_break=tie, keep=["event_id"])
    return log, store


def test_daily_runs_and_their_repeat(spark, tmp_out):
    rows = _random_hits(7)
    runs = [(daily.NO_DAY, daily.NO_DAY), ("2024-01-01", "2024-01-02"), ("2024-01-03", "2024-01-03"), ("2024-01-04", "2024-01-04")]
    log, store = _store(spark, tmp_out, rows, runs)
    want = sorted(map(str, rows_of_any(sessionize(_frame(spark, rows), tie_break="event_id"))))
    read = lambda: sorted(map(str, rows_of_any(spark.read.parquet(f"{store}/sessions"))))
    assert read() == want
    # a day run again starts from the state before it and changes nothing
    daily.run_days(spark, spark.read.parquet(log), store, "2024-01-03", tie_break="event_id", keep=["event_id"])
    assert read() == want
    # a state that was not finished is not used
    os.remove(f"{store}/session_state/asof=2024-01-03/_SUCCESS")
    daily.run_days(spark, spark.read.parquet(log), store, "2024-01-03", tie_break="event_id", keep=["event_id"])
    daily.run_days(spark, spark.read.parquet(log), store, "2024-01-04", tie_break="event_id", keep=["event_id"])
    assert read() == want


def test_a_run_reads_one_day(spark, tmp_out):
    log, store = _store(spark, tmp_out, _random_hits(3), [])
    for d in ("2024-01-02", "2024-01-04"):
        day = daily.days_of(spark.read.parquet(log), d, d)
        files = {f.split("/day=")[1].split("/")[0] for f in (r[0] for r in day.select("_metadata.file_path").distinct().collect())}
        assert files == {str(int(d[-2:]))}
        out, _ = sessionize_from(day, None, tie_break="event_id")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
        scan = day._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.selectedPartitions().partitionCount() == 1


def test_new_visitors_from_last_seen(spark, tmp_out):
    rows = [(h, d * DAY + 5, "/x", 10 * d + k) for d in range(12) for k, h in enumerate("abcd") if (d * (k + 2)) % 5 == 0 or (h == "d" and d == 11)]
    log, store = _store(spark, tmp_out, rows, [])
    lookback, frame = 3, spark.read.parquet(log)
    daily.start_new_visitors(spark, frame, store, "2024-01-01", "2024-01-04", lookback)
    for d in [*range(5, 13), 12]:  # the last day twice
        daily.count_new_visitors(spark, frame, store, f"2024-01-{d:02}", lookback)
    got = {r[0]: r[1] for r in tables.read_published(spark, store, "new_visitors").select("insight_date", "new_users_count").collect()}
    want = insights.new_visitors_by_day(frame, frame, lookback).collect()
    assert {k: v for k, v in got.items() if v} == {str(r[0]): r[1] for r in want if r[1]}
    for d in range(12):  # by hand
        seen = {h for h, t, _, _ in rows if d - lookback <= t // DAY < d}
        assert got.get(f"2024-01-{d + 1:02}", 0) == len({h for h, t, _, _ in rows if t // DAY == d} - seen)


def test_window_visitors_read_sketches_only(spark, tmp_out):
    rows = [(f"h{(k * 7919) % 9000}" if k % 50 else None, (k % 10) * DAY, "/x", k) for k in range(30_000)]
    path = os.path.join(tmp_out, "visitor_sketches")
    frame = _frame(spark, rows)
    tables.publish(insights.visitor_sketches_by_day(frame), path)
    out = insights.window_visitors(tables.read_published(spark, tmp_out, "visitor_sketches"), 3)
    assert "visitor_sketches" in out._jdf.queryExecution().optimizedPlan().toString() or out.inputFiles()
    assert all("visitor_sketches" in f for f in out.inputFiles())
    got = dict(out.collect())
    for d in range(10):
        exact = len({h for h, t, _, _ in rows if d - 3 < t // DAY <= d})
        assert abs(got[f"2024-01-{d + 1:02}"] - exact) <= 0.03 * exact
    assert insights.window_visitors(insights.visitor_sketches_by_day(frame.limit(0)), 3).collect() == []


def test_upsert(spark, tmp_out):
    path = os.path.join(tmp_out, "t")
    shape = "insight_date string, country_name string, n bigint"
    df = lambda rows: spark.createDataFrame(rows, shape)
    read = lambda: sorted(map(str, tables.read_published(spark, tmp_out, "t").select("insight_date", "country_name", "n").collect()))
    rows = lambda *r: sorted(str(T.Row(insight_date=a, country_name=b, n=c)) for a, b, c in r)
    tables.upsert(df([("d1", "A", 1), ("d1", None, 2), ("d2", "A", 3)]), path, ["country_name"])
    assert read() == rows(("d1", "A", 1), ("d1", None, 2), ("d2", "A", 3))
    untouched = set(os.listdir(f"{path}/insight_date=d2"))
    tables.upsert(df([("d1", None, 20), ("d1", "B", 5), ("d1", "B", 6), ("d3", "C", 7)]), path, ["country_name"])
    want = rows(("d1", "A", 1), ("d1", None, 20), ("d1", "B", 6), ("d2", "A", 3), ("d3", "C", 7))
    assert read() == want and set(os.listdir(f"{path}/insight_date=d2")) == untouched
    tables.upsert(df([]), path, ["country_name"])
    tables.upsert(df([("d1", "B", 6)]), path, ["country_name"])  # again: nothing changes
    assert read() == want


def test_publish_computes_its_frame_once(spark, tmp_out):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    path = os.path.join(tmp_out, "p")
    shape = "insight_date string, n bigint"
    tables.publish(spark.createDataFrame([("d1", 1), ("d2", 2), ("d3", 3)], shape), path)
    df = spark.createDataFrame([("d1", 10), ("d9", 9)], shape).mapInArrow(count, shape)
    tables.publish(df, path, ["d1", "d2"])
    back = tables.read_published(spark, tmp_out, "p").select("insight_date", "n")
    assert sorted(map(tuple, back.collect())) == [("d1", 10), ("d3", 3)]
    assert seen.value == 2


def test_total_order_over_files(spark, tmp_out):
    rows = [("hot" if k % 3 else f"h{k % 40}", (k * 7919) % 50_000, "/x", k) for k in range(3000)] + [(None, None, "/n", 3001)]
    path = os.path.join(tmp_out, "o")
    cols = ["encrypted_host", "datetime", "event_id"]
    tables.write_ordered(hits(spark, rows), path, cols, files=7)
    back = tables.read_ordered(spark, path).orderBy("position").collect()
    key = lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[3])
    assert [r["position"] for r in back] == list(range(1, len(rows) + 1))
    assert [r["event_id"] for r in back] == [r[3] for r in sorted(rows, key=key)]
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    hot = [f for f in parts if spark.read.parquet(f"{path}/{f}").where("encrypted_host = 'hot'").count()]
    assert len(hot) > 2  # the hot host spans files


def test_names_and_paths_of_any_kind(spark, tmp_out):
    h = hits(spark, [("a", 5, "/x", 1), ("a", 9000, "/y", 2)])
    odd = h.toDF("my host", "order", "group", "select", "a`b", "tie break")
    got = sessionize_sql(spark, odd, tie_break="tie break", host="my host", time="order", epoch="group", url="select")
    assert sorted(r["session_id"] for r in got.collect()) == ["a_0", "a_1"]
    path = os.path.join(tmp_out, "it's here")
    h.select("event_id", "country").write.partitionBy("country").parquet(path)
    shape = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("country", T.StringType())])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS odd_names LOCATION '{tmp_out}/db'")
    assert tables.create_external_table(spark, "odd_names.t", path, shape, ["country"]).count() == 2
    spark.sql("DROP DATABASE odd_names CASCADE")


def test_sql_functions_on_bad_values(spark):
    register_functions(spark, "t_")
    one = spark.sql("SELECT t_ipv4_to_long('1.2.3.4'), t_ipv4_to_long('1.2.x.4'), t_ipv4_to_long(NULL), t_host_suffix('...'), t_host_suffix('a.b.'), t_request_resource('GET'), t_date_prefix(NULL)")
    assert tuple(one.first()) == (16909060, None, None, None, "b", None, None)


def test_landing_by_file(spark, tmp_out):
    src, dst = os.path.join(tmp_out, "src"), os.path.join(tmp_out, "dst")

    def put(day, name, *lines):
        os.makedirs(f"{src}/day={day}", exist_ok=True)
        with open(f"{src}/day={day}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")

    read = lambda: sorted(map(tuple, tables.read_landed_files(spark, dst).collect()))
    put("d1", "a.log", "1", "2")
    assert tables.land_new_files(spark, src, dst) == ["day=d1/a.log"]
    put("d1", "late.log", "3")
    put("d2", "a.log", "4")
    # a run that failed before its manifest left rows
    spark.createDataFrame([("junk", "late.log", "d1")], "value string, file string, day string").write.partitionBy("day").parquet(f"{dst}/batch=failed")
    assert read() == [("1", "d1"), ("2", "d1")]
    assert tables.land_new_files(spark, src, dst) == ["day=d1/late.log", "day=d2/a.log"]
    assert not os.path.exists(f"{dst}/batch=failed")
    assert tables.land_new_files(spark, src, dst) == []
    assert read() == [("1", "d1"), ("2", "d1"), ("3", "d1"), ("4", "d2")]
    put("d1", "a.log", "1", "2", "changed")
    later = dt.datetime.now().timestamp() + 60
    os.utime(f"{src}/day=d1/a.log", (later, later))
    assert tables.land_new_files(spark, src, dst) == ["day=d1/a.log"]
    assert read() == [("1", "d1"), ("2", "d1"), ("3", "d1"), ("4", "d2"), ("changed", "d1")]
