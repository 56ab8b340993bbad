import os

import pytest
from pyspark.sql import functions as F

from hitscope.operators import insights
from hitscope.operators.sessions import sessionize
from hitscope.sinks import tables

from .helpers import hits

DAY = 86400
ROWS = [("a", 100, "/x", 1), ("a", DAY + 100, "/y", 2), ("b", DAY + 5, "/y", 3), ("c", 2 * DAY + 9, "/z", 4)]


def _enriched(spark):
    h = hits(spark, ROWS)
    return h.withColumns({"year": F.year("datetime"), "month": F.month("datetime"), "day": F.dayofmonth("datetime")})


def test_partitioned_rerun_replaces_only_that_day(spark, tmp_out):
    path = os.path.join(tmp_out, "log")
    e = _enriched(spark)
    tables.write_partitioned(e, path, sort_cols=["encrypted_host", "datetime"])
    rerun = e.where((F.col("day") == 2) & (F.col("encrypted_host") == "b"))
    tables.write_partitioned(rerun, path)
    back = spark.read.parquet(path)
    got = sorted((r["day"], r["encrypted_host"]) for r in back.collect())
    assert got == [(1, "a"), (2, "b"), (3, "c")]


def test_publish_rerun_is_idempotent(spark, tmp_out):
    root = os.path.join(tmp_out, "pub")
    s = sessionize(hits(spark, ROWS), 1800, tie_break="event_id")
    daily = insights.daily_insights_all_days(s, tie_break="event_id")
    pages = insights.page_insights_by_day(s, 5, 5, tie_break="event_id")
    countries = insights.country_insights_by_day(s)
    tables.publish_insights(daily, pages, countries, root)
    before = {t: tables.read_published(spark, root, t).count() for t in ("daily_insights", "page_insights", "country_insights")}
    day = "2024-01-02"
    for _ in range(2):
        tables.publish_insights(
            insights.daily_insights(s, s, day, tie_break="event_id"),
            pages.where(F.col("insight_date") == day),
            countries.where(F.col("insight_date") == day),
            root,
            dates=[day],
        )
    after = {t: tables.read_published(spark, root, t).count() for t in before}
    assert before == after
    # a rerun that yields no rows for the day clears that day
    tables.publish(countries.where(F.lit(False)), f"{root}/country_insights", dates=[day])
    left = {r["insight_date"] for r in tables.read_published(spark, root, "country_insights").collect()}
    assert day not in left and "2024-01-01" in left


def test_failed_publish_keeps_the_old_day(spark, tmp_out):
    path, day = os.path.join(tmp_out, "t"), "2024-01-02"
    old = spark.createDataFrame([(day, "x", 1), ("2024-01-01", "y", 2)], "insight_date string, country_name string, page_request_count long")
    tables.publish(old, path, sort_cols=["page_request_count"])
    broken = old.withColumn("country_name", F.when(F.col("country_name") == "x", F.raise_error(F.lit("broken"))).cast("string"))
    with pytest.raises(Exception, match="broken"):
        tables.publish(broken, path, dates=[day])
    assert {r["country_name"] for r in spark.read.parquet(path).collect()} == {"x", "y"}


def test_published_files_are_sorted(spark, tmp_out):
    s = sessionize(hits(spark, [("a", i * 10, f"/{i % 4}", i) for i in range(30)]), 1800, tie_break="event_id")
    tables.publish_insights(
        insights.daily_insights_all_days(s), insights.page_insights_by_day(s, 5, 5), insights.country_insights_by_day(s), tmp_out
    )
    rows = [r["measure_value"] for r in spark.read.parquet(f"{tmp_out}/page_insights").where("query_type = 'Page_Hits'").collect()]
    assert rows == sorted(rows, reverse=True) and len(rows) == 4


def test_land_new_days(spark, tmp_out):
    src, dst = os.path.join(tmp_out, "src"), os.path.join(tmp_out, "dst")
    lines = spark.createDataFrame(
        [("l1", "2024-01-01"), ("l2", "2024-01-01"), ("l3", "2024-01-02"), ("l4", "2024-01-03")], "value string, day string"
    )
    lines.write.partitionBy("day").text(src)
    lines.where(F.col("day") == "2024-01-01").write.partitionBy("day").text(dst)
    os.makedirs(os.path.join(dst, "day=2024-01-02"))  # folders of a run that failed: no marker, so not landed
    assert tables.land_new_days(spark, src, dst) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert tables.land_new_days(spark, src, dst) == []
    back = spark.read.schema("value string, day string").text(dst)
    assert sorted((r["day"], r["value"]) for r in back.collect()) == [
        ("2024-01-01", "l1"), ("2024-01-01", "l2"), ("2024-01-02", "l3"), ("2024-01-03", "l4")
    ]


def test_routed_and_table_sinks(spark, tmp_out):
    e = _enriched(spark).withColumnRenamed("event_id", "id")
    tables.save_partitioned_table(e.where(F.col("day") == 1), "hits_partitioned")
    tables.save_partitioned_table(e, "hits_partitioned")
    assert spark.table("hits_partitioned").count() == 4
    path = os.path.join(tmp_out, "ext")
    tables.write_partitioned(e, path)
    schema = e.schema
    t = tables.create_external_table(spark, "hits_external", path, schema, ["year", "month", "day"])
    assert t.count() == 4 and t.where("day = 2").count() == 2
    spark.sql("DROP TABLE IF EXISTS hits_partitioned")
    spark.sql("DROP TABLE IF EXISTS hits_external")


def test_routed_sink_and_session_csv_scan(spark, tmp_out):
    from hitscope import schemas
    from hitscope.operators.routing import PLAIN_HOSTS, route_logs
    from hitscope.sources.access_log import read_session_hits

    from .helpers import raw_log

    good = ("h.a.com", "-", "-", "[01/Jul/1995:00:00:01", "-0400]", "GET /a.html HTTP/1.0", "200", "10")
    routes = route_logs(raw_log(spark, [good, good[:5] + ("GET /x?a=1 HTTP/1.0",) + good[6:], ("x",) + (None,) * 7]), PLAIN_HOSTS)
    routes = {k: v for k, v in routes.items() if k in ("null", "rejected", "page", "non_page")}
    out = os.path.join(tmp_out, "routed")
    tables.write_routed(routes, out)
    counts = {k: spark.read.parquet(f"{out}/{k}").count() for k in routes}
    assert counts == {"null": 1, "rejected": 1, "page": 1, "non_page": 0}
    assert spark.read.parquet(f"{out}/page").columns == schemas.ROUTED_FIELDS
    csv = os.path.join(tmp_out, "sessions.csv")
    with open(csv, "w") as f:
        f.write("h,1995-07-01 00:00:01,804556801,GET / HTTP/1.0,200,10,/,NA,1995,7,1,,0,h_0,/,/,1\n")
    s = read_session_hits(spark, csv, fmt="csv").first()
    assert s["session_id"] == "h_0" and s["epoch"] == 804556801 and s["session_time_difference"] is None
