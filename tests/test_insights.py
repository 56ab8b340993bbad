from pyspark.sql import functions as F

from hitscope.operators import insights
from hitscope.operators.sessions import sessionize

from .helpers import hits

DAY = 86400


def _sessions(spark, rows, gap=1800):
    return sessionize(hits(spark, rows), gap, tie_break="event_id")


ROWS = [
    # host a: a session crossing midnight (23:50 -> 00:10), then a bounce
    ("a", DAY - 600, "/x", 1),
    ("a", DAY + 600, "/y", 2),
    ("a", DAY + 20000, "/z", 3),
    # host b: day 0 only, two hits 1800 s apart (a new session that still counts in duration)
    ("b", 100, "/x", 4),
    ("b", 1900, "/x", 5),
    # host c: first seen day 1
    ("c", DAY + 50, "/y", 6),
]


def test_daily_insights_all_days(spark):
    s = _sessions(spark, ROWS)
    d = {r["insight_date"]: r.asDict() for r in insights.daily_insights_all_days(s, lookback_days=7, tie_break="event_id").collect()}
    d0, d1 = d["2024-01-01"], d["2024-01-02"]
    # day 0: a_0 (1 hit), b_0 (1 hit), b_1 (1 hit, gap 1800 counted as duration)
    assert (d0["unique_visitor_count"], d0["user_session_count"], d0["page_views_count"]) == (2, 3, 3)
    assert d0["bounce_count"] == 3 and d0["bounce_rate"] == 100.0
    assert d0["avg_session_duration"] == 30.0 and d0["avg_session_duration_sec"] == 1800
    assert d0["new_users_count"] == 2
    # day 1: a_0 continues (1 hit that day, gap 1200), a_1 bounce, c_0 bounce
    assert (d1["unique_visitor_count"], d1["user_session_count"], d1["page_views_count"]) == (2, 3, 3)
    assert d1["bounce_count"] == 3
    assert d1["avg_session_duration"] == 20.0
    assert d1["new_users_count"] == 1  # c only; a was seen the day before
    assert (d1["insight_year"], d1["insight_month"], d1["insight_day"]) == (2024, 1, 2)


def test_single_day_and_empty_day(spark):
    s = _sessions(spark, ROWS)
    one = insights.daily_insights(s, s, "2024-01-02", 7, tie_break="event_id").collect()
    assert len(one) == 1 and one[0]["user_session_count"] == 3 and one[0]["new_users_count"] == 1
    empty = insights.daily_insights(s, s, "2024-03-01", 7, tie_break="event_id").collect()
    assert len(empty) == 1
    e = empty[0]
    assert e["user_session_count"] == 0 and e["page_views_count"] == 0 and e["new_users_count"] == 0
    assert e["avg_session_duration"] is None and e["bounce_rate"] is None
    assert e["insight_date"] == "2024-03-01"


def test_new_visitors_history_rules(spark):
    s = _sessions(spark, ROWS)
    empty_hist = s.where(F.lit(False))
    nv = {r["insight_date"].isoformat(): r["new_users_count"] for r in insights.new_visitors_by_day(s, empty_hist, 7).collect()}
    assert nv == {"2024-01-01": 2, "2024-01-02": 2}
    # lookback of 0 days: nothing is history, everyone is new every day
    nv0 = {r["insight_date"].isoformat(): r["new_users_count"] for r in insights.new_visitors_by_day(s, s, 0).collect()}
    assert nv0 == {"2024-01-01": 2, "2024-01-02": 2}
    nulls = spark.createDataFrame([(None, None)], "encrypted_host string, datetime timestamp")
    today = s.select("encrypted_host", "datetime").unionByName(
        nulls.withColumn("datetime", F.lit("2024-01-02 05:00:00").cast("timestamp"))
    )
    nvn = {r["insight_date"].isoformat(): r["new_users_count"] for r in insights.new_visitors_by_day(today, s, 7).collect()}
    assert nvn["2024-01-02"] == 1  # a NULL host is never new


def test_page_and_exit_insights(spark):
    s = _sessions(spark, ROWS)
    ex = {(r["insight_date"].isoformat(), r["request_url"]): r for r in insights.exit_rates_by_day(s, "event_id").collect()}
    # day 0: exits a_0 at /x, b_0 at /x, b_1 at /x -> 3 exits of 3 hits
    assert ex[("2024-01-01", "/x")]["exit_rate"] == 100.0
    pi = insights.page_insights_by_day(s, 1, 1, tie_break="event_id").collect()
    assert {(r["insight_date"], r["query_type"]) for r in pi} == {
        ("2024-01-01", "Page_Hits"), ("2024-01-01", "Exit_Rate"), ("2024-01-02", "Page_Hits"), ("2024-01-02", "Exit_Rate")
    }
    top1 = {r["insight_date"]: r["request_url"] for r in pi if r["query_type"] == "Page_Hits"}
    assert top1 == {"2024-01-01": "/x", "2024-01-02": "/y"}  # /y has 2 hits on day 1


def test_country_and_site(spark):
    s = _sessions(spark, ROWS)
    c = insights.country_insights_by_day(s).collect()
    assert sorted((r["insight_date"], r["country_name"], r["page_request_count"]) for r in c) == [
        ("2024-01-01", "X", 3), ("2024-01-02", "X", 3)
    ]
    site = insights.site_insights(s).first()
    assert site["unique_visitor_count"] == 3 and site["user_session_count"] == 5 and site["page_views_count"] == 6
    assert site["avg_session_duration_sec"] == 1500  # (1200 + 1800) / 2
    top = insights.site_top_pages(s, 2).collect()
    assert [(r["request_url"], r["count_page_visit"]) for r in top] == [("/x", 3), ("/y", 2)]


def test_day_slice_prunes_partitions(spark, tmp_out):
    from hitscope.sinks.tables import write_partitioned

    s = _sessions(spark, ROWS).withColumns(
        {"year": F.year("datetime"), "month": F.month("datetime"), "day": F.dayofmonth("datetime")}
    )
    path = f"{tmp_out}/sessions"
    write_partitioned(s, path)
    stored = spark.read.parquet(path)
    one = insights.day_slice(stored, "2024-01-02")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "make_date" in plan
    assert one.count() == 3  # a at 00:10 and 05:33, c at 00:00:50
    assert insights.lookback_slice(stored, "2024-01-02", 1).count() == 3
    d = insights.daily_insights(stored, stored, "2024-01-02", 7, tie_break="event_id").first()
    assert d["user_session_count"] == 3 and d["new_users_count"] == 1


def test_hits_without_a_time_are_in_no_day(spark):
    s = _sessions(spark, ROWS + [("a", None, "/x", 7)])
    assert {r["insight_date"] for r in insights.country_insights_by_day(s).collect()} == {"2024-01-01", "2024-01-02"}
    assert all(r["insight_date"] for r in insights.daily_insights_all_days(s, tie_break="event_id").collect())
    assert all(r["insight_date"] for r in insights.page_insights_by_day(s, 9, 9, "event_id").collect())
    assert insights.site_insights(s).first()["page_views_count"] == 7


def test_own_history_equals_given_history(spark):
    rows = [(f"h{i % 5}", (i * 7919) % 40 * DAY + i, "/x", i) for i in range(120)]
    s = _sessions(spark, rows)
    for days in (0, 1, 7):
        a = insights.daily_insights_all_days(s, lookback_days=days, tie_break="event_id").collect()
        b = insights.daily_insights_all_days(s, s, lookback_days=days, tie_break="event_id").collect()
        assert sorted(map(str, a)) == sorted(map(str, b))


def test_plan_shapes(spark):
    s = _sessions(spark, ROWS)
    top = insights.top_k_by(insights.page_hits_by_day(s), ["insight_date"], "page_request_count", 2)
    top.collect()
    p = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p and "Partial" in p  # top-K cut before the shuffle
    daily = insights.daily_metrics(s, tie_break="event_id")
    daily.collect()
    q = daily._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in q and "Python" not in q
    pages = insights.page_insights_by_day(s, 3, 3, tie_break="event_id")
    pages.collect()
    assert "SortAggregate" not in pages._jdf.queryExecution().executedPlan().toString()


def test_crawler_day_and_equal_times(spark):
    # one session-day with many pages, and latest hits of the very same time
    rows = [("bot", i, f"/p{i % 300}", i) for i in range(900)]
    rows += [("tie", 100, "/a", 1000), ("tie", 100, "/c", 1001), ("tie", 100, "/b", 1002), ("tie", 50, "/c", 1003)]
    s = _sessions(spark, rows)
    ends = {r["request_url"]: (r["page_request_count"], r["count_last_visit"]) for r in insights.page_days(s, "event_id").collect()}
    assert len(ends) == 303 and sum(n for n, _ in ends.values()) == 904
    assert {u for u, (_, k) in ends.items() if k} == {"/p299", "/b"}
    larger = {r["request_url"] for r in insights.page_days(s).collect() if r["count_last_visit"]}
    assert larger == {"/p299", "/c"}
    days = insights.page_days(s, "event_id")
    plan = days._jdf.queryExecution().optimizedPlan().toString()
    assert "struct(request_url" in plan  # the window's third key keeps other pages apart


def test_last_pages_and_rollup_aggregate_hits_by_hash(spark):
    from hitscope.operators.sessions import session_rollup

    rows = [("a", 0, "/1", 1), ("a", 100, "/2", 2), ("a", 100, "/0", 3), ("b", None, "/x", 5), ("b", None, "/y", 4), (None, 7, "/n", 6)]
    s = _sessions(spark, rows)
    last = {r[0]: r[1] for r in insights.site_last_pages(s, "event_id").collect()}
    rolled = {r["session_id"]: (r["hits"], r["entry_page"], r["exit_page"]) for r in session_rollup(s, tie_break="event_id").collect()}
    assert {k: v[2] for k, v in rolled.items()} == last
    assert rolled["a_0"] == (3, "/1", "/0") and rolled["b_0"] == (2, "/y", "/x")
    for df in (insights.site_last_pages(s, "event_id"), session_rollup(s, tie_break="event_id")):
        plan = [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Aggregate(" in x]
        # from the top: text of pages, at last hits (and the summary of the sessioniser below them)
        over_pages = [x for x in plan if "last_visited_page" in x]
        assert "HashAggregate" in over_pages[-1] and "HashAggregate" in over_pages[-2]


def test_page_insights_read_the_hits_once_for_both_measures(spark):
    s = _sessions(spark, [("a", i * 50, f"/p{i % 7}", i) for i in range(100)] + [("b", 9, None, 500), ("b", 5, "/p1", 499)])
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")
    top = insights.page_insights_by_day(s, 3, 2, tie_break="event_id")
    assert scans(top) == scans(insights.page_days(s, "event_id")) > 0
    got = {k: [(r["request_url"], r["measure_value"]) for r in top.collect() if r["query_type"] == k] for k in ("Page_Hits", "Exit_Rate")}
    # 15 hits of /p0 and /p1 each (and one more of b), 14 of the others; a ends on /p1, b on no page
    assert sorted(got["Page_Hits"]) == [("/p0", 15.0), ("/p1", 16.0), ("/p2", 14.0)]
    assert got["Exit_Rate"] == [("/p1", 6.25)]


def test_page_days_from_session_pages(spark):
    rows = [("bot", i * 97, f"/p{i % 300}", i) for i in range(2000)]
    rows += [("tie", 100, "/a", 3000), ("tie", 100, "/c", 3001), ("tie", 100, "/b", 3002), ("tie", 50, "/c", 3003)]
    rows += [("nul", 7, None, 4000), ("nul", 7, "/x", 3999), (None, 8, "/x", 4001), (None, None, "/y", 4002), ("end", DAY - 5, None, 5000), ("end", DAY + 5, None, 5001)]
    s = _sessions(spark, rows)
    text = lambda df: sorted(str(r.asDict()) for r in df.collect())
    for tie in ("event_id", None):
        pages = insights.session_pages(s, tie_break=tie)
        rollup = insights.rollup_of_pages(pages)
        days = insights.page_days(s, tie)
        assert text(insights.page_days_of_pages(pages, rollup).select(days.columns)) == text(days)
        plain = insights.session_day_rollup(s, exits=False)
        assert text(rollup.select(plain.columns)) == text(plain)
