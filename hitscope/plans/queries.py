"""Registered queries: one per operator family of the inventory, each over
the whole shared test tables (through the adapter in
``hitscope.sources.testdata``).  Each takes ``(spark, sf_dir)`` and returns a
lazy DataFrame; the matching DuckDB SQL is in ``hitscope.plans.oracles``.

Queries that exercise sinks write under the session's shared checkpoint
folder (``spark.checkpoint.dir``) and return a read of what was written.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitscope import schemas
from hitscope.config import apply_runtime_conf, scratch_path
from hitscope.functions import depseudonymize, pseudonymize, timestamp_date_prefix
from hitscope.functions import patterns as P
from hitscope.operators import geo, insights, routing
from hitscope.operators.sessions import LAYOUT, session_rollup, sessionize_bucketed
from hitscope.operators.timecols import add_time_columns
from hitscope.plans import daily, jobs, refresh
from hitscope.plans.oracles import GAP_6H, GAP_30M, LOOKBACK_DAYS, RERUN_DAY, TOP_K, WINDOW_DAYS
from hitscope.sinks import tables
from hitscope.sources import testdata
from hitscope.sources.access_log import read_access_log, read_ip_ranges, read_session_hits, read_table, typed_ip_ranges

TB = "event_id"
HIT = "hit_no"  # orders the copies of a hit whose host has two countries, too
#: A key for the test log only, made for this repository.
DEMO_KEY = "aGl0c2NvcGUtZGVtby0wMQ=="

Query = Callable[[SparkSession, str], DataFrame]


# --- the shared tables as inputs ---------------------------------------------------
def _raw(spark: SparkSession, sf: str) -> DataFrame:
    apply_runtime_conf(spark)
    return testdata.access_log(spark, sf)


def _ranges(spark: SparkSession, sf: str) -> DataFrame:
    return testdata.ip_ranges(spark, sf)


def _routes(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return routing.route_logs(_raw(spark, sf), routing.PLAIN_HOSTS)


def _hosts(spark: SparkSession, sf: str) -> DataFrame:
    return geo.distinct_hosts(_routes(spark, sf)["page"]).select("host")


def _enriched(spark: SparkSession, sf: str, use_offset: bool = False) -> DataFrame:
    return jobs.preprocess(_raw(spark, sf), _ranges(spark, sf), routing.PLAIN_HOSTS, keep=[TB], use_offset=use_offset)["enriched"]


def _ordered_hits(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("country")
    second = c.isNull() | (c == P.UNKNOWN_SUFFIX_COUNTRY) | c.startswith("OVER,")
    return _enriched(spark, sf).withColumn(HIT, F.col(TB) * 2 + second.cast("int"))


def _sessions(spark: SparkSession, sf: str, gap: int, stored: bool = False, strategy: str = "chunked") -> DataFrame:
    """Sessions over the enriched log.  The chunked plan reads its input twice
    (hits and per-chunk summary), so the log is stored first; ``stored`` also
    stores the sessions, for outputs that read them several times."""
    enriched = _ordered_hits(spark, sf)
    if strategy == "chunked":
        enriched = jobs.materialize(enriched, "enriched")
    s = jobs.build_sessions(enriched, gap=gap, tie_break=HIT, strategy=strategy)
    return jobs.materialize(s, "sessions") if stored else s


# --- C1 ----------------------------------------------------------------------------
def route_counts(spark, sf):
    return routing.route_counts(_raw(spark, sf))


def rejected_hits(spark, sf):
    return routing.routed_output(_routes(spark, sf)["rejected"])


def page_hits(spark, sf):
    return routing.routed_output(_routes(spark, sf)["page"])


def non_page_hits(spark, sf):
    return routing.routed_output(_routes(spark, sf)["non_page"])


def null_hits(spark, sf):
    """Lines with a missing field."""
    return _routes(spark, sf)["null"]


def raw_log_roundtrip(spark, sf):
    """Write the hits as raw log text, scan it back with the log reader,
    quarantine and parse it."""
    path = scratch_path(spark, "raw-log")
    testdata.access_log_lines(_raw(spark, sf)).select("value").write.text(path)
    raw = read_access_log(spark, path)
    kept = routing.kept_hits(raw, routing.PLAIN_HOSTS)
    return add_time_columns(kept).select(
        "host", "raw_timestamp", "timezone", "request", "http_response_code", "bytes", "datetime"
    )


# --- C2 ----------------------------------------------------------------------------
def host_kind(spark, sf):
    return geo.host_kinds(_hosts(spark, sf))


def ip_to_int(spark, sf):
    return geo.numeric_hosts(_hosts(spark, sf)).select("host", "ip_int")


def pseudonymised_hosts(spark, sf):
    """F1 and its inverse: the host back from its pseudonym, the pseudonym's
    length, and whether the hits of a host share one pseudonym."""
    hits = _routes(spark, sf)["page"].select("host", pseudonymize("host", DEMO_KEY).alias("token"))
    return hits.groupBy("host").agg(
        F.min(depseudonymize("token", DEMO_KEY)).alias("back"),
        F.max(F.length("token")).alias("token_length"),
        (F.min("token") == F.max("token")).alias("same_token"),
    )


def ip_range_country(spark, sf):
    return geo.ip_range_country(geo.numeric_hosts(_hosts(spark, sf)), _ranges(spark, sf))


def ip_range_country_bucketed(spark, sf):
    ips = geo.numeric_hosts(_hosts(spark, sf))
    return geo.ip_range_country_bucketed(ips, _ranges(spark, sf)).select("host", "country")


def smallest_range_country(spark, sf):
    return geo.ip_range_country(geo.numeric_hosts(_hosts(spark, sf)), _ranges(spark, sf), overlap="smallest")


def ambiguous_hosts(spark, sf):
    return geo.ambiguous_hosts(geo.host_country_map(_routes(spark, sf)["page"], _ranges(spark, sf)))


def labelled_countries(spark, sf):
    tagged = geo.tag_country(_routes(spark, sf)["page"], _ranges(spark, sf), unknown_label="unknown")
    return tagged.select(TB, "country")


def ip_ranges_csv(spark, sf):
    """The dimension as a comma file and back (one name holds a comma)."""
    path = scratch_path(spark, "ip-ranges")
    _ranges(spark, sf).write.csv(path)
    return typed_ip_ranges(read_ip_ranges(spark, path))


def host_suffix_country(spark, sf):
    names = geo.named_hosts(_hosts(spark, sf))
    return geo.suffix_country(names, _ranges(spark, sf))


def country_tagged_hits(spark, sf):
    """C2 through the distinct hosts and their map."""
    tagged = geo.tag_country(_routes(spark, sf)["page"], _ranges(spark, sf))
    return tagged.select(TB, "encrypted_host", "request_url", "country")


def country_tagged_hits_direct(spark, sf):
    """C2 in the form that a stream runs: every hit meets the lookups."""
    tagged = geo.tag_country_direct(_routes(spark, sf)["page"], _ranges(spark, sf))
    return tagged.select(TB, "encrypted_host", "request_url", "country")


def country_tagged_hits_shuffle(spark, sf):
    """C2 on the enriched log's own columns, after the map join."""
    return _enriched(spark, sf).select(TB, "encrypted_host", "request_url", "country")


# --- C3 / C4 -----------------------------------------------------------------------------
def time_columns(spark, sf):
    return _enriched(spark, sf).select(*schemas.ENRICHED_FIELDS, TB)


def time_columns_with_offset(spark, sf):
    """F8 reading the logged offset instead of the session zone."""
    return _enriched(spark, sf, use_offset=True).select(*schemas.ENRICHED_FIELDS, TB)


def date_prefix(spark, sf):
    """the date part of the stored time text."""
    return _enriched(spark, sf).select(TB, timestamp_date_prefix(F.col("datetime").cast("string")).alias("date_text"))


def partitioned_rewrite(spark, sf):
    """C4: write the enriched log partitioned by year/month/day, rerun one
    day (dynamic overwrite replaces just that day), read everything back."""
    path = scratch_path(spark, "partitioned-log")
    enriched = _enriched(spark, sf)
    tables.write_partitioned(enriched, path, sort_cols=["encrypted_host", "datetime"])
    rerun = enriched.where(
        (F.col("year") == 2024) & (F.col("month") == 1) & (F.col("day") == 1)
    )
    tables.write_partitioned(rerun, path, sort_cols=["encrypted_host", "datetime"])
    back = spark.read.parquet(path)
    return back.select(*schemas.ENRICHED_FIELDS, TB)


# --- C5 ------------------------------------------------------------------------------
def gaps_and_flags(spark, sf):
    return _sessions(spark, sf, GAP_30M).select(TB, "encrypted_host", "session_time_difference", "is_new_session")


def session_hits_30m(spark, sf):
    return _sessions(spark, sf, GAP_30M).select(*schemas.SESSION_FIELDS, TB)


def session_hits_30m_window(spark, sf):
    """C5 with the direct window plan (one shuffle on host), for comparison
    with the default skew-proof chunked plan."""
    return _sessions(spark, sf, GAP_30M, strategy="window").select(*schemas.SESSION_FIELDS, TB)


def session_hits_30m_chunked(spark, sf):
    """C5 with the skew-proof chunked plan."""
    return _sessions(spark, sf, GAP_30M, strategy="chunked").select(*schemas.SESSION_FIELDS, TB)


def session_hits_6h_chunked(spark, sf):
    return _sessions(spark, sf, GAP_6H, strategy="chunked").select(*schemas.SESSION_FIELDS, TB)


def session_hits_6h(spark, sf):
    return _sessions(spark, sf, GAP_6H).select(*schemas.SESSION_FIELDS, TB)


def session_rollup_q(spark, sf):
    return session_rollup(_sessions(spark, sf, GAP_6H), tie_break=TB)


# --- C6 - C10 ------------------------------------------------------------------------------
def _metrics(spark, sf, gap):
    m = insights.daily_metrics(_sessions(spark, sf, gap), tie_break=TB)
    return m.withColumn("insight_date", F.date_format("insight_date", "yyyy-MM-dd"))


def unique_visitors(spark, sf):
    return _metrics(spark, sf, GAP_30M).select("insight_date", "unique_visitor_count")


def user_sessions(spark, sf):
    return _metrics(spark, sf, GAP_30M).select("insight_date", "user_session_count")


def page_views(spark, sf):
    return _metrics(spark, sf, GAP_30M).select("insight_date", "page_views_count")


def avg_session_duration(spark, sf):
    return _metrics(spark, sf, GAP_6H).select("insight_date", "avg_session_duration", "avg_session_duration_sec")


def bounce_rate(spark, sf):
    return _metrics(spark, sf, GAP_6H).select("insight_date", "bounce_count", "user_session_count", "bounce_rate")


def top_pages(spark, sf):
    hits = insights.page_hits_by_day(_sessions(spark, sf, GAP_30M))
    top = insights.top_k_by(hits, ["insight_date"], "page_request_count", TOP_K)
    return top.select(F.date_format("insight_date", "yyyy-MM-dd").alias("insight_date"), "request_url", "page_request_count")


def country_traffic(spark, sf):
    return insights.country_insights_by_day(_sessions(spark, sf, GAP_30M))


def last_page_per_session(spark, sf):
    return insights.site_last_pages(_sessions(spark, sf, GAP_6H), tie_break=TB)


def exit_rates(spark, sf):
    e = insights.exit_rates_by_day(_sessions(spark, sf, GAP_6H, stored=True), tie_break=TB)
    return e.select(
        F.date_format("insight_date", "yyyy-MM-dd").alias("insight_date"),
        "request_url",
        "count_last_visit",
        "page_request_count",
        "exit_rate",
    )


def page_insights(spark, sf):
    return insights.page_insights_by_day(_sessions(spark, sf, GAP_30M, stored=True), TOP_K, TOP_K, tie_break=TB)


def page_insights_6h(spark, sf):
    return insights.page_insights_by_day(_sessions(spark, sf, GAP_6H, stored=True), TOP_K, TOP_K, tie_break=TB)


def new_visitors(spark, sf):
    s = _sessions(spark, sf, GAP_30M, stored=True)
    nv = insights.new_visitors_by_day(s, s, LOOKBACK_DAYS)
    return nv.select(F.date_format("insight_date", "yyyy-MM-dd").alias("insight_date"), "new_users_count")


def daily_insights(spark, sf):
    return insights.daily_insights_all_days(_sessions(spark, sf, GAP_30M, stored=True), lookback_days=LOOKBACK_DAYS, tie_break=TB)


def daily_insights_6h(spark, sf):
    return insights.daily_insights_all_days(_sessions(spark, sf, GAP_6H, stored=True), lookback_days=LOOKBACK_DAYS, tie_break=TB)


def country_insights(spark, sf):
    return insights.country_insights_by_day(_sessions(spark, sf, GAP_30M))


def country_rank(spark, sf):
    """O1: the countries of each day in order."""
    return insights.ranked_countries_by_day(_sessions(spark, sf, GAP_30M))


def site_insights(spark, sf):
    return insights.site_insights(_sessions(spark, sf, GAP_30M), tie_break=TB)


def site_top_pages(spark, sf):
    return insights.site_top_pages(_sessions(spark, sf, GAP_6H), TOP_K)


def site_top_exits(spark, sf):
    return insights.site_top_exits(_sessions(spark, sf, GAP_6H, stored=True), TOP_K, tie_break=TB)


# --- C11 / C12 -----------------------------------------------------------------------------
def _published(spark, sf) -> str:
    """C11: publish the three tables for every day from stored sessions, then
    run a day in the middle again as the daily job does: its own slice, with
    the sessions of the days before as history."""
    root, store = scratch_path(spark, "published"), scratch_path(spark, "session-history")
    tables.write_sessions(_sessions(spark, sf, GAP_30M), store, keep=[TB])
    s = spark.read.parquet(store)
    daily = insights.daily_insights_all_days(s, lookback_days=LOOKBACK_DAYS, tie_break=TB)
    pages = insights.page_insights_by_day(s, TOP_K, TOP_K, tie_break=TB)
    countries = insights.country_insights_by_day(s)
    tables.publish_insights(daily, pages, countries, root)
    today = insights.day_slice(s, RERUN_DAY)
    tables.publish_insights(
        insights.daily_insights(s, s, RERUN_DAY, LOOKBACK_DAYS, tie_break=TB),
        insights.page_insights_by_day(today, TOP_K, TOP_K, tie_break=TB),
        insights.country_insights_by_day(today),
        root,
        dates=[RERUN_DAY],
    )
    return root


def publish_rerun(spark, sf):
    """C11: the daily table after the rerun."""
    return tables.read_published(spark, _published(spark, sf), "daily_insights").select(*schemas.DAILY_INSIGHTS_FIELDS)


def published_tables(spark, sf):
    """C11: all three tables after the rerun, as (table, day, key, measure)."""
    root = _published(spark, sf)
    read = lambda t: tables.read_published(spark, root, t)
    shape = lambda t, df, key, value: df.select(F.lit(t).alias("table_name"), "insight_date", key.alias("key"), value.cast("double").alias("measure"))
    daily = shape("daily_insights", read("daily_insights"), F.lit("new_users_count"), F.col("new_users_count"))
    pages = shape("page_insights", read("page_insights"), F.concat_ws(" ", "query_type", "request_url"), F.col("measure_value"))
    return daily.unionByName(pages).unionByName(
        shape("country_insights", read("country_insights"), F.col("country_name"), F.col("page_request_count"))
    )


def session_history(spark, sf):
    """Sessions stored by day, read back with their declared schema as
    the input and the history of the daily table."""
    store = scratch_path(spark, "session-history")
    tables.write_sessions(_sessions(spark, sf, GAP_30M), store)
    s = read_session_hits(spark, store)
    return insights.daily_insights_all_days(s, s, lookback_days=LOOKBACK_DAYS)


def session_csv_scan(spark, sf):
    """S3: session hits as a comma file and back."""
    path = scratch_path(spark, "session-csv")
    tables.write_routed({"session": _sessions(spark, sf, GAP_30M)}, path)
    spark.read.parquet(f"{path}/session").write.csv(f"{path}/csv")
    return read_session_hits(spark, f"{path}/csv", fmt="csv")


def managed_table(spark, sf):
    """The enriched log as a managed, partitioned catalog table, one
    day of it written again, scanned by name."""
    db = f"hitscope_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'catalog')}'")
    enriched = _enriched(spark, sf).select(*schemas.ENRICHED_FIELDS[:8], TB, *tables.LOG_PARTITIONS)
    tables.save_partitioned_table(enriched, f"{db}.log")
    tables.save_partitioned_table(insights.day_slice(enriched, RERUN_DAY), f"{db}.log")
    return read_table(spark, f"{db}.log").select(*schemas.ENRICHED_FIELDS, TB)


#: Buckets of the stored log; a cluster takes about one for each 200 MB of hits.
BUCKETS = 16


def _bucketed(spark, hits: DataFrame, tie: str):
    db = f"hitscope_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'catalog')}'")
    tables.save_bucketed_log(hits, f"{db}.log", BUCKETS, sort_cols=["datetime", tie], tie_break=tie)
    return tables.read_bucketed_log(spark, f"{db}.log")


def session_hits_bucketed(spark, sf):
    """C5 over a log stored by (host, chunk) buckets: no exchange of hits."""
    log, width = _bucketed(spark, _ordered_hits(spark, sf), HIT)
    return sessionize_bucketed(log, width, gap=GAP_30M, tie_break=HIT).select(*schemas.SESSION_FIELDS, TB)


def country_tagged_hits_bucketed(spark, sf):
    """J3, C2 over a log stored by (host, chunk) buckets: no exchange of hits."""
    pages = add_time_columns(_routes(spark, sf)["page"]).select("host", "encrypted_host", "datetime", "epoch", "request_url", TB)
    log, _ = _bucketed(spark, pages, TB)
    return geo.tag_country_bucketed(log, _ranges(spark, sf), LAYOUT).select(TB, "encrypted_host", "request_url", "country")


def external_tables(spark, sf):
    """A table with a declared schema over the partitioned log folder."""
    path, db = scratch_path(spark, "external"), f"hitscope_{uuid.uuid4().hex[:10]}"
    tables.write_partitioned(_enriched(spark, sf).select(*schemas.ENRICHED_FIELDS), path, sort_cols=["encrypted_host", "datetime"])
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'catalog')}'")
    t = tables.create_external_table(spark, f"{db}.log", path, schemas.ENRICHED_LOG, tables.LOG_PARTITIONS)
    return t.select(*schemas.ENRICHED_FIELDS)


def land_new_days(spark, sf):
    """Raw log text per day; the first run lands the first week, a run
    that failed leaves half a day, the next one lands that day and the rest,
    a rerun lands nothing; read back per day."""
    src, dst = scratch_path(spark, "log-src"), scratch_path(spark, "log-landed")
    time = F.try_to_timestamp(F.substring(F.col("value"), F.instr("value", "[") + 1, 20), F.lit(P.TIMESTAMP_FORMAT))
    lines = (
        testdata.access_log_lines(_raw(spark, sf))
        .select("value", F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit("unknown")).alias("day"))
    )
    first_week = F.col("day") <= "2024-01-07"
    lines.where(first_week).write.partitionBy("day").text(src)
    tables.land_new_days(spark, src, dst)
    lines.where(~first_week).write.mode("append").partitionBy("day").text(src)
    lines.where("day = '2024-01-08' and length(value) % 2 = 0").write.mode("append").partitionBy("day").text(dst)
    tables.land_new_days(spark, src, dst)
    if tables.land_new_days(spark, src, dst):
        raise AssertionError("a rerun landed a day again")
    back = spark.read.schema("value string, day string").text(dst)
    return back.groupBy("day").agg(F.count(F.lit(1)).alias("lines"))


# --- a new day from carried state --------------------------------------------------------
#: The month up to here is one run; each day after it is a run of its own.
FIRST_RUN = ("2024-01-01", "2024-01-23")
DAILY_RUNS = [f"2024-01-{d}" for d in range(24, 32)]


def _daily_log(spark, sf) -> DataFrame:
    path = scratch_path(spark, "daily-log")
    tables.write_partitioned(_ordered_hits(spark, sf), path)
    return spark.read.parquet(path)


def session_hits_incremental(spark, sf):
    """C5 day by day: each run reads one day of the log and the state."""
    log, store = _daily_log(spark, sf), scratch_path(spark, "daily-store")
    for first, last in ((daily.NO_DAY, daily.NO_DAY), FIRST_RUN, *((d, d) for d in DAILY_RUNS)):
        daily.run_days(spark, log, store, first, last, gap=GAP_30M, tie_break=HIT, keep=[TB])
    return spark.read.parquet(f"{store}/sessions").select(*schemas.SESSION_FIELDS, TB)


def new_visitors_incremental(spark, sf):
    """C9 day by day: each run reads one day and the last-seen table."""
    log, store = _daily_log(spark, sf), scratch_path(spark, "daily-store")
    daily.start_new_visitors(spark, log, store, *FIRST_RUN, LOOKBACK_DAYS)
    for d in DAILY_RUNS:
        daily.count_new_visitors(spark, log, store, d, LOOKBACK_DAYS)
    return tables.read_published(spark, store, "new_visitors").where("new_users_count > 0").select("insight_date", "new_users_count")


def window_visitors(spark, sf):
    """A1 from published sketches: the visitors of every 7 days, and whether
    the estimate lies within 3 % of their exact number."""
    s = _sessions(spark, sf, GAP_30M, stored=True)
    root = scratch_path(spark, "sketches")
    tables.publish(insights.visitor_sketches_by_day(s), f"{root}/visitor_sketches")
    estimate = insights.window_visitors(tables.read_published(spark, root, "visitor_sketches"), WINDOW_DAYS)
    host_days = insights.with_day(s).select(insights.HOST, "insight_date").distinct()
    ends = F.explode(F.sequence("insight_date", F.date_add("insight_date", WINDOW_DAYS - 1)))
    exact = (
        host_days.select(insights.HOST, ends.alias("end"))
        .groupBy(F.date_format("end", "yyyy-MM-dd").alias("window_end")).agg(F.count_distinct(insights.HOST).alias("exact_visitors"))
    )
    near = F.abs(F.col("visitors") - F.col("exact_visitors")) <= 0.03 * F.col("exact_visitors")
    return estimate.join(exact, "window_end").select("window_end", "exact_visitors", near.alias("within_3_percent"))


def country_upsert(spark, sf):
    """S10 by key: half of one day's countries get new numbers, and one country
    is new; the rest of that day and all other days stay."""
    root = scratch_path(spark, "upsert")
    path = f"{root}/country_insights"
    tables.publish(insights.country_insights_by_day(_sessions(spark, sf, GAP_30M)), path)
    day = tables.read_published(spark, root, "country_insights").where(F.col("insight_date") == RERUN_DAY)
    half = day.where("length(coalesce(country_name, '')) % 2 = 0").withColumn("page_request_count", F.col("page_request_count") + 1000)
    new = spark.range(1).select(
        F.lit(RERUN_DAY).alias("insight_date"), F.lit("Nowhere").alias("country_name"), F.lit(1).cast("bigint").alias("page_request_count")
    )
    tables.upsert(half.unionByName(new), path, ["country_name"])
    return tables.read_published(spark, root, "country_insights").select(*schemas.COUNTRY_INSIGHTS_FIELDS)


def ordered_sessions(spark, sf):
    """Sessions in one total order over all files, read back by place."""
    path = scratch_path(spark, "ordered")
    s = _sessions(spark, sf, GAP_30M).select(*schemas.SESSION_FIELDS, TB, HIT)
    tables.write_ordered(s, path, ["encrypted_host", "datetime", HIT], files=16)
    return tables.read_ordered(spark, path).select("position", "encrypted_host", "datetime", TB, "session_id", "request_url")


def routed_tables(spark, sf):
    """All six routes through the sink, a catalog table over each, and
    the rows and distinct first columns of each table."""
    path, db = scratch_path(spark, "routed"), f"hitscope_{uuid.uuid4().hex[:10]}"
    routes = _routes(spark, sf)
    enriched = jobs.materialize(_ordered_hits(spark, sf), "enriched")
    routes |= {"enriched": enriched, "session": jobs.build_sessions(enriched, gap=GAP_30M, tie_break=HIT)}
    tables.write_routed(routes, path)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'catalog')}'")
    routed = T.StructType([T.StructField(c, T.StringType()) for c in schemas.ROUTED_FIELDS])
    shapes = {
        "null": schemas.ACCESS_LOG, "rejected": routed, "page": routed, "non_page": routed,
        "enriched": schemas.ENRICHED_LOG, "session": schemas.SESSION_HITS,
    }
    counts = []
    for route, shape in shapes.items():
        t = tables.create_external_table(spark, f"{db}.{route}_hits", f"{path}/{route}", shape)
        first = shape.fields[0].name
        counts.append(t.agg(F.lit(route).alias("route"), F.count(F.lit(1)).alias("hits"), F.count_distinct(first).alias("hosts")))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def sql_functions(spark, sf):
    """F1-F5 and sessions as SQL text only: scalar functions and a table
    function over the enriched log's view."""
    from hitscope.plans.sql import register_functions, register_session_function

    tag = uuid.uuid4().hex[:8]
    register_functions(spark, f"f{tag}_")
    jobs.materialize(_ordered_hits(spark, sf), "enriched").createOrReplaceTempView(f"hits_{tag}")
    register_session_function(spark, f"sessions_{tag}", f"hits_{tag}", tie_break=HIT)
    return spark.sql(f"""
        SELECT {TB}, session_id, page_count,
               f{tag}_pseudonym_host(f{tag}_pseudonym(encrypted_host, '{DEMO_KEY}'), '{DEMO_KEY}') AS host_back,
               f{tag}_request_resource(request) AS resource,
               CASE WHEN encrypted_host RLIKE '^[0-9.]+$' THEN f{tag}_ipv4_to_long(encrypted_host) END AS ip_int,
               f{tag}_host_suffix(encrypted_host) AS suffix,
               f{tag}_date_prefix(cast(datetime AS STRING)) AS date_text
        FROM sessions_{tag}({GAP_30M})""")


# --- after a day has changed ---------------------------------------------------------------
def _refreshed(spark, sf) -> str:
    """The log lands with half of one day; the insight tables are built; then
    the whole day lands and only what it touches is computed again."""
    path, store = scratch_path(spark, "refresh-log"), scratch_path(spark, "refresh-store")
    hits = jobs.materialize(_ordered_hits(spark, sf), "enriched")
    half = (F.to_date("datetime") == F.lit(RERUN_DAY).cast("date")) & (F.col(TB) % 2 == 0)
    tables.write_partitioned(hits.where(~F.coalesce(half, F.lit(False))), path)
    run = lambda: refresh.refresh(spark, path, store, LOOKBACK_DAYS, TOP_K, TOP_K, gap=GAP_30M, tie_break=HIT)
    run()
    tables.write_partitioned(insights.day_slice(hits, RERUN_DAY), path)
    done = run()
    if done["changed"] not in ([], [RERUN_DAY]) or len(done["read"]) > 3 or run()["changed"]:
        raise AssertionError(f"days that did not change were read: {done}")
    return store


def daily_insights_refreshed(spark, sf):
    """C6 after one day has landed again: that day, the next and the lookback."""
    return tables.read_published(spark, _refreshed(spark, sf), "daily_insights").select(*schemas.DAILY_INSIGHTS_FIELDS)


def page_insights_refreshed(spark, sf):
    """C7 after one day has landed again."""
    return tables.read_published(spark, _refreshed(spark, sf), "page_insights").select(*schemas.PAGE_INSIGHTS_FIELDS)


def country_insights_refreshed(spark, sf):
    """C8 after one day has landed again."""
    return tables.read_published(spark, _refreshed(spark, sf), "country_insights").select(*schemas.COUNTRY_INSIGHTS_FIELDS)


def land_late_files(spark, sf):
    """C12 by file: a week lands, then the rest of the month together with late
    files of landed days, then nothing; lines per day."""
    src, dst = scratch_path(spark, "log-src"), scratch_path(spark, "log-landed")
    time = F.try_to_timestamp(F.substring(F.col("value"), F.instr("value", "[") + 1, 20), F.lit(P.TIMESTAMP_FORMAT))
    lines = (
        testdata.access_log_lines(_raw(spark, sf))
        .select("value", F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit("unknown")).alias("day"))
    )
    early = (F.col("day") <= "2024-01-07") & (F.length("value") % 4 != 0)
    lines.where(early).write.partitionBy("day").text(src)
    first = tables.land_new_files(spark, src, dst)
    lines.where(~early).write.mode("append").partitionBy("day").text(src)
    second = tables.land_new_files(spark, src, dst)
    if set(first) & set(second) or tables.land_new_files(spark, src, dst):
        raise AssertionError("a file landed twice")
    return tables.read_landed_files(spark, dst).groupBy("day").agg(F.count(F.lit(1)).alias("lines"))


_QUERIES: dict[str, Query] = {
    "route_counts": route_counts,
    "rejected_hits": rejected_hits,
    "page_hits": page_hits,
    "non_page_hits": non_page_hits,
    "null_hits": null_hits,
    "raw_log_roundtrip": raw_log_roundtrip,
    "host_kind": host_kind,
    "ip_to_int": ip_to_int,
    "pseudonymised_hosts": pseudonymised_hosts,
    "ip_range_country": ip_range_country,
    "ip_range_country_bucketed": ip_range_country_bucketed,
    "smallest_range_country": smallest_range_country,
    "ambiguous_hosts": ambiguous_hosts,
    "labelled_countries": labelled_countries,
    "ip_ranges_csv": ip_ranges_csv,
    "host_suffix_country": host_suffix_country,
    "country_tagged_hits": country_tagged_hits,
    "country_tagged_hits_direct": country_tagged_hits_direct,
    "country_tagged_hits_shuffle": country_tagged_hits_shuffle,
    "time_columns": time_columns,
    "time_columns_with_offset": time_columns_with_offset,
    "date_prefix": date_prefix,
    "gaps_and_flags": gaps_and_flags,
    "session_hits_30m": session_hits_30m,
    "session_hits_30m_window": session_hits_30m_window,
    "session_hits_30m_chunked": session_hits_30m_chunked,
    "session_hits_6h_chunked": session_hits_6h_chunked,
    "session_hits_6h": session_hits_6h,
    "session_rollup": session_rollup_q,
    "unique_visitors": unique_visitors,
    "user_sessions": user_sessions,
    "page_views": page_views,
    "avg_session_duration": avg_session_duration,
    "bounce_rate": bounce_rate,
    "top_pages": top_pages,
    "country_traffic": country_traffic,
    "last_page_per_session": last_page_per_session,
    "exit_rates": exit_rates,
    "page_insights": page_insights,
    "page_insights_6h": page_insights_6h,
    "new_visitors": new_visitors,
    "daily_insights": daily_insights,
    "daily_insights_6h": daily_insights_6h,
    "country_insights": country_insights,
    "country_rank": country_rank,
    "site_insights": site_insights,
    "site_top_pages": site_top_pages,
    "site_top_exits": site_top_exits,
    "partitioned_rewrite": partitioned_rewrite,
    "publish_rerun": publish_rerun,
    "published_tables": published_tables,
    "session_history": session_history,
    "session_csv_scan": session_csv_scan,
    "managed_table": managed_table,
    "session_hits_bucketed": session_hits_bucketed,
    "country_tagged_hits_bucketed": country_tagged_hits_bucketed,
    "external_tables": external_tables,
    "land_new_days": land_new_days,
    "land_late_files": land_late_files,
    "session_hits_incremental": session_hits_incremental,
    "new_visitors_incremental": new_visitors_incremental,
    "daily_insights_refreshed": daily_insights_refreshed,
    "page_insights_refreshed": page_insights_refreshed,
    "country_insights_refreshed": country_insights_refreshed,
    "window_visitors": window_visitors,
    "country_upsert": country_upsert,
    "ordered_sessions": ordered_sessions,
    "routed_tables": routed_tables,
    "sql_functions": sql_functions,
}


def _wrap(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime_conf(spark)
        return fn(spark, os.path.abspath(sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Query]:
    return {k: _wrap(v) for k, v in _QUERIES.items()}


# --- S5 and the file-stream form --------------------------------------------------------
def session_hits_sql(spark, sf):
    """The same sessions through a temp view and SQL text."""
    from hitscope.plans.sql import sessionize_sql

    return sessionize_sql(spark, _ordered_hits(spark, sf), GAP_30M, tie_break=HIT).select(*schemas.SESSION_FIELDS, TB)


def session_view_sql(spark, sf):
    """SQL over the chunked sessions' view: the last hit of each session."""
    from hitscope.plans.sql import register_sessions

    view = f"sessions_{uuid.uuid4().hex[:10]}"
    register_sessions(jobs.materialize(_ordered_hits(spark, sf), "enriched"), view, GAP_30M, tie_break=HIT)
    return spark.sql(f"SELECT session_id, max(page_count) AS pages, count(*) AS hits FROM {view} GROUP BY session_id")


def streamed_enriched_log(spark, sf):
    """The enriched log built incrementally from raw log files: the first
    run processes the first half of the month, the second run only the files
    that arrived after it, a third run nothing."""
    from hitscope.streaming.incremental import run_incremental

    src = scratch_path(spark, "stream-src")
    out = scratch_path(spark, "stream-out")
    ckpt = scratch_path(spark, "stream-ckpt")
    lines = testdata.access_log_lines(_raw(spark, sf))
    day = F.substring(F.col("value"), F.instr("value", "[") + 1, 2).cast("int")
    ranges = _ranges(spark, sf)
    lines.where(day <= 15).select("value").write.text(f"{src}/part-1")
    run_incremental(spark, f"{src}/*", ranges, out, ckpt, routing.PLAIN_HOSTS)
    lines.where(day > 15).select("value").write.text(f"{src}/part-2")  # and the times that do not parse
    run_incremental(spark, f"{src}/*", ranges, out, ckpt, routing.PLAIN_HOSTS)
    run_incremental(spark, f"{src}/*", ranges, out, ckpt, routing.PLAIN_HOSTS)
    return spark.read.parquet(out).select(*schemas.ENRICHED_FIELDS)


_QUERIES["session_hits_sql"] = session_hits_sql
_QUERIES["session_view_sql"] = session_view_sql
_QUERIES["streamed_enriched_log"] = streamed_enriched_log
