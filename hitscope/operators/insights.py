"""Daily site, page and country insights and whole-file insights.

The original computed each daily number with its own action (seven driver
round trips, one of them collecting every historical host).  Here every
insight is a lazy aggregate over one *session-day rollup*: one row per
``(day, session)`` with its hits, duration and exit page, built with
map-side combined aggregates.  All days are computed at once; a single
day is the same plan with a day filter.

Semantics kept from the original:

* The day slice comes first (D26): a session crossing midnight counts on
  both days, and a bounce is a session with exactly one hit *that day*.
* Duration sums the gaps ``<= duration_gap`` (default 1800 s, the same
  number that opens a session, so a gap of exactly 1800 s does both);
  sessions without such a gap are left out of the average.
* Average duration in minutes at 2 decimals (HALF_UP) and, as the
  whole-file job reported it, in whole seconds.
* A hit whose time does not parse belongs to no day, so it is in no daily
  table (the original's day filter leaves it out as well).
* Unique visitors and sessions count a NULL key once, as ``SELECT
  DISTINCT`` does.
* Top-K ties are broken by URL ascending; the exit page of a session-day is
  the running last page of its latest hit.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitscope import schemas
from hitscope.functions import distinct_with_null, percent
from hitscope.functions import patterns as P
from hitscope.operators.sessions import order_number

HOST = "encrypted_host"


def _order_key(tie_break: str | None) -> Column:
    return F.struct(F.col("datetime"), F.col(tie_break)) if tie_break else F.col("datetime")


def with_day(sessions: DataFrame) -> DataFrame:
    """F16: the hit's calendar day (session time zone); hits without a time
    have no day and are left out."""
    return sessions.where(F.col("datetime").isNotNull()).withColumn("insight_date", F.col("datetime").cast("date"))


def _stored_day(df: DataFrame) -> Column | None:
    """The day as given by ``year``/``month``/``day`` columns, when present.
    These are derived from ``datetime``, so filtering on them selects the same
    rows; on a table partitioned by them it becomes a partition filter and
    other days are never read."""
    if {"year", "month", "day"} <= set(df.columns):
        return F.make_date("year", "month", "day")
    return None


def day_slice(sessions: DataFrame, date: str | _dt.date) -> DataFrame:
    """Hits of one day."""
    d = F.lit(date).cast("date")
    cond = F.col("datetime").cast("date") == d
    stored = _stored_day(sessions)
    return sessions.where(cond if stored is None else cond & (stored == d))


def lookback_slice(sessions: DataFrame, date: str | _dt.date, days: int) -> DataFrame:
    """P15 + F14: hits in ``[date - days, date)``."""
    d = F.lit(date).cast("date")
    day = F.col("datetime").cast("date")
    cond = (day >= F.date_sub(d, days)) & (day < d)
    stored = _stored_day(sessions)
    if stored is not None:
        cond = cond & (stored >= F.date_sub(d, days)) & (stored < d)
    return sessions.where(cond)


def session_day_rollup(
    sessions: DataFrame,
    duration_gap: int = P.DURATION_GAP_SECONDS,
    tie_break: str | None = None,
    exits: bool = True,
) -> DataFrame:
    """One row per ``(insight_date, session_id)``: host, hits, duration and,
    if asked for, the exit page (W6 as ``max_by`` over the time order; its text
    buffer makes Spark sort, so metrics that do not need it leave it out)."""
    td = F.col("session_time_difference")
    # The host is fixed per session, so it is a grouping key rather than a
    # string aggregate buffer: the metrics then aggregate by hash, not by sort.
    return (
        with_day(sessions)
        .groupBy("insight_date", "session_id", HOST)
        .agg(
            F.count(F.lit(1)).alias("hits"),
            F.sum(F.when(td <= duration_gap, td)).alias("duration"),
            *([F.max_by("last_visited_page", _order_key(tie_break)).alias("exit_page")] if exits else []),
        )
    )


def _site_metrics(rollup: DataFrame) -> list[Column]:
    """A1 A2 A3 A8 A9 A10 over session(-day) rollup rows."""
    sessions = F.count(F.lit(1))
    bounces = F.count_if(F.col("hits") == 1)
    avg = F.avg("duration")
    return [
        distinct_with_null(HOST).alias("unique_visitor_count"),
        sessions.alias("user_session_count"),
        F.round(avg / 60, 2).alias("avg_session_duration"),
        F.round(avg, 0).cast("bigint").alias("avg_session_duration_sec"),
        F.coalesce(F.sum("hits"), F.lit(0)).cast("bigint").alias("page_views_count"),
        bounces.alias("bounce_count"),
        percent(bounces, sessions).alias("bounce_rate"),
    ]


def daily_metrics(sessions: DataFrame, duration_gap: int = P.DURATION_GAP_SECONDS, tie_break: str | None = None) -> DataFrame:
    """Per day: the site metrics of the daily table except new users."""
    r = session_day_rollup(sessions, duration_gap, tie_break, exits=False)
    return r.groupBy("insight_date").agg(*_site_metrics(r))


# --- visitors of any window, from stored sketches (A1) ------------------------------
SKETCH_LOG_K = 14  # 16384 registers: a standard error of 0.8 %


def visitor_sketches_by_day(sessions: DataFrame, log_k: int = SKETCH_LOG_K) -> DataFrame:
    """A1 in its approximate form: per day one mergeable HyperLogLog sketch of
    its hosts (a NULL host counts once), small enough to be published beside the
    daily numbers."""
    host = F.coalesce(F.concat(F.lit("="), F.col(HOST)), F.lit(""))
    return (
        with_day(sessions).groupBy("insight_date").agg(F.hll_sketch_agg(host, F.lit(log_k)).alias("visitor_sketch"))
        .withColumn("insight_date", F.date_format("insight_date", "yyyy-MM-dd"))
    )


def window_visitors(sketches: DataFrame, days: int) -> DataFrame:
    """Estimated distinct visitors of the ``days`` days up to each day that has
    a sketch.  Reads sketches only, one row per day: each is handed to the
    windows that it lies in, and a window's sketches are merged."""
    d = F.col("insight_date").cast("date")
    windows = F.transform(F.sequence(d, F.date_add(d, days - 1)), lambda x: F.date_format(x, "yyyy-MM-dd"))
    ends = sketches.select(F.col("insight_date").alias("end"))
    each = sketches.select("visitor_sketch", F.explode(windows).alias("end"))
    merged = each.join(ends, "end", "left_semi").groupBy("end").agg(F.hll_union_agg("visitor_sketch").alias("s"))
    return merged.select(F.col("end").alias("window_end"), F.hll_sketch_estimate("s").alias("visitors"))


def new_visitors_by_day(
    today: DataFrame,
    history: DataFrame,
    lookback_days: int,
) -> DataFrame:
    """C9 for every day of ``today``: hosts seen that day and not in
    ``history`` during ``[day - lookback_days, day)``.  Days without new hosts
    report 0.  A NULL host is never new; an empty history makes every host
    new.

    Both sides are first reduced to distinct ``(host, day)`` rows.  Instead
    of comparing every day of a host with every earlier day (a range join),
    one window per host in day order carries the latest history day before
    each day: the host is new when that day is missing or older than the
    lookback.  Work per host grows with its number of days, never with the
    square of it.  (The single-day form is a plain left anti join on host.)"""
    t = _host_days(with_day(today)).withColumn("_hist", F.lit(0))
    h = _host_days(with_day(history)).withColumn("_hist", F.lit(1))
    # today rows sort before history rows of the same day, so the frame of a
    # today row holds only history days strictly before it
    w = (
        Window.partitionBy(HOST)
        .orderBy("insight_date", "_hist")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    prev = F.last(F.when(F.col("_hist") == 1, F.col("insight_date")), ignorenulls=True).over(w)
    marked = t.unionByName(h).withColumn("_prev_seen", prev).where(F.col("_hist") == 0)
    return _count_new(marked, lookback_days)


def _host_days(days: DataFrame) -> DataFrame:
    return days.where(F.col(HOST).isNotNull()).select(HOST, "insight_date").distinct()


def _count_new(marked: DataFrame, lookback_days: int) -> DataFrame:
    seen = F.col("_prev_seen")
    is_new = seen.isNull() | (seen < F.date_sub(F.col("insight_date"), lookback_days))
    return marked.groupBy("insight_date").agg(F.count_if(is_new).cast("bigint").alias("new_users_count"))


def own_new_visitors_by_day(rollup: DataFrame, lookback_days: int) -> DataFrame:
    """C9 where the history is the same table: the host-days of the session-day
    rollup, each with the host's day before (one LAG)."""
    prev = F.lag("insight_date").over(Window.partitionBy(HOST).orderBy("insight_date"))
    return _count_new(_host_days(rollup).withColumn("_prev_seen", prev), lookback_days)


def _date_parts(date: Column) -> list[Column]:
    return [
        F.year(date).alias("insight_year"),
        F.month(date).alias("insight_month"),
        F.dayofmonth(date).alias("insight_day"),
        F.date_format(date, "yyyy-MM-dd").alias("insight_date"),
    ]


def daily_insights_all_days(
    sessions: DataFrame,
    history: DataFrame | None = None,
    lookback_days: int = 7,
    duration_gap: int = P.DURATION_GAP_SECONDS,
    tie_break: str | None = None,
) -> DataFrame:
    """C6 for every day present in ``sessions`` (history defaults to the
    sessions themselves)."""
    r = session_day_rollup(sessions, duration_gap, tie_break, exits=False)
    nv = own_new_visitors_by_day(r, lookback_days) if history is None else new_visitors_by_day(sessions, history, lookback_days)
    return daily_from_rollup(r, nv)


def daily_from_rollup(rollup: DataFrame, new_visitors: DataFrame) -> DataFrame:
    """C6 for the days of a session-day rollup, with their new visitors."""
    r = rollup
    j = r.groupBy("insight_date").agg(*_site_metrics(r)).join(new_visitors, "insight_date", "left")
    d = F.col("insight_date")
    return j.select(
        *_date_parts(d),
        *[c for c in schemas.DAILY_INSIGHTS_FIELDS[4:-1]],
        F.coalesce("new_users_count", F.lit(0)).cast("bigint").alias("new_users_count"),
    )


def daily_insights(
    sessions: DataFrame,
    history: DataFrame,
    date: str,
    lookback_days: int = 7,
    duration_gap: int = P.DURATION_GAP_SECONDS,
    tie_break: str | None = None,
) -> DataFrame:
    """C6 for one day: always exactly one row; an empty day gives zero
    counts and NULL averages and rates (D17)."""
    today = day_slice(sessions, date)
    r = session_day_rollup(today, duration_gap, tie_break, exits=False)
    one = r.agg(*_site_metrics(r))
    t = today.select(HOST).where(F.col(HOST).isNotNull()).distinct()
    h = lookback_slice(history, date, lookback_days).select(F.col(HOST).alias("h_host")).distinct()
    new_users = (
        t.join(h, F.col(HOST) == F.col("h_host"), "left_anti")
        .select(F.count(F.lit(1)).alias("new_users_count"))
        .scalar()
    )
    d = F.lit(date).cast("date")
    return one.withColumn("new_users_count", new_users).select(
        *_date_parts(d), *schemas.DAILY_INSIGHTS_FIELDS[4:]
    )


# --- page insights (C7) -----------------------------------------------------------


def page_hits_by_day(sessions: DataFrame) -> DataFrame:
    """A4 per day."""
    return with_day(sessions).groupBy("insight_date", "request_url").agg(
        F.count(F.lit(1)).alias("page_request_count")
    )


def page_days(sessions: DataFrame, tie_break: str | None = None) -> DataFrame:
    """Per day and page, its hits and the session-days that end on
    it.  The hits are grouped by (day, session, page) and meet the time of
    their session-day's latest hit, which a hash aggregate gives.  Only the
    pages of that very time are gathered to settle ties (to the larger page),
    so a crawler's session-day with very many pages is spread over tasks."""
    days = with_day(sessions).withColumn("last", order_number("datetime", tie_break))
    per_page = days.groupBy("insight_date", "session_id", "request_url").agg(F.count(F.lit(1)).alias("n"), F.max("last").alias("last"))
    latest = days.groupBy("insight_date", F.col("session_id").alias("of")).agg(F.max("last").alias("latest"))
    met = per_page.join(
        latest.withColumnRenamed("insight_date", "on_date"),
        (F.col("insight_date") == F.col("on_date")) & F.col("session_id").eqNullSafe(F.col("of")),
    ).withColumn("ends", F.col("last") == F.col("latest"))
    # the other pages stand alone: their own page is part of the key
    alone = F.when(~F.col("ends"), F.struct("request_url"))
    rank = F.row_number().over(Window.partitionBy("insight_date", "session_id", alone).orderBy(F.col("request_url").desc_nulls_last()))
    return (
        met.withColumn("rank", rank)
        .groupBy("insight_date", "request_url")
        .agg(F.sum("n").alias("page_request_count"), F.count_if(F.col("ends") & (F.col("rank") == 1)).alias("count_last_visit"))
    )


def session_pages(sessions: DataFrame, duration_gap: int = P.DURATION_GAP_SECONDS, tie_break: str | None = None) -> DataFrame:
    """One row per ``(insight_date, session_id, request_url)``: host, hits,
    duration and the time of the latest hit as a number, all by hash.  What C6
    and C7 need of the hits, so a table of it stands in for them."""
    td = F.col("session_time_difference")
    return (
        with_day(sessions)
        .groupBy("insight_date", "session_id", HOST, "request_url")
        .agg(
            F.count(F.lit(1)).alias("hits"),
            F.sum(F.when(td <= duration_gap, td)).alias("duration"),
            F.max(order_number("datetime", tie_break)).alias("last"),
        )
    )


def rollup_of_pages(pages: DataFrame) -> DataFrame:
    """The session-day rollup from :func:`session_pages`, with the page of the
    latest hit (ties to the larger page).  The text is compared over a row for
    each page and combined map-side, so a crawler's session-day with very many
    pages is spread over tasks."""
    return pages.groupBy("insight_date", "session_id", HOST).agg(
        F.sum("hits").alias("hits"),
        F.sum("duration").alias("duration"),
        F.max(F.struct("last", "request_url")).getField("request_url").alias("exit_page"),
    )


def page_days_of_pages(pages: DataFrame, rollup: DataFrame) -> DataFrame:
    """The rows of :func:`page_days` from a table of :func:`session_pages` and
    its rollup: two small counts side by side, no join."""
    none = F.lit(0).cast("bigint")
    hits = pages.groupBy("insight_date", "request_url").agg(F.sum("hits").alias("page_request_count"))
    ends = rollup.groupBy("insight_date", F.col("exit_page").alias("request_url")).agg(F.count(F.lit(1)).alias("count_last_visit"))
    both = hits.withColumn("count_last_visit", none).unionByName(ends.withColumn("page_request_count", none))
    return both.groupBy("insight_date", "request_url").agg(
        F.sum("page_request_count").alias("page_request_count"), F.sum("count_last_visit").alias("count_last_visit")
    )


def exit_rates_by_day(sessions: DataFrame, tie_break: str | None = None) -> DataFrame:
    """A6 + J4 + A13 per day: sessions whose latest hit of the day is on the
    page, over the page's hits that day, in percent (2 decimals)."""
    return _exit_rates(page_days(sessions, tie_break))


def _exit_rates(pages: DataFrame) -> DataFrame:
    return (
        pages.where((F.col("count_last_visit") > 0) & F.col("request_url").isNotNull())
        .withColumn("exit_rate", percent("count_last_visit", "page_request_count"))
    )


def top_k_by(df: DataFrame, part: list[str], measure: str, k: int, tie: str = "request_url") -> DataFrame:
    """O1 + O3 per group: the ``k`` largest ``measure`` rows, ties by
    ``tie`` ascending.  Catalyst plans a partial WindowGroupLimit before the
    shuffle, so only ``k`` rows per group and task move."""
    w = Window.partitionBy(*part).orderBy(F.col(measure).desc(), F.col(tie).asc())
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def page_insights_by_day(sessions: DataFrame, k_hits: int, k_exit: int, tie_break: str | None = None) -> DataFrame:
    """C7 + U2 + P12: Page_Hits and Exit_Rate top-K per day in one table."""
    return page_insights(page_days(sessions, tie_break), k_hits, k_exit)


def page_insights(pages: DataFrame, k_hits: int, k_exit: int) -> DataFrame:
    """C7 from :func:`page_days`.  Both measures of a page come from one row, so
    ``pages`` is computed once; the limits differ by type, hence two filters
    (the first, a number, becomes the limit before the shuffle)."""
    exits = (F.col("count_last_visit") > 0) & F.col("request_url").isNotNull()
    measure = lambda label, value: F.struct(F.lit(label).alias("query_type"), value.cast("double").alias("measure_value"))
    measures = F.array(
        measure(P.PAGE_HITS_LABEL, F.col("page_request_count")),
        measure(P.EXIT_RATE_LABEL, F.when(exits, percent("count_last_visit", "page_request_count"))),
    )
    each = pages.select("insight_date", "request_url", F.inline(measures)).where("measure_value is not null")
    w = Window.partitionBy("insight_date", "query_type").orderBy(F.col("measure_value").desc(), F.col("request_url").asc())
    k = F.when(F.col("query_type") == P.PAGE_HITS_LABEL, k_hits).otherwise(k_exit)
    top = each.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= max(k_hits, k_exit)).where(F.col("_rank") <= k)
    return top.withColumn("insight_date", F.date_format("insight_date", "yyyy-MM-dd")).select(*schemas.PAGE_INSIGHTS_FIELDS)


# --- country insights (C8) -----------------------------------------------------------


def country_insights_by_day(sessions: DataFrame) -> DataFrame:
    """A5 per day; the NULL country is a group of its own."""
    return (
        with_day(sessions)
        .groupBy("insight_date", F.col("country").alias("country_name"))
        .agg(F.count(F.lit(1)).alias("page_request_count"))
        .withColumn("insight_date", F.date_format("insight_date", "yyyy-MM-dd"))
        .select(*schemas.COUNTRY_INSIGHTS_FIELDS)
    )


def ranked_countries_by_day(sessions: DataFrame) -> DataFrame:
    """C8 with O1: the busiest country of a day has rank 1; ties by name, the
    NULL country last."""
    w = Window.partitionBy("insight_date").orderBy(F.col("page_request_count").desc(), F.col("country_name").asc_nulls_last())
    return country_insights_by_day(sessions).withColumn("country_rank", F.row_number().over(w))


# --- whole-file insights (C10) -----------------------------------------------------------


def site_insights(sessions: DataFrame, duration_gap: int = P.DURATION_GAP_SECONDS, tie_break: str | None = None) -> DataFrame:
    """One row for the whole input (no day slice)."""
    td = F.col("session_time_difference")
    r = sessions.groupBy("session_id", HOST).agg(
        F.count(F.lit(1)).alias("hits"),
        F.sum(F.when(td <= duration_gap, td)).alias("duration"),
    )
    return r.agg(*_site_metrics(r)).select(
        "unique_visitor_count",
        "user_session_count",
        "avg_session_duration",
        "avg_session_duration_sec",
        "page_views_count",
    )


def site_page_hits(sessions: DataFrame) -> DataFrame:
    """A4 over the whole input."""
    return sessions.groupBy("request_url").agg(F.count(F.lit(1)).alias("count_page_visit"))


def site_last_pages(sessions: DataFrame, tie_break: str | None = None) -> DataFrame:
    """W6 as an aggregate: each session's latest hit and its last page.  The
    hits are aggregated by hash, to one number for each page of a session."""
    pages = sessions.groupBy("session_id", "last_visited_page").agg(F.max(order_number("datetime", tie_break)).alias("last"))
    return pages.groupBy("session_id").agg(
        F.max(F.struct("last", "last_visited_page")).getField("last_visited_page").alias("last_visited_page")
    )


def site_exit_rates(sessions: DataFrame, tie_break: str | None = None) -> DataFrame:
    """A6 + J4 + A13 over the whole input."""
    exits = (
        site_last_pages(sessions, tie_break)
        .groupBy(F.col("last_visited_page").alias("request_url"))
        .agg(F.count(F.lit(1)).alias("count_last_visit"))
    )
    return exits.join(site_page_hits(sessions), "request_url", "inner").withColumn(
        "exit_rate", percent("count_last_visit", "count_page_visit")
    )


def site_top_pages(sessions: DataFrame, k: int) -> DataFrame:
    """O1 + O3 whole file: TakeOrderedAndProject on the aggregated counts."""
    return site_page_hits(sessions).orderBy(F.col("count_page_visit").desc(), F.col("request_url").asc()).limit(k)


def site_top_exits(sessions: DataFrame, k: int, tie_break: str | None = None) -> DataFrame:
    return site_exit_rates(sessions, tie_break).orderBy(F.col("exit_rate").desc(), F.col("request_url").asc()).limit(k)
