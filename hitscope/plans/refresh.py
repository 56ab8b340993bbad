"""C6-C8 after some days of the log have changed.

The partitioned log is compared, by a listing of its files, with what the last
refresh has seen; a day whose files differ (also a day that is new or gone) is
*changed*.  From there

* the session-days and the page and country tables of a changed day and of the
  ``reach`` days after it are computed again: ``reach`` is the gap in whole days,
  rounded up, and a session that goes on from before a longer pause does not
  exist.  For the same reason the hits of ``reach`` days before are all that is
  read beside them: a hit's predecessor in an unread day is a gap away anyway;
* the daily table of the ``lookback_days`` after it is computed again as well,
  since its new visitors depend on the changed day, but from the stored
  session-days, not from hits.

``store`` holds ``session_days`` (one row per day and session: host, hits,
duration), the three insight tables, all by ``insight_date``, and ``seen``, one
row per day of the log, written last: a refresh that failed is done again by the
next one.  Session numbers are those of the whole history and are not stored
here, so later days need no new ones.  Hits without a time belong to no day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.functions import patterns as P
from hitscope.operators import insights
from hitscope.operators.sessions import sessionize
from hitscope.plans.jobs import materialize
from hitscope.sinks import tables

SEEN_SCHEMA = "insight_date string, files bigint, mark bigint"
_DAY_FOLDER = "year=([0-9]+)/month=([0-9]+)/day=([0-9]+)/[^/]+$"


def day_marks(spark: SparkSession, log_path: str) -> DataFrame:
    """Per day of the log: its number of files and a hash of their names, lengths
    and times.  From a listing; no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(log_path)
    part = [F.regexp_extract("path", _DAY_FOLDER, i).try_cast("int") for i in (1, 2, 3)]
    one = F.xxhash64(F.element_at(F.split("path", "/"), -1), "length", F.col("modificationTime").cast("timestamp"))
    return (
        found.select(F.make_date(*part).cast("string").alias("insight_date"), one.alias("one"))
        .where("insight_date is not null")
        .groupBy("insight_date")
        .agg(F.count(F.lit(1)).alias("files"), F.bit_xor("one").alias("mark"))
    )


def _marks(df: DataFrame) -> dict[str, tuple[int, int]]:
    return {r[0]: (r[1], r[2]) for r in df.collect()}  # a row per day


def _seen(spark: SparkSession, store: str) -> dict[str, tuple[int, int]]:
    fs, root, jvm = tables._hadoop_fs(spark, f"{store}/seen")
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(root, "_SUCCESS")):
        return {}
    return _marks(spark.read.schema(SEEN_SCHEMA).parquet(f"{store}/seen"))


def changed_days(now: dict, before: dict) -> list[str]:
    return sorted(d for d in now.keys() | before.keys() if now.get(d) != before.get(d))


def around(days: list[str], before: int, after: int) -> set[str]:
    """The days from ``before`` days before to ``after`` days after any of ``days``."""
    steps = [dt.timedelta(days=k) for k in range(-before, after + 1)]
    return {str(dt.date.fromisoformat(d) + s) for d in days for s in steps}


def _on(day: Column, days: set[str]) -> Column:
    return day.isin([dt.date.fromisoformat(d) for d in sorted(days)])


def hits_of(log: DataFrame, days: set[str]) -> DataFrame:
    """Hits of ``days`` by partition; other days are not read."""
    return log.where(_on(F.make_date("year", "month", "day"), days) & F.col("datetime").isNotNull())


def refresh(
    spark: SparkSession,
    log_path: str,
    store: str,
    lookback_days: int,
    k_hits: int,
    k_exit: int,
    gap: int = P.SESSION_GAP_SECONDS,
    duration_gap: int = P.DURATION_GAP_SECONDS,
    tie_break: str | None = None,
) -> dict[str, list[str]]:
    """Brings the stored session-days and the three insight tables up to the
    log.  Returns the days whose files changed, those whose hits were read, and
    those whose sessions and whose daily rows were computed again."""
    now = _marks(day_marks(spark, log_path))
    changed = changed_days(now, _seen(spark, store))
    if not changed:
        return {"changed": [], "read": [], "sessions": [], "daily": []}
    reach = -(-max(gap, duration_gap) // 86400)
    kept = now.keys() | set(changed)
    again = around(changed, 0, reach) & kept
    read = around(list(again), reach, 0) & now.keys()
    daily = around(changed, 0, max(reach, lookback_days)) & kept

    hits = hits_of(spark.read.parquet(log_path), read)  # stored by day: read again, not copied
    timed = hits.select(insights.HOST, "datetime", "epoch", "request_url", *([tie_break] if tie_break else []))
    in_days = _on(F.col("datetime").cast("date"), again)
    sessions = sessionize(timed, gap=gap, tie_break=tie_break).where(in_days)
    pages = materialize(insights.session_pages(sessions, duration_gap, tie_break), "refresh-session-pages")
    rollup = materialize(insights.rollup_of_pages(pages), "refresh-session-days")
    stored = rollup.drop("session_id", "exit_page")
    tables.publish(stored.withColumn("insight_date", F.date_format("insight_date", "yyyy-MM-dd")), f"{store}/session_days", again)
    top = insights.page_insights(insights.page_days_of_pages(pages, rollup), k_hits, k_exit)
    tables.publish(top, f"{store}/page_insights", again, sort_cols=["query_type", "measure_value", "request_url"])
    countries = insights.country_insights_by_day(hits.where(in_days))
    tables.publish(countries, f"{store}/country_insights", again, sort_cols=["page_request_count", "country_name"])
    tables.publish(daily_from_store(spark, store, daily, lookback_days), f"{store}/daily_insights", daily)

    rows = [(d, *m) for d, m in sorted(now.items())]
    spark.createDataFrame(rows, SEEN_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{store}/seen")
    return {"changed": changed, "read": sorted(read), "sessions": sorted(again), "daily": sorted(daily)}


def session_days(spark: SparkSession, store: str, days: set[str]) -> DataFrame:
    """The stored session-days of ``days``, by partition."""
    path = f"{store}/session_days"
    schema = "encrypted_host string, hits bigint, duration bigint, insight_date date"
    return spark.read.schema(schema).option("basePath", path).parquet(path).where(_on(F.col("insight_date"), days))


def daily_from_store(spark: SparkSession, store: str, days: set[str], lookback_days: int) -> DataFrame:
    """C6 of ``days`` from the stored session-days of these days and their
    lookback."""
    rollup = session_days(spark, store, around(sorted(days), lookback_days, 0))
    new = insights.own_new_visitors_by_day(rollup, lookback_days)
    return insights.daily_from_rollup(rollup.where(_on(F.col("insight_date"), days)), new)
