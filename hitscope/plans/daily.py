"""The daily job from carried state: a new day is sessionised, and its new
visitors are counted, from its own hits and small tables of one row per host.
No earlier day is read.

``store`` holds

* ``sessions``: session hits by year / month / day,
* ``session_state/asof=<day>``: the sessioniser's state after that day
  (:data:`hitscope.operators.sessions.STATE_SCHEMA`),
* ``last_seen/asof=<day>``: each host's last day up to that day,
* ``new_visitors``: the daily count, by ``insight_date``.

A run takes the newest tables before its first day, writes the day's rows, and
then its own tables, whose ``_SUCCESS`` file ends the run.  A run that failed is
repeated: it starts from the same tables and replaces what it has written.
Days have to be run in order; a day that changes later is run again together
with the days after it.  Hits whose time does not parse belong to no day; they
come before all others, so they are a run of their own before the first day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.functions import patterns as P
from hitscope.operators import insights
from hitscope.operators.sessions import STATE_SCHEMA, sessionize_from
from hitscope.plans.jobs import materialize
from hitscope.sinks import tables

NO_DAY = "0000-00-00"  # the run of the hits without a time


def days_of(log: DataFrame, first: str, last: str) -> DataFrame:
    """Hits of the days from ``first`` to ``last``; by partition, where the log
    is partitioned by year, month and day.  ``NO_DAY``: hits without a time."""
    if first == NO_DAY:
        stored = F.col("year").isNull() & F.col("month").isNull() & F.col("day").isNull()
        return log.where(stored & F.col("datetime").isNull())
    day = F.make_date("year", "month", "day")
    return log.where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")) & F.col("datetime").isNotNull())


def _before(spark: SparkSession, path: str, day: str, schema: str) -> DataFrame:
    """The newest finished table before ``day``; empty if there is none."""
    fs, root, jvm = tables._hadoop_fs(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    done = [n for n in found if n.startswith("asof=") and n[5:] < day and fs.exists(jvm.org.apache.hadoop.fs.Path(root, f"{n}/_SUCCESS"))]
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{max(done)}")


def run_days(
    spark: SparkSession,
    log: DataFrame,
    store: str,
    first: str,
    last: str | None = None,
    gap: int = P.SESSION_GAP_SECONDS,
    tie_break: str | None = None,
    keep: list[str] | None = None,
) -> None:
    """Sessions of the days from ``first`` to ``last`` (one day, if not given),
    going on from the state before them."""
    last = last or first
    hits = days_of(log, first, last)
    state = _before(spark, f"{store}/session_state", first, STATE_SCHEMA)
    sessions, after = sessionize_from(hits, state, gap=gap, tie_break=tie_break)
    tables.write_sessions(sessions, f"{store}/sessions", keep=keep)
    after.write.mode("overwrite").parquet(f"{store}/session_state/asof={last}")


def new_visitors_of_day(today: DataFrame, last_seen: DataFrame, date: str, lookback_days: int) -> DataFrame:
    """C9 for one day: hosts of ``today`` that ``last_seen`` does not have in
    the ``lookback_days`` before ``date``.  One row, also for an empty day."""
    d = F.lit(date).cast("date")
    recent = last_seen.where((F.col("last_day") >= F.date_sub(d, lookback_days)) & (F.col("last_day") < d))
    hosts = today.select(insights.HOST).where(F.col(insights.HOST).isNotNull()).distinct()
    new = hosts.join(recent.select(F.col("host").alias(insights.HOST)), insights.HOST, "left_anti")
    return new.agg(F.lit(date).alias("insight_date"), F.count(F.lit(1)).alias("new_users_count"))


LAST_SEEN_SCHEMA = "host string, last_day date"


def merge_last_seen(last_seen: DataFrame, today: DataFrame) -> DataFrame:
    """``last_seen`` with the days of ``today``: one row per host."""
    now = insights.with_day(today).where(F.col(insights.HOST).isNotNull())
    now = now.groupBy(F.col(insights.HOST).alias("host")).agg(F.max("insight_date").alias("last_day"))
    return last_seen.unionByName(now).groupBy("host").agg(F.max("last_day").alias("last_day"))


def count_new_visitors(spark: SparkSession, log: DataFrame, store: str, date: str, lookback_days: int) -> None:
    """Publishes the day's new visitors and the last-seen table after it."""
    today = days_of(log, date, date)
    seen = _before(spark, f"{store}/last_seen", date, LAST_SEEN_SCHEMA)
    tables.publish(new_visitors_of_day(today, seen, date, lookback_days), f"{store}/new_visitors", [date])
    merge_last_seen(seen, today).write.mode("overwrite").parquet(f"{store}/last_seen/asof={date}")


def start_new_visitors(spark: SparkSession, log: DataFrame, store: str, first: str, last: str, lookback_days: int) -> None:
    """The same for a stretch of days at the start, from their hits."""
    days = materialize(insights.with_day(days_of(log, first, last)).select(insights.HOST, "datetime").distinct(), "host-days")
    counts = insights.new_visitors_by_day(days, days, lookback_days)
    counts = counts.withColumn("insight_date", F.date_format("insight_date", "yyyy-MM-dd"))
    tables.publish(counts, f"{store}/new_visitors")
    merge_last_seen(spark.createDataFrame([], LAST_SEEN_SCHEMA), days).write.mode("overwrite").parquet(f"{store}/last_seen/asof={last}")
