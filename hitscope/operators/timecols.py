"""Time columns of a hit (F8, F9, F10, F16) and the enriched output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitscope.functions import epoch_seconds, parse_log_time


def time_columns(ts: str = "raw_timestamp", use_offset: bool = False) -> dict[str, Column]:
    """``datetime`` (NULL when the text does not parse), ``epoch`` seconds,
    ``year``/``month``/``day`` ints and the ``date``.  The wall time is read
    in the session zone unless ``use_offset`` honours the logged offset."""
    dt = parse_log_time(ts, "timezone" if use_offset else None)
    return {
        "datetime": dt,
        "epoch": epoch_seconds(dt),
        "year": F.year(dt),
        "month": F.month(dt),
        "day": F.dayofmonth(dt),
        "date": dt.cast("date"),
    }


def add_time_columns(hits: DataFrame, ts: str = "raw_timestamp", use_offset: bool = False) -> DataFrame:
    return hits.withColumns(time_columns(ts, use_offset))


def enriched_hits(tagged: DataFrame, keep: list[str] | None = None, use_offset: bool = False) -> DataFrame:
    """The enriched log: the 11 published columns, typed (code int, bytes
    bigint; non-numeric text such as ``-`` becomes NULL), plus ``keep``."""
    t = time_columns(use_offset=use_offset)
    return tagged.select(
        F.col("encrypted_host"),
        t["datetime"].alias("datetime"),
        t["epoch"].alias("epoch"),
        F.col("request"),
        F.col("http_response_code").try_cast("int").alias("http_response_code"),
        F.col("bytes").try_cast("bigint").alias("bytes"),
        F.col("request_url"),
        F.col("country"),
        t["year"].alias("year"),
        t["month"].alias("month"),
        t["day"].alias("day"),
        *(keep or []),
    )
