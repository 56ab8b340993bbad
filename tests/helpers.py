"""Small builders for hand-made rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hitscope import schemas


def raw_log(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schemas.ACCESS_LOG)


def ranges(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """rows of (begin_int, end_int, code, country) as the text dimension."""
    return spark.createDataFrame(
        [("", "", str(b) if b is not None else None, str(e) if e is not None else None, c, n) for b, e, c, n in rows],
        schemas.IP_RANGES,
    )


HITS = T.StructType(
    [
        T.StructField("encrypted_host", T.StringType()),
        T.StructField("datetime", T.TimestampType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("request_url", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("event_id", T.LongType()),
    ]
)

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def hits(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """rows of (host, seconds after 2024-01-01 00:00 UTC or None, url, id)."""
    out = []
    for h, sec, url, i in rows:
        ts = T0 + dt.timedelta(seconds=sec) if sec is not None else None
        out.append((h, ts, (1704067200 + sec) if sec is not None else None, url, "X", i))
    return spark.createDataFrame(out, HITS)


def rows_of(df: DataFrame, cols: list[str]) -> list[tuple]:
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
