"""Scans: raw access log (S1), IP-range dimension (S2), typed session hits
(S3) and stored tables (S4).  All schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope import schemas


def read_access_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Space-delimited log; ``"`` groups the request, short lines are
    padded with NULL, extra tokens are dropped, ``""`` reads as NULL.  The
    file is split across tasks by ``spark.sql.files.maxPartitionBytes``."""
    return (
        spark.read.schema(schemas.ACCESS_LOG)
        .option("delimiter", " ")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def parse_access_log_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """S1 for log text already in a DataFrame (``spark.read.text``, a stream):
    the same CSV rules applied with ``from_csv``."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.ACCESS_LOG.fields)
    parsed = F.from_csv(F.col(column), F.lit(ddl), {"sep": " "})
    return lines.select(parsed.alias("r")).select("r.*")


def read_ip_ranges(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Comma CSV without header, six text columns."""
    return spark.read.schema(schemas.IP_RANGES).csv(path)


def typed_ip_ranges(ranges: DataFrame) -> DataFrame:
    """Range bounds as bigint (text bounds compared to a number are a trap);
    country codes lower case.  Bad bounds become NULL and never match."""
    return ranges.select(
        F.col("begin_ip_int").try_cast("bigint").alias("begin_ip_int"),
        F.col("end_ip_int").try_cast("bigint").alias("end_ip_int"),
        F.lower("country_code").alias("country_code"),
        F.col("country"),
    )


def read_session_hits(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S3: session hits; Parquet between stages, CSV for files in the
    original layout."""
    if fmt == "csv":
        return spark.read.schema(schemas.SESSION_HITS).csv(path)
    return spark.read.schema(schemas.SESSION_HITS).parquet(path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)
