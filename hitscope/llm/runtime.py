"""What the operators of this subpackage share on the Spark side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.config import scratch_path

#: Arrow batches stay this small, so that a task's Python worker holds a few
#: MB of text at a time whatever the lengths of the texts are.
ARROW_RECORDS = 2000
ARROW_BYTES = 4 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: adaptive plans with skew joins
    (hot keys of joins are split at run time) and small Arrow batches."""
    for k, v in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(ARROW_RECORDS),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(ARROW_BYTES),
    }.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Cut the lineage: write under the shared checkpoint folder, read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest id reachable, for every id in ``edges`` (columns a, b, both
    long): rows (id, root).  Alternating large-star and small-star rounds;
    each is two grouped minima and two joins, and no component is ever
    gathered in one place.  Stops when a round changes nothing."""

    def star(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (  # every larger neighbour of u hangs on the smallest of u's neighbourhood
            both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        ).where("a < b").distinct()
        low2 = large.groupBy("b").agg(F.min("a").alias("m"))
        return (  # every smaller neighbour of b, and b, hang on the smallest of them
            large.join(low2, "b")
            .select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b"))
            .where("a < b")
            .distinct()
        )

    def mark(e: DataFrame) -> tuple:
        return tuple(
            e.select(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )

    now = stored(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges"
    )
    seen = mark(now)
    while seen[0]:
        now = stored(star(now), "edges")
        last, seen = seen, mark(now)
        if seen == last:
            break
    return now.select(F.col("b").alias("id"), F.col("a").alias("root"))
