"""A training corpus from ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again by the next.  All but the last return the columns
of ``documents``.  Rows leave the corpus for stated reasons only: the quality
verdict, a text that held nothing but boilerplate, a near copy that stays, or
a benchmark window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.llm import decontaminate, line_dedup, mixing, near_dup, quality
from hitscope.llm.runtime import stored, table


def _columns(docs: DataFrame, text: str = "text") -> list:
    """The columns of ``docs`` again, from (row, text)."""
    return [F.col(text).alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base counts and whose lines are mostly content."""
    field = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, field).where("kept").select(_columns(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines that unlike documents of many sites
    share, of fixed footers too; a document of which nothing is left goes.
    n_chars follows the text where it changed."""
    found = line_dedup.clean_lines(docs, by="bodies").where("n_removed = 0 or trim(text) != ''")
    out = found.select(*_columns(docs), "n_removed")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return out.select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8): the one
    with the smallest id.  Rows that repeat an id and a text are one document,
    of which the row with the smallest hash stays; texts that share an id are
    documents for themselves."""
    given = docs.where("doc_id is not null")
    mark = F.xxhash64("text")
    several = stored(
        given.groupBy(F.col("doc_id").alias("shared_id")).agg(F.min(mark).alias("lo"), F.max(mark).alias("hi")).where("lo < hi").select("shared_id"), "shared-ids"
    )
    rest = [c for c, kind in docs.dtypes if "map<" not in kind]
    one = given.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.xxhash64(*(F.col(f"`{c}`") for c in rest)).alias("order"))
    nodes = one.join(several, F.col("row.doc_id") == F.col("shared_id"), "left").select(
        # a number of its own for each text of a shared id
        F.when(F.col("shared_id").isNull(), F.col("row.doc_id").cast("long")).otherwise(F.xxhash64("row.doc_id", "row.text")).alias("node"),
        "shared_id", "row", "order",
    )
    found = near_dup.near_duplicates(nodes.select("node", F.col("row.text").alias("text")), id_col="node")
    named = nodes.where("shared_id is not null").select(F.col("node").alias("id"), F.col("shared_id").cast("long").alias("named")).distinct()
    member = found.select("id", "component").distinct().join(named, "id", "left")
    first = member.groupBy("component").agg(F.min(F.struct(F.coalesce("named", "id").alias("doc"), "id")).alias("first"))
    keep = first.select(F.col("first.id").alias("node"))
    kept = nodes.join(keep, "node", "left_semi").groupBy("node").agg(F.min_by("row", "order").alias("row"))
    return kept.select("row.*").unionByName(docs.where("doc_id is null"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: sorted by slot and place."""
    own = {"mix_slot": "slot", "mix_place": "place", "mix_block": "block"}
    placed = mixing.mix(docs)
    out = placed.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in own), *(F.col(v).alias(k) for k, v in own.items()))
    return out.repartitionByRange("mix_slot").sortWithinPartitions("mix_slot", "mix_place")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("near-duplicate documents", dedup_documents),
    ("benchmark decontamination", drop_benchmark),
    ("source mix", mix_sources),
]

#: The field's Viterbi labels have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
