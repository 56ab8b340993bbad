"""The registered queries of this subpackage: each operator, with production
parameters, over its whole table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from hitscope.llm import (
    decontaminate,
    hard_negatives,
    html_extract,
    license_scan,
    line_dedup,
    mixing,
    near_dup,
    oracles,
    packing,
    quality,
    runs,
    token_count,
    url_filter,
    warc,
)
from hitscope.llm.runtime import table


URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page's url.  The list holds the urls of the pages
    whose id is divisible by 50, so every page with one of their canonical
    forms is blocked unless a rule allows it."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, pages.where("page_id % 50 = 0"), URL_RULES)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that unlike documents of five sources
    or more share."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.clean_lines(docs, by="bodies").select("row.doc_id", "text", "n_lines", "n_removed")


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extract.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates, also wrapped ones, in every document."""
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"), wrapped=True)
    starts = F.flatten(F.array("places.p0", "places.p1", "places.p2"))
    return found.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", "found_labels")), ",").alias("labels"),
        "score",
    )


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot in the mix; targets are the square roots of the
    sources' sizes."""
    placed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))
    return placed.select("row.doc_id", "row.source", "block", "slot", "place", "release", "due")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")), with_text=False)
    return found.select("row.doc_id", *quality.COUNTS, "base_failed", "content_share", "kept")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after personal data is
    masked."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_count.apply_edits(token_count.build_trees(docs), token_count.mask_personal, with_text=False)
    return counted.select("row.doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_chars_encoded")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through WARC archives and back."""
    captures = warc.round_trip(table(spark, sf_dir, "pages"), with_payload=False)
    return captures.select(
        warc.page_id_of("metadata").alias("page_id"),
        F.coalesce("original.payload_bytes", "response.payload_bytes").alias("payload_bytes"),
        F.coalesce("original.payload_digest", "response.payload_digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        warc.page_id_of("original_metadata").alias("refers_to"),
        "target_uri",
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in a benchmark window."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents: five words, 0.85."""
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"), num=85, den=100)
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, mixed as the sources' tokens
    are in every window."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = packing.pack(docs, vocabulary=str(public_tokenizers.path("byte_bpe_50k.json")))
    return found.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source", "round"
    )


def _periodic(docs: DataFrame) -> DataFrame:
    """The contract's input for op12: in one of ten documents, by the crc of the
    id, the words from a place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    w = docs.withColumns({"_w": words, "_g": F.floor(h / 10)})
    n = F.size("_w")
    w = w.withColumns({"_a": F.when(n > 0, F.col("_g") % n)})
    w = w.withColumn("_p", F.lit(1) + F.floor((n - F.col("_a")) / (F.lit(3) + F.col("_g") % 8)))
    word = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    again = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("_w", word(i).cast("int")))
    return w.select("doc_id", F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and the text without the
    repeats."""
    found = runs.detect_runs(_periodic(table(spark, sf_dir, "documents").select("doc_id", "text")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return found.select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three negatives for each of up to five positives of every anchor
    (ids divisible by 50).  As the contract says, every seventh id first takes
    the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0, "vec_id", "label", "embedding")


_QUERIES = (
    op1_url_filter,
    op2_line_dedup,
    op3_html_extract,
    op4_license_scan,
    op5_mix_sources,
    op6_quality_rules,
    op7_token_counts,
    op8_warc,
    op9_decontaminate,
    op10_near_duplicates,
    op11_packing,
    op12_periodic_runs,
    op13_hard_negatives,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in oracles.SQL.items() if k in queries()}
