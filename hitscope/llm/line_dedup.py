"""Cross-site boilerplate: lines that recur on many sites.

For each distinct line (trimmed; 128-bit hash) one aggregation merges two
HyperLogLog sketches: of the sites that have the line, and of the line's
contexts (the pair of lines before and after it).  A line is boilerplate if
it has at least ``sites`` sites, and stands in at least as many contexts, and
in at least one context for every two occurrences.  The context rule tells
boilerplate, which stands among different neighbours, from lines of copied
documents, which keep their neighbours; copies are left to the near-duplicate
operator, which keeps one of each group.

Only lines whose estimates lie near a threshold (``margin``, well over three
standard errors of the sketch) get exact distinct counts.  Sketches and
distinct counts are combined map-side, so a line that a third of all documents
hold costs each task one row.

That rule (``by="contexts"``) keeps the later lines of a fixed footer, whose
neighbours never change, and lets one large group of copies shield a line.
``by="bodies"``, the rule of ``op2_line_dedup`` and of the pipeline, has
neither fault: a line on ``sites`` sites is spread; a
document's body is what is left of it without its spread lines; a document
has a say if its body is at least ``OWN`` of its text, which copies of a
document, exact or near, do not have, as nearly all of their lines are spread.
A spread line is boilerplate if the documents with a say that hold it are on
``sites`` sites and have ``sites`` different bodies.  The counts are exact.

Defined cases: null text stays null and has no lines; blank lines are never
boilerplate; a null site counts as no site; a line that repeats within a
document counts each time as an occurrence; documents whose lines all go have
an empty text; repeated rows and null ids are cleaned like any other row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitscope.llm.runtime import prepare, stored

SITES = 5
LG_K = 12  # standard error 1.6 % after merging
MARGIN = 0.1
OWN = 0.2  # near copies at 0.8 have less text of their own


def _trimmed(c: Column) -> Column:
    return F.trim(c, F.lit(" \t\r\x0b\x0c"))


def _keys(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("k1"), F.xxhash64(line, F.lit(1)).alias("k2")]


def _lines(docs: DataFrame, text: Column, site: Column, *more: Column) -> DataFrame:
    """One row per line that is not blank: key, site, context, place."""
    arr = F.col("lines")
    # the neighbours of line i are lines i and i + 2 of the array with an end mark on both sides
    mark = F.array(F.lit(None).cast("string"))
    split = docs.select(F.transform(F.split(text, "\n"), _trimmed).alias("lines"), site.cast("string").alias("site"), *more)
    names = split.columns[1:]
    pos = split.select(*names, F.posexplode(F.arrays_zip(arr.alias("line"), F.concat(mark, arr).alias("before"), F.slice(F.concat(arr, mark), 2, F.size(arr)).alias("after"))).alias("place", "at"))
    return pos.where("at.line is not null and at.line != ''").select(
        *names, *_keys(F.col("at.line")), F.xxhash64("at.before", "at.after").alias("context"), "place"
    )


def boilerplate_lines(docs: DataFrame, text: Column, site: Column, sites: int = SITES, lg_k: int = LG_K, margin: float = MARGIN) -> DataFrame:
    """Keys (k1, k2) of the boilerplate lines."""
    lines = _lines(docs, text, site)
    spread = lines.groupBy("k1", "k2").agg(
        F.hll_sketch_agg("site", lg_k).alias("s"), F.hll_sketch_agg("context", lg_k).alias("c"), F.count(F.lit(1)).alias("n")
    )
    estimated = stored(
        spread.where(F.col("n") >= sites).select(
            "k1", "k2", "n", F.hll_sketch_estimate("s").alias("s"), F.hll_sketch_estimate("c").alias("c"),
        ),
        "spread",
    )
    need = F.greatest(F.lit(sites).cast("double"), F.col("n") / 2)
    over = lambda x, t: x >= t * (1 + margin) + 1
    under = lambda x, t: x <= t * (1 - margin) - 1
    s, c = F.col("s"), F.col("c")
    sure = estimated.where(over(s, F.lit(sites)) & over(c, need)).select("k1", "k2")
    near = estimated.where(~(over(s, F.lit(sites)) & over(c, need)) & ~under(s, F.lit(sites)) & ~under(c, need)).select("k1", "k2", "n")
    again = lines.join(near, ["k1", "k2"])
    by_site = again.select("k1", "k2", "site").where("site is not null").distinct().groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("s"))
    by_context = again.select("k1", "k2", "n", "context").distinct().groupBy("k1", "k2", "n").agg(F.count(F.lit(1)).alias("c"))
    exact = by_site.where(s >= sites).join(by_context.where(c >= need), ["k1", "k2"]).select("k1", "k2")
    return sure.unionByName(exact)


def _spread_lines(lines: DataFrame, sites: int, lg_k: int, margin: float) -> DataFrame:
    """Keys of the lines on ``sites`` sites or more."""
    estimated = stored(
        lines.groupBy("k1", "k2").agg(F.hll_sketch_agg("site", lg_k).alias("s"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= sites).select("k1", "k2", F.hll_sketch_estimate("s").alias("s")),
        "spread",
    )
    sure = F.col("s") >= sites * (1 + margin) + 1
    near = estimated.where(~sure & (F.col("s") > sites * (1 - margin) - 1)).select("k1", "k2")
    exact = (
        lines.where("site is not null").select("k1", "k2", "site").join(near, ["k1", "k2"], "left_semi").distinct()
        .groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("s")).where(F.col("s") >= sites)
    )
    return estimated.where(sure).select("k1", "k2").unionByName(exact.select("k1", "k2"))


def _places(docs: DataFrame, text: Column, ident: Column, keys: DataFrame, *more: Column) -> DataFrame:
    """For each document (id and hash of the text) with lines of ``keys``: their
    places, from 0."""
    return (
        _lines(docs, text, F.lit(None), ident.alias("at_id"), F.xxhash64(text).alias("at_key"))
        .join(keys, ["k1", "k2"], "left_semi")
        .groupBy("at_id", "at_key").agg(F.collect_set("place").alias("at"), *more)
    )


def _others(lines: Column, at: Column) -> Column:
    """The column ``lines`` without those at the places ``at``; linear, as sets
    of places are hashed."""
    return F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), at), lambda i: F.get(lines, i))


def _once(c: Column) -> Column:
    """A generated column, which no later filter can put back into a function
    over places, where it would be computed anew for each place."""
    return F.explode(F.array(c))


def body_boilerplate(docs: DataFrame, text: Column, site: Column, ident: Column, sites: int = SITES, lg_k: int = LG_K, margin: float = MARGIN) -> DataFrame:
    """Keys (k1, k2) of the spread lines that unlike documents share."""
    spread = stored(_spread_lines(_lines(docs, text, site), sites, lg_k, margin), "spread-keys")
    held = _places(docs, text, ident, spread, F.collect_set(F.struct("k1", "k2")).alias("held"))
    length = lambda ls: F.aggregate(ls, F.lit(0).cast("long"), lambda n, x: n + F.length(x))
    voters = (
        docs.select(ident.alias("id"), F.xxhash64(text).alias("key"), site.cast("string").alias("site"), text.alias("text"))
        .join(held, F.col("id").eqNullSafe(F.col("at_id")) & (F.col("key") == F.col("at_key")))
        .select("site", "held", "at", _once(F.transform(F.split("text", "\n"), _trimmed)).alias("lines"))
        .select("site", "held", "lines", F.filter(_others(F.col("lines"), F.col("at")), lambda x: x != "").alias("own"))
        .where(length(F.col("own")) >= OWN * length(F.col("lines")))
        .select("site", F.xxhash64("own").alias("body"), "held")
    )
    return (
        voters.select("site", "body", F.inline("held"))
        .groupBy("k1", "k2").agg(F.count_distinct("site").alias("s"), F.count_distinct("body").alias("b"))
        .where((F.col("s") >= sites) & (F.col("b") >= sites)).select("k1", "k2")
    )


def clean_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    sites: int = SITES,
    lg_k: int = LG_K,
    margin: float = MARGIN,
    by: str = "contexts",
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, as (row: struct
    of the other columns, text, n_lines, n_removed)."""
    if by not in ("contexts", "bodies"):
        raise ValueError(f"unknown rule {by!r}")
    prepare(docs.sparkSession)
    text, site, ident = F.col(f"`{text_col}`"), F.col(f"`{site_col}`"), F.col(f"`{id_col}`")
    keys = boilerplate_lines(docs, text, site, sites, lg_k, margin) if by == "contexts" else body_boilerplate(docs, text, site, ident, sites, lg_k, margin)
    common = stored(keys, "boilerplate")
    # which documents lose which lines; the texts themselves meet only this list
    lost = _places(docs, text, ident, common)
    rest = [c for c in docs.columns if c != text_col]
    row = docs.select(ident.alias("id"), F.xxhash64(text).alias("key"), F.struct(*(F.col(f"`{c}`") for c in rest)).alias("row"), text.alias("text"))
    joined = row.join(lost, F.col("id").eqNullSafe(F.col("at_id")) & (F.col("key") == F.col("at_key")), "left")
    lines = F.col("lines")
    return joined.select("row", "text", "at", _once(F.split("text", "\n")).alias("lines")).select(
        "row",
        F.when(F.col("at").isNull(), F.col("text")).otherwise(F.array_join(_others(lines, F.col("at")), "\n")).alias("text"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("at"), F.lit(0)).cast("long").alias("n_removed"),
    )
