"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are cut into blocks of ``block_rows`` documents in a
hashed order.  A source of weight w owns a share w of the slots of a clock:
its k-th block is released at ``floor(k / w)`` and due at ``ceil((k + 1) / w)``,
and every slot goes to the released block with the earliest deadline.  All
weights together are 1, so every deadline is met, and at any time up to the end
of a source the blocks it has had differ from ``w * time`` by less than one.
Windows come from the weights as given, in whole numbers of any length, so this
holds for any weights and any number of sources: a source of small weight just
has a late deadline.  A source that runs out leaves its slots empty; no document
is repeated or dropped.

The schedule holds blocks, not documents.  It is made in one task from one row
per source, with a heap of the sources' next blocks, and written as a table of
one row per block, which the documents then join.  So that this task stays small
at any size of the corpus, blocks grow beyond ``SLOTS * block_rows`` documents:
there are at most ``SLOTS`` blocks, and one more for each source.  Documents are
numbered in small hashed buckets with bucket offsets, so a source with a third
of all documents is spread over many tasks.

Defined cases: a null source counts as the empty name; a source without a
target weight takes the smallest weight given; weights must be positive;
null ids and repeated rows are numbered like any other; an empty table gives
an empty schedule; weights so far apart that a slot passes 2^63 are an error.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping
from fractions import Fraction
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitscope.llm.runtime import prepare, stored

BLOCK_ROWS = 16
SLOTS = 1 << 20
BUCKET_ROWS = 2048  # documents numbered together

_PLAN = "name string, block long, slot long, release long, due long"


def schedule(sources: list[tuple[str, float, int]]) -> Iterator[tuple[str, int, int, int, int]]:
    """Earliest deadline first over sources given as (name, weight, number of
    blocks): (name, block, slot, release, due), by slot.  Weights are taken as
    written (0.05 is a twentieth), as shares of their sum."""
    exact = [Fraction(str(w)) for _, w, _ in sources]
    scale = lcm(*(x.denominator for x in exact))
    part = [int(x * scale) for x in exact]
    whole = sum(part)
    later = [(0, i, 0) for i, (_, _, n) in enumerate(sources) if n]  # release, source, block
    heapq.heapify(later)
    ready: list[tuple[int, int, int, int]] = []  # due, source, block, release
    t = 0
    while later or ready:
        if not ready:
            t = max(t, later[0][0])
        while later and later[0][0] <= t:
            release, i, k = later[0]
            heapq.heappush(ready, (-(-(k + 1) * whole // part[i]), i, k, release))
            if k + 1 < sources[i][2]:
                heapq.heapreplace(later, ((k + 1) * whole // part[i], i, k + 1))
            else:
                heapq.heappop(later)
        due, i, k, release = heapq.heappop(ready)
        if due <= t:
            raise AssertionError("a deadline was missed")
        if due >= 1 << 63:
            raise ValueError("the weights are too far apart")
        yield sources[i][0], k, t, release, due
        t += 1


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sources = sorted(r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("name", "w", "blocks"))))
    held: list[tuple] = []
    names = ["name", "block", "slot", "release", "due"]
    for row in schedule(sources):
        held.append(row)
        if len(held) == 1 << 15:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held)], names=names)


def _numbered(docs: DataFrame, sources: DataFrame, ident: Column, name: Column, id_col: str) -> DataFrame:
    """(row, name, columns of ``sources``, at): numbers from 0 within each
    source: place in the bucket plus the buckets before."""
    order = F.xxhash64(ident, *(F.col(f"`{c}`") for c, t in docs.dtypes if c != id_col and not t.startswith("map")))
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), name.alias("name"), order.alias("h"))
    keyed = keyed.join(sources, "name").withColumn("bucket", F.pmod(F.shiftright("h", 16), F.col("buckets")).cast("int"))
    full = keyed.groupBy("name", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = full.select(
        F.col("name"), "bucket", (F.sum("n").over(Window.partitionBy("name").orderBy("bucket")) - F.col("n")).alias("before")
    )
    at = F.row_number().over(Window.partitionBy("name", "bucket").orderBy("h", f"row.`{id_col}`")) - 1
    return keyed.withColumn("at", at).join(before, ["name", "bucket"]).withColumn("at", F.col("at") + F.col("before"))


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    temperature: float = 0.5,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
    slots: int = SLOTS,
) -> DataFrame:
    """Every row as (row: struct of all columns, block, slot, place, release,
    due).  Read by (slot, place), the sources come at their target weights;
    without ``weights`` these are the sources' sizes to the power
    ``temperature``."""
    spark = prepare(docs.sparkSession)
    if weights is not None and (not weights or min(weights.values()) <= 0):
        raise ValueError("weights must be positive")
    ident, name = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit(""))
    sizes = docs.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        sizes = sizes.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(float(temperature))))
    else:
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "name string, w double")
        sizes = sizes.join(given, "name", "left").withColumn("w", F.coalesce("w", F.lit(float(min(weights.values())))))
    sizes = stored(sizes, "sources")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    block_rows = max(block_rows, -(-total // slots))
    counted = sizes.select("name", "w", F.ceil(F.col("n") / block_rows).alias("blocks"))
    plan = stored(counted.coalesce(1).mapInArrow(_plan, _PLAN), "schedule")
    sources = sizes.select("name", F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("buckets"))
    return (
        _numbered(docs, sources, ident, name, id_col)
        .withColumn("block", F.floor(F.col("at") / block_rows))
        .withColumn("place", (F.col("at") % block_rows).cast("int"))
        .join(plan, ["name", "block"])
        .select("row", "block", "slot", "place", "release", "due")
    )
