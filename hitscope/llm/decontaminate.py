"""Benchmark decontamination by a broadcast set of test n-grams.

Texts and items are lower-cased (A-Z) and cut into words of letters, digits
and non-ASCII characters.  Every run of ``n`` consecutive item words is a
window; an item with fewer words, but not none, is one window.  The windows
go to the tasks as a broadcast hash set; each document's windows are hashed
and looked up, hits are verified word by word, and the words inside verified
hits are marked.  The documents are never shuffled.

The broadcast is bounded: windows are counted first, and beyond
``BLOCK_WINDOWS`` windows or ``BLOCK_BYTES`` bytes they are dealt by hash
into blocks that are scanned one after the other, the marks being carried
along in a written table.

Defined cases: a null or empty text has no words and no hits; an item
without words has no window; repeated items count once for each item id; a
null item id is not counted as an item, but its windows mark words.  Repeated
document rows are scanned separately.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitscope.llm import text as X
from hitscope.llm.runtime import prepare, stored

WINDOW = 10
BLOCK_WINDOWS = 500_000
BLOCK_BYTES = 48 << 20

_STATE = "at array<int>, len array<int>, items array<string>"
_BITS = 22


def _item_windows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = X.Words(b.column("text"), X.PLAIN)
            h = w.hashes()
            ids = b.column("item").to_pylist()
            raw = w.data.tobytes().lower()
            word = [raw[s:e] for s, e in zip(w.start, w.end)]
            out = {"item": [], "len": [], "hash": [], "gram": []}
            for i, count in enumerate(w.count):
                s = w.first[i]
                for at in range(s, s + max(count - n, 0) + 1 if count else s):
                    k = min(n, count)
                    out["item"].append(ids[i])
                    out["len"].append(k)
                    out["hash"].append(int(X.sequence_hash([h[j : j + 1] for j in range(at, at + k)])[0].view(np.int64)))
                    out["gram"].append(b" ".join(word[at : at + k]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["item"], pa.string()), pa.array(out["len"], pa.int32()), pa.array(out["hash"], pa.int64()), pa.array(out["gram"], pa.binary())],
                names=list(out),
            )

    return run


def _lookup(rows: list) -> dict:
    """Windows of one block: by length, sorted hashes with the windows' words
    and the items they belong to, and a bit table that most lookups end at."""
    out = {}
    for k in sorted({r["len"] for r in rows}):
        mine = [r for r in rows if r["len"] == k]
        h = np.array([r["hash"] for r in mine], np.int64).view(np.uint64)
        order = np.argsort(h, kind="stable")
        seen = np.zeros(1 << _BITS, bool)
        seen[(h & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
        out[k] = (h[order], [bytes(mine[i]["gram"]) for i in order], [mine[i]["items"] for i in order], seen)
    return out


def _find(lookup: dict, w: X.Words, h: np.ndarray) -> Iterator[tuple[int, int, list[str]]]:
    """Verified hits: first word, number of words, items."""
    for k, (hashes, grams, items, seen) in lookup.items():
        at, win = w.windows(h, k)
        maybe = np.flatnonzero(seen[(win & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
        lo = np.searchsorted(hashes, win[maybe])
        hit = lo < len(hashes)
        hit[hit] = hashes[lo[hit]] == win[maybe][hit]
        for m, i in zip(maybe[hit], lo[hit]):
            s = at[m]
            gram = b" ".join(w.data[w.start[j] : w.end[j]].tobytes() for j in range(s, s + k)).lower()
            while i < len(hashes) and hashes[i] == win[m]:
                if grams[i] == gram:
                    yield int(s), k, items[i]
                i += 1


def _scan(grams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in X.pieces(whole, "text"):
                w = X.Words(b.column("text"), X.PLAIN)
                state = [(list(x or ()), list(y or ()), set(z or ())) for x, y, z in zip(*(b.column(c).to_pylist() for c in ("at", "len", "items")))]
                for s, k, ids in _find(grams.value, w, w.hashes()):
                    i = int(w.doc[s])
                    state[i][0].append(s - int(w.first[i]))
                    state[i][1].append(k)
                    state[i][2].update(x for x in ids if x is not None)
                names = b.schema.names
                cols = {c: b.column(c) for c in names}
                cols["at"] = pa.array([x[0] for x in state], pa.list_(pa.int32()))
                cols["len"] = pa.array([x[1] for x in state], pa.list_(pa.int32()))
                cols["items"] = pa.array([sorted(x[2]) for x in state], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([cols[c] for c in names], names=names)

    return run


def _finish(cut: bool):
    """Counts of words and hit words; with ``cut`` the text without the hit
    words and what lies between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in X.pieces(whole, "text"):
                w = X.Words(b.column("text"), X.PLAIN)
                change = np.zeros(len(w) + 1, np.int64)
                for i, (ats, lens) in enumerate(zip(b.column("at").to_pylist(), b.column("len").to_pylist())):
                    for a, k in zip(ats or (), lens or ()):
                        change[w.first[i] + a] += 1
                        change[w.first[i] + a + k] -= 1
                # runs never cross rows, so the running sum is back at 0 at each row's end
                hit = np.cumsum(change[:-1]) > 0
                n_hit = np.bincount(w.doc[hit], minlength=b.num_rows)
                text = b.column("text")
                if cut and hit.any():
                    texts = text.to_pylist()
                    for i in np.flatnonzero(n_hit):
                        texts[i] = _without(w, hit, int(i))
                    text = pa.array(texts, b.schema.field("text").type)
                names = b.schema.names
                cols = {c: b.column(c) for c in names} | {"text": text}
                yield pa.RecordBatch.from_arrays(
                    [cols[c] for c in names if c not in ("at", "len")] + [pa.array(w.count, pa.int64()), pa.array(n_hit, pa.int64())],
                    names=[c for c in names if c not in ("at", "len")] + ["n_words", "n_hit"],
                )

    return run


def _without(w: X.Words, hit: np.ndarray, i: int) -> str:
    s, e = w.first[i], w.first[i + 1]
    keep = np.ones(w.off[i + 1] - w.off[i], bool)
    where = np.flatnonzero(np.diff(np.concatenate([[0], hit[s:e].astype(np.int8), [0]])))
    for a, z in zip(where[::2], where[1::2]):  # runs of hit words
        keep[w.start[s + a] - w.off[i] : w.end[s + z - 1] - w.off[i]] = False
    return w.data[w.off[i] : w.off[i + 1]][keep].tobytes().decode("utf-8", "replace")


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = WINDOW,
    cut: bool = False,
    block_windows: int = BLOCK_WINDOWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` as (row: struct of the other columns, text, items: sorted item
    ids that occur, n_words, n_hit).  ``cut`` removes the hit spans from text."""
    spark = prepare(docs.sparkSession)
    grams = stored(
        benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
        .mapInArrow(_item_windows(n), "item string, len int, hash long, gram binary")
        .groupBy("hash", "len", "gram")
        .agg(F.sort_array(F.collect_set("item")).alias("items")),
        "grams",
    )
    count, size = grams.select(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("gram") + 64 + F.size("items") * 64), F.lit(0))
    ).first()
    blocks = max(1, -(-count // block_windows), -(-size // block_bytes))
    rest = [c for c in docs.columns if c != text_col]
    row = F.struct(*(F.col(f"`{c}`") for c in rest)) if rest else F.struct(F.lit(0).alias("_"))
    empty = {k: F.array().cast(t) for k, t in (("at", "array<int>"), ("len", "array<int>"), ("items", "array<string>"))}
    now = docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("text"), *(c.alias(k) for k, c in empty.items()))
    for i in range(blocks):
        mine = grams if blocks == 1 else grams.where(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == i)
        held = spark.sparkContext.broadcast(_lookup(mine.collect()))
        now = now.mapInArrow(_scan(held), now.schema)
        if i + 1 < blocks:
            now = stored(now, "scanned")
    plain = now.schema
    out = f"row {plain['row'].dataType.simpleString()}, text string, items array<string>, n_words long, n_hit long"
    return now.mapInArrow(_finish(cut), out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "documents", **options) -> DataFrame:
    """``docs`` without the documents that hold a test window (``documents``)
    or with the hit spans removed from their texts (``spans``); same columns."""
    if action not in ("documents", "spans"):
        raise ValueError(action)
    text_col = options.get("text_col", "text")
    found = scan(docs, benchmark, cut=action == "spans", **options)
    if action == "documents":
        found = found.where("n_hit = 0")
    return found.select(*(F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
