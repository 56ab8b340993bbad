"""Hard negatives for anchors, exactly, by spanning trees of anchors.

A row's score is the integer inner product of its vector (components
``floor(scale * x)``) with the anchor's.  An anchor's positives are its best
rows of the same label; each pair of anchor and positive takes the best rows of
other labels whose score lies between ``low`` and ``high`` hundredths of the
positive's.

Anchors are dealt into blocks of neighbours (label, then the side of some
random planes), and each block gets its minimum spanning tree.  Candidates are
dealt into chunks.  A task walks a block's tree over one chunk after another:
the root is scored with every candidate; a child's score differs from its
parent's by at most the length of the edge times the candidate's norm, so the
parent's score, or its bounds, bound the child's.  Only candidates whose bounds
meet a window that is still open are scored anew: for positives the window
begins at the worst of the best so far, for negatives it is the interval that
the positive gives, begun at the worst of the best so far.  Bounds that miss
every window are handed down, wider by the next edge.

The anchors are a stated share of the rows, so this is a search in blocks: each
chunk is sent to the blocks it can serve (positives: those that share a label),
and each block's work is split into ``SPLITS`` tasks whose short lists are
merged.  A task holds one block, one chunk and the bounds of the open branches
(at most log2 of the block) at a time.  A label, or a vector, that a third of
all rows share only means more chunks.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component take no part; vectors of different lengths never meet; labels are
integers; equal scores go by the smaller id; repeated rows are rows of their
own, and an anchor is not its own positive; an anchor without positives, and a
pair without negatives, gives no row.  Scores must stay below 2^63.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitscope.llm.runtime import prepare, stored

BLOCK_ROWS = 512  # anchors in a block
CHUNK_ROWS = 4096  # candidates in a chunk
SPLITS = 8  # tasks for a block
PLANES = 8
EXACT = float(1 << 53)

_PACKED = "rows binary, ids binary, labels binary, vectors binary, n int, dim int, kinds array<bigint>"
_TREE = "parents binary, edges binary, turns binary, anchors array<bigint>"


def _vectors(rows: DataFrame, scale: int) -> DataFrame:
    """(row, id, label, vector of whole numbers) of the rows that take part."""
    x = F.transform("vector", lambda c: c.cast("double"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        rows.where("id is not null and label is not null and vector is not null")
        .withColumn("x", x)
        .where(fine)
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.col("id").cast("long").alias("id"),
            F.col("label").cast("long").alias("label"),
            F.transform("x", lambda c: F.floor(c * F.lit(float(scale)))).alias("vector"),
            "is_anchor",
        )
    )


def _side(vector: str) -> Column:
    """On which sides of ``PLANES`` planes through the origin a vector lies."""
    sign = lambda b: lambda x, i: F.when(F.xxhash64(i, F.lit(b)) % 2 == 0, x).otherwise(-x)
    total = lambda b: F.aggregate(F.transform(vector, sign(b)), F.lit(0.0), lambda s, x: s + x)
    out = F.lit(0)
    for b in range(PLANES):
        out = out * 2 + (total(b) > 0).cast("int")
    return out


def _tree(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree (Prim): each row's parent (-1 at the root), the
    length of the edge to it, and the rows in an order in which parents come
    before children and the largest branch comes last."""
    n = len(v)
    norm = np.einsum("ij,ij->i", v, v)
    near, parent = np.full(n, np.inf), np.full(n, -1)
    left = np.ones(n, bool)
    now, found = 0, [0]
    while True:
        left[now] = False
        far = np.maximum(norm + norm[now] - 2 * (v @ v[now]), 0)
        closer = left & (far < near)
        near[closer], parent[closer] = far[closer], now
        if not left.any():
            break
        now = int(np.argmin(np.where(left, near, np.inf)))
        found.append(now)
    near[0] = 0
    size = np.ones(n, np.int64)
    for x in reversed(found[1:]):
        size[parent[x]] += size[x]
    children: list[list[int]] = [[] for _ in range(n)]
    for x in found[1:]:
        children[parent[x]].append(x)
    turns, open_ = [], [0]
    while open_:
        x = open_.pop()
        turns.append(x)
        open_ += sorted(children[x], key=lambda c: -size[c])  # the smallest branch is taken first
    return parent.astype(np.int32), np.sqrt(near), np.array(turns, np.int32)


def _pack(most: int, with_tree: bool):
    """Rows in the order given -> packed tables of at most ``most`` rows of one
    vector length, with their labels."""

    def pack(rows: list) -> dict:
        cat = [np.concatenate([r[k] for r in rows]) for k in range(4)]
        row, ids, label, v = cat
        out = {
            "rows": row.tobytes(), "ids": ids.tobytes(), "labels": label.tobytes(), "vectors": v.tobytes(),
            "n": len(row), "dim": v.shape[1], "kinds": np.unique(label).tolist(),
        }
        if with_tree:
            parent, edge, turns = _tree(v.astype(np.float64))
            out |= {"parents": parent.tobytes(), "edges": edge.tobytes(), "turns": turns.tobytes(), "anchors": row.tolist()}
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        kinds = {"n": pa.int32(), "dim": pa.int32(), "kinds": pa.list_(pa.int64()), "anchors": pa.list_(pa.int64())}

        def emit() -> pa.RecordBatch:
            d = pack(held)
            return pa.RecordBatch.from_arrays([pa.array([x], kinds.get(k, pa.binary())) for k, x in d.items()], names=list(d))

        for b in batches:
            vectors = b.column("vector")
            width = np.diff(vectors.offsets.to_numpy())
            flat, at = vectors.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(width)])
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("row", "id", "label")]
            x = 0
            while x < b.num_rows:
                if held and (n >= most or held[0][3].shape[1] != width[x]):
                    yield emit()
                    held, n = [], 0
                y = x
                while y < b.num_rows and width[y] == width[x] and n + y - x < most:
                    y += 1
                held.append([*(c[x:y] for c in cols), flat[at[x] : at[y]].reshape(y - x, int(width[x]))])
                n, x = n + y - x, y
        if held:
            yield emit()

    return run


def _unpack(r: dict) -> dict:
    n, dim = r["n"], r["dim"]
    out = {k: np.frombuffer(r[k], np.int64) for k in ("rows", "ids", "labels")}
    out["vectors"] = np.frombuffer(r["vectors"], np.int64).reshape(n, dim)
    return out


def _whole(score: np.ndarray) -> np.ndarray:
    return score if score.dtype == np.int64 else np.rint(score).astype(np.int64)


def _best(k: int, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, old: tuple) -> tuple:
    """The first k of the old and new (score, id, row): by score, id, row."""
    if len(score) > k:  # all rows as good as the k-th
        top = score >= np.partition(score, len(score) - k)[len(score) - k]
        score, ids, rows = score[top], ids[top], rows[top]
    score, ids, rows = (np.concatenate(x) for x in zip(old, (score, ids, rows)))
    order = np.lexsort((rows, ids, -score))[:k]
    return score[order], ids[order], rows[order]


_NONE = (np.zeros(0, np.int64),) * 3


class _Block:
    """A block's tree and, for each anchor, its short lists."""

    def __init__(self, r: dict):
        d = _unpack(r)
        self.rows, self.labels = d["rows"], d["labels"]
        self.whole, self.v = d["vectors"], d["vectors"].astype(np.float64)
        self.norm = float(np.sqrt(np.einsum("ij,ij->i", self.v, self.v)).max(initial=0))
        self.parents, self.turns = np.frombuffer(r["parents"], np.int32), np.frombuffer(r["turns"], np.int32)
        self.edges = np.frombuffer(r["edges"], np.float64) * (1 + 1e-9)
        self.children = np.bincount(self.parents[self.parents >= 0], minlength=len(self.rows))
        self.scored = 0

    def walk(self, chunk: dict, offer) -> None:
        """Bounds of every anchor's scores with the chunk, by the tree.
        ``offer(anchor, low, high, score)`` picks the candidates it has to know
        exactly and calls ``score`` for them."""
        v = chunk["vectors"].astype(np.float64)
        norm = np.sqrt(np.einsum("ij,ij->i", v, v)) * (1 + 1e-9)
        exact = self.norm * float(norm.max(initial=0)) < EXACT
        if not exact:  # whole numbers beyond a double's: every score in 64 bits
            v = chunk["vectors"]
        bounds: dict[int, list] = {}
        for a in self.turns.tolist():
            p = int(self.parents[a])
            if p < 0 or not exact:
                s = v @ (self.v[a] if exact else self.whole[a])
                low = high = s
                self.scored += len(s)
                offer(a, low, high, lambda at, s=s: s[at])
            else:
                reach = self.edges[a] * norm
                low, high = bounds[p][0] - reach, bounds[p][1] + reach

                def score(at, a=a, low=low, high=high):
                    # picking more than half of the rows costs more than all of them
                    s = (v @ self.v[a])[at] if 2 * len(at) > len(v) else v[at] @ self.v[a]
                    self.scored += len(at)
                    low[at] = high[at] = s
                    return s

                offer(a, low, high, score)
                bounds[p][2] -= 1
                if not bounds[p][2]:
                    del bounds[p]
            if exact and self.children[a]:
                bounds[a] = [low, high, int(self.children[a])]


def _positives(b: _Block, chunk: dict, best: list, k: int) -> None:
    groups = {x: np.flatnonzero(chunk["labels"] == x) for x in np.unique(b.labels).tolist()}

    def offer(a, low, high, score):
        at = groups[int(b.labels[a])]
        at = at[chunk["rows"][at] != b.rows[a]]
        if not len(at):
            return
        old = best[a]
        least = float(old[0][-1]) if len(old[0]) == k else -np.inf
        if len(at) > k:  # k candidates reach the k-th of the lower bounds
            least = max(least, float(np.partition(low[at], len(at) - k)[len(at) - k]))
        at = at[high[at] >= least]
        s = _whole(score(at))
        best[a] = _best(k, s, chunk["ids"][at], chunk["rows"][at], old)

    b.walk(chunk, offer)


def _negatives(b: _Block, chunk: dict, best: dict, k: int, windows: dict) -> None:
    """``windows``: anchor -> its positives as (place, lowest, highest)."""
    other = {x: chunk["labels"] != x for x in np.unique(b.labels).tolist()}

    def offer(a, low, high, score):
        need, still = np.zeros(len(low), bool), []
        for place, lo, hi in windows.get(a, ()):
            old = best.get((a, place), _NONE)[0]
            lo = max(lo, int(old[-1])) if len(old) == k else lo
            if lo <= hi:
                need |= (high >= lo) & (low <= hi)
                still.append((place, lo, hi))
        at = np.flatnonzero(need & other[int(b.labels[a])])
        if not len(at):
            return
        s = _whole(score(at))
        for place, lo, hi in still:
            m = (s >= lo) & (s <= hi)
            if m.any():
                best[a, place] = _best(k, s[m], chunk["ids"][at[m]], chunk["rows"][at[m]], best.get((a, place), _NONE))

    b.walk(chunk, offer)


def _search(n_positives: int, n_negatives: int, low: int, high: int, of: int, negatives: bool):
    """Rows of a (block, split), the block first and then its chunks -> the
    short lists of each anchor."""

    def lists(block: _Block, best) -> Iterator[tuple]:
        items = best.items() if negatives else (((a, None), x) for a, x in enumerate(best))
        for (a, place), (score, ids, rows) in items:
            for s, i, r in zip(score.tolist(), ids.tolist(), rows.tolist()):
                yield int(block.rows[a]), place, i, r, s

    def out(block: _Block, best) -> Iterator[pa.RecordBatch]:
        found = list(lists(block, best))
        for x in range(0, len(found), 4096):
            cols = zip(*found[x : x + 4096])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["anchor", "place", "id", "row", "score"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best, windows = None, None, {}
        for b in batches:
            for r in b.to_pylist():
                if r["kind"] == 0:
                    if block:
                        yield from out(block, best)
                    block = _Block(r)
                    best = {} if negatives else [_NONE] * len(block.rows)
                    windows = {}
                    for x in r["targets"] or ():
                        s = x["score"]
                        windows.setdefault(x["place_in_block"], []).append((x["place"], -(-low * s // of), high * s // of))
                elif negatives:
                    _negatives(block, _unpack(r), best, n_negatives, windows)
                else:
                    _positives(block, _unpack(r), best, n_positives)
        if block:
            yield from out(block, best)

    return run


def _tiles(blocks: DataFrame, chunks: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of (block, split): the block (kind 0), then its chunks (kind 1)."""
    first = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(SPLITS - 1))).alias("split"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("chunk"))
    rest = chunks.join(pairs, "chunk").withColumns({"split": F.pmod(F.xxhash64("chunk"), F.lit(SPLITS)).cast("int"), "kind": F.lit(1)})
    return (
        first.unionByName(rest, allowMissingColumns=True)
        .repartition("block", "split")
        .sortWithinPartitions("block", "split", "kind", "chunk")
    )


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "id",
    label_col: str = "label",
    vector_col: str = "vector",
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
    of: int = 100,
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each anchor and each of its positives the first
    negatives with low * positive <= of * negative <= high * positive."""
    spark = prepare(rows.sparkSession)
    given = rows.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    all_rows = stored(_vectors(given, scale), "vectors").withColumn("width", F.size("vector"))
    n, n_anchors = all_rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    parts = lambda count, most: max(1, -(-count // most))

    def packed(df: DataFrame, most: int, tree: bool, count: int, key: Column, name: str) -> DataFrame:
        sorted_ = (
            df.withColumn("key", key)
            .repartitionByRange(parts(count, most), "width", "label", "key")
            .sortWithinPartitions("width", "label", "key", "id")
            .select("row", "id", "label", "vector")
        )
        shape = _PACKED + (f", {_TREE}" if tree else "")
        made = sorted_.mapInArrow(_pack(most, tree), shape).withColumn(name, F.monotonically_increasing_id())
        return stored(made, f"{name}s")

    chunks = packed(all_rows, CHUNK_ROWS, False, n, F.xxhash64("id"), "chunk")
    blocks = packed(all_rows.where("is_anchor"), BLOCK_ROWS, True, n_anchors, _side("vector"), "block")

    # positives: blocks meet the chunks that share a label
    of_chunk = chunks.select("chunk", "dim", F.explode("kinds").alias("label"))
    of_block = blocks.select("block", "dim", F.explode("kinds").alias("label"))
    same = of_chunk.join(of_block, ["dim", "label"]).select("chunk", "block").distinct()
    no_targets = F.lit(None).cast("array<struct<place_in_block: int, place: int, score: bigint>>")
    found = "anchor long, place int, id long, row long, score long"
    arguments = (n_positives, n_negatives, low, high, of)
    partial = _tiles(blocks.withColumn("targets", no_targets), chunks, same).mapInArrow(_search(*arguments, False), found)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row")
    positives = stored(
        partial.withColumn("place", F.row_number().over(first)).where(F.col("place") <= n_positives), "positives"
    )

    # negatives: each block takes its anchors' positives along and meets all chunks but those of its only label
    where_is = blocks.select("block", F.posexplode("anchors").alias("place_in_block", "anchor"))
    targets = (
        positives.join(where_is, "anchor")
        .groupBy("block").agg(F.collect_list(F.struct("place_in_block", "place", "score")).alias("targets"))
    )
    one = F.when(F.size("kinds") == 1, F.col("kinds")[0])
    differ = (
        chunks.select("chunk", "dim", one.alias("only"))
        .join(blocks.select("block", "dim", one.alias("only_b")), "dim")
        .where("only is null or only_b is null or only != only_b")
        .select("chunk", "block")
    )
    partial = _tiles(blocks.join(targets, "block"), chunks, differ.join(targets.select("block"), "block")).mapInArrow(_search(*arguments, True), found)
    first = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row")
    negatives = partial.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= n_negatives)
    pair = positives.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = all_rows.where("is_anchor").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return (
        negatives.join(pair, ["anchor", "place"]).join(ids, "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
