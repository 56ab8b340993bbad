"""MinHash near-duplicates with sequential Bayesian verification.

Documents are linked when their sets of distinct word shingles have
``intersection / union >= num / den``.  The steps:

1. One pass over the texts makes, for each document, the size of its set, a
   128-bit digest of the set and a MinHash signature.  Equal sets collapse
   into a class, represented by its smallest id, so groups of exact copies
   cost one row from here on.
2. Signatures are cut into bands; documents that share a band are candidates.
   In each band the members are compared with the band's smallest id only
   (linear in the group).  Batches of signature positions are compared in
   turn; a pair is dropped as soon as the posterior probability that its
   similarity reaches the threshold falls below ``miss`` (uniform prior).
   Each member's most promising survivor is verified exactly on the full
   shingle sets, and the verified links give provisional components.
3. Bands that still join several components are searched in full for links
   across components.  In such a band the members of its largest component are
   never compared with each other: only the others, the outsiders, are compared
   with all members, in blocks of bounded size, so a band of many near copies
   costs a row each, and its outsiders a row for each block.  First the blocks
   hold signatures: the sequential test prunes.  Then members that are left
   meet again with their texts, and the pairs are verified exactly, inside the
   block: a block gives the links that span its components, never a pair list.
4. Components of all verified links.

A link at the threshold is missed with probability
``(1 - s**rows)**bands + miss`` (about 6e-11 + 1e-6 at s = 0.85, rows = 4,
bands = 32).  Executors' loss is safe: every hand-off is a written table.

Defined cases: null or empty text, or text without words, has an empty set
(size 0) and links with nothing.  Fewer words than a shingle: the whole
sequence is the one shingle.  Rows that repeat a doc_id keep a row each and
count as one document.  A null doc_id stays alone: component null, kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitscope.llm import text as X
from hitscope.llm.runtime import connected_components, prepare, stored

SHINGLE = 5
BANDS, ROWS = 32, 4
BATCH = 32  # signature positions compared between two tests
MISS = 1e-6
BLOCK, BLOCK_SHINGLES = 1024, 1_000_000  # members of a band, and their shingles, compared at once in the full search

_SIZE = BANDS * ROWS
_MULT = X._mix(np.arange(1, _SIZE + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)

SIGNED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("k1", T.LongType()),
        T.StructField("k2", T.LongType()),
        T.StructField("sig", T.BinaryType()),
    ]
)


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = X.Words(column, X.SPACED)
    h = words.hashes()
    at, win = words.windows(h, k)
    lo = np.searchsorted(at, words.first[:-1])
    hi = np.searchsorted(at, words.first[1:])
    out = []
    for i, n in enumerate(words.count):
        if n >= k:
            out.append(np.unique(win[lo[i] : hi[i]]))
        elif n:
            out.append(np.array([X.fold(h[words.first[i] : words.first[i + 1]])], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(s: np.ndarray, size: int) -> bytes:
    low = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
    mult = _MULT[:size, None]
    for i in range(0, len(s), 512):
        np.minimum(low, (mult * s[None, i : i + 512]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype("<u4").tobytes()


def _signed(k: int, size: int, with_text: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in X.pieces(whole, "text"):
                n, k1, k2, sig = [], [], [], []
                for s in shingle_sets(b.column("text"), k):
                    n.append(len(s))
                    k1.append(int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else None)
                    k2.append(int(X._mix(s ^ X._MIX1).sum(dtype=np.uint64).view(np.int64)) if len(s) else None)
                    sig.append(signature(s, size) if len(s) else None)
                cols = [b.column("id"), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sig, pa.binary())]
                names = ["id", "n", "k1", "k2", "sig"]
                if with_text:
                    cols, names = [*cols, b.column("text")], [*names, "text"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def least_matches(s: float, size: int, batch: int, miss: float) -> list[int]:
    """After each batch of n positions, the fewest matches m for which the
    posterior P(J >= s | m of n), with a uniform prior, is at least miss."""
    out = []
    for n in range(batch, size + 1, batch):
        tail, m = 0.0, 0
        while True:  # P(Beta(m+1, n-m+1) >= s) = P(Binomial(n+1, s) <= m)
            tail += comb(n + 1, m) * s**m * (1 - s) ** (n + 1 - m)
            if tail >= miss or m == n:
                break
            m += 1
        out.append(m)
    return out


def _promising(a: np.ndarray, b: np.ndarray, least: list[int], batch: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two signature arrays that pass every test, and their matches;
    later batches look only at the rows that are left."""
    left = np.arange(len(a))
    m = np.zeros(len(a), np.int64)
    for i, need in enumerate(least):
        part = slice(i * batch, (i + 1) * batch)
        m[left] += (a[left, part] == b[left, part]).sum(axis=1)
        left = left[m[left] >= need]
        if not len(left):
            break
    return left, m


def _array(column: pa.Array, size: int) -> np.ndarray:
    data, _ = X.flat(column)
    return data.view("<u4").reshape(-1, size) if len(data) else np.zeros((0, size), "<u4")


def _test_pairs(size: int, least: list[int], num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            na, nb = (b.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb"))
            fit = np.flatnonzero(np.minimum(na, nb) * den >= np.maximum(na, nb) * num)
            sa, sb = _array(b.column("sa"), size), _array(b.column("sb"), size)
            left, m = _promising(sa[fit], sb[fit], least, BATCH)
            rows = pa.array(fit[left])
            yield pa.RecordBatch.from_arrays(
                [b.column("a").take(rows), b.column("b").take(rows), pa.array(m[left], pa.int64())], names=["a", "b", "m"]
            )

    return run


_GROUP = ("key", "c", "o")
_MEMBER = "key long, c int, o int, id long, comp long, side int, out boolean, band int"


def _search_blocks(size: int, rows: int, least: list[int], num: int, den: int, shingle: int, with_text: bool):
    """Rows sorted by (key, c, o): block c of a band's members (side 0) and block
    o of its outsiders (side 1).  Tests outsiders with members of other
    components, each pair in the first band that it shares.  Without texts it
    gives the members that some test leaves; with texts it verifies on the full
    sets and gives links that span what the block joins, not every link."""

    def pairs(i, home, ids, comp, n, out, band, sig):
        """Members that outsider ``i`` may be linked with."""
        j = home[~out[home] | (ids[home] > ids[i])]  # two outsiders: from the smaller id only
        j = j[np.minimum(n[j], n[i]) * den >= np.maximum(n[j], n[i]) * num]
        if len(j):
            keep, _ = _promising(np.broadcast_to(sig[i], (len(j), size)), sig[j], least, BATCH)
            j = j[keep]
        if len(j):
            j = j[(sig[j].reshape(len(j), -1, rows) == sig[i].reshape(-1, rows)).all(axis=2).argmax(axis=1) == band]
        return j

    def hopeful(ids, comp, n, side, out, band, sig):
        hit, home = np.zeros(len(ids), bool), np.flatnonzero(side == 0)
        for i in np.flatnonzero(side == 1):
            j = pairs(i, home[comp[home] != comp[i]], ids, comp, n, out, band, sig)
            hit[j] = True
            hit[i] |= len(j) > 0
        return hit

    def links(t: pa.Table, ids, comp, n, side, out, band, sig):
        home = np.flatnonzero(side == 0)
        values, comp = np.unique(comp, return_inverse=True)
        now = np.arange(len(values))  # what the block's links have joined so far
        places = None
        for i in np.flatnonzero(side == 1):
            j = pairs(i, home[now[comp[home]] != now[comp[i]]], ids, comp, n, out, band, sig)
            if not len(j):
                continue
            if places is None:  # the sets of the block, as places in a common list of shingles
                sets = shingle_sets(t.column("text").combine_chunks(), shingle)
                first = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
                vocabulary, places = np.unique(np.concatenate(sets), return_inverse=True)
                mark = np.zeros(len(vocabulary), bool)
            mine = places[first[i] : first[i + 1]]
            mark[mine] = True
            for x in j:
                if now[comp[x]] != now[comp[i]]:
                    both = int(mark[places[first[x] : first[x + 1]]].sum())
                    if den * both >= num * (int(n[i]) + int(n[x]) - both):
                        now[now == now[comp[x]]] = now[comp[i]]
                        yield (min(ids[i], ids[x]), max(ids[i], ids[x]))
            mark[mine] = False

    def work(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        cols = {c: t.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in (*_GROUP, "id", "comp", "n", "side", "out", "band")}
        cols["out"] = cols["out"].astype(bool)
        sig = _array(t.column("sig"), size)
        k = np.stack([cols[c] for c in _GROUP])
        cuts = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
        bounds = [0, *cuts.tolist(), t.num_rows]
        a, b, hit = [], [], np.zeros(t.num_rows, bool)
        for s, e in zip(bounds, bounds[1:]):
            mine = [*(cols[c][s:e] for c in ("id", "comp", "n", "side", "out")), cols["band"][s], sig[s:e]]
            if not with_text:
                hit[s:e] = hopeful(*mine)
                continue
            for x, y in links(t.slice(s, e - s), *mine):
                a.append(x)
                b.append(y)
        if with_text:
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        names = [c.split()[0] for c in _MEMBER.split(", ")]
        return t.select(names).filter(pa.array(hit)).combine_chunks().to_batches(max_chunksize=1 << 30)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out_of(t: pa.Table):
            found = work(t)
            yield from [found] if isinstance(found, pa.RecordBatch) else found

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            t = pa.Table.from_batches(held)
            k = np.stack([t.column(c).to_numpy() for c in _GROUP])
            other = (k != k[:, -1:]).any(axis=0)
            cut = int(np.flatnonzero(other)[-1] + 1) if other.any() else 0
            if cut:
                yield from out_of(t.slice(0, cut))
            held = t.slice(cut).to_batches()
        if held:
            yield from out_of(pa.Table.from_batches(held))

    return run


def open_bands(labelled: DataFrame) -> DataFrame:
    """Bands (rows of ``labelled``: key, comp, n) of several components: the
    largest, and the blocks of all members and of the others."""
    each = labelled.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("size"))
    band = each.groupBy("key").agg(F.max(F.struct("m", "comp", "size")).alias("top"), F.sum("m").alias("m"), F.sum("size").alias("size"))
    blocks = lambda m, size: F.ceil(F.greatest(m / F.lit(BLOCK), size / F.lit(BLOCK_SHINGLES))).cast("int")
    return band.where("top.m < m").select(
        "key",
        F.col("top.comp").alias("major"),
        blocks(F.col("m"), F.col("size")).alias("blocks"),
        blocks(F.col("m") - F.col("top.m"), F.col("size") - F.col("top.size")).alias("outer"),
    )


def spread_members(labelled: DataFrame, bands: DataFrame) -> DataFrame:
    """Members of open bands in their block, and outsiders in every block."""
    tagged = labelled.join(bands, "key").withColumns(
        {"c": F.pmod(F.hash("id"), F.col("blocks")), "o": F.pmod(F.hash("id", F.lit(1)), F.col("outer")), "out": F.col("comp") != F.col("major")}
    )
    cols = ["id", "comp", "out", "band"]
    homes = tagged.select("key", "c", F.explode(F.sequence(F.lit(0), F.col("outer") - 1)).alias("o"), *cols, F.lit(0).alias("side"))
    asks = tagged.where("out").select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("c"), "o", *cols, F.lit(1).alias("side"))
    return homes.unionByName(asks)


def _verify(k: int, num: int, den: int):
    """Exact test on the full shingle sets of both texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in X.pieces(whole, "ta"):
                ok = []
                for x, y in zip(shingle_sets(b.column("ta"), k), shingle_sets(b.column("tb"), k)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(bool(both) and den * both >= num * (len(x) + len(y) - both))
                rows = pa.array(np.flatnonzero(ok))
                yield pa.RecordBatch.from_arrays([b.column("a").take(rows), b.column("b").take(rows)], names=["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    num: int = 80,
    den: int = 100,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    miss: float = MISS,
) -> DataFrame:
    """One row per input row: (id, n, component), component being the smallest
    id reachable over links of similarity >= num / den."""
    prepare(docs.sparkSession)
    size = bands * rows
    if not 0 < size <= _SIZE or size % BATCH:
        raise ValueError(f"bands * rows must be a multiple of {BATCH} up to {_SIZE}")
    least = least_matches(num / den, size, BATCH, miss)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    signed = stored(source.mapInArrow(_signed(shingle, size), SIGNED), "signed")
    full = signed.where("n > 0 and id is not null")
    # Grouped tables that meet hot keys again are written first: the adaptive
    # plan can split a hot key only where both sides of a join are plain shuffles.
    classes = stored(full.groupBy("k1", "k2").agg(F.min("id").alias("rep")), "classes")
    heads = stored(
        full.join(classes, ["k1", "k2"]).where("id = rep").select("id", "n", "sig"), "heads"
    )

    key = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda i: F.struct(i.alias("band"), F.xxhash64(i, F.substring("sig", i * (4 * rows) + 1, F.lit(4 * rows))).alias("key")),
    )
    banded = heads.select("id", F.inline(key))
    shared = banded.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last")).where("lead < last")
    members = stored(banded.join(stored(shared.select("key", "lead"), "shared"), "key"), "members")

    side = lambda x: heads.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
    star = members.where("id > lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    tested = (
        star.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "sa", "sb")
        .mapInArrow(_test_pairs(size, least, num, den), "a long, b long, m long")
    )
    best = tested.groupBy("b").agg(F.max(F.struct("m", (-F.col("a")).alias("x"))).alias("t")).select(
        (-F.col("t.x")).alias("a"), "b"
    )

    # texts that a verification may need: those of documents that share a band
    involved = stored(source.join(members.select("id").distinct(), "id", "left_semi"), "involved")

    text = lambda x: involved.select(F.col("id").alias(x), F.col("text").alias(f"t{x}"))
    first = stored(
        stored(best, "best").join(text("a"), "a").join(text("b"), "b").select("a", "b", "ta", "tb")
        .mapInArrow(_verify(shingle, num, den), "a long, b long"),
        "links",
    )
    roots = connected_components(first)
    labelled = members.join(roots, "id", "left").withColumn("comp", F.coalesce("root", "id")).select("id", "key", "band", "comp")
    bands = stored(open_bands(labelled.join(heads.select("id", "n"), "id")), "open")
    spread = stored(spread_members(labelled, bands), "spread")
    search = lambda df, with_text, shape: (
        df.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "id")
        .mapInArrow(_search_blocks(size, rows, least, num, den, shingle, with_text), shape).distinct()
    )
    cols = ["key", "c", "o", "id", "comp", "n", "side", "out", "band", "sig"]
    hopeful = stored(search(spread.join(heads, "id").select(cols), False, _MEMBER), "hopeful")
    # signature and text of a member from one row, whatever its id repeats
    searched = involved.join(hopeful.select("id").distinct(), "id", "left_semi").mapInArrow(
        _signed(shingle, size, True), T.StructType([*SIGNED.fields, T.StructField("text", T.StringType())])
    )
    second = stored(search(hopeful.join(searched.where("n > 0"), "id").select(*cols, "text"), True, "a long, b long"), "links")
    roots = connected_components(
        roots.select(F.col("root").alias("a"), F.col("id").alias("b")).unionByName(second)
    )
    component = stored(
        classes.join(roots.withColumnRenamed("id", "rep"), "rep", "left")
        .select("k1", "k2", F.coalesce("root", "rep").alias("component")),
        "components",
    )
    return (
        signed.drop("sig").join(component, ["k1", "k2"], "left")
        .select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
    )
