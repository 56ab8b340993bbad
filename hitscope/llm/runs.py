"""Periodic runs of words: every maximal stretch of a text that repeats with
a period of ``q`` words at least ``min_exponent`` times and holds at least
``min_length`` words.

Two stages per document.  *Grid*: a run of period p and length L has L - p
neighbouring places i whose word equals the word at i + p.  Places that are
multiples of half that stretch are tried for every period up to n / 3, so the
number of pairs (place, period) is a harmonic sum, n log n.  A pair stays if the
hashes of the next ``K`` words agree, which leaves little but true runs.
*Extension*: how far a pair goes on to both sides is the longest common
extension of two places.  It is answered from suffixes sampled by a difference
cover of ``V``: for any two places there is a shift below V after which both are
samples, so at most V - 1 words are compared one by one, and the rest is a range
minimum over the common prefixes of the sorted samples (a sparse table).  Only
the samples are sorted: by their first V words, then by doubling among samples
of the same residue.  The same structure over the reversed words gives the way
back.  Documents without a surviving pair get no such structure.  A stretch that
is found with several periods keeps the smallest.

One pass in small batches, without a shuffle; a task holds a batch of about
1 MB of text, or one text, at a time (a text of n words takes some 200 n bytes).

Defined cases: words are runs of anything but ASCII white space, compared byte
by byte; null and empty texts have no words, no runs and an empty collapsed
text; null ids, repeated rows and extra columns pass through in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitscope.llm import text as X
from hitscope.llm.runtime import prepare

MIN_LENGTH = 24
MIN_EXPONENT = 3
#: A difference cover of 31: every residue is a difference of two of these.
V = 31
COVER = (0, 1, 3, 8, 12, 18)
RUN = "struct<start: bigint, length: bigint, period: bigint>"
PAIRS = 1 << 20  # pairs held at a time
LOOP_PERIODS = 1024  # longer periods have few places each and are tried together


def _shifts() -> np.ndarray:
    """[difference of two places mod V, first place mod V] -> the smallest
    shift that makes both samples."""
    out = np.full((V, V), V, np.int64)
    for a in COVER:
        for b in COVER:
            for i in range(V):
                d = (b - a) % V
                out[d, i] = min(out[d, i], (a - i) % V)
    return out


def _dense(*keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks from 1 of rows of keys (first key first), and how many differ."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) + 1
    return rank, int(rank[order[-1]]) if len(order) else 0


class CoverLce:
    """Longest common extensions of places in a sequence of codes (0 and up).
    Codes that must not be crossed have to be unique in the sequence."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        tail = np.arange(2 * V, dtype=np.int64) + (int(codes.max()) + 1 if n else 0)
        self.words = w = np.concatenate([codes.astype(np.int64), tail])
        self.shift = _shifts()
        sampled = np.zeros(V, bool)
        sampled[list(COVER)] = True
        at = np.flatnonzero(sampled[np.arange(n + V) % V])
        self.place = np.full(len(w) + 1, -1, np.int64)
        self.place[at] = np.arange(len(at))
        after = np.full(len(at) + 1, len(at), np.int64)  # the sample V words on; the last entry stands for none
        inside = at + V < n + V
        after[:-1][inside] = self.place[at[inside] + V]
        # first V words: codes packed three to a key
        bits = max(1, int(w.max()).bit_length()) if len(w) else 1
        per, keys = max(1, 63 // bits), []
        for k in range(0, V, per):
            key = np.zeros(len(at), np.int64)
            for x in range(k, min(k + per, V)):
                key = (key << bits) | w[at + x]
            keys.append(key)
        rank, kinds = _dense(*keys)
        levels, hops = [np.append(rank, 0)], [after]
        while kinds < len(at):
            r, hop = levels[-1], hops[-1]
            rank, kinds = _dense(r[:-1], r[hop[:-1]])
            levels.append(np.append(rank, 0))
            hops.append(hop[hop])
        self.rank = levels[-1]
        order = np.argsort(self.rank[:-1])
        # common prefixes of neighbours in order, by whole powers of V words and then word by word
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for level, (r, hop) in reversed(list(enumerate(zip(levels, hops)))):
            same = (r[a] == r[b]) & (a < len(at)) & (b < len(at))
            common[same] += V << level
            a[same], b[same] = hop[a[same]], hop[b[same]]
        live = np.flatnonzero((a < len(at)) & (b < len(at)))
        pa_, pb = at[a[live]], at[b[live]]
        for x in range(V):
            same = w[pa_ + x] == w[pb + x]
            live, pa_, pb = live[same], pa_[same], pb[same]
            if not len(live):
                break
            common[live] += 1
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            t, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(t[:-half], t[half:]))

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each pair of different places, how many words agree from there."""
        w = self.words
        shift = self.shift[(j - i) % V, i % V]
        out = shift.copy()
        live = np.flatnonzero(shift > 0)
        for x in range(V):
            same = w[i[live] + x] == w[j[live] + x]
            out[live[~same]] = x
            live = live[same]
            live = live[shift[live] > x + 1]
            if not len(live):
                break
        far = np.flatnonzero(out == shift)
        a, b = (self.rank[self.place[p[far] + shift[far]]] - 1 for p in (i, j))
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        for k in np.unique(level):
            m = level == k
            t = self.table[k]
            out[far[m]] += np.minimum(t[lo[m]], t[hi[m] - (1 << k)])
        return out


def _need(p, min_length: int, exponent: int):
    """Places in a row at which a run of period p repeats, at least."""
    return np.maximum(np.maximum(min_length - p, (exponent - 1) * p), 1)


def _pairs(h: np.ndarray, sizes: np.ndarray, min_length: int, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid pairs (place, period) whose next words agree.  ``sizes``: words of
    each document, falling; ``h``: their word hashes on end."""
    upto = np.cumsum(sizes)
    periods = np.arange(1, int(sizes[0]) // exponent + 1)
    need = _need(periods, min_length, exponent)
    step = np.maximum(need // 2, 1)
    k = int((need - step + 1).min())
    n = len(h) - k + 1
    if n <= 0:
        return
    prefix = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * X._powers(X._B, len(h)), dtype=np.uint64, out=prefix[1:])
    window = (prefix[k:] - prefix[:-k]) * X._powers(X._B_INV, n)
    # words of the documents that are long enough for each period
    fit = np.searchsorted(-sizes, -np.maximum(periods * exponent, min_length), "right")
    words = np.where(fit > 0, upto[np.maximum(fit, 1) - 1], 0)
    end = np.minimum(words - k + 1, n) - periods  # places i with both windows
    loop = min(len(periods), LOOP_PERIODS)
    for x in range(loop):
        p, e, s = x + 1, int(end[x]), int(step[x])
        if e > 0:
            at = np.flatnonzero(window[:e:s] == window[p : p + e : s])
            if len(at):
                yield at * s, np.full(len(at), p, np.int64)
    rest, counts = periods[loop:], np.maximum(-(-end[loop:] // step[loop:]), 0)
    upto_pair = np.cumsum(counts)
    x = 0
    while x < len(rest):
        y = max(x + 1, int(np.searchsorted(upto_pair, (upto_pair[x - 1] if x else 0) + PAIRS, "right")))
        c = counts[x:y]
        p = np.repeat(rest[x:y], c)
        at = (np.arange(len(p)) - np.repeat(np.cumsum(c) - c, c)) * np.repeat(step[loop + x : loop + y], c)
        same = window[at] == window[at + p]
        if same.any():
            yield at[same], p[same]
        x = y


def find_runs(h: np.ndarray, sizes: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (document, start, length, period), sorted, of documents given by
    their words' hashes on end and their numbers of words."""
    none = np.zeros((0, 4), np.int64)
    order = np.argsort(-sizes, kind="stable")
    long = order[sizes[order] >= min_length]
    if not len(long):
        return none
    first = np.cumsum(sizes) - sizes

    def joined(docs: np.ndarray) -> np.ndarray:
        c = sizes[docs]
        return np.repeat(first[docs] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))

    begins = np.cumsum(sizes[long]) - sizes[long]
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for at, p in _pairs(h[joined(long)], sizes[long], min_length, exponent):
        d = np.searchsorted(begins, at, "right") - 1
        ok = (at + p < begins[d] + sizes[long][d]) & (sizes[long][d] >= p * exponent)
        if ok.any():
            held.append((long[d[ok]], np.stack([at[ok] - begins[d[ok]], p[ok]])))
    if not held:
        return none
    doc = np.concatenate([d for d, _ in held])
    place, period = np.concatenate([x for _, x in held], axis=1)
    docs = np.unique(doc)
    # these documents on end, a code of its own after each of them
    codes = np.unique(h[joined(docs)], return_inverse=True)[1].astype(np.int64)
    ends = np.cumsum(sizes[docs])
    walls = codes.max() + 1 + np.arange(len(docs))
    codes = np.insert(codes, ends, walls)
    base = ends - sizes[docs] + np.arange(len(docs))
    ahead, back = CoverLce(codes), CoverLce(codes[::-1])
    n, out = len(codes), []
    for x in range(0, len(doc), PAIRS):
        p = period[x : x + PAIRS]
        d = np.searchsorted(docs, doc[x : x + PAIRS])
        i = base[d] + place[x : x + PAIRS]
        f = ahead.lce(i, i + p)
        b = back.lce(n - i, n - i - p)
        start, length = place[x : x + PAIRS] - b, b + f + p
        ok = (f > 0) & (length >= np.maximum(min_length, exponent * p))
        out.append(np.unique(np.stack([docs[d], start, length, p], axis=1)[ok], axis=0))
    found = np.unique(np.concatenate(out), axis=0)  # by document, start, length, period
    if not len(found):
        return none
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    found = found[new]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def best_run(runs: list[dict]) -> dict | None:
    """The run with the greatest exact length / period; ties go to the
    smallest start, then period."""
    return max(runs, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None)


def _detect(min_length: int, exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for whole in batches:
            for b in X.pieces(whole, "text"):
                words = X.Words(b.column("text"), X.SPACED)
                found = find_runs(words.hashes(X.EXACT), words.count, min_length, exponent)
                # words after the first period of a run are dropped
                gone = np.zeros(len(words) + 1, np.int64)
                begin = words.first[found[:, 0]] + found[:, 1]
                np.add.at(gone, begin + found[:, 3], 1)
                np.add.at(gone, begin + found[:, 2], -1)
                kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                # bytes of kept words, and the white space after each but a document's last, as one space
                data, inside = words.data.copy(), np.zeros(len(words.data) + 1, np.int64)
                np.add.at(inside, words.start[kept], 1)
                np.add.at(inside, words.end[kept], -1)
                take = np.cumsum(inside[:-1]) > 0
                more = kept[:-1][words.doc[kept[:-1]] == words.doc[kept[1:]]]
                take[words.end[more]] = True
                data[words.end[more]] = 32
                upto = np.zeros(len(take) + 1, np.int64)
                np.cumsum(take, out=upto[1:])
                collapsed = pa.Array.from_buffers(
                    pa.large_string(), b.num_rows, [None, pa.py_buffer(upto[words.off]), pa.py_buffer(data[take])]
                ).cast(pa.string())
                of = np.searchsorted(found[:, 0], np.arange(b.num_rows + 1))
                runs = [[{"start": s, "length": n, "period": p} for _, s, n, p in found[x:y].tolist()] for x, y in zip(of[:-1], of[1:])]
                best = [best_run(x) for x in runs]
                yield pa.RecordBatch.from_arrays(
                    [b.column("row"), pa.array(words.count, pa.int64()), pa.array(runs, pa.list_(kind)), pa.array(best, kind), collapsed],
                    names=["row", "n_words", "runs", "best", "collapsed"],
                )

    return run


def detect_runs(
    docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> DataFrame:
    """Every row as (row: struct of the other columns, n_words, runs: array of
    (start, length, period) by start and period, best: see ``best_run``,
    collapsed: the text without the words after the first period of each run,
    single spaces between)."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run repeats at least twice")
    prepare(docs.sparkSession)
    rest = [c for c in docs.columns if c != text_col]
    row = F.struct(*(F.col(f"`{c}`") for c in rest)) if rest else F.struct(F.lit(0).alias("_"))
    given = docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("text"))
    kind = given.schema["row"].dataType.simpleString()
    return given.mapInArrow(
        _detect(min_length, min_exponent),
        f"row {kind}, n_words long, runs array<{RUN}>, best {RUN}, collapsed string",
    )
