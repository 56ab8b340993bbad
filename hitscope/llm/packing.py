"""Packing documents into sequences of at most ``length`` tokens whose sources
keep target proportions: deficit round-robin over source queues.

A document is its token ids and an end id; ids are cut into packets of at most
``length`` ids, and each source has a queue of packets (documents in a hashed
order).  In every round (a mixing window of ``window`` tokens) a queue's deficit
grows by its quantum, the window times its target share, and it sends packets
while the deficit covers them.  What is left over is carried into the next
round, so at the end of a round a source is less than one packet behind what its
share allows; each queue starts with a head start of up to a packet, by the hash
of its name, so that small sources do not all send in the same round.  The
deficit before a packet follows from the ids queued before it: the packet that
ends at the e-th id of a queue goes into round ``ceil((e - head start) /
quantum)``.  Deficits therefore cross windows and partitions as prefix sums, and
no round waits for another.  A queue that has run out leaves its share to the
others.  Without given targets the shares are the sources' own, so that all
queues run out in the last window.

The stream of packets, by round and queue, is cut into full sequences; the rest,
less than ``length`` ids, becomes sequences of powers of two, so nothing is
padded.  A packet is cut once at most, at the end of a sequence.

Texts are encoded once, into a table of packets.  A word with the white space
before it is encoded once for a batch, because a byte-level pre-token never
continues from a character into white space.  Positions are computed on
numbers alone: queue positions in ``BUCKETS`` hashed buckets for each source, so
that a source with a third of all ids is spread over many tasks, stream
positions within rounds, rounds within groups of ``FAN``.  Then the ids meet
their positions in one join.  The vocabulary file is a parameter; its bytes are
broadcast (``MAX_VOCABULARY`` at most, checked).

Defined cases: a null or empty text is the end id alone; a null source is a queue
of its own, and a source without a target takes the smallest one given; null
ids and repeated rows are documents like any other; an empty table gives no
piece; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitscope.llm import text as X
from hitscope.llm.runtime import prepare, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
MAX_VOCABULARY = 16 << 20
LENGTH = 1024
WINDOW = 64 * 1024
END_ID = 0
BUCKETS = 1 << 16
FAN = 4096
CACHE = 1 << 18  # words whose ids a worker remembers

#: The pattern that splits text before the merges (fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes after which a text may be cut if white space follows: printable ASCII,
#: and the second byte of two-byte characters from U+00C0 on, none of which is
#: white space.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 13, 32]] = True
_PRINTED = np.zeros(256, bool)
_PRINTED[33:127] = True
_TWO = np.zeros(256, bool)
_TWO[0xC3:0xE0] = True


def pieces_of(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of the pieces that can be encoded by themselves: the beginnings of
    non-empty texts, and white space that follows a safe character."""
    cut = _SPACE[data]
    if len(data):
        ok = _PRINTED[data[:-1]]
        ok[1:] |= _TWO[data[:-2]] & (data[1:-1] >= 0x80)
        cut[1:] &= ok
        cut[0] = False
    cut[off[:-1][np.diff(off) > 0]] = True
    return np.flatnonzero(cut)


def byte_values() -> dict[str, int]:
    """The byte for which each character of a byte-level vocabulary stands:
    printable Latin-1 characters for themselves, U+0100 and so on, in order, for
    the other bytes."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}


class Encoder:
    """Token ids of batches of texts, as the tokenizers library gives them for
    a byte-level vocabulary file of its kind whose ids follow its merges (then
    tiktoken finds the same ids in a third of the time).  Strings of the file's
    added tokens become their ids."""

    def __init__(self, vocabulary: bytes):
        import json

        import tiktoken

        model = json.loads(vocabulary)
        value = byte_values()
        added = {t["content"]: t["id"] for t in model["added_tokens"]}
        names = {i: w for w, i in model["model"]["vocab"].items() if w not in added}
        ranks = {bytes(value[c] for c in w): i for i, w in names.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        if any(names.get(256 + k) != "".join(m) for k, m in enumerate(merges)):
            raise ValueError("the vocabulary's ids do not follow its merges")
        self.code = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(names) + 1, np.int64)
        self.width[list(names)] = [len(w) for w in names.values()]
        self.added = added
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.known: dict[int, bytes] = {}

    def one(self, text: str) -> bytes:
        out = []
        for part in self.split.split(text) if self.split else [text]:
            out += [self.added[part]] if part in self.added else self.code.encode_ordinary(part)
        return np.array(out, "<u4").tobytes()

    def learn(self, keys: list[int], words: list[bytes]) -> None:
        """Ids of pieces: those that can stand side by side, because each begins
        with white space after a safe character, in one text."""
        if len(self.known) > CACHE:
            self.known.clear()
        side = [k for k, w in enumerate(words) if _SPACE[w[0]] and _PRINTED[w[-1]] and not (self.split and b"<" in w)]
        for k in set(range(len(words))).difference(side):
            self.known[keys[k]] = self.one(words[k].decode())
        if side:
            ids = np.asarray(self.code.encode_to_numpy(b"".join(words[k] for k in side).decode()), "<u4")
            upto = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(words[k]) for k in side])) + 1
            raw = ids.tobytes()
            for k, a, b in zip(side, [0, *upto[:-1].tolist()], upto.tolist()):
                self.known[keys[k]] = raw[4 * a : 4 * b]

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end, and n + 1 places where texts begin."""
        start = pieces_of(data, off)
        doc = np.searchsorted(off, start, "right") - 1
        stop = np.append(start[1:], len(data))
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        code, kinds = pd.factorize(X.span_hashes(data, X.EXACT, (start, stop))[0])
        first = np.flatnonzero(np.append(True, code[1:] > np.maximum.accumulate(code)[:-1]))
        kinds = kinds.tolist()
        found = [self.known.get(k) for k in kinds]
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            raw = data.tobytes()
            at = zip(start[first[new]].tolist(), stop[first[new]].tolist())
            self.learn([kinds[i] for i in new], [raw[a:b] for a, b in at])
            for i in new:
                found[i] = self.known[kinds[i]]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        n = sizes[code]
        upto = np.cumsum(n)
        at = np.repeat((np.cumsum(sizes) - sizes)[code] - (upto - n), n) + np.arange(int(upto[-1]))
        each = np.bincount(doc, weights=n, minlength=len(off) - 1).astype(np.int64)
        return ids[at], np.concatenate([[0], np.cumsum(each)])


def _packets(vocabulary, length: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(vocabulary.value)
        for whole in batches:
            for b in X.pieces(whole, "text"):
                ids, off = encode(*X.flat(b.column("text")))
                ids = np.insert(ids, off[1:], end_id)
                size = np.diff(off) + 1
                begin = np.cumsum(size) - size
                parts = -(-size // length)
                doc = np.repeat(np.arange(len(size)), parts)
                part = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                n = np.minimum(size[doc] - part * length, length)
                upto = np.concatenate([begin[doc] + part * length, [len(ids)]]) * 4
                packed = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(upto), pa.py_buffer(ids.astype("<u4"))])
                given = [b.column(c).take(pa.array(doc)) for c in ("doc", "id", "queue", "order")]
                yield pa.RecordBatch.from_arrays(
                    [*given, pa.array(part, pa.int64()), pa.array(n, pa.int64()), pa.array(size[doc], pa.int64()), packed.cast(pa.binary())],
                    names=["doc", "id", "queue", "order", "part", "n", "doc_tokens", "ids"],
                )

    return run


def totals_before(sums: DataFrame, top: int) -> DataFrame:
    """(key, before): the sum of n over all smaller keys, for rows (key, n) with
    different keys from 0 to ``top``.  No task sees more than ``FAN`` rows of
    a group; above the groups stand groups of groups."""
    before = lambda w: F.coalesce(F.sum("n").over(w.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    group = F.expr(f"key div {FAN}")
    if top < FAN:
        return sums.select("key", before(Window.partitionBy(F.lit(0))).alias("before"))
    upper = sums.groupBy(group.alias("group")).agg(F.sum("n").alias("n"))
    above = totals_before(upper.withColumnRenamed("group", "key"), top // FAN).select(F.col("key").alias("group"), F.col("before").alias("above"))
    inner = sums.withColumn("group", group).select("key", "group", before(Window.partitionBy("group")).alias("inside"))
    return inner.join(above, "group").select("key", (F.col("above") + F.col("inside")).alias("before"))


def _queue(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def rounds(packets: DataFrame, targets: DataFrame | None, window: int, length: int) -> DataFrame:
    """(doc, part, n, queue, ends, round) of every packet: where it ends in its
    queue, and the round whose deficit covers it."""
    bucket = F.pmod(F.shiftright("order", 40), F.lit(BUCKETS))
    p = packets.select("doc", "part", "n", "queue", "order", bucket.alias("bucket"))
    each = stored(p.groupBy("queue", "bucket").agg(F.sum("n").alias("total")), "buckets")
    # buckets before a bucket: in two steps, no group of which has more than 256 rows
    prior = lambda w: F.coalesce(F.sum("total").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = each.withColumn("shelf", F.expr("bucket div 256"))
    shelves = each.groupBy("queue", "shelf").agg(F.sum("total").alias("total"))
    above = shelves.select("queue", "shelf", prior(Window.partitionBy("queue").orderBy("shelf")).alias("above"))
    before = (
        each.withColumn("before", prior(Window.partitionBy("queue", "shelf").orderBy("bucket")))
        .join(above, ["queue", "shelf"])
        .select("queue", "bucket", (F.col("above") + F.col("before")).alias("before"))
    )
    own = each.groupBy("queue").agg(F.sum("total").cast("double").alias("weight"))
    if targets is not None:
        least = targets.where("weight > 0").agg(F.min("weight").cast("double")).first()[0]
        if least is None:
            raise ValueError("target weights must be positive")
        given = targets.where("weight > 0").groupBy(_queue(F.col("source")).alias("queue")).agg(F.max("weight").cast("double").alias("given"))
        own = own.join(given, "queue", "left").select("queue", F.coalesce("given", F.lit(least)).alias("weight"))
    whole = own.agg(F.sum("weight")).first()[0] or 1.0
    quantum = own.select("queue", (F.col("weight") * F.lit(window / whole)).alias("quantum"))
    inside = Window.partitionBy("queue", "bucket").orderBy("order", "doc", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = F.col("before") + F.col("inside")
    head = F.pmod(F.xxhash64("queue"), F.lit(length))
    due = F.ceil((F.col("ends") - head) / F.col("quantum"))
    return (
        p.withColumn("inside", F.sum("n").over(inside))
        .join(before, ["queue", "bucket"])
        .join(quantum, "queue")
        .withColumn("ends", ends)
        .select("doc", "part", "n", "queue", "ends", "quantum", F.greatest(due, F.lit(1).cast("long")).alias("round"))
    )


def _cuts(length: int, total: int) -> Column:
    """The sequences (id, from, to) that a packet at ``x`` with ``n`` ids meets."""
    full, begin, rest = total // length, total // length * length, []
    while begin < total:
        size = 1 << ((total - begin).bit_length() - 1)
        rest.append((full + len(rest), begin, begin + size))
        begin += size
    first, last = F.expr(f"x div {length}"), F.expr(f"(least(x + n, {full * length}) - 1) div {length}")
    one = lambda s, a, b: F.struct(s.alias("sequence_id"), a.alias("low"), b.alias("high"))
    whole = F.transform(F.sequence(first, last), lambda s: one(s, s * length, (s + 1) * length))
    whole = F.when(F.col("x") < full * length, whole)
    if not rest:
        return whole
    tail = F.array(*(one(*(F.lit(v).cast("long") for v in r)) for r in rest))
    end = F.col("x") + F.col("n")
    tail = F.filter(tail, lambda t: (t["low"] < end) & (t["high"] > F.col("x")))
    return F.concat(F.coalesce(whole, F.slice(tail, 1, 0)), tail)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    targets: DataFrame | None = None,
    vocabulary: str = VOCABULARY,
    length: int = LENGTH,
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces (id, source, start, length, ids: little-endian unsigned 32-bit,
    doc_tokens, sequence_id, offset, round).  ``targets``: rows (source,
    weight)."""
    spark = prepare(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        model = f.read(MAX_VOCABULARY + 1)
    if len(model) > MAX_VOCABULARY:
        raise ValueError("vocabulary too large to broadcast")
    if length < 1 or window < length:
        raise ValueError("a window holds at least one sequence")
    col = lambda c: F.col(f"`{c}`")
    given = docs.select(
        F.monotonically_increasing_id().alias("doc"), col(id_col).alias("id"), _queue(col(source_col)).alias("queue"),
        F.xxhash64(col(id_col)).alias("order"), col(text_col).alias("text"),
    )
    shape = f"doc long, id {given.schema['id'].dataType.simpleString()}, queue string, order long, part long, n long, doc_tokens long, ids binary"
    packets = stored(given.mapInArrow(_packets(spark.sparkContext.broadcast(model), length, end_id), shape), "packets", "zstd")

    placed = stored(rounds(packets, targets, window, length).select("doc", "part", "n", "queue", "ends", "round"), "rounds")
    sums = placed.groupBy(F.col("round").alias("key")).agg(F.sum("n").alias("n"))
    top, total = sums.agg(F.max("key"), F.sum("n")).first()
    inside = Window.partitionBy("round").orderBy("queue", "ends").rowsBetween(Window.unboundedPreceding, -1)
    x = F.col("before") + F.coalesce(F.col("inside"), F.lit(0))
    laid = (
        placed.withColumn("inside", F.sum("n").over(inside))
        .join(totals_before(sums, top or 0).withColumnRenamed("key", "round"), "round")
        .select("doc", "part", "round", x.alias("x"))
    )
    low, high = F.greatest("x", "cut.low"), F.least(F.col("x") + F.col("n"), F.col("cut.high"))
    skip, size = F.col("low") - F.col("x"), F.col("high") - F.col("low")
    return (
        packets.join(laid, ["doc", "part"])
        .withColumn("cut", F.explode(_cuts(length, total or 0)))
        .withColumns({"low": low, "high": high})
        .select(
            "id",
            F.when(F.col("queue") != "", F.expr("substring(queue, 2)")).alias("source"),
            (F.col("part") * length + skip).alias("start"),
            size.alias("length"),
            F.substring("ids", (skip * 4 + 1).cast("int"), (size * 4).cast("int")).alias("ids"),
            "doc_tokens",
            F.col("cut.sequence_id").alias("sequence_id"),
            (F.col("low") - F.col("cut.low")).alias("offset"),
            "round",
        )
    )
