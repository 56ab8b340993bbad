"""Packing against whole encodings and a round-by-round scheduler."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hitscope.llm import packing
from hitscope.llm import text as X
from hitscope.llm.queries import op11_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.VOCABULARY)


def encoded(tokenizer, text) -> list[int]:
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def raw(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def check_layout(pieces: list, length: int, total: int) -> None:
    """Every sequence is gapless and full, or a power of two."""
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append((p.offset, p.length))
    assert sorted(by) == list(range(len(by)))
    sizes = []
    for s in sorted(by):
        at = 0
        for offset, n in sorted(by[s]):
            assert offset == at and n > 0
            at += n
        sizes.append(at)
    assert sum(sizes) == total
    tail = sizes[total // length :]
    assert sizes[: total // length] == [length] * (total // length)
    assert all(n & (n - 1) == 0 for n in tail) and len(set(tail)) == len(tail)


def test_pieces_encode_as_the_whole(tokenizer):
    """Texts cut at safe places give the ids of the whole text."""
    rnd = random.Random(1)
    parts = ["a", "Bc", "don't", "é", "ñé ", "日本", "　", " ", "\n", "\t", "\r\n", " ", "\u0085", " ", "\x0b", "\x0c", "\x1c", "1", "23", "!?", "<|endoftext|>", "'ll", "😀", "  ", "ß.", " ", "​", "x" * 40, "Ω", "ж"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.choice([0, 1, 3, 30, 200]))) for _ in range(400)]
    encode = packing.Encoder(open(packing.VOCABULARY, "rb").read())
    for x in range(0, 400, 80):
        ids, off = encode(*X.flat(pa.array(texts[x : x + 80])))
        for k, t in enumerate(texts[x : x + 80]):
            assert ids[off[k] : off[k + 1]].tolist() == encoded(tokenizer, t)[:-1], t


def simulate(queues: dict[str, list[int]], quantum: dict[str, float], head: dict[str, int]) -> dict[str, list[int]]:
    """Deficit round-robin, one round after another: the round of each packet."""
    left = {q: deque(n) for q, n in queues.items()}
    deficit, out, now = dict(head), {q: [] for q in queues}, 0
    while any(left.values()):
        now += 1
        for q, waiting in left.items():
            deficit[q] += quantum[q]
            while waiting and waiting[0] <= deficit[q] + 1e-6:
                deficit[q] -= waiting[0]
                waiting.popleft()
                out[q].append(now)
    return out


def documents(n, seed=2):
    rnd = random.Random(seed)
    words = ["alpha", "beta,", "Gamma", "δ", "42", "\n"]
    size = lambda: rnd.choice([0, 1, 5, 30, 30, 200])
    return [(i, " ".join(rnd.choice(words) for _ in range(size())), "big" if i % 3 else f"s{i % 5}") for i in range(n)]


@pytest.mark.parametrize("weights", [None, {"big": 1.0, "s0": 1.0, "s1": 0.5, "s2": 3.0, "s3": 0.01}])
def test_rounds_are_those_of_the_scheduler(spark, tokenizer, weights):
    length, window = 32, 128
    rows = documents(150)
    targets = spark.createDataFrame(list(weights.items()), "source string, weight double") if weights else None
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), targets=targets, length=length, window=window).collect()
    ids = {i: encoded(tokenizer, t) for i, t, _ in rows}
    check_layout(got, length, sum(map(len, ids.values())))
    found = defaultdict(list)
    for p in got:
        assert p.ids == raw(ids[p.id][p.start : p.start + p.length]) and p.doc_tokens == len(ids[p.id])
        found[p.id].append((p.start, p.length))
    for i, x in found.items():
        assert [s for s, _ in sorted(x)] == [sum(n for _, n in sorted(x)[:k]) for k in range(len(x))]
        assert sum(n for _, n in x) == len(ids[i])
    # queues as they came out: packets by their place in the stream
    stream = sorted(got, key=lambda p: (p.sequence_id, p.offset))
    queues, told, last = defaultdict(list), defaultdict(list), {}
    for p in stream:
        key = (p.id, p.start // length)
        if last.get(p.source) == key:
            queues[p.source][-1] += p.length
        else:
            queues[p.source].append(p.length)
            told[p.source].append(p.round)
            last[p.source] = key
    assert [p.round for p in stream] == sorted(p.round for p in stream)
    own = {q: sum(n) for q, n in queues.items()}
    share = {q: weights.get(q, min(weights.values())) for q in own} if weights else own
    quantum = {q: window * share[q] / sum(share.values()) for q in own}
    hashed = spark.createDataFrame([(f"={q}",) for q in own], "q string").select("q", F.xxhash64("q").alias("h")).collect()
    head = {r.q[1:]: r.h % length for r in hashed}
    assert told == simulate(queues, quantum, head)
    # at the end of every round a source that still waits is within one packet of its share
    for q in own:
        sent = 0
        for now in range(1, max(told[q])):
            sent = sum(n for n, r in zip(queues[q], told[q]) if r <= now)
            assert -length < sent - quantum[q] * now < length


def test_small_cases(spark, tokenizer):
    rows = [
        (1, None, "a", 1, "x"), (2, "", "a", 1, "x"), (None, "no id", None, 1, "x"), (3, "twice", "", 1, "x"), (3, "twice", "", 1, "x"),
        (3, "another text of the id", "b", 1, "x"), (4, "word " * 3000, "a", 1, "x"), (5, "y" * 5000, None, 1, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n int, queue string")
    got = packing.pack(df).collect()
    whole = sorted((raw(encoded(tokenizer, t)), str(i), str(s)) for i, t, s, *_ in rows)
    check_layout(got, 1024, sum(len(w[0]) // 4 for w in whole))
    assert sum(p.length for p in got if p.id == 3) == sum(len(w[0]) // 4 for w in whole if w[1] == "3")
    one = {}
    for p in sorted((p for p in got if p.id != 3), key=lambda p: p.start):
        assert len(one.get((p.id, p.source), b"")) == 4 * p.start
        one[p.id, p.source] = one.get((p.id, p.source), b"") + p.ids
    assert sorted((v, str(i), str(s)) for (i, s), v in one.items()) == [w for w in whole if w[1] != "3"]
    assert packing.pack(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        packing.pack(df, targets=spark.createDataFrame([("a", 0.0)], "source string, weight double"))


def test_totals_before(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN", 4)
    rnd = random.Random(5)
    keys = sorted(rnd.sample(range(1000), 200))
    rows = [(k, rnd.randint(1, 9)) for k in keys]
    got = dict(packing.totals_before(spark.createDataFrame(rows, "key long, n long"), max(keys)).collect())
    assert got == {k: sum(n for j, n in rows if j < k) for k in keys}


def test_op11(spark, tokenizer):
    """The whole table: every id in one piece, sums of the ids, no padding."""
    given = {r.doc_id: encoded(tokenizer, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op11_packing(spark, SF).collect()
    check_layout(got, 1024, sum(map(len, given.values())))
    at = defaultdict(int)
    for p in sorted(got, key=lambda p: (p.doc_id, p.start)):
        ids = given[p.doc_id]
        assert p.start == at[p.doc_id] and p.doc_tokens == len(ids)
        assert p.ids_crc32 == zlib.crc32(raw(ids[p.start : p.start + p.length]))
        at[p.doc_id] += p.length
    assert at == {i: len(x) for i, x in given.items()}
