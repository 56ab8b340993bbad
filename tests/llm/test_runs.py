"""Periodic runs against a direct search over every period."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

from hitscope.llm import runs
from hitscope.llm import text as X
from hitscope.llm.queries import op12_periodic_runs

SF = "/root/testdata/sf0.001"


def direct(words: list, min_length: int = 24, exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run, one period after another."""
    code = {}
    w = np.array([code.setdefault(x, len(code)) for x in words], np.int64)
    n, found = len(w), {}
    for p in range(1, n // exponent + 1):
        same = np.concatenate([[0], w[: n - p] == w[p:], [0]]).astype(np.int8)
        turn = np.flatnonzero(np.diff(same))
        for a, b in zip(turn[::2].tolist(), turn[1::2].tolist()):
            if b - a + p >= max(min_length, exponent * p):
                found.setdefault((a, b - a + p), p)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words: list, found: list[tuple[int, int, int]]) -> list:
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def hashes(words: list[int]) -> np.ndarray:
    return X._mix(np.array(words, np.uint64) + np.uint64(7))


def test_the_cover_has_every_difference():
    assert {(a - b) % runs.V for a in runs.COVER for b in runs.COVER} == set(range(runs.V))


@pytest.mark.parametrize("seed", range(6))
def test_random_sequences(seed):
    rnd = random.Random(seed)
    for _ in range(25):
        shortest, exponent = rnd.choice([(24, 3), (24, 3), (6, 2), (2, 2), (10, 4)])
        docs = []
        for _ in range(rnd.randint(1, 6)):
            w, size = [], rnd.choice([0, 5, 60, 300, 900])
            while len(w) < size:
                if rnd.random() < 0.5:
                    w += [rnd.randint(0, rnd.choice([1, 2, 5, 100])) for _ in range(rnd.randint(1, 40))]
                else:
                    unit = [rnd.randint(0, 3) for _ in range(rnd.randint(1, rnd.choice([3, 12, 60])))]
                    w += (unit * rnd.randint(2, 30))[: rnd.randint(10, 400)]
            docs.append(w)
        found = runs.find_runs(hashes(sum(docs, [])), np.array([len(w) for w in docs]), shortest, exponent).tolist()
        for k, w in enumerate(docs):
            assert [tuple(r[1:]) for r in found if r[0] == k] == direct(w, shortest, exponent)


def test_common_extensions():
    rnd = random.Random(3)
    for size in (1, 2, 40, 700):
        w = [rnd.randint(0, 1) if rnd.random() < 0.9 else 2 + i for i in range(size)] + [10_000]
        lce = runs.CoverLce(np.array(w))
        i = np.array([rnd.randrange(size + 1) for _ in range(300)])
        j = np.array([rnd.randrange(size + 1) for _ in range(300)])
        i, j = i[i != j], j[i != j]
        for a, b, got in zip(i.tolist(), j.tolist(), lce.lce(i, j).tolist()):
            true = 0
            while max(a, b) + true < len(w) and w[a + true] == w[b + true]:
                true += 1
            assert got == true


def test_long_texts_take_bounded_time():
    began = time.time()
    for w in ([0] * 60_000, [i % 7 for i in range(60_000)], list(range(200_000))):
        found = runs.find_runs(hashes(w), np.array([len(w)])).tolist()
        assert found == ([[0, 0, len(w), max(w) + 1]] if max(w) < 7 else [])
    assert time.time() - began < 30


def test_small_cases(spark):
    unit = " ".join("abcdefgh")
    rows = [
        (1, None, "x"), (2, "", "x"), (3, "one  two\n", "x"), (4, "\t" + "\n".join([unit] * 4) + "  end ", "x"),
        (4, "\t" + "\n".join([unit] * 4) + "  end ", "x"), (None, "z " * 24, None), (5, "z " * 23, None), (6, "é b " * 30, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = runs.detect_runs(docs).select("row.doc_id", "row.runs", "n_words", runs_of(), "best", "collapsed").collect()
    assert len(got) == len(rows)
    for (i, text, extra), r in zip(rows, sorted(got, key=lambda r: [x[0] for x in rows].index(r[0]))):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert (r[0], r[1], r[2]) == (i, extra, len(w))
        assert [tuple(x) for x in r[3]] == direct(w)
        assert r[5] == " ".join(collapse(w, direct(w)))
    assert sorted(len(r[3]) for r in got) == [0, 0, 0, 0, 1, 1, 1, 1]
    assert runs.detect_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.detect_runs(docs, min_exponent=1)


def runs_of():
    from pyspark.sql import functions as F

    return F.col("runs").alias("found")


def test_nested_runs_and_ties(spark):
    # runs of period 1 inside a run of period 30, which is repeated three times
    unit = ["a"] * 24 + list("bcdefg")
    w = unit * 3 + ["end"]
    r = runs.detect_runs(spark.createDataFrame([(" ".join(w),)], "text string")).first()
    found = [tuple(x) for x in r["runs"]]
    assert found == direct(w) and (0, 90, 30) in found and (30, 24, 1) in found
    assert tuple(r["best"]) == (0, 24, 1)
    assert r["collapsed"] == " ".join(collapse(w, found))


def test_op12(spark):
    """Every document of the table against the direct search."""
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in op12_periodic_runs(spark, SF).collect()}
    assert got.keys() == given.keys()
    changed = 0
    for i, text in given.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[x] if x < a else w[a + (x - a) % p] for x in range(n)]
            changed += 1
        found = direct(w)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        r = got[i]
        assert (r.n_runs, r.n_words) == (len(found), n)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{p}\n" for s, n, p in found))
        assert r.collapsed_sha256 == sha(" ".join(collapse(w, found)))
    assert changed > 5
