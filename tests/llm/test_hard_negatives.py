"""Hard negatives against a search over all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hitscope.llm import hard_negatives as H
from hitscope.llm.queries import op13_hard_negatives

SF = "/root/testdata/sf0.001"


def direct(rows, is_anchor, n_positives=5, n_negatives=3, low=50, high=95, of=100, scale=256):
    """All pairs in whole numbers; rows are (id, label, vector)."""
    kept = [
        (i, c, [math.floor(scale * x) for x in v])
        for i, c, v in rows
        if None not in (i, c, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, c, v) in enumerate(kept):
        if not is_anchor(i):
            continue
        score = sorted(
            (-sum(x * y for x, y in zip(v, w)), j, d, b) for b, (j, d, w) in enumerate(kept) if b != a and len(w) == len(v)
        )
        for s, j, d, _ in [x for x in score if x[2] == c][:n_positives]:
            ok = [x for x in score if x[2] != c and low * -s <= of * -x[0] <= high * -s][:n_negatives]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(ok)]
    return sorted(out)


def run(spark, rows, kind="double", every=3, **more):
    df = spark.createDataFrame(rows, f"id long, label int, vector array<{kind}>")
    got = H.hard_negatives(df, F.col("id") % every == 0, **more)
    return sorted(map(tuple, got.collect()))


def clustered(n, dim, centres, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    return [(i, int(rng.integers(4)), (c[i % centres] + spread * rng.normal(size=dim)).round(3).tolist()) for i in range(n)]


@pytest.mark.parametrize("block, chunk", [(512, 4096), (4, 7), (1, 50)])
def test_blocks_and_chunks(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(H, "BLOCK_ROWS", block)
    monkeypatch.setattr(H, "CHUNK_ROWS", chunk)
    rows = clustered(90, 6, 5, 1)
    assert run(spark, rows) == direct(rows, lambda i: i % 3 == 0)


def test_small_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.0]), (3, 1, [1.0, 0.5]), (6, 2, [0.75, 0.0]), (6, 2, [0.75, 0.0]), (1, 2, [0.75, 0.0]), (2, 2, [0.75, 0.0]),
        (4, 3, [0.6, 0.1]), (5, 3, [-1.0, 0.0]), (None, 1, [1.0, 0.0]), (9, None, [1.0, 0.0]), (12, 1, None), (15, 1, [1.0, None]),
        (18, 1, [nan, 0.0]), (21, 1, [inf, 0.0]), (24, 1, [1.0]), (27, 1, [1.0]), (7, 2, [0.9]), (30, 1, []), (33, 1, []), (8, 2, []),
        (36, 7, [1.0, 1.0]),
    ]
    want = direct(rows, lambda i: i % 3 == 0)
    assert run(spark, rows) == want and len(want) > 8
    assert any(r[0] == 24 and r[3] == 7 for r in want) and any(r[0] == 30 and r[4] == 0 for r in want)
    assert run(spark, []) == []
    assert run(spark, [r for r in rows if r[0] is None or r[0] % 3]) == []


def test_clashing_names(spark):
    rows = clustered(30, 3, 4, 2)
    df = spark.createDataFrame([(i, c, v, 1, "z") for i, c, v in rows], "`row` long, `kind` int, x array<double>, score int, `block` string")
    got = H.hard_negatives(df, F.col("row") % 3 == 0, "row", "kind", "x")
    assert sorted(map(tuple, got.collect())) == direct(rows, lambda i: i % 3 == 0)


def test_many_equal_vectors(spark, monkeypatch):
    """Ties of one vector over many chunks go by id."""
    monkeypatch.setattr(H, "CHUNK_ROWS", 20)
    rows = [(i, 1 if i % 2 else 2, [1.0, 0.0]) for i in range(80)] + [(100 + i, 3, [0.9, 0.1 * i]) for i in range(6)]
    random.Random(4).shuffle(rows)
    assert run(spark, rows, every=25) == direct(rows, lambda i: i % 25 == 0)


def test_scores_beyond_a_double(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(2)), [float(x) for x in rng.integers(-(10**8), 10**8, 3)]) for i in range(30)]
    assert run(spark, rows, scale=10) == direct(rows, lambda i: i % 3 == 0, scale=10)


def test_other_parameters(spark):
    rows = clustered(60, 4, 3, 6)
    more = {"n_positives": 2, "n_negatives": 6, "low": 0, "high": 100, "of": 100, "scale": 16}
    assert run(spark, rows, **more) == direct(rows, lambda i: i % 3 == 0, **more)


def test_the_tree_saves_scores():
    """On clustered rows most candidates are never scored, and the bounds hold."""
    rows = clustered(3000, 16, 40, 7, spread=0.002)
    v = np.array([[math.floor(256 * x) for x in r[2]] for r in rows])
    anchors = np.arange(0, 3000, 50)
    parent, edge, turns = H._tree(v[anchors].astype(float))
    assert sorted(turns.tolist()) == list(range(len(anchors))) and (parent == -1).sum() == 1
    seen = set()
    for a in turns.tolist():
        assert parent[a] < 0 or int(parent[a]) in seen
        seen.add(a)
        if parent[a] >= 0:
            assert edge[a] == pytest.approx(np.linalg.norm(v[anchors[a]] - v[anchors[parent[a]]]))
    labels = np.array([r[1] for r in rows])
    packed = {
        "rows": anchors.tobytes(), "ids": anchors.tobytes(), "labels": labels[anchors].tobytes(), "vectors": v[anchors].tobytes(),
        "n": len(anchors), "dim": 16, "parents": parent.tobytes(), "edges": edge.tobytes(), "turns": turns.tobytes(),
    }
    b = H._Block(packed)
    truth = v @ v[anchors].T
    chunk = {"rows": np.arange(3000), "ids": np.arange(3000), "labels": labels, "vectors": v}

    def offer(a, low, high, score):
        assert (low - 1e-6 <= truth[:, a]).all() and (truth[:, a] <= high + 1e-6).all()

    b.walk(chunk, offer)
    b.scored = 0
    H._positives(b, chunk, best := [H._NONE] * len(anchors), 5)
    assert b.scored < 0.4 * 3000 * len(anchors)
    for a in range(len(anchors)):
        mine = [(-truth[i, a], i) for i in range(3000) if labels[i] == labels[anchors[a]] and i != anchors[a]]
        assert best[a][1].tolist() == [i for _, i in sorted(mine)[:5]]


def test_op13(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in given]
    assert sorted(map(tuple, op13_hard_negatives(spark, SF).collect())) == direct(rows, lambda i: i % 50 == 0)
