"""Quality rules: base counts, then line labelling by a linear-chain CRF.

Each line with a word gets features (length, symbols, capitals, repeats, ...).
A linear-chain conditional random field with two labels, content and
boilerplate, scores the lines and their neighbours; Viterbi decoding picks the
best labels of each document, and the share of word characters in content
lines decides whether the document is kept.

The field is fitted here, by gradient ascent on the likelihood, on at most
``SAMPLE`` labelled documents of each quality, of at most ``SAMPLE_LINES``
lines each (chosen by a hash of the id).  Labels are given for documents, so
those of lines are hidden: they start as the document's, and in up to
``ROUNDS`` rounds each line takes the label that the field, fitted to the last
ones, finds more probable, but at least half of a document's word characters
keep the document's label (the lines surest of it).  The first round's field
has no chain, so that a line is judged by itself before its neighbours count;
from then on both switches are seen.  Only this bounded sample reaches the
driver.  Everything else is one pass over the documents without a shuffle.

Defined cases: null or empty text, or text without words, has zero counts,
fails the base rule and is not kept.  Without labelled rows of both qualities
there is no field, and the base rule alone decides.  Repeated rows are judged
one by one; null ids are judged like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitscope.llm import text as X
from hitscope.llm.runtime import prepare

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CONTENT_SHARE = 0.5
SAMPLE = 600
SAMPLE_LINES = 200
STEPS = 120
RIDGE = 1.0
ROUNDS = 6  # settles in two or three

_CLASSES = {}
for _name, _chars in {"symbol": b"#*$%&|<>", "upper": bytes(range(65, 91)), "digit": b"0123456789", "loud": b"!?", "bracket": b"{}[]=;_\\/"}.items():
    _CLASSES[_name] = np.zeros(256, bool)
    _CLASSES[_name][list(_chars)] = True
_CLASSES["point"] = np.ones(256, bool)  # every byte that begins a character
_CLASSES["point"][0x80:0xC0] = False
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?:;")] = True

N_FEATURES = 12
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Lines:
    """Counts of every text of a batch, and features of its lines with words."""

    def __init__(self, column: pa.Array):
        w = X.Words(column, X.SPACED)
        d, off, n = w.data, w.off, len(w.off) - 1
        breaks = np.flatnonzero(d == 10)
        full = off[1:] > off[:-1]
        starts = np.union1d(off[:-1][full], breaks + 1)
        starts = starts[starts < len(d)]
        ends = np.concatenate([starts[1:], [len(d)]]) if len(starts) else starts
        ends = ends - ((ends > starts) & (d[ends - 1] == 10)) if len(starts) else ends
        # words of each line; lines without any drop out
        a, b = np.searchsorted(w.start, starts), np.searchsorted(w.start, ends)
        some = b > a
        starts, ends, a, b = starts[some], ends[some], a[some], b[some]
        doc = w.doc[a] if len(a) else a
        word, line = X.span_hashes(d, X.EXACT, (w.start, w.end), (starts, ends))
        salt = X._mix(np.arange(1, n + 1, dtype=np.uint64) * X._MIX1)  # equal hashes count within a row only

        _, first, same = np.unique(line ^ salt[doc], return_index=True, return_inverse=True)
        dup = np.ones(len(line), bool)
        dup[first] = False
        at, win = w.windows(word, 3)
        repeated = np.zeros(len(w) + 1, np.int64)
        if len(at):
            key = win ^ salt[w.doc[at]]
            order = np.argsort(key)
            k = key[order]
            twin = np.zeros(len(k), bool)
            twin[1:] = k[1:] == k[:-1]
            twin[:-1] |= twin[1:]
            twice = at[order[twin]]
            np.add.at(repeated, twice, 1)
            np.add.at(repeated, twice + 3, -1)  # windows do not cross rows
        repeated = np.cumsum(repeated[:-1]) > 0

        total = {c: np.concatenate([[0], np.cumsum(t[d])]) for c, t in _CLASSES.items()}
        chars = np.concatenate([[0], np.cumsum(total["point"][w.end] - total["point"][w.start])])
        again = np.concatenate([[0], np.cumsum(repeated)])
        rows = lambda c: c[w.first[1:]] - c[w.first[:-1]]
        self.counts = {
            "n_words": w.count,
            "word_chars": rows(chars),
            "n_symbols": total["symbol"][off[1:]] - total["symbol"][off[:-1]],
            "n_dup_lines": np.bincount(doc[dup], minlength=n),
            "n_repeat_words": rows(again),
        }
        self.weight = (chars[b] - chars[a]).astype(np.float64)  # characters in the words of a line
        words, size = (b - a).astype(np.float64), np.maximum(self.weight, 1)
        share = {c: (total[c][ends] - total[c][starts]) / size for c in ("symbol", "upper", "digit", "loud", "bracket")}
        last = d[w.end[b - 1] - 1] if len(b) else d[:0]
        self.x = np.stack(
            [
                np.ones_like(words),
                np.log1p(words),
                np.sqrt(share["symbol"]),
                np.sqrt(share["upper"]),
                np.sqrt(share["digit"]),
                np.sqrt(share["loud"]),
                np.sqrt(share["bracket"]),
                (again[b] - again[a]) / np.maximum(words, 1),
                dup.astype(np.float64),
                np.log1p(self.weight / np.maximum(words, 1)),
                (words <= 3).astype(np.float64),
                _ENDS[last].astype(np.float64),
            ],
            axis=1,
        )
        self.doc = doc
        self.first = np.searchsorted(doc, np.arange(n + 1))


def _by_position(first: np.ndarray):
    """Rows by falling length, and for each position the rows that reach it."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    reach = np.searchsorted(-size[order], -np.arange(1, size.max(initial=0) + 1), side="right")
    return order, reach


def viterbi(scores: np.ndarray, step: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best labels (0, 1) of each sequence.  ``scores`` (lines, 2), ``step``
    (2, 2) from label to label; all sequences move on together."""
    order, reach = _by_position(first)
    begin = first[:-1][order]
    label = np.zeros(len(scores), np.int8)
    back = np.zeros((len(scores), 2), np.int8)
    best = np.zeros((len(order), 2))
    for t, k in enumerate(reach):
        at = begin[:k] + t
        if t:
            via = best[:k, :, None] + step
            back[at] = via.argmax(axis=1)
            best[:k] = via.max(axis=1) + scores[at]
        else:
            best[:k] = scores[at]
    now = best.argmax(axis=1).astype(np.int8)
    for t in range(len(reach) - 1, -1, -1):
        k = reach[t]
        at = begin[:k] + t
        label[at] = now[:k]
        now[:k] = back[at, now[:k]]
    return label


def _passes(s, step, first):
    """Forward and backward sums of the scores, and each line's total."""
    order, reach = _by_position(first)
    begin = first[:-1][order]
    fwd, bwd = np.zeros_like(s), np.zeros_like(s)
    add = lambda v, axis: np.logaddexp(v.take(0, axis), v.take(1, axis))
    for t, k in enumerate(reach):
        at = begin[:k] + t
        fwd[at] = s[at] + (add(fwd[at - 1][:, :, None] + step, 1) if t else 0)
    for t in range(len(reach) - 2, -1, -1):
        at = begin[: reach[t + 1]] + t
        bwd[at] = add(step + (s + bwd)[at + 1][:, None, :], 2)
    z_of = np.zeros(len(first) - 1)
    some = np.diff(first) > 0
    z_of[some] = add((fwd + bwd)[first[:-1][some]], 1)
    return fwd, bwd, z_of


def _likelihood(x, y, first, w, step):
    """Log likelihood of the labels, and its gradients."""
    s = np.stack([np.zeros(len(x)), x @ w], axis=1)
    fwd, bwd, z_of = _passes(s, step, first)
    some = np.diff(first) > 0
    z = np.repeat(z_of, np.diff(first))
    p = np.exp(fwd + bwd - z[:, None])
    inner = np.ones(len(x), bool)
    inner[first[:-1][some]] = False
    here = np.flatnonzero(inner)
    pair = np.exp(fwd[here - 1][:, :, None] + step + (s + bwd)[here][:, None, :] - z[here][:, None, None])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[here - 1], y[here]), 1)
    value = s[np.arange(len(x)), y].sum() + (seen * step).sum() - z_of.sum()
    return value, x.T @ (y - p[:, 1]), seen - pair.sum(axis=0)


def fit_field(x: np.ndarray, y: np.ndarray, first: np.ndarray, steps: int = STEPS, ridge: float = RIDGE) -> dict:
    """Weights of the field, by adaptive gradient ascent with a ridge."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[0], scale[0] = 0, 1
    scale[scale < 1e-9] = 1
    z = (x - mean) / scale
    w, step = np.zeros(x.shape[1]), np.zeros((2, 2))
    seen_w, seen_s = np.zeros_like(w), np.zeros_like(step)
    for _ in range(steps):
        _, gw, gs = _likelihood(z, y, first, w, step)
        gw, gs = (gw - ridge * w) / len(z), (gs - ridge * step) / len(z)
        seen_w, seen_s = seen_w + gw * gw, seen_s + gs * gs
        w, step = w + 0.5 * gw / np.sqrt(seen_w + 1e-12), step + 0.5 * gs / np.sqrt(seen_s + 1e-12)
    w = w / scale
    w[0] -= (w * mean).sum()
    return {"w": w.tolist(), "step": step.tolist()}


def line_labels(sure: np.ndarray, weight: np.ndarray, first: np.ndarray, quality: np.ndarray) -> np.ndarray:
    """A label for each line: by the sign of ``sure`` (log odds of content), but
    in each document lines of at least half the ``weight`` have its quality."""
    y = (sure > 0).astype(np.int64)
    for a, b, q in zip(first[:-1], first[1:], quality):
        w = weight[a:b]
        if 2 * w[y[a:b] == q].sum() < w.sum():
            surest = np.argsort(-sure[a:b] if q else sure[a:b], kind="stable")
            half = np.searchsorted(2 * np.cumsum(w[surest]), w.sum()) + 1
            y[a + surest[:half]] = q
    return y


def learn(x: np.ndarray, weight: np.ndarray, first: np.ndarray, quality: np.ndarray, steps: int = STEPS, rounds: int = ROUNDS) -> dict:
    """The field from lines whose documents only have labels."""
    y = np.repeat(quality, np.diff(first))
    chains = np.arange(len(x) + 1)  # a line each, in the first round
    for _ in range(rounds):
        field = fit_field(x, y, chains, steps)
        fwd, bwd, _ = _passes(np.stack([np.zeros(len(x)), x @ np.array(field["w"])], axis=1), np.array(field["step"]), chains)
        now = line_labels((fwd + bwd) @ np.array([-1.0, 1.0]), weight, first, quality)
        if chains is first and (now == y).all():
            return field
        y, chains = now, first
    return fit_field(x, y, first, steps)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in X.pieces(whole, "text"):
            lines = Lines(b.column("text"))
            cut = [lines.x[s:e].astype("<f4").tobytes() for s, e in zip(lines.first, lines.first[1:])]
            size = [lines.weight[s:e].astype("<f4").tobytes() for s, e in zip(lines.first, lines.first[1:])]
            yield pa.RecordBatch.from_arrays([b.column("quality"), pa.array(cut, pa.binary()), pa.array(size, pa.binary())], names=["quality", "x", "size"])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES, steps: int = STEPS,
) -> dict | None:
    """The field, from a bounded sample; None without labels of both kinds."""
    prepare(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("label_id"), F.col("quality").cast("int").alias("quality")).where("label_id is not null")
    order = F.xxhash64("label_id"), F.col("label_id")
    chosen = known.where("quality = 0").orderBy(*order).limit(sample).unionByName(known.where("quality = 1").orderBy(*order).limit(sample))
    rows = (
        docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
        .join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
        .where(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) < sample_lines)
        .select("quality", "text")
        .mapInArrow(_features, "quality int, x binary, size binary")
        .limit(4 * sample)  # ids may repeat; the sample stays bounded
        .collect()
    )
    rows = sorted((r["quality"], bytes(r["x"]), bytes(r["size"])) for r in rows if r["x"])
    if len({r[0] for r in rows}) < 2:
        return None
    read = lambda v: np.frombuffer(v, "<f4").astype(np.float64)
    x = np.concatenate([read(r[1]) for r in rows]).reshape(-1, N_FEATURES)
    first = np.concatenate([[0], np.cumsum([len(r[2]) // 4 for r in rows])])
    return learn(x, np.concatenate([read(r[2]) for r in rows]), first, np.array([r[0] for r in rows]), steps)


def _judge(field: dict | None, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in X.pieces(whole, "text"):
                lines = Lines(b.column("text"))
                c, n = lines.counts, b.num_rows
                failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
                content = np.ones(n)
                if field is not None and len(lines.x):
                    scores = np.stack([np.zeros(len(lines.x)), lines.x @ np.array(field["w"])], axis=1)
                    label = viterbi(scores, np.array(field["step"]), lines.first)
                    good = np.bincount(lines.doc, lines.weight * label, minlength=n)
                    content = good / np.maximum(np.bincount(lines.doc, lines.weight, minlength=n), 1)
                names = [x for x in b.schema.names if x != "text" or "keep_text" in b.schema.names]
                cols = [b.column(x) for x in names if x != "keep_text"]
                cols += [pa.array(c[k], pa.int64()) for k in COUNTS]
                cols += [pa.array(failed), pa.array(content), pa.array(~failed & (content >= share))]
                yield pa.RecordBatch.from_arrays(cols, names=[x for x in names if x != "keep_text"] + [*COUNTS, "base_failed", "content_share", "kept"])

    return run


def judge(
    docs: DataFrame, field: dict | None, text_col: str = "text", share: float = CONTENT_SHARE, with_text: bool = True
) -> DataFrame:
    """Every row as (row: struct of the other columns, text if asked for, the
    base counts, base_failed, content_share, kept)."""
    prepare(docs.sparkSession)
    rest = [c for c in docs.columns if c != text_col]
    row = F.struct(*(F.col(f"`{c}`") for c in rest)) if rest else F.struct(F.lit(0).alias("_"))
    given = docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("text"))
    if with_text:
        given = given.withColumn("keep_text", F.lit(True))
    kind = given.schema["row"].dataType.simpleString()
    out = f"row {kind}, " + ("text string, " if with_text else "") + ", ".join(f"{c} long" for c in COUNTS)
    return given.mapInArrow(_judge(field, share), f"{out}, base_failed boolean, content_share double, kept boolean")
