"""Edit-aware token counts.

A byte-level BPE counts each pre-token by itself, and a pre-token never
continues from a character into white space.  So a text can be cut before
white space that follows another character, and counts of the pieces add up.
Each document keeps a segment tree: leaves are runs of pre-tokens (about
``LEAF`` characters, cut at such places) with their token counts, inner nodes
are sums.  ``build_trees`` encodes every text once and gives the leaves as two
array columns, which can be stored beside the text.  ``apply_edits`` takes such
a table: an edit replaces text in the leaves that it touches; if an end of the
touched run is no longer a safe cut, the neighbouring leaf joins it as boundary
context.  Only these leaves are encoded again, and the sums on their paths to
the root are updated; the leaves that come out serve the next edits.

Both are one pass in small batches, without a shuffle.
The vocabulary file is a parameter; its bytes are broadcast (at most
``MAX_VOCABULARY`` bytes, checked).

Defined cases: null or empty text has no tokens and no edits; edits are
(start, end, text) in code points, in the text before any edit; they may not
overlap and are cut to the text; an edit may leave the text empty.  Repeated
rows and null ids are counted row by row.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitscope.llm import text as X
from hitscope.llm.runtime import prepare

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_VOCABULARY = 16 << 20
LEAF = 512

#: The pattern that splits text before the merges (fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_CUT = re.compile(r"\S(?=[ \t\r\n])")
_PERSONAL = re.compile(
    # a mail address is tried where its characters begin only, so that long runs of them are read once
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+" r"|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])" r"|(?<![\w+])\+?\d[\d ()-]{7,}\d(?!\w)"
)

Edit = tuple[int, int, str]


def mask_personal(text: str) -> list[Edit]:
    """Edits that mask mail addresses, IPv4 addresses and phone numbers."""
    return [(m.start(), m.end(), "[masked]") for m in _PERSONAL.finditer(text)]


def encoder(vocabulary: bytes):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
    return tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def cuts(text: str, leaf: int = LEAF) -> list[int]:
    """Starts of the leaves: 0, then safe cuts about ``leaf`` apart."""
    out, at = [0], leaf
    while at < len(text) and (m := _CUT.search(text, at - 1)) and m.end() < len(text):
        out.append(m.end())
        at = m.end() + leaf
    return out


def _safe(left: str, right: str) -> bool:
    """No pre-token crosses the place between two texts."""
    return not left[-1].isspace() and right[0] in " \t\r\n"


class SegmentTree:
    """Token counts of a text under edits, from its leaves' starts and counts."""

    def __init__(self, text: str, start: list[int], counts: list[int], count: Callable[[str], int]):
        self.count, self.start = count, start
        self.leaf = [text[a:b] for a, b in zip(start, [*start[1:], len(text)])]
        self.size = 1 << max(0, len(start) - 1).bit_length()
        self.sum = [0] * (2 * self.size)
        self.sum[self.size : self.size + len(counts)] = counts
        for i in range(self.size - 1, 0, -1):
            self.sum[i] = self.sum[2 * i] + self.sum[2 * i + 1]
        self.encoded = 0  # characters encoded by edits
        n = len(self.leaf)
        self.right, self.left = list(range(1, n + 1)), list(range(-1, n - 1))  # towards the next leaf that holds text

    @classmethod
    def build(cls, text: str, count: Callable[[str], int], leaf: int = LEAF) -> SegmentTree:
        start = cuts(text, leaf)
        parts = (text[a:b] for a, b in zip(start, [*start[1:], len(text)]))
        return cls(text, start, [count(x) if x else 0 for x in parts], count)

    def leaves(self) -> tuple[list[int], list[int]]:
        """Starts and counts of the leaves as they are now."""
        start, counts, at = [], [], 0
        for i, x in enumerate(self.leaf):
            if x or (not start and i + 1 == len(self.leaf)):
                start.append(at)
                counts.append(self.sum[self.size + i])
                at += len(x)
        return start, counts

    @property
    def total(self) -> int:
        return self.sum[1]

    def text(self) -> str:
        return "".join(self.leaf)

    def edit(self, edits: list[Edit]) -> None:
        """Applies edits given in places of the first text, all at once."""
        touched = set()
        length = self.start[-1] + len(self.leaf[-1])
        last = length
        for s, e, new in sorted(edits, reverse=True):  # from the right: places to the left stay
            s, e = max(0, s), min(e, length)
            if not 0 <= s <= e <= last:
                raise ValueError("edits overlap or leave the text")
            last = s
            i = bisect_right(self.start, s) - 1
            j = max(i, bisect_right(self.start, e - 1) - 1) if e > s else i
            self.leaf[i] = self.leaf[i][: s - self.start[i]] + new + self.leaf[j][e - self.start[j] :]
            for x in range(i + 1, j + 1):
                self.leaf[x] = ""
            touched.update(range(i, j + 1))
        # context: leaves join until no pre-token can cross an edge of a touched one
        for i in sorted(touched):
            if not self.leaf[i]:
                continue
            while (b := self._next(i)) is not None and not _safe(self.leaf[i], self.leaf[b]):
                self.leaf[i], self.leaf[b] = self.leaf[i] + self.leaf[b], ""
                touched.add(b)
            if (a := self._previous(i)) is not None and not _safe(self.leaf[a], self.leaf[i]):
                self.leaf[a], self.leaf[i] = self.leaf[a] + self.leaf[i], ""
                touched.add(a)
        # an emptied run brings its neighbours together
        for i in sorted(touched):
            if self.leaf[i]:
                continue
            a, b = self._previous(i), self._next(i)
            while a is not None and b is not None and not _safe(self.leaf[a], self.leaf[b]):
                self.leaf[a], self.leaf[b] = self.leaf[a] + self.leaf[b], ""
                touched.update((a, b))
                b = self._next(a)
        for i in touched:
            x = self.leaf[i]
            self.encoded += len(x)
            self.sum[self.size + i] = self.count(x) if x else 0
        up = {(self.size + i) // 2 for i in touched}
        while up and up != {0}:
            for i in up:
                self.sum[i] = self.sum[2 * i] + self.sum[2 * i + 1]
            up = {i // 2 for i in up if i > 1}

    def _next(self, i: int) -> int | None:
        return self._follow(i, self.right)

    def _previous(self, i: int) -> int | None:
        return self._follow(i, self.left)

    def _follow(self, i: int, link: list[int]) -> int | None:
        """The nearest leaf with text on one side; emptied leaves on the way are
        passed over from now on."""
        way, x = [i], link[i]
        while 0 <= x < len(self.leaf) and not self.leaf[x]:
            way.append(x)
            x = link[x]
        for w in way:
            link[w] = x
        return x if 0 <= x < len(self.leaf) else None


_INT_LIST = pa.list_(pa.int32())


def _build(vocabulary, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary.value)
        count = lambda s: len(code.encode_ordinary(s))
        for whole in batches:
            for b in X.pieces(whole, "text"):
                leaves = [SegmentTree.build(text or "", count, leaf).leaves() for text in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array([x for x, _ in leaves], _INT_LIST), pa.array([x for _, x in leaves], _INT_LIST)],
                    names=[*b.schema.names, "leaf_starts", "leaf_tokens"],
                )

    return run


def _apply(vocabulary, edits_of: Callable[[str], list[Edit]] | None, with_text: bool):
    counts = ("n_tokens", "n_edits", "n_tokens_edited", "n_chars_encoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(vocabulary.value)
        count = lambda s: len(code.encode_ordinary(s))
        for whole in batches:
            for b in X.pieces(whole, "text"):
                out = {c: [] for c in (*counts, "text", "leaf_starts", "leaf_tokens")}
                given = b.column("edits").to_pylist() if edits_of is None else [None] * b.num_rows
                for text, start, tokens, mine in zip(*(b.column(c).to_pylist() for c in ("text", "leaf_starts", "leaf_tokens")), given):
                    edits = edits_of(text or "") if edits_of else [(e["start"], e["stop"], e["text"] or "") for e in mine or ()]
                    out["n_tokens"].append(sum(tokens))
                    out["n_edits"].append(len(edits))
                    if edits:
                        tree = SegmentTree(text or "", start, tokens, count)
                        tree.edit(edits)
                        text, (start, tokens) = tree.text(), tree.leaves()
                    out["n_tokens_edited"].append(sum(tokens))
                    out["n_chars_encoded"].append(tree.encoded if edits else 0)
                    for c, x in (("text", text), ("leaf_starts", start), ("leaf_tokens", tokens)):
                        out[c].append(x)
                kinds = {"text": pa.string(), "leaf_starts": _INT_LIST, "leaf_tokens": _INT_LIST}
                names = list(out) if with_text else list(counts)
                yield pa.RecordBatch.from_arrays([b.column("row"), *(pa.array(out[c], kinds.get(c, pa.int64())) for c in names)], names=["row", *names])

    return run


def _vocabulary(df: DataFrame, path: str):
    with open(path, "rb") as f:
        ranks = f.read(MAX_VOCABULARY + 1)
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError("vocabulary too large to broadcast")
    return prepare(df.sparkSession).sparkContext.broadcast(ranks)


def build_trees(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, leaf: int = LEAF) -> DataFrame:
    """Every row as (row: struct of the other columns, text, leaf_starts,
    leaf_tokens); the token count is the sum of leaf_tokens."""
    rest = [c for c in docs.columns if c != text_col]
    row = F.struct(*(F.col(f"`{c}`") for c in rest)) if rest else F.struct(F.lit(0).alias("_"))
    given = docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("text"))
    kind = given.schema["row"].dataType.simpleString()
    return given.mapInArrow(
        _build(_vocabulary(docs, vocabulary), leaf), f"row {kind}, text string, leaf_starts array<int>, leaf_tokens array<int>"
    )


def apply_edits(
    trees: DataFrame, edits_of: Callable[[str], list[Edit]] | None = None, vocabulary: str = VOCABULARY, with_text: bool = True
) -> DataFrame:
    """(row, n_tokens, n_edits, n_tokens_edited, n_chars_encoded) and, if asked
    for, the text and leaves after the edits.  The edits come from a function
    of the text, or from a column ``edits`` of structs (start, stop, text)."""
    cols = ["row", "text", "leaf_starts", "leaf_tokens", *(["edits"] if edits_of is None else [])]
    out = f"row {trees.schema['row'].dataType.simpleString()}, n_tokens long, n_edits long, n_tokens_edited long, n_chars_encoded long"
    if with_text:
        out += ", text string, leaf_starts array<int>, leaf_tokens array<int>"
    return trees.select(*cols).mapInArrow(_apply(_vocabulary(trees, vocabulary), edits_of, with_text), out)
