"""Archives that are not as they should be, and token trees on long texts."""

from __future__ import annotations

import gzip
import random
import time

import pytest

from hitscope.llm import token_count, warc


def record(body: bytes, length=None, version="1.1", kind="resource", name="x") -> bytes:
    size = "" if length is False else f"Content-Length: {len(body) if length is None else length}\r\n"
    return f"WARC/{version}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{name}>\r\n{size}\r\n".encode() + body + b"\r\n\r\n"


def read(spark, folder, *files):
    for i, f in enumerate(files):
        with gzip.open(f"{folder}/f{i}.warc.gz", "wb") as g:
            g.write(f)
    rows = warc.read_archives(spark, str(folder)).collect()
    assert sum(r["record_bytes"] for r in rows) == sum(map(len, files))
    return rows


BODY = [b"first", b"second " * 40, b"third WARC/1.1\r\nWARC-Type: no\r\n\r\n", b"", b"fifth\r\n\r\n"]


@pytest.mark.parametrize("length, problem", [("many", "no length"), (False, "no length"), (10**9, "too long"), (9999, "cut off"), (700, "wrong length"), (3, "wrong length"), (-5, "no length")])
def test_one_bad_length_costs_one_record(spark, tmp_path, length, problem):
    parts = [record(b, length if i == 1 else None, name=str(i)) for i, b in enumerate([*BODY, b"more " * 200])]
    rows = read(spark, tmp_path, b"".join(parts))
    good = {r["record_id"]: bytes(r["payload"]) for r in rows if r["type"] != "malformed"}
    want = {f"<{i}>": b for i, b in enumerate([*BODY, b"more " * 200]) if i != 1}
    assert good == want
    (bad,) = [r for r in rows if r["type"] == "malformed"]
    assert bytes(bad["payload"]) == parts[1] and bad["problem"] == problem


def test_either_version_and_other_bytes(spark, tmp_path):
    parts = [record(b, version="1.0" if i % 2 else "1.1", name=str(i)) for i, b in enumerate(BODY)]
    rows = read(spark, tmp_path, b"".join(parts), b"not an archive", b"junk\r\n" + parts[0], parts[4][:-6], parts[1][:-30], parts[0][:-4])
    kinds = [(r["type"], r["problem"]) for r in rows]
    assert kinds.count(("resource", None)) == len(BODY) + 2
    assert sorted(p for _, p in kinds if p) == ["cut off", "cut off", "no version line", "no version line"]


def test_many_lines_within_a_payload(spark, tmp_path):
    """Reading takes time in proportion, also when the length is wrong."""
    body = b"WARC/1.1\r\n" * 60_000
    began = time.time()
    (r,) = read(spark, tmp_path, record(body))
    assert bytes(r["payload"]) == body and time.time() - began < 60


def test_every_cut_of_a_file_is_read(spark, tmp_path):
    whole = b"".join(record(b, name=str(i)) for i, b in enumerate(BODY))
    cuts = sorted(random.Random(1).sample(range(len(whole)), 25))
    rows = read(spark, tmp_path, *(whole[:c] for c in cuts))
    assert sum(r["type"] == "malformed" for r in rows) <= len(cuts) * 2


def test_masks_in_linear_time():
    began = time.time()
    for text in ("a" * 1_000_000, "7" * 1_000_000, "7" * 500_000 + "x", "a." * 500_000, "1 " * 300_000 + "x", "a@" * 300_000):
        token_count.mask_personal(text)
    assert time.time() - began < 20
    found = lambda t: [t[a:b] for a, b, _ in token_count.mask_personal(t)]
    assert found("write to me.you+x@mail.example.org, or 10.0.0.1 or +1 (555) 010-9999!") == ["me.you+x@mail.example.org", "10.0.0.1", "+1 (555) 010-9999"]


def test_a_megabyte_deleted_in_one_edit():
    with open(token_count.VOCABULARY, "rb") as f:
        code = token_count.encoder(f.read())
    count = lambda s: len(code.encode_ordinary(s))
    text = "some words here " * 70_000
    tree = token_count.SegmentTree.build(text, count)
    began = time.time()
    tree.edit([(10, len(text) - 10, "")])
    assert tree.text() == text[:10] + text[-10:] and tree.total == count(tree.text())
    tree = token_count.SegmentTree.build(text, count)
    tree.edit([(k, k + 700, "") for k in range(0, len(text) - 700, 1400)])
    assert tree.total == count(tree.text())
    assert time.time() - began < 30
