"""Queries against their SQL on tables made to hold what the given ones lack:
fixed footers, copies, wrapped notices, very many lines in one document."""

import random
import time

import duckdb
import pytest

from hitscope.llm import line_dedup, oracles, queries

FOOTER = "About us\nContact\nAll pages of this site"
WRAPPED = (
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that",
    "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy",
    "Released\nunder the\n\nMIT\r\nLicense",
    "# Licensed under the Apache\n# License, Version\n# 2.0 (the notice)",
    "released under " + "far " * 6 + "\nthe mit license",
    "mit license under the released",
    "the\nmit license",
)


def _prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 8))) for _ in range(n))


def _both(spark, tmp_path, name, rows):
    """Rows of a registered query and of its SQL over ``rows`` as documents."""
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(path)
    found = queries.queries()[name](spark, str(tmp_path))
    names = sorted(found.columns)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    cursor = con.execute(oracles.SQL[name])
    order = [[c[0] for c in cursor.description].index(n) for n in names]
    want = sorted(str([r[i] for i in order]) for r in cursor.fetchall())
    return sorted(str(list(r)) for r in found.select(*names).collect()), want


def test_boilerplate_rule(spark, tmp_path):
    rows = [(i, f"{_prose(i, 6)}\n  {FOOTER}\t\n{_prose(100 + i, 6)}", f"s{i}") for i in range(12)]
    rows += [(50 + i, "copied one\ncopied two\ncopied three", f"s{i}") for i in range(12)]
    rows += [(100 + i, f"one text\n{FOOTER}\nin many copies", f"s{i % 4}") for i in range(60)]
    rows += [(200 + i, f"local\nline\n{_prose(600 + i % 2, 5)}", f"s{i % 9}") for i in range(18)]
    # the footer is all but a share of 0.2, or just less, of a text
    rows += [(300 + i, "fifth of it" + "x" * (i % 3) + "\n" + "y" * 44, f"s{i}") for i in range(9)]
    rows += [(400, None, "s1"), (401, "", "s2"), (402, "\n\n", None), (None, f"mine\n{FOOTER}", "s3"), (403, FOOTER, None), (403, FOOTER, None)]
    rows += [(404, f"same id\n{FOOTER}", "s1"), (404, f"Contact\nother text, other places\n{FOOTER}\nContact", "s2"), (None, FOOTER, None)]
    got, want = _both(spark, tmp_path, "op2_line_dedup", rows)
    assert got == want and sum("'mine'" in r for r in got) == 1


@pytest.mark.parametrize("name", ["op2_line_dedup", "op4_license_scan"])
def test_empty_documents(spark, tmp_path, name):
    got, want = _both(spark, tmp_path, name, [(1, None, None), (2, "", "s"), (None, " \n ", "s")])
    assert got == want and len(got) == 3


def test_wrapped_notices(spark, tmp_path):
    rows = []
    for t in WRAPPED:
        for form in (t, t.replace("\n", "\n\n"), "\n".join(t.split()), f"{_prose(1, 40)}\n{t}\n{_prose(2, 40)}", f"All rights reserved. {t}"):
            rows.append((len(rows), form, "s"))
    rows.append((len(rows), "\n".join(WRAPPED), "s"))
    got, want = _both(spark, tmp_path, "op4_license_scan", rows)
    assert got == want and sum("'mit'" in r for r in got) >= 5


def test_very_many_lines(spark):
    """16,000 lines, half of them boilerplate, take seconds: places are hashed."""
    common = [f"common line {i}" for i in range(8_000)]
    rows = [(1, "\n".join(x for i, c in enumerate(common) for x in (c, f"own {i} {i * i}")), "s1")]
    rows += [(2 + k, "\n".join(common[i] for i in range(k, 8_000, 7)) + "\n" + _prose(k, 20_000), f"t{k}") for k in range(7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    twice = docs.unionByName(docs.selectExpr("doc_id + 10 as doc_id", "concat('again ', doc_id, '\n', text) as text", "concat(source, 'b') as source"))
    start = time.time()
    got = {r[0]: (r[1], r[2]) for r in line_dedup.clean_lines(twice, sites=3, by="bodies").select("row.doc_id", "n_lines", "n_removed").collect()}
    assert time.time() - start < 40
    assert got[1] == (16_000, 8_000) and len(got) == 16
