"""Each operator on hand-made rows: nulls, empty and very long texts, ties,
repeated rows, empty tables and extra columns with clashing names."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hitscope.llm import (
    decontaminate,
    html_extract,
    license_scan,
    line_dedup,
    mixing,
    near_dup,
    quality,
    token_count,
    url_filter,
    warc,
)
from hitscope.llm.runtime import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "n_words int, row string, id string, k1 int, component int, block int, slot int, key string, word string, items string, kept string, n string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def clashing(df):
    """Extra columns whose names the operators use themselves."""
    return df.select("*", *(F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in CLASH.split(", ")))


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))


# --- connected components ---


def test_components_of_random_graphs(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {x["id"]: x["root"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- op 1 ---

RULES = (("net/", "block"), ("example.net/en/", "allow"))


def test_urls(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://A.Example.NET/en/x?y#z", "h"),
            (2, "https://b.net/", None),
            (3, "https://b.net", None),
            (4, None, None),
            (5, "no scheme", None),
            (6, "", None),
            (7, "http://www.List.org:80/p/?b=2&a=1&utm_source=q#f", None),
            (8, "https://list.org/p?a=1&b=2", None),
            (8, "https://list.org/p?a=1&b=2", None),
            (9, "https://list.org/p?a=1", None),
            (10, "x://notnet/en/", None),
            (None, "http://y//a://b" + "c" * 5000, None),
        ],
        "page_id long, url string, key string",
    )
    listed = spark.createDataFrame([("http://list.org/p?b=2&a=1",), (None,), ("junk",)], "url string")
    rows = url_filter.judge_urls(pages, listed, RULES).collect()
    got = sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in rows), key=str)
    assert len(got) == 12
    by = {g[0]: g[1:] for g in got}
    assert by[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert by[2] == ("b.net", "/", "net/", "block")
    assert by[3] == ("b.net", "", None, "allow")
    assert by[4] == by[5] == by[6] == ("", "", None, "allow")
    assert by[7] == ("www.list.org:80", "/p/", None, "block")
    assert by[8][3] == "block" and by[9][3] == "allow"
    assert by[10] == ("notnet", "/en/", None, "allow")
    assert by[None][:2] == ("y", "//a://b" + "c" * 5000)
    none = url_filter.judge_urls(pages, listed.limit(0), RULES).where("verdict = 'block'").collect()
    assert [r["page_id"] for r in none] == [2]
    assert url_filter.judge_urls(pages.limit(0), listed, RULES).count() == 0


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = url_filter.bloom_blocks(4000)
    bloom = url_filter.build_bloom(keys, blocks)
    assert url_filter.may_be_listed(keys, "key", bloom, blocks).where("not maybe").count() == 0
    other = spark.range(20000).select(F.concat(F.lit("x"), "id").alias("key"))
    assert url_filter.may_be_listed(other, "key", bloom, blocks).where("maybe").count() < 200
    # a filter that is far too small only passes more: the verdicts are the same
    pages = keys.limit(50).select(F.lit(1).cast("long").alias("page_id"), F.concat(F.lit("http://"), "key", F.lit("/")).alias("url"))
    pages = pages.unionByName(other.limit(50).select(F.lit(2).cast("long").alias("page_id"), F.concat(F.lit("http://"), "key", F.lit("/")).alias("url")))
    got = url_filter.judge_urls(pages, keys.select(F.concat(F.lit("http://"), "key").alias("url")), (), max_blocks=1)
    assert {(r["page_id"], r["verdict"]) for r in got.collect()} == {(1, "block"), (2, "allow")}


# --- op 2 ---


def _spread_brute(rows, sites):
    import collections

    seen, contexts, n = collections.defaultdict(set), collections.defaultdict(set), collections.Counter()
    for _, t, s in rows:
        ls = [x.strip(" \t\r\x0b\x0c") for x in t.split("\n")] if t is not None else []
        for i, x in enumerate(ls):
            if x:
                n[x] += 1
                seen[x] |= {s} - {None}
                contexts[x].add((ls[i - 1] if i else None, ls[i + 1] if i + 1 < len(ls) else None))
    return {x for x in n if len(seen[x]) >= sites and len(contexts[x]) >= max(sites, n[x] / 2)}


@pytest.mark.parametrize("sites", [3, 10])
def test_lines(spark, sites):
    r = random.Random(sites)
    rows = []
    for i in range(160):
        body = [prose(i * 7 + j, 6) for j in range(r.randint(0, 4))]
        for k in range(6):  # lines on about 5, 10, ... sites, so that some lie near the threshold
            if i % 40 < (k + 1) * 3:
                body.insert(r.randint(0, len(body)), f"  common {k} " + "\t" * (i % 2))
        rows.append((i, "\n".join(body), f"s{i % 40}"))
    rows += [(500 + i, "copied one\ncopied two\ncopied three", f"s{i}") for i in range(40)]  # copies are not boilerplate
    rows += [(900, None, "s1"), (901, "", "s2"), (902, "\n\n", None), (None, "common 5\nmine", "s3"), (903, "common 5", None), (903, "common 5", None)]
    got = line_dedup.clean_lines(clashing(documents(spark, rows)), sites=sites).select("row.doc_id", "text", "n_lines", "n_removed").collect()
    common = _spread_brute(rows, sites)
    assert any(x.startswith("common") for x in common) and not any(x.startswith("copied") for x in common)

    def clean(i, t):
        ls = t.split("\n") if t is not None else []
        kept = [x for x in ls if x.strip(" \t\r\x0b\x0c") not in common]
        return (i, t if t is None else "\n".join(kept), len(ls), len(ls) - len(kept))

    assert sorted(map(str, map(tuple, got))) == sorted(str(clean(i, t)) for i, t, _ in rows)
    assert line_dedup.clean_lines(documents(spark, [])).count() == 0


FOOTER = "About us\nContact\nAll pages of this site"


def _pipeline_texts(spark, rows):
    return {r["doc_id"]: r["text"] for r in corpus_pipeline.dedup_lines(spark, documents(spark, rows), "").collect()}


def test_pipeline_takes_out_all_lines_of_a_fixed_footer(spark):
    rows = [(i, f"{prose(i, 6)}\n{prose(100 + i, 6)}\n{FOOTER}", f"s{i}") for i in range(12)]
    rows += [(50 + i, "copied one\ncopied two\ncopied three", f"s{i}") for i in range(12)]
    for i in range(12):  # near copies: a line of each is its own
        lines = [prose(200 + j, 6) for j in range(10)]
        lines[i % 10] = f"edited {i}"
        rows.append((80 + i, "\n".join(lines), f"s{i}"))
    rows += [(99, f"four {FOOTER}\nsites", "s1")]
    got = _pipeline_texts(spark, rows)
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert got[i] == ("\n".join(t.split("\n")[:2]) if i < 12 else t.replace("\nContact\nAll pages of this site", "\nAll pages of this site").replace("\nAll pages of this site", "") if i == 99 else t)


def test_copies_do_not_shield_a_line(spark):
    rows = [(i, f"{prose(i, 6)}\n{FOOTER}\n{prose(300 + i, 4)}", f"s{i % 10}") for i in range(40)]
    rows += [(1000 + i, f"one text\n{FOOTER}\nin many copies", f"s{i % 4}") for i in range(100)]
    rows += [(2000 + i, f"local\nline\n{prose(600 + i % 2, 5)}", f"s{i % 9}") for i in range(18)]  # two documents, copied
    got = _pipeline_texts(spark, rows)
    assert all(got[i] == t.replace(FOOTER + "\n", "") for i, t, _ in rows)


# --- op 3 ---

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="home ad-free-not">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- x --><div class="ad">Buy</div><div class="cookie-notice">Cookies</div>
<article><header><h1>Title &amp; more&nbsp;x</h1></header><p><b>One   two<br><p>three&copy; <i>four</i>five</p>%s<ul><li>a<li>b</ul>
<form><p>mail</p></form><div id="comments"><p>first!</p></div></article><aside>side</aside><footer>&copy; me</footer></body></html>"""


def test_page_blocks():
    text = lambda h: "\n".join(t for t, _ in html_extract.page_blocks(h))
    assert text(PAGE % "") == "Title & more x\nOne two\nthree© fourfive\na\nb"
    assert text("<p>a<p>b<div>c<span>d</span> e</div>") == "a\nb\ncd e"
    assert text("plain &lt;text") == "plain <text"
    assert text("<main><p>in</p></main><p>out</p>") == "in"
    assert text("<table><tr><td>1<td>2<tr><td>3</table>") == "1\n2\n3"
    assert text("<article><p>cut off") == "cut off"
    assert text("<div><b>x</div>y</b>") == "x\ny"
    assert text("<article><p>" + "w " * 200_000 + "</p></article>") == "w " * 199_999 + "w"
    assert html_extract.page_blocks(None) == html_extract.page_blocks("") == html_extract.page_blocks("<p> </p>") == []
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert text(deep) == "x"


def test_site_templates_go(spark):
    box = "<div class=x1><p>Join us today</p><p>It is free</p></div>"
    rows = [(i, f"https://H.org/{i}", f"<body><div class=t><p>Text {i}</p><p>Shared words</p></div>{box}</body>") for i in range(6)]
    rows += [(10, "https://other.org/1", f"<body>{box}<p>Alone</p></body>"), (11, None, None), (12, "u", ""), (1, "https://H.org/1", rows[1][2]), (None, "https://h.org/n", rows[0][2])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, host string")
    got = sorted(((r["page_id"], r["text"]) for r in html_extract.extract_text(df).collect()), key=str)
    want = [(i, f"Text {i}\nShared words") for i in range(6)] + [(10, "Join us today\nIt is free\nAlone"), (11, ""), (12, ""), (1, "Text 1\nShared words"), (None, "Text 0\nShared words")]
    assert got == sorted(want, key=str)
    assert html_extract.extract_text(df.limit(0)).count() == 0


def _html_texts(spark, rows):
    got = html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r["page_id"]: r["text"] for r in got}


def test_copies_on_a_host_keep_their_text(spark):
    page = "<body><div id=page><div class=t><p>Whole</p></div><div class=u><p>article</p></div></div></body>"
    rows = [(i, f"https://h.org/{i}", page) for i in range(4)]  # a host of copies
    mixed = [(10 + i, f"https://m.org/{i}", f"<body><div class=w><p>Story {i // 3}</p></div><p>tail</p></body>") for i in range(6)]
    wrapped = [(20 + i, f"https://w.org/{i}", f"<body><div class=v><p>Same words</p></div><!-- {i} --></body>") for i in range(5)]
    got = _html_texts(spark, rows + mixed + wrapped)
    assert all(got[i] == "Whole\narticle" for i in range(4))
    assert all(got[10 + i] == f"Story {i // 3}\ntail" for i in range(6))
    assert all(got[20 + i] == "Same words" for i in range(5))


def test_templates_of_a_section_of_a_large_host_go(spark):
    box = "<div><p>Related</p><p>links</p></div>"
    rows = [(i, f"https://big.org/{i}", f"<body><p>Text {i}</p>{box if i < 60 else '<div>alone ' + str(i // 2) + '</div>'}</body>") for i in range(400)]
    got = _html_texts(spark, rows)
    assert all(got[i] == (f"Text {i}" if i < 60 else f"Text {i}\nalone {i // 2}") for i in range(400))


# --- op 4 ---


def test_licenses(spark):
    rows = [
        (1, "Released under the MIT License.", "a"),
        (2, "x\nreleased, under: THE mit\nlicense", "a"),  # four of five words in a block
        (3, "released under\nthe mit license", "a"),  # no block has four
        (4, "cc by cc by x\nAll Rights\nReserved", "a"),
        (5, None, "a"),
        (6, "", "a"),
        (7, "  \n ", "a"),
        (8, "all rights " * 50 + "reserved " + "long " * 100_000, "a"),
        (None, "GNU General Public License", "a"),
        (1, "nothing here", "b"),
        (9, "ÀÉ all rights reserved", "a"),
    ]
    got = license_scan.scan_licenses(clashing(documents(spark, rows))).collect()
    by = {(r["doc_id"], r["n_words"]): (r["places"], r["base_labels"], r["found_labels"], round(r["score"], 4)) for r in got}
    assert len(got) == len(rows)
    assert by[1, 5][1:] == ([], ["mit"], 1.0)
    assert by[2, 6][1:] == ([], ["mit"], 0.8)
    assert by[3, 5][1:] == ([], [], 0.0)
    assert by[4, 8][0] == ([0, 2], [], [5]) and by[4, 8][1] == ["cc-by", "reserved"] and by[4, 8][3] == 1.0
    assert by[5, 0] == by[6, 0] == by[7, 0] == (([], [], []), [], [], 0.0)
    assert by[8, 100_101][0][2] == [98]
    assert by[None, 4][0][1] == [1] and by[1, 2][2] == []
    assert by[9, 4][0][2] == [1]
    assert license_scan.scan_licenses(documents(spark, [])).count() == 0


BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"
MPL = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy"
MIT = "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated"
APACHE = "Copyright 2020 Somebody Else.  Licensed under the Apache\nLicense, Version 2.0 (the notice);"


def _commented(text, mark):
    return "\n".join(f"{mark} {x}" for x in ("", *text.split("\n"), ""))


def test_wrapped_licenses(spark):
    texts = [("bsd", BSD), ("mpl-2.0", MPL), ("mit", MIT), ("apache-2.0", APACHE)]
    rows = []
    for label, t in texts:
        words = t.split()
        forms = (t, t.replace("\n", "\n\n"), t.replace("\n", "\r\n"), "\n".join(words), prose(1, 40) + "\n" + t + "\n" + prose(2, 40))
        forms += (_commented(t, "#"), _commented(t, " *"), _commented(t, "//"))
        rows += [(len(rows) + i, f, label) for i, f in enumerate(forms)]
    # the words of the MIT line spread over two lines, farther apart than the line is long
    rows += [(90, "released " + prose(3, 9) + " under the\nword word word " + "license", ""), (91, "released under\nthe mit license", "mit"), (92, None, ""), (93, "\n\n", "")]
    got = {r["doc_id"]: (r["found_labels"], r["score"]) for r in license_scan.scan_licenses(documents(spark, rows), wrapped=True).collect()}
    assert len(got) == len(rows)
    for i, _, label in rows:
        assert got[i] == (([label], 1.0) if label else ([], 0.0)), rows[i]


# --- op 5 ---


def lags(slots_of, weight, total):
    """Largest distance of a source's blocks from its target, at every slot up
    to its end; no code of the operator."""
    from fractions import Fraction

    total = Fraction(str(total)) if isinstance(total, float) else total
    weight = {s: Fraction(str(w)) for s, w in weight.items()}
    if abs(sum(weight.values()) - total) < 1e-9:
        total = sum(weight.values())
    worst = 0
    for s, mine in slots_of.items():
        w = weight[s] / total
        for i, t in enumerate(sorted(mine)):
            worst = max(worst, abs(i - w * t), abs(i + 1 - w * (t + 1)))
    return worst


def test_mix_keeps_the_shares(spark):
    rows = [(i, "t", s) for s, n in (("hot", 900), ("b", 300), ("c", 120), ("d", 7)) for i in range(n)]
    rows += [(None, None, None), (5, "t", "b"), (5, "t", "b")]
    weights = {"hot": 0.2, "b": 0.5, "c": 0.25, "d": 0.05}
    docs = clashing(documents(spark, rows))
    placed = mixing.mix(docs, weights, block_rows=4).select("row.doc_id", "row.source", "block", "slot", "place", "release", "due").collect()
    assert len(placed) == len(rows)
    assert len({(p["slot"], p["place"]) for p in placed}) == len(rows)
    assert all(p["release"] <= p["slot"] < p["due"] for p in placed)
    target = weights | {None: 0.05}
    slots = {}
    for p in placed:
        slots.setdefault(p["source"], set()).add(p["slot"])
    assert lags(slots, target, sum(target.values())) < 1
    blocks = {}
    for p in placed:
        blocks.setdefault((p["source"], p["block"]), []).append(p["place"])
    assert all(sorted(v) == list(range(len(v))) for v in blocks.values())
    assert sum(len(v) < 4 for v in blocks.values()) <= 5  # the last block of each source
    assert mixing.mix(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"hot": 0.0})


@pytest.mark.parametrize("weights", [None, {"hot": 5.0, "s1": 1.0}])
def test_mix_with_larger_blocks(spark, weights):
    """Few slots: blocks grow, and the shares hold in the larger blocks."""
    rows = [(i, "t", "hot") for i in range(400)] + [(1000 + i, "t", f"s{i % 60}") for i in range(700)] + [(None, None, None), (5, "t", "s1"), (5, "t", "s1")]
    placed = mixing.mix(clashing(documents(spark, rows)), weights, block_rows=4, slots=100).select("row.doc_id", "row.source", "block", "slot", "place", "release", "due").collect()
    assert sorted(str((p["doc_id"], p["source"])) for p in placed) == sorted(str((i, s)) for i, _, s in rows)
    assert len({(p["slot"], p["place"]) for p in placed}) == len(rows) and max(p["place"] for p in placed) == 11
    slots = {}
    for p in placed:
        slots.setdefault(p["source"], set()).add(p["slot"])
    size = {s: sum(x == s for _, _, x in rows) for _, _, s in rows}
    target = {s: n**0.5 if weights is None else weights.get(s or "", 1.0) for s, n in size.items()}
    assert len(slots["hot"]) == 34 and lags(slots, target, sum(target.values())) < 1


@pytest.mark.parametrize("others, skew", [(20, 0), (200, 0), (1100, 0), (25_000, 0), (1100, 2), (25_000, 3)])
def test_schedule_meets_the_given_weights(others, skew):
    """One source at 0.9 and many that share the rest, equally or not."""
    r = random.Random(others)
    rest = [r.random() ** skew + 1e-9 for _ in range(others)]
    weight = {"hot": 0.9} | {f"s{i}": 0.1 * x / sum(rest) for i, x in enumerate(rest)}
    total = sum(weight.values())
    slots, taken = {}, set()
    for s, k, t, release, due in mixing.schedule([(s, w, 9000 if s == "hot" else 2) for s, w in weight.items()]):
        assert release <= t < due and t not in taken
        assert k == len(slots.setdefault(s, []))
        slots[s].append(t)
        taken.add(t)
    assert [len(slots[s]) for s in weight] == [9000] + [2] * others
    assert lags(slots, weight, total) < 1


def test_schedule_of_random_weights():
    r = random.Random(3)
    for _ in range(30):
        weight = {f"s{i}": r.random() ** 3 + 1e-3 for i in range(r.randint(1, 40))}
        slots = {}
        for s, _, t, _, _ in mixing.schedule([(s, w, r.randint(0, 60)) for s, w in weight.items()]):
            slots.setdefault(s, []).append(t)
        assert lags(slots, weight, sum(weight.values())) < 1
    assert list(mixing.schedule([])) == [] == list(mixing.schedule([("a", 1.0, 0)]))
    with pytest.raises(ValueError):
        list(mixing.schedule([("a", 1e300, 3), ("b", 1e-300, 3)]))


# --- op 6 ---


def _viterbi_brute(scores, step):
    import itertools

    value = lambda y: sum(scores[i][a] for i, a in enumerate(y)) + sum(step[a][b] for a, b in zip(y, y[1:]))
    return max(value(y) for y in itertools.product((0, 1), repeat=len(scores))), value


def test_viterbi_finds_the_best_labels():
    import numpy as np

    r = np.random.default_rng(5)
    sizes = [3, 0, 7, 1, 5, 0]
    first = np.concatenate([[0], np.cumsum(sizes)])
    scores, step = r.normal(size=(sum(sizes), 2)), r.normal(size=(2, 2))
    label = quality.viterbi(scores, step, first)
    for a, b in zip(first, first[1:]):
        if b > a:
            best, value = _viterbi_brute(scores[a:b], step)
            assert abs(value(label[a:b]) - best) < 1e-9


def test_field_gradient_is_the_likelihood_slope():
    import numpy as np

    r = np.random.default_rng(6)
    first = np.array([0, 4, 4, 9, 10])
    x, y = r.normal(size=(10, 3)), r.integers(0, 2, 10)
    w, step = r.normal(size=3), r.normal(size=(2, 2))
    _, gw, gs = quality._likelihood(x, y, first, w, step)
    for i in range(3):
        d = np.zeros(3)
        d[i] = 1e-5
        slope = (quality._likelihood(x, y, first, w + d, step)[0] - quality._likelihood(x, y, first, w - d, step)[0]) / 2e-5
        assert abs(slope - gw[i]) < 1e-4
    for i in range(2):
        for j in range(2):
            d = np.zeros((2, 2))
            d[i, j] = 1e-5
            slope = (quality._likelihood(x, y, first, w, step + d)[0] - quality._likelihood(x, y, first, w, step - d)[0]) / 2e-5
            assert abs(slope - gs[i, j]) < 1e-4


def test_line_labels_keep_half_of_a_document():
    import numpy as np

    sure = np.array([2.0, -1.0, -3.0, 1.0, -0.5, 4.0, 5.0])
    weight = np.array([10.0, 30.0, 60.0, 5.0, 5.0, 1.0, 1.0])
    first = np.array([0, 3, 3, 5, 7])
    # a good document mostly like junk keeps its surest half; one that fits is left; junk that all looks good too
    got = quality.line_labels(sure, weight, first, np.array([1, 0, 1, 0]))
    assert got.tolist() == [1, 1, 1, 1, 0, 0, 1]
    assert quality.line_labels(sure[:3], np.array([50.0, 30.0, 20.0]), first[:2], np.array([1])).tolist() == [1, 0, 0]


def test_field_sees_both_switches_from_document_labels():
    """Documents of 12 lines, of good quality with 3 boilerplate lines in a run,
    or junk with 3 content lines in a run: the true line labels come back."""
    import numpy as np

    r = np.random.default_rng(9)
    docs, truth, q = 80, [], np.arange(80) % 2
    for k in range(docs):
        y = np.full(12, q[k])
        at = r.integers(0, 10)
        y[at : at + 3] = 1 - q[k]
        truth.append(y)
    truth = np.concatenate(truth)
    x = np.stack([np.ones(len(truth)), truth * 2.0 - 1 + r.normal(size=len(truth)) * 0.6], axis=1)
    first = np.arange(docs + 1) * 12

    def decoded(field):
        return quality.viterbi(np.stack([np.zeros(len(x)), x @ np.array(field["w"])], axis=1), np.array(field["step"]), first)

    label = decoded(quality.learn(x, np.ones(len(x)), first, q))
    told = decoded(quality.fit_field(x, truth, first))  # as good as with the true labels of all lines
    assert (label == truth).mean() >= (told == truth).mean() - 0.005 > 0.95
    share = label.reshape(docs, 12).mean(axis=1)
    assert np.abs(share - truth.reshape(docs, 12).mean(axis=1)).max() <= 3 / 12 and ((share > 0) & (share < 1)).mean() > 0.9


def counts_brute(t):
    import collections

    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    tri = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] >= 2 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for x in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(hit))


TEXTS = [
    None, "", " ", "\n\n", "a", "a\na\n a\nA\n\n", "x y z x y z x", "é ü #*$%&|<> \u00a0 \u2003k", "a\r\nb\r\na\r\n", "one two three\none two three",
    "w " * 100_000, "q\x0bq\x0cq", "aaa bbb ccc ddd aaa bbb ccc", "\n".join(["same line here"] * 300), prose(1, 2000), "日本 語 " * 40,
]


def test_base_counts(spark):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(3, "repeat", "s"), (3, "repeat", "s"), (None, prose(2, 60), "s")]
    got = quality.judge(clashing(documents(spark, rows)), None).select("row.doc_id", "text", *quality.COUNTS, "base_failed", "kept").collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in got) == sorted(str(r[:2]) for r in rows)
    for r in got:
        want = counts_brute(r["text"])
        assert tuple(r[c] for c in quality.COUNTS) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r["kept"] == (not r["base_failed"])
    assert quality.judge(documents(spark, []), None).count() == 0
    assert quality.fit(documents(spark, rows), spark.createDataFrame([], "doc_id long, quality int, toxic int")) is None


# --- op 7 ---


@pytest.fixture(scope="module")
def code():
    with open(token_count.VOCABULARY, "rb") as f:
        return token_count.encoder(f.read())


def test_counts_under_edits_are_those_of_the_whole_text(code):
    count = lambda s: len(code.encode_ordinary(s))
    r = random.Random(9)
    letters = "ab'sll  \n\n\t 12é日.,\u00a0\u2003\x1c\x85"
    for trial in range(300):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 200)))
        places = sorted(r.randint(0, len(text)) for _ in range(2 * r.randint(0, 5)))
        edits = [(a, b, "".join(r.choice(letters) for _ in range(r.randint(0, 12)))) for a, b in zip(places[::2], places[1::2])]
        edits = [e for i, e in enumerate(edits) if not i or e[0] > edits[i - 1][1]]
        tree = token_count.SegmentTree.build(text, count, leaf=r.choice([1, 4, 16, 64]))
        assert tree.total == count(text) and tree.text() == text
        tree.edit(edits)
        want = text
        for a, b, new in reversed(edits):
            want = want[:a] + new + want[b:]
        assert tree.text() == want
        assert tree.total == count(want), (text, edits)
        again = token_count.SegmentTree(want, *tree.leaves(), count)  # the leaves serve further edits
        again.edit([(len(want) // 2, len(want), " x")])
        assert again.total == count(want[: len(want) // 2] + " x")


def test_edits_touch_few_leaves(code):
    text = prose(4, 20_000)
    tree = token_count.SegmentTree.build(text, lambda s: len(code.encode_ordinary(s)))
    tree.edit([(50_000, 50_010, "changed"), (90_000, 90_000, " new words ")])
    assert 0 < tree.encoded < 4 * token_count.LEAF
    with pytest.raises(ValueError):
        token_count.SegmentTree.build("abc", len).edit([(0, 2, ""), (1, 3, "")])


def test_token_counts(spark, code):
    rows = [(1, "mail a.b@c.example now or 10.1.2.3, call +1 555 123 4567.", "s"), (2, None, "s"), (3, "", "s"), (None, "x" * 30_000, "s"), (4, prose(8, 4000) + " me@x.org", "s"), (4, "again", "s"), (4, "again", "s")]
    trees = token_count.build_trees(clashing(documents(spark, rows)))
    got = token_count.apply_edits(trees, token_count.mask_personal).collect()
    assert len(got) == len(rows)
    for r in got:
        before = dict(((i, len(t or "")), t) for i, t, _ in rows)[r["row"]["doc_id"], r["row"]["n_chars"]] or ""
        assert r["n_tokens"] == len(code.encode_ordinary(before))
        assert r["n_tokens_edited"] == len(code.encode_ordinary(r["text"] or ""))
    assert {(r["row"]["doc_id"], r["n_edits"]) for r in got} == {(1, 3), (2, 0), (3, 0), (None, 0), (4, 1), (4, 0)}
    given = trees.withColumn("edits", F.expr("if(row.doc_id = 1, array(struct(0 as start, 4 as stop, 'post' as text)), null)"))
    by_column = token_count.apply_edits(given).where("n_edits > 0").collect()
    assert [r["text"] for r in by_column] == ["post" + rows[0][1][4:]]
    assert by_column[0]["n_tokens_edited"] == sum(by_column[0]["leaf_tokens"]) == len(code.encode_ordinary(by_column[0]["text"]))
    assert token_count.apply_edits(token_count.build_trees(documents(spark, [])), token_count.mask_personal).count() == 0


# --- op 8 ---


def test_warc_round_trip(spark):
    big = "<p>é</p>" + "x" * 2000
    nasty = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [
        (1, "http://a.org/x?y z", big), (2, "http://a.org/2", big), (3, None, big), (4, "http://a.org/4", "small"), (5, "http://b.org", "small"),
        (6, "u\r\nv", nasty), (7, "http://c.org/" + "p" * 3000, "WARC/1.1\r\n" * 300), (8, "http://d.org/", None), (9, "http://d.org/", ""),
        (None, "http://e.org/", big), (10, "http://f.org/", "same" * 400), (10, "http://f.org/", "same" * 400), (11, "http://g", "\x00\x01" + "\r\n\r\n" * 600),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, type string")
    caps = warc.round_trip(df).select("*", warc.page_id_of("metadata").alias("page_id"), warc.page_id_of("original_metadata").alias("to")).collect()
    assert len(caps) == len(rows)
    by = {}
    for c in caps:
        by.setdefault(c["page_id"], []).append(c)
    assert [c["type"] for c in by[3]] == ["response"] and bytes(by[3][0]["response"]["payload"]).decode() == big
    for i in (1, 2, None):
        (c,) = by[i]
        assert (c["type"], c["to"], c["response"]["payload"]) == ("revisit", 3, None)
        assert c["original"]["payload_bytes"] == len(big.encode()) and c["original"]["payload_digest"] == c["response"]["digest"]
    for i in (4, 5, 6, 7, 8, 9, 11):
        (c,) = by[i]
        html = dict((r[0], r[2]) for r in rows)[i] or ""
        assert c["type"] == "response" and bytes(c["response"]["payload"]).decode() == html
        assert c["response"]["digest"] == c["response"]["payload_digest"]
        assert c["request"]["concurrent_to"] == c["metadata"]["concurrent_to"] == c["record_id"]
    assert [c["type"] for c in by[10]] == ["response"] * 2
    assert bytes(by[1][0]["request"]["payload"]) == b""
    assert warc.round_trip(df.limit(0)).count() == 0


def test_archives_are_gzip_files_of_records(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.org/", "hello")], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    data = b"".join(zlib.decompress(f.read_bytes(), 31) for f in sorted((tmp_path / "w").glob("*.gz")))
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"\r\n\r\n") and data.count(b"WARC/1.1\r\n") == 3


# --- op 9 ---


def test_decontamination(spark):
    items = [(1, prose(1, 14)), (2, prose(2, 4)), (2, prose(2, 4)), (3, None), (4, ""), (5, "!!"), (None, prose(6, 12)), (7, "w"), (8, prose(1, 14).upper())]
    one, four = prose(1, 14).split(), prose(2, 4)
    rows = [
        (1, "start " + " ".join(one) + " end", "s"), (2, "start, " + "; ".join(one[2:12]).upper() + " end", "s"), (3, " ".join(one[2:11]), "s"),
        (4, f"x {four} y {four}", "s"), (5, None, "s"), (6, "", "s"), (7, "…", "s"), (8, " ".join(["long"] * 50_000 + one), "s"),
        (None, prose(6, 12), "s"), (9, "a w b", "s"), (9, "a w b", "s"), (10, prose(99, 300), "s"),
    ]
    docs, bench = clashing(documents(spark, rows)), spark.createDataFrame(items, "item_id long, text string")
    for windows in (500_000, 2):  # one block of windows, and many
        got = {(r["row"]["doc_id"], r["n_words"]): (r["n_hit"], r["items"]) for r in decontaminate.scan(docs, bench, block_windows=windows).collect()}
        assert got == {
            (1, 16): (14, ["1", "8"]), (2, 12): (10, ["1", "8"]), (3, 9): (0, []), (4, 10): (8, ["2"]), (5, 0): (0, []), (6, 0): (0, []), (7, 1): (0, []),
            (8, 50_014): (14, ["1", "8"]), (None, 12): (12, []), (9, 3): (1, ["7"]), (10, 300): (0, []),
        }
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 5, 6, 7, 10]
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, bench, "spans").collect()}
    assert cut[1] == "start  end" and cut[2] == "start,  end" and cut[4] == "x  y " and cut[3] == rows[2][1] and cut[5] is None
    assert decontaminate.scan(documents(spark, []), bench).count() == 0
    assert decontaminate.scan(docs, bench.limit(0)).where("n_hit > 0").count() == 0


# --- op 10 ---


def _shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_brute(rows, num, den):
    sets = [(i, _shingles(t)) for i, t, _ in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and den * len(a & b) >= num * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in root}


@pytest.mark.parametrize("num", [80, 85])
def test_near_duplicates(spark, num):
    r = random.Random(num)
    rows = []
    for g in range(12):
        base = prose(g, r.choice([4, 6, 30, 120, 400])).split()
        for v in range(r.choice([1, 2, 5, 30])):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 40))):
                w[r.randrange(len(w))] = f"e{g}{v}{r.random():.3f}"
            rows.append((r.randrange(10**6), " ".join(w).title() if v % 2 else " ".join(w), "s"))
        # a chain: each differs a little from the one before
        for v in range(6):
            base = base[: len(base) * 97 // 100] + [f"c{g}{v}"]
            rows.append((r.randrange(10**6), "  ".join(base), "s"))
    rows += [(1, None, "s"), (2, "", "s"), (3, " \n", "s"), (4, "one two", "s"), (5, "ONE  two", "s"), (None, "one two", "s"), (None, None, "s"), (6, "one two", "s"), (6, "one two", "s")]
    rows += [(7, "k " * 50_000, "s"), (8, "K " * 30_000, "s")]
    got = near_dup.near_duplicates(clashing(documents(spark, rows)).drop("id"), num=num).collect()
    assert len(got) == len(rows)
    want = near_brute(rows, num, 100)
    sizes = {}
    for i, t, _ in rows:
        sizes.setdefault(i, set()).add(len(_shingles(t)))
    for x in got:
        assert x["component"] == want.get(x["id"]) and x["n"] in sizes[x["id"]]
    assert near_dup.near_duplicates(documents(spark, [])).count() == 0


def test_full_search_in_blocks(spark, monkeypatch):
    """A hot group whose members link with some of the others only."""
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    r = random.Random(4)
    base = prose(77, 200).split()
    rows = []
    for v in range(90):
        w = list(base)
        for _ in range(r.randint(0, 14)):
            w[r.randrange(len(w))] = f"e{v}{r.random():.3f}"
        rows.append((v * 13 % 997, " ".join(w), "s"))
    want = near_brute(rows, 85, 100)
    assert 5 < len(set(want.values())) < 85
    got = near_dup.near_duplicates(documents(spark, rows), num=85)
    assert {x["id"]: x["component"] for x in got.collect()} == want


def test_sequential_test_bounds():
    least = near_dup.least_matches(0.85, 128, 32, 1e-6)
    assert least == sorted(least) and 0 < least[0] < 32 * 0.85 and 70 < least[-1] < 128 * 0.85


# --- pipeline ---


def test_pipeline_stages_take_any_columns(spark, tmp_path):
    rows = [(i, prose(i, 80) + "\n" + prose(1000 + i, 60), f"s{i % 4}") for i in range(12)]
    rows += [(20, rows[0][1], "s1"), (21, rows[0][1] + " tail", "s2"), (22, "short", "s1"), (23, None, "s0"), (None, prose(50, 90), None), (24, prose(51, 70) + " " + prose(900, 12), "s0")]
    docs = clashing(documents(spark, rows)).drop("id")
    spark.createDataFrame([(900, prose(900, 12))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(p := str(tmp_path / f"{_}.parquet".replace(" ", "-")))
        docs = spark.read.parquet(p)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in last} == {*range(12), None}
    empty = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_texts_that_share_an_id_stay(spark):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(1, a, "s1"), (5, a + " tail", "s2"), (5, b, "s3"), (5, b, "s3"), (6, b + " tail", "s1"), (7, c, "s2"), (7, c, "s1"), (None, a, "s1"), (8, None, "s1"), (8, "", "s1"), (9, c + " end", "s1")]
    got = [sorted(map(str, map(tuple, corpus_pipeline.dedup_documents(spark, documents(spark, rows).repartition(n), "").collect()))) for n in (1, 7)]
    texts = sorted(str(x[:2]) for x in map(eval, got[0]))
    assert texts == sorted(str(x) for x in [(1, a), (5, b), (7, c), (None, a), (8, None), (8, "")])
    assert got[0] == got[1]


@pytest.mark.parametrize("n", [2000, 8000])
def test_a_hot_band_is_spread_in_proportion(spark, n):
    """Near copies and 20 outsiders in one band: a row for each member and one
    for each outsider and block."""
    rows = [(i, 7, 0, 0 if i < n else i, 200) for i in range(n + 20)]
    labelled = spark.createDataFrame(rows, "id long, key long, band int, comp long, n long")
    bands = near_dup.open_bands(labelled)
    (band,) = bands.collect()
    assert (band["major"], band["outer"]) == (0, 1) and band["blocks"] == -(-(n + 20) // near_dup.BLOCK)
    spread = near_dup.spread_members(labelled, bands)
    assert spread.count() == n + 20 + 20 * band["blocks"]
    one = spark.createDataFrame([(i, 7, 0, 0, 200) for i in range(50)], "id long, key long, band int, comp long, n long")
    assert near_dup.open_bands(one).count() == 0


def test_outsiders_of_a_hot_band_are_found(spark, monkeypatch):
    """Chains that leave the largest component are linked across blocks."""
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    base = prose(9, 60).split()
    texts = [" ".join([*base[:-1], f"end{i}"]) for i in range(120)]
    texts += [" ".join([*base[:k], f"mid{k}", *base[k + 1 :]]) for k in range(5, 55, 3)]
    texts += [" ".join([f"x{j}" if i % 13 == j % 13 else w for i, w in enumerate(base)]) for j in range(12)]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    got = {r["id"]: r["component"] for r in near_dup.near_duplicates(documents(spark, rows)).collect()}
    assert got == near_brute(rows, 80, 100)
