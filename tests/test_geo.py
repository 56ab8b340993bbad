import random

import pytest
from pyspark.sql import functions as F

from hitscope.operators import geo
from hitscope.sources.access_log import typed_ip_ranges

from .helpers import ranges


def _hits(spark, hosts):
    return spark.createDataFrame([(h, i) for i, h in enumerate(hosts)], "host string, event_id long")


TAG = {"map": geo.tag_country, "direct": geo.tag_country_direct}


def _tag(spark, hosts, rng, form):
    out = TAG[form](_hits(spark, hosts), rng)
    return sorted(((r["event_id"], r["host"], r["country"]) for r in out.collect()), key=str)


RANGES = [
    (16909056, 16909311, "AU", "Australia"),  # 1.2.3.0 - 1.2.3.255
    (16909060, 16909060, "au", "Australia"),  # 1.2.3.4 again: same country, overlapping
    (16909060, 16909070, "xx", "Korea, Republic of"),  # 1.2.3.4 - 1.2.3.14: another country
    (0, 16777215, "zz", "Zero"),  # spans 256 buckets
    (None, 5, "bad", "Bad bounds"),
]
HOSTS = ["1.2.3.4", "1.2.3.20", "1.2.3.4", "9.9.9.9", "0.1.0.1", "a.b.au", "A.com", "localhost", "...",
         "x.example.com", "a.b.", "999.1.1.1", None, "host.xx"]


@pytest.mark.parametrize("form", sorted(TAG))
def test_tag_country_semantics(spark, form):
    got = _tag(spark, HOSTS, ranges(spark, RANGES), form)
    by_id = {}
    for i, h, c in got:
        by_id.setdefault(i, []).append(c)
    # overlapping ranges: one row per distinct country (Australia twice -> once)
    assert sorted(by_id[0]) == ["Australia", "Korea, Republic of"]
    assert by_id[1] == ["Australia"]
    assert by_id[3] == [None]  # IP in no range
    assert by_id[4] == ["Zero"]
    assert by_id[5] == ["Australia"]  # suffix, code lower-cased
    assert by_id[6] == [None]  # upper case: neither pattern
    assert by_id[7] == [None]  # no dot
    assert by_id[8] == ["NA"]  # dots only: no suffix
    assert by_id[9] == ["NA"]  # unknown suffix
    assert by_id[10] == ["NA"]  # suffix "b" unknown
    assert by_id[11] == [None]
    assert by_id[12] == [None]
    assert by_id[13] == ["Korea, Republic of"]
    assert len(got) == len(HOSTS) + 2  # 1.2.3.4 is listed twice, two countries each


def test_forms_agree_on_random_ranges(spark):
    rnd = random.Random(5)
    rs = []
    for k in range(150):
        b = rnd.randrange(0, 2**32 - 2**20)
        rs.append((b, b + rnd.choice([0, 255, 65535, 70000, 2**20]), "c" + chr(97 + k % 20), f"Country {k % 37}"))
    hosts = []
    for _ in range(400):
        r = rnd.choice(rs)
        n = rnd.randrange(r[0], r[1] + 1) if rnd.random() < 0.8 else rnd.randrange(0, 2**32)
        hosts.append(".".join(str((n >> s) & 255) for s in (24, 16, 8, 0)))
    hosts += [f"h{k}.example.c" + chr(97 + k % 26) for k in range(100)]
    rng = ranges(spark, rs)
    a = _tag(spark, hosts, rng, "map")
    b = _tag(spark, hosts, rng, "direct")
    assert a == b
    # brute force
    expect = []
    for i, h in enumerate(hosts):
        if h[0].isdigit():
            n = sum(int(p) << s for p, s in zip(h.split("."), (24, 16, 8, 0)))
            cs = sorted({r[3] for r in rs if r[0] <= n <= r[1]}) or [None]
        else:
            code = h.rsplit(".", 1)[1]
            cs = sorted({r[3] for r in rs if r[2] == code}) or ["NA"]
        expect += [(i, h, c) for c in cs]
    assert sorted(a, key=str) == sorted(expect, key=str)


def test_ip_range_join_forms(spark):
    rng = typed_ip_ranges(ranges(spark, RANGES))
    ips = geo.numeric_hosts(geo.distinct_hosts(_hits(spark, HOSTS)))
    rows = lambda df: sorted((r["host"], r["country"]) for r in df.collect())
    raw = rows(geo.ip_range_country_bucketed(ips, rng, typed=True))
    assert raw.count(("1.2.3.4", "Australia")) == 2  # the raw range join: one row per range
    assert rows(geo.ip_range_country(ips, rng, typed=True)) == sorted(set(raw))
    s = {r["host"]: r["country"] for r in geo.ip_range_country(ips, rng, overlap="smallest", typed=True).collect()}
    assert s["1.2.3.4"] == "Australia"  # the single-address range is narrowest


@pytest.mark.parametrize("form", sorted(TAG))
def test_missing_names(spark, form):
    rng = ranges(spark, [(16909060, 16909061, None, None), (16909060, 16909060, "au", "Australia"), (1, 2, "qq", None), (3, 4, "qq", "NA")])
    got = _tag(spark, ["1.2.3.4", "1.2.3.5", "a.qq", "a.au"], rng, form)
    assert sorted(got, key=str) == sorted(
        [(0, "1.2.3.4", None), (0, "1.2.3.4", "Australia"), (1, "1.2.3.5", None), (2, "a.qq", "NA"), (3, "a.au", "Australia")], key=str
    )


@pytest.mark.parametrize("form", sorted(TAG))
def test_bounds_outside_the_address_space(spark, form):
    rng = ranges(spark, [(0, 2**62, "aa", "All"), (-5, 10, "bb", "Low"), (2**40, 2**41, "cc", "Beyond"), (9, 3, "dd", "Turned")])
    got = _tag(spark, ["0.0.0.4", "255.255.255.255", "999.999.999.999"], rng, form)
    assert sorted(got, key=str) == sorted(
        [(0, "0.0.0.4", "All"), (0, "0.0.0.4", "Low"), (1, "255.255.255.255", "All"), (2, "999.999.999.999", None)], key=str
    )


def test_dense_bucket_is_cut_again(spark):
    rng = spark.range(50_000).selectExpr(
        "'' begin_ip", "'' end_ip", "string(16777216 + id) begin_ip_int", "string(16777216 + id) end_ip_int", "'aa' country_code", "concat('C', id % 7) country"
    )
    spans = geo.range_spans(rng)
    assert spans.groupBy("bucket", "sub").count().agg(F.max("count")).first()[0] <= 256
    hosts = [f"1.0.{i // 256}.{i % 256}" for i in (0, 1, 4000, 49_999, 50_000)]
    got = {h: c for _, h, c in _tag(spark, hosts, rng, "map")}
    assert got == {h: (f"C{i % 7}" if i < 50_000 else None) for h, i in zip(hosts, (0, 1, 4000, 49_999, 50_000))}
    assert _tag(spark, hosts, rng, "direct") == _tag(spark, hosts, rng, "map")


def test_no_jobs_and_no_broadcast_hints_before_the_action(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy-geo", "")
    out = geo.tag_country(_hits(spark, HOSTS), ranges(spark, RANGES))
    assert not tracker.getJobIdsForGroup("lazy-geo")
    assert "ResolvedHint" not in out._jdf.queryExecution().optimizedPlan().toString()
    spark.sparkContext.setJobGroup("", "")


def test_ambiguous_hosts(spark):
    m = geo.host_country_map(_hits(spark, HOSTS), ranges(spark, RANGES))
    amb = {r["host"] for r in geo.ambiguous_hosts(m).collect()}
    assert amb == {"1.2.3.4"}
    assert m.where(F.col("host") == "9.9.9.9").count() == 0


def _brute_narrowest(rs, n):
    """The country of the narrowest range that holds ``n``; None first among equals."""
    best = min(((e - b, c is not None, c or "") for b, e, _, c in rs if b <= n <= e), default=None)
    return "none" if best is None else best[2] if best[1] else None


def test_narrowest_range_by_the_sweep(spark):
    """Nested, crossing, touching, equal and bucket-crossing ranges, NULL names."""
    rnd = random.Random(8)
    base = 5 << 24
    rs = [(base, base + 300_000, "aa", "Wide"), (base + 10, base + 10, "bb", None), (base + 10, base + 10, "cc", "Point")]
    for k in range(700):  # one dense bucket with deep overlaps
        b = base + rnd.randrange(0, 60_000)
        rs.append((b, b + rnd.choice([0, 1, 7, 200, 3000, 5000]), "cd", rnd.choice([None, *(f"C{k % 13}" for _ in range(5))])))
    for k in range(60):
        b = base + rnd.randrange(0, 2**20)
        rs.append((b, b + rnd.choice([65535, 65536, 200_000]), "ef", f"D{k % 7}"))
    ips = sorted({base + rnd.randrange(0, 2**20) for _ in range(500)} | {x for r in rs[:40] for x in (r[0], r[1], r[1] + 1)})
    hosts = [".".join(str((n >> s) & 255) for s in (24, 16, 8, 0)) for n in ips]
    frame = geo.numeric_hosts(spark.createDataFrame([(h,) for h in hosts], "host string"))
    out = geo.ip_range_country(frame, ranges(spark, rs), overlap="smallest")
    got = {r["host"]: r["country"] for r in out.collect()}
    assert out.count() == len(got)
    assert {h: got.get(h, "none") for h in hosts} == {h: _brute_narrowest(rs, n) for h, n in zip(hosts, ips)}
    spans = geo.narrowest_spans(ranges(spark, rs)).where("sub = -1 or span_begin >> 8 = sub").select("span_begin", "span_end").distinct().collect()
    spans = sorted(map(tuple, spans))
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # disjoint


def test_spans_are_computed_once(spark):
    """The host map asks the spans in one join, the narrowest owner in another."""
    hits = _hits(spark, HOSTS)
    plan = geo.tag_country(hits, ranges(spark, RANGES))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("shiftright(begin_ip_int") == geo.range_spans(ranges(spark, RANGES))._jdf.queryExecution().optimizedPlan().toString().count("shiftright(begin_ip_int")
