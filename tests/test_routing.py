import pytest

from hitscope.operators.routing import PLAIN_HOSTS, route_counts, route_logs, routed_output
from hitscope.sources.access_log import parse_access_log_lines, read_access_log

from .helpers import raw_log

GOOD = ("h.a.com", "-", "-", "[01/Jul/1995:00:00:01", "-0400]", "GET /a.html HTTP/1.0", "200", "10")


def test_quarantine_samples(spark, tmp_out):
    # The three malformed shapes of the original null-records sample: no
    # time (columns shift left by two), no request, a truncated line.
    lines = [
        'ppp-mia-30.shadow.net - - "GET / HTTP/1.0" 200 7074',
        "ppp-mia-30.shadow.net - - [01/Jul/1995:00:00:43 -0400] 200 669",
        "alyssa.p",
        'ok.host.com - - [01/Jul/1995:00:00:43 -0400] "GET / HTTP/1.0" 200 669 extra',
    ]
    path = f"{tmp_out}/log.txt"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    raw = read_access_log(spark, path)
    r = route_logs(raw, PLAIN_HOSTS)
    assert r["null"].count() == 3
    assert r["page"].count() == 1
    filled = sorted(sum(v is not None for v in row) for row in raw.collect())
    assert filled == [1, 6, 7, 8]
    same = parse_access_log_lines(spark.read.text(path))
    assert sorted(map(tuple, same.collect()), key=str) == sorted(map(tuple, raw.collect()), key=str)


def test_rejected_sample_three_spaces(spark):
    row = ("mizzou-ts3-03.missouri.edu", "-", "-", "[01/Jul/1995:03:05:40", "-0400]",
           "GET /shuttle/missions/sts-67/images/images.html   HTTP/1.0", "200", "4464")
    r = route_logs(raw_log(spark, [row]), PLAIN_HOSTS)
    out = routed_output(r["rejected"]).collect()
    assert len(out) == 1
    assert out[0]["raw_timestamp"] == "01/Jul/1995:03:05:40"


def test_null_and_kept_overlap(spark):
    # A missing hyphen or zone quarantines the row but does not stop it being
    # kept (the quarantine tests 8 fields, the keep filter 5).
    no_zone = GOOD[:4] + (None,) + GOOD[5:]
    r = route_logs(raw_log(spark, [GOOD, no_zone]), PLAIN_HOSTS)
    assert r["null"].count() == 1
    assert r["kept"].count() == 2
    assert route_logs(raw_log(spark, [GOOD, no_zone]), PLAIN_HOSTS, strict=True)["kept"].count() == 1


def test_routes_partition_valid_hits(spark):
    reqs = ["GET /a.html HTTP/1.0", "GET /b.gif HTTP/1.0", "GET /x?a=1 HTTP/1.0", "GET ",
            "GET  HTTP/1.0", "GET /x.txt HTTP/1.0", "GET /" + "ab/" * 5000 + " HTTP/1.0"]
    rows = [GOOD[:5] + (q,) + GOOD[6:] for q in reqs]
    r = route_logs(raw_log(spark, rows), PLAIN_HOSTS)
    assert r["rejected"].count() == 1
    assert r["page"].count() == 2
    assert r["non_page"].count() == 4
    counts = {x["route"]: x["hits"] for x in route_counts(raw_log(spark, rows)).collect()}
    assert counts == {"null": 0, "kept": 7, "rejected": 1, "page": 2, "non_page": 4}


def test_pseudonymised_routes(spark):
    key = "AAECAwQFBgcICQoLDA0ODw=="
    r = route_logs(raw_log(spark, [GOOD]), pseudonym_key=key)
    row = r["page"].first()
    assert row["encrypted_host"] != row["host"] and len(row["encrypted_host"]) == 24


def test_a_key_is_required(spark):
    for key in (None, ""):
        with pytest.raises(ValueError):
            route_logs(raw_log(spark, [GOOD]), key)
