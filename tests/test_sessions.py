import random
from collections import defaultdict

import pytest

from hitscope.operators.sessions import SESSION_COLUMNS, session_rollup, sessionize

from .helpers import hits, rows_of

COLS = ["event_id", *SESSION_COLUMNS]


def brute_force(rows, gap):
    """The original SQL, row by row: per host in (time, id) order."""
    by_host = defaultdict(list)
    for h, sec, url, i in rows:
        by_host[h].append((sec, i, url))
    out = []
    for h, hs in by_host.items():
        hs.sort(key=lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, x[1]))
        prev = None
        n = 0
        first = None
        count = 0
        for k, (sec, i, url) in enumerate(hs):
            td = None if k == 0 or sec is None or prev is None else sec - prev
            flag = 1 if td is not None and td >= gap else 0
            n += flag
            if k == 0 or flag:
                first, count = url, 0
            count += url is not None
            out.append((i, td, flag, None if h is None else f"{h}_{n}", first, url, count))
            prev = sec
    return sorted(out)


@pytest.mark.parametrize("strategy", ["window", "chunked"])
def test_gap_edges(spark, strategy):
    rows = [("a", 0, "/1", 1), ("a", 1799, "/2", 2), ("a", 3599, "/3", 3), ("a", 5400, "/4", 4)]
    got = rows_of(sessionize(hits(spark, rows), 1800, tie_break="event_id", strategy=strategy), COLS)
    assert got == [
        (1, None, 0, "a_0", "/1", "/1", 1),
        (2, 1799, 0, "a_0", "/1", "/2", 2),
        (3, 1800, 1, "a_1", "/3", "/3", 1),
        (4, 1801, 1, "a_2", "/4", "/4", 1),
    ]


@pytest.mark.parametrize("strategy", ["window", "chunked"])
def test_matches_brute_force(spark, strategy):
    rnd = random.Random(11)
    rows = []
    i = 0
    for h in ["hot", "b", "c", "d"]:
        t = rnd.randrange(0, 3600)
        n = 1500 if h == "hot" else 40
        for _ in range(n):
            t += rnd.choice([0, 1, 5, 60, 600, 1799, 1800, 1801, 3000, 7200, 30000])
            i += 1
            rows.append((h, t, f"/p{rnd.randrange(6)}", i))
    rows.append(("b", None, "/nil", 0))
    for gap in (1800, 21600):
        df = sessionize(hits(spark, rows), gap, tie_break="event_id", strategy=strategy, chunk_seconds=900)
        assert rows_of(df, COLS) == brute_force(rows, gap)


def test_strategies_agree_without_tie_break(spark):
    # Equal times are peers (RANGE frames): they share the session number and
    # the running count; which peer is "last" is not defined, so it is not compared.
    rows = [("a", 0, "/1", 1), ("a", 0, "/2", 2), ("a", 10, "/3", 3), ("a", 4000, "/4", 4),
            ("a", 4000, "/5", 5), ("b", 7, "/x", 6)]
    cols = ["event_id", "session_id", "page_count", "is_new_session"]
    w = rows_of(sessionize(hits(spark, rows), 1800, strategy="window"), cols)
    c = rows_of(sessionize(hits(spark, rows), 1800, strategy="chunked"), cols)
    assert w == c
    assert [r[2] for r in w][:2] == [2, 2]


def test_rollup_totals_sit_on_last_hit(spark):
    rows = [("a", 0, "/1", 1), ("a", 100, "/2", 2), ("a", 200, "/3", 3), ("a", 9000, "/4", 4)]
    s = sessionize(hits(spark, rows), 1800, tie_break="event_id")
    r = {x["session_id"]: x for x in session_rollup(s, tie_break="event_id").collect()}
    assert r["a_0"]["hits"] == 3 and r["a_0"]["duration"] == 200
    assert r["a_0"]["entry_page"] == "/1" and r["a_0"]["exit_page"] == "/3"
    assert r["a_1"]["hits"] == 1 and r["a_1"]["duration"] is None


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_python_and_bounded_shuffles(spark):
    rows = [("a", i * 100, "/x", i) for i in range(50)]
    w = sessionize(hits(spark, rows), 1800, tie_break="event_id", strategy="window")
    c = sessionize(hits(spark, rows), 1800, tie_break="event_id", strategy="chunked")
    for df in (w, c):
        p = _plan(df)
        assert "Python" not in p and "ArrowEval" not in p
    assert _plan(w).count("Exchange hashpartitioning") == 1
    # hits once by (key, chunk); summaries: partial aggregate, carry window, join
    assert _plan(c).count("Exchange hashpartitioning") <= 4


def test_hits_without_time_spread_over_chunks(spark):
    # one host whose times do not parse for many hits, plus timed hits: same
    # rows as the brute force, with the untimed hits split into several chunks
    rows = [("hot", None, f"/n{i % 3}", i * 40000) for i in range(12)]
    rows += [("hot", 100 + 50 * i, f"/t{i}", 10**7 + i) for i in range(5)] + [("x", 5, "/x", 1)]
    df = sessionize(hits(spark, rows), 1800, tie_break="event_id", strategy="chunked")
    assert rows_of(df, COLS) == brute_force(rows, 1800)


@pytest.mark.parametrize("strategy", ["window", "chunked"])
def test_missing_hosts_and_urls(spark, strategy):
    rows = [("a", 0, "/1", 1), ("a", 700, None, 2), ("a", 1400, "/3", 3), (None, 0, "/n", 4), (None, 700, "/m", 5), (None, 5000, None, 6), ("", 3, "/e", 7)]
    df = sessionize(hits(spark, rows), 1800, tie_break="event_id", strategy=strategy)
    assert rows_of(df, COLS) == brute_force(rows, 1800)
