"""Insights after some days of the log have changed: equal to a full run, and
only the days around the change are read."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from hitscope import schemas
from hitscope.operators import insights
from hitscope.operators.sessions import sessionize
from hitscope.plans import refresh as R
from hitscope.plans.jobs import materialize
from hitscope.sinks import tables

from .test_incremental import DAY, _frame, _random_hits

LOOKBACK, K = 3, 4


def _refresh(spark, log, store, gap=1800):
    return R.refresh(spark, log, store, LOOKBACK, K, K, gap=gap, tie_break="event_id")


def _text(df):
    return sorted(str(r.asDict()) for r in df.collect())


def _stored(spark, store):
    read = lambda t: _text(tables.read_published(spark, store, t).select(*COLUMNS[t]))
    return {t: read(t) for t in COLUMNS}


COLUMNS = {
    "daily_insights": schemas.DAILY_INSIGHTS_FIELDS,
    "page_insights": schemas.PAGE_INSIGHTS_FIELDS,
    "country_insights": schemas.COUNTRY_INSIGHTS_FIELDS,
}


def _full(spark, log, gap=1800):
    s = sessionize(spark.read.parquet(log), gap=gap, tie_break="event_id").cache()
    return {
        "daily_insights": _text(insights.daily_insights_all_days(s, lookback_days=LOOKBACK, tie_break="event_id")),
        "page_insights": _text(insights.page_insights_by_day(s, K, K, tie_break="event_id")),
        "country_insights": _text(insights.country_insights_by_day(s)),
    }


def _put(spark, log, rows):
    tables.write_partitioned(_frame(spark, rows), log)


def _damage(log, days):
    """Same names, lengths and times, but rows that no longer can be read."""
    for d in days:
        for f in glob.glob(f"{log}/year=2024/month=1/day={d}/*.parquet"):
            st = os.stat(f)
            with open(f, "r+b") as out:
                out.seek(-8, os.SEEK_END)
                footer = int.from_bytes(out.read(4), "little") + 8
                out.seek(4)
                out.write(b"\xff" * (st.st_size - footer - 4))
            os.utime(f, ns=(st.st_atime_ns, st.st_mtime_ns))
            crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
            if os.path.exists(crc):
                os.remove(crc)


# 1800: a day of reach; 100000: two days, so sessions run through whole days
@pytest.mark.parametrize("gap, reach", [(1800, 1), (100_000, 2)])
def test_refresh_equals_a_full_run(spark, tmp_out, gap, reach):
    log, store = os.path.join(tmp_out, "log"), os.path.join(tmp_out, "store")
    rows = _random_hits(gap, days=9)
    on = lambda d: [r for r in rows if r[1] is not None and r[1] // DAY == d]
    _put(spark, log, [r for r in rows if r not in on(4)[::2]])
    first = _refresh(spark, log, store, gap)
    assert first["changed"] == [f"2024-01-0{d}" for d in range(1, 10)]
    assert _stored(spark, store) == _full(spark, log, gap)
    _put(spark, log, on(4))  # the fifth of January is whole now
    want = _full(spark, log, gap)
    reads = range(5 - reach, 6 + reach)
    _damage(log, [d for d in range(1, 10) if d not in reads])
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(log).agg(F.max("request_url")).collect()
    done = _refresh(spark, log, store, gap)
    assert done["changed"] == ["2024-01-05"]
    assert done["read"] == [f"2024-01-0{d}" for d in reads]
    assert done["sessions"] == [f"2024-01-0{d}" for d in range(5, 6 + reach)]
    assert done["daily"] == [f"2024-01-0{d}" for d in range(5, 6 + LOOKBACK)]
    assert _stored(spark, store) == want
    assert _refresh(spark, log, store, gap)["changed"] == []


def test_days_that_come_and_go(spark, tmp_out):
    log, store = os.path.join(tmp_out, "log"), os.path.join(tmp_out, "store")
    rows = _random_hits(11, days=6)
    on = lambda d: [r for r in rows if r[1] is not None and r[1] // DAY == d]
    _put(spark, log, on(0) + on(1) + on(2) + on(4) + [r for r in rows if r[1] is None])
    _refresh(spark, log, store)
    assert _stored(spark, store) == _full(spark, log)
    tables.drop_partitions(spark, f"{log}/year=2024/month=1", "day", ["2"])
    _put(spark, log, on(3) + on(5))
    done = _refresh(spark, log, store)
    assert done["changed"] == ["2024-01-02", "2024-01-04", "2024-01-06"]
    assert "2024-01-01" not in done["sessions"]
    assert _stored(spark, store) == _full(spark, log)
    # a refresh that did not finish is done again
    _put(spark, log, on(0)[:5])
    os.remove(f"{store}/seen/_SUCCESS")
    assert len(_refresh(spark, log, store)["changed"]) == 5
    assert _stored(spark, store) == _full(spark, log)


def test_days_around():
    assert R.around(["2024-03-01"], 1, 2) == {"2024-02-29", "2024-03-01", "2024-03-02", "2024-03-03"}
    assert R.changed_days({"a": (1, 2), "b": (1, 1)}, {"b": (1, 1), "c": (3, 3)}) == ["a", "c"]
    assert R.changed_days({}, {}) == []


def test_the_store_reads_only_the_lookback(spark, tmp_out):
    log, store = os.path.join(tmp_out, "log"), os.path.join(tmp_out, "store")
    _put(spark, log, _random_hits(5, days=9))
    _refresh(spark, log, store)
    out = R.session_days(spark, store, R.around(["2024-01-08"], LOOKBACK, 0))
    scan = out._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.selectedPartitions().partitionCount() == LOOKBACK + 1
    assert out.select(F.min("insight_date").cast("string")).first()[0] == "2024-01-05"


def test_a_refresh_hands_over_pages_of_sessions_and_no_hits(spark, tmp_out, monkeypatch):
    log, store = os.path.join(tmp_out, "log"), os.path.join(tmp_out, "store")
    # 3 hosts, 400 hits on 2 pages, in one long session a day
    _put(spark, log, [(f"h{i % 3}", 1000 + i * 60, f"/{i % 2}", i) for i in range(400)])
    handed = {}

    def kept(df, name="stage"):
        out = materialize(df, name)
        handed[name] = out.count()
        return out

    monkeypatch.setattr(R, "materialize", kept)
    _refresh(spark, log, store)
    assert _stored(spark, store) == _full(spark, log)
    assert handed and max(handed.values()) <= 3 * 2  # a row for each page of a session-day
