"""Bench: run the headline queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and print one JSON line.

Every query is executed in full with Spark's ``noop`` sink (all rows are
produced, nothing is collected to the driver).  Two queries run
first on the smallest tables so JVM warm-up is not billed to the first
measured query.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hitscope.config import local_session  # noqa: E402
from hitscope.plans.queries import queries  # noqa: E402

HEADLINE = [
    "route_counts",  # C1
    "country_tagged_hits",  # C2, distinct hosts, spans, host map
    "country_tagged_hits_shuffle",  # C2 and C3, the enriched log
    "ip_range_country",  # J1, spans
    "ip_range_country_bucketed",  # J1, a row per range
    "session_hits_30m",  # C5, gap 1,800 s
    "session_hits_30m_window",  # C5, gap 1,800 s, direct window plan
    "session_hits_30m_chunked",  # C5, gap 1,800 s, the same plan by name
    "session_hits_6h",  # C5, gap 21,600 s
    "daily_insights",  # C6 (+ C9), all days
    "page_insights",  # C7
    "country_insights",  # C8
    "site_insights",  # C10
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="hitscope-bench")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hitscope-bench-"))
    qs = queries()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):  # JVM warm-up (class loading, code generation) on the smallest tables
        for name in ("country_tagged_hits", "daily_insights"):
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
