"""Composite jobs: read -> route -> tag -> time columns -> sessions.

Each function returns lazy DataFrames; only sinks act.  These are the
user-level entry points that replace the three original batch programs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from hitscope.config import scratch_path
from hitscope.functions import patterns as P
from hitscope.operators.geo import tag_country
from hitscope.operators.routing import route_logs
from hitscope.operators.sessions import sessionize
from hitscope.operators.timecols import enriched_hits


def preprocess(
    raw: DataFrame,
    ranges: DataFrame,
    pseudonym_key: str,
    overlap: str = "all",
    keep: list[str] | None = None,
    use_offset: bool = False,
) -> dict[str, DataFrame]:
    """C1 + C2 + C3: routed hit streams and the enriched (country-tagged,
    timed) page hits.  ``keep`` lists extra input columns to carry along,
    such as an ordering tie-break.  ``pseudonym_key`` is required (see
    :data:`hitscope.operators.routing.PLAIN_HOSTS`)."""
    routes = route_logs(raw, pseudonym_key)
    tagged = tag_country(routes["page"], ranges, overlap=overlap)
    routes["enriched"] = enriched_hits(tagged, keep=keep, use_offset=use_offset)
    return routes


def build_sessions(
    enriched: DataFrame,
    gap: int = P.SESSION_GAP_SECONDS,
    tie_break: str | None = None,
    strategy: str = "chunked",
) -> DataFrame:
    """C5 over the enriched log."""
    return sessionize(enriched, gap=gap, tie_break=tie_break, strategy=strategy)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Hand an intermediate to the next stage through a table, as the
    original jobs did: Parquet in a new folder under the session's shared
    checkpoint folder, read back.  Lineage is cut (a lost executor never
    recomputes the upstream), and every later reader gets column pruning
    and filter pushdown instead of recomputing the upstream plan."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
