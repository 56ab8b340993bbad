"""Clean and route raw hits into null / rejected / page / non-page.

All routes are lazy filters over one scan; Catalyst pushes the null checks
into a Parquet scan and code-generates the regex predicates.  Routes are
predicates, not a partition: the quarantine tests all eight fields while the
keep filter tests five, so a hit with only a hyphen or the zone missing is
both quarantined and kept (pass ``strict=True`` to keep only complete hits).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitscope import schemas
from hitscope.functions import (
    is_page_url,
    is_valid_request,
    pseudonymize,
    request_resource,
    strip_bracket,
)


#: Given in place of a key: hosts stay readable (tests, logs that hold no
#: personal data).  Nothing does this by default.
PLAIN_HOSTS = "plain hosts"


def null_predicate(fields: list[str] = schemas.ACCESS_LOG_FIELDS) -> Column:
    """Any field missing."""
    return reduce(lambda a, b: a | b, [F.col(f).isNull() for f in fields])


def required_predicate(fields: list[str] = schemas.REQUIRED_FIELDS) -> Column:
    """All required fields present."""
    return reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in fields])


def null_hits(raw: DataFrame) -> DataFrame:
    return raw.where(null_predicate())


def kept_hits(raw: DataFrame, pseudonym_key: str, strict: bool = False) -> DataFrame:
    """Required fields present, host pseudonym added, ``[`` removed
    from the time text (now ``raw_timestamp``).  Extra input columns (for
    example a tie-break id) are carried along.  The key is required; only the
    constant :data:`PLAIN_HOSTS` leaves hosts as they are."""
    if not pseudonym_key:
        raise ValueError("a pseudonym key is required")
    keep = ~null_predicate() if strict else required_predicate()
    enc = F.col("host") if pseudonym_key == PLAIN_HOSTS else pseudonymize("host", pseudonym_key)
    extras = [c for c in raw.columns if c not in schemas.ACCESS_LOG_FIELDS]
    return raw.where(keep).select(
        "host",
        enc.alias("encrypted_host"),
        strip_bracket("timestamp").alias("raw_timestamp"),
        "timezone",
        "request",
        "http_response_code",
        "bytes",
        *extras,
    )


def rejected_hits(kept: DataFrame) -> DataFrame:
    """P5: request line not well formed."""
    return kept.where(~is_valid_request("request"))


def valid_hits(kept: DataFrame) -> DataFrame:
    """P4 + F2: well-formed request with its resource part."""
    return kept.where(is_valid_request("request")).withColumn(
        "request_url", request_resource("request")
    )


def page_hits(valid: DataFrame) -> DataFrame:
    """Page requests."""
    return valid.where(is_page_url("request_url"))


def non_page_hits(valid: DataFrame) -> DataFrame:
    """Everything else that is well formed (images, but also .txt, .pl)."""
    return valid.where(~is_page_url("request_url"))


def route_logs(raw: DataFrame, pseudonym_key: str, strict: bool = False) -> dict[str, DataFrame]:
    """The routed streams as lazy DataFrames over one input."""
    kept = kept_hits(raw, pseudonym_key, strict)
    valid = valid_hits(kept)
    return {
        "null": null_hits(raw),
        "kept": kept,
        "rejected": rejected_hits(kept),
        "valid": valid,
        "page": page_hits(valid),
        "non_page": non_page_hits(valid),
    }


def route_counts(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Hits per route in a single pass (one aggregate, map-side combined),
    as rows ``(route, hits)``."""
    keep = ~null_predicate() if strict else required_predicate()
    valid = keep & is_valid_request("request")
    url = request_resource("request")
    one = raw.agg(
        F.count_if(null_predicate()).alias("null"),
        F.count_if(keep).alias("kept"),
        F.count_if(keep & ~is_valid_request("request")).alias("rejected"),
        F.count_if(valid & is_page_url(url)).alias("page"),
        F.count_if(valid & ~is_page_url(url)).alias("non_page"),
    )
    return one.unpivot([], ["null", "kept", "rejected", "page", "non_page"], "route", "hits")


def routed_output(df: DataFrame) -> DataFrame:
    """The five columns written for the rejected / page / non-page tables."""
    return df.select(*schemas.ROUTED_FIELDS)
