"""Scalar column functions and the fixed patterns they use."""

from hitscope.functions.columns import (
    depseudonymize,
    distinct_with_null,
    epoch_seconds,
    host_suffix,
    ipv4_to_long,
    is_host_name,
    is_numeric_host,
    is_page_url,
    is_valid_request,
    long_to_ipv4,
    parse_log_time,
    percent,
    pseudonymize,
    request_resource,
    session_key,
    strip_bracket,
    timestamp_date_prefix,
)

__all__ = [
    "depseudonymize",
    "distinct_with_null",
    "epoch_seconds",
    "host_suffix",
    "ipv4_to_long",
    "is_host_name",
    "is_numeric_host",
    "is_page_url",
    "is_valid_request",
    "long_to_ipv4",
    "parse_log_time",
    "percent",
    "pseudonymize",
    "request_resource",
    "session_key",
    "strip_bracket",
    "timestamp_date_prefix",
]
