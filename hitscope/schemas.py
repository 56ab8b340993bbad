"""Declared schemas (nothing is inferred)."""

from pyspark.sql import types as T

_S = T.StringType()

# Space-delimited access log, every field text.
ACCESS_LOG = T.StructType(
    [
        T.StructField("host", _S),
        T.StructField("hyphen_string1", _S),
        T.StructField("hyphen_string2", _S),
        T.StructField("timestamp", _S),
        T.StructField("timezone", _S),
        T.StructField("request", _S),
        T.StructField("http_response_code", _S),
        T.StructField("bytes", _S),
    ]
)
ACCESS_LOG_FIELDS = [f.name for f in ACCESS_LOG.fields]
# The fields a hit must have to be kept.
REQUIRED_FIELDS = ["host", "timestamp", "request", "http_response_code", "bytes"]

# IP-range dimension, comma CSV without header.
IP_RANGES = T.StructType(
    [
        T.StructField("begin_ip", _S),
        T.StructField("end_ip", _S),
        T.StructField("begin_ip_int", _S),
        T.StructField("end_ip_int", _S),
        T.StructField("country_code", _S),
        T.StructField("country", _S),
    ]
)

# Enriched hit (output of route + tag + time columns).
ENRICHED_FIELDS = [
    "encrypted_host",
    "datetime",
    "epoch",
    "request",
    "http_response_code",
    "bytes",
    "request_url",
    "country",
    "year",
    "month",
    "day",
]

# S3: session hits, typed.
SESSION_HITS = T.StructType(
    [
        T.StructField("encrypted_host", _S),
        T.StructField("datetime", T.TimestampType()),
        T.StructField("epoch", T.LongType()),
        T.StructField("request", _S),
        T.StructField("http_response_code", T.IntegerType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("request_url", _S),
        T.StructField("country", _S),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("session_time_difference", T.LongType()),
        T.StructField("is_new_session", T.IntegerType()),
        T.StructField("session_id", _S),
        T.StructField("first_visited_page", _S),
        T.StructField("last_visited_page", _S),
        T.StructField("page_count", T.LongType()),
    ]
)
SESSION_FIELDS = [f.name for f in SESSION_HITS.fields]

ENRICHED_LOG = T.StructType([f for f in SESSION_HITS.fields if f.name in ENRICHED_FIELDS])

# Routed hit tables (null, rejected, page, non-page) as written.
ROUTED_FIELDS = ["encrypted_host", "raw_timestamp", "request", "http_response_code", "bytes"]

DAILY_INSIGHTS_FIELDS = [
    "insight_year",
    "insight_month",
    "insight_day",
    "insight_date",
    "unique_visitor_count",
    "user_session_count",
    "avg_session_duration",
    "avg_session_duration_sec",
    "page_views_count",
    "bounce_count",
    "bounce_rate",
    "new_users_count",
]
PAGE_INSIGHTS_FIELDS = ["insight_date", "query_type", "request_url", "measure_value"]
COUNTRY_INSIGHTS_FIELDS = ["insight_date", "country_name", "page_request_count"]
