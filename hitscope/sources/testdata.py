"""Adapter from the shared test tables to access-log shaped inputs.

``events`` becomes a web log (one hit per event) and ``nation`` becomes the
IP-range dimension.  Only integer and string expressions are used, so the
oracle SQL in ``hitscope.plans.oracles`` builds the very same rows in DuckDB.

Three of ten users share the host of user 0, so one host holds about a third
of all hits.  Host by ``user % 4``: 0 a dotted IPv4 address, 1
``u<id>.example.<cc>`` (a two-letter suffix, some without a country), 2
``u<id>.example.com`` (no suffix country, so ``NA``), 3 ``U<id>.LOCAL`` (upper
case: no country).  Requests by ``event_type``: view/click/signup are pages,
purchase is an image, error carries ``=`` and is rejected.  Every 50th event
is a 404 with ``-`` bytes.  Some lines lack the host, the zone or the request,
some times do not parse, some zones are not UTC.  ``event_id`` travels along
as the ordering tie-break.

Each nation has a range; some have a second one inside it under another name
(so a code has two names, one with a comma), some one without code and name,
and one code is also listed without a name.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.functions import long_to_ipv4

FIRST_IP = 16777216
IP_STRIDE_PER_USER = 65537
RANGE_STRIDE = 4000000
RANGE_WIDTH = 3000000  # the rest of a stride is in no range


# Declared schemas of the shared tables this adapter reads (only the
# columns it uses), so no file footer is read while the plan is built.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "nation": "n_nationkey int, n_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _two_letters(n: Column) -> Column:
    """Letter ``97 + n`` written twice (``aa``, ``bb``, ...)."""
    return F.repeat(F.chr(F.lit(97) + n), 2)


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 8 raw text fields of S1 plus ``event_id``."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    uid = F.when(F.col("user_id") % 10 < 3, F.lit(0).cast("bigint")).otherwise(F.col("user_id"))
    eid, et = F.col("event_id"), F.col("event_type")
    kind = uid % 4
    ids = uid.cast("string")
    host = (
        F.when(kind == 0, long_to_ipv4(F.lit(FIRST_IP) + uid * IP_STRIDE_PER_USER))
        .when(kind == 1, F.concat(F.lit("u"), ids, F.lit(".example."), _two_letters(uid % 26)))
        .when(kind == 2, F.concat(F.lit("u"), ids, F.lit(".example.com")))
        .otherwise(F.concat(F.lit("U"), ids, F.lit(".LOCAL")))
    )
    k = (eid % 10).cast("string")
    request = (
        F.when(et == "view", F.concat(F.lit("GET /view/"), k, F.lit(".html HTTP/1.0")))
        .when(et == "click", F.concat(F.lit("GET /click/"), k, F.lit(" HTTP/1.0")))
        .when(et == "signup", F.lit("POST /signup/ HTTP/1.0"))
        .when(et == "purchase", F.concat(F.lit("GET /img/"), k, F.lit(".gif HTTP/1.0")))
        .otherwise(F.concat(F.lit("GET /cgi/x?k="), k, F.lit(" HTTP/1.0")))
    )
    missing = eid % 50 == 0
    fields = F.struct(
        F.when(eid % 227 != 0, host).alias("host"),
        F.lit("-").alias("hyphen_string1"),
        F.lit("-").alias("hyphen_string2"),
        F.when(eid % 229 == 0, "[99/Foo/2024:00:00:00")
        .otherwise(F.concat(F.lit("["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")))
        .alias("timestamp"),
        F.when(eid % 223 != 0, F.when(eid % 7 == 3, "-0400]").otherwise("+0000]")).alias("timezone"),
        F.when(eid % 211 != 0, request).alias("request"),
        F.when(missing, F.lit("404")).otherwise(F.lit("200")).alias("http_response_code"),
        F.when(missing, F.lit("-")).otherwise((eid % 5000).cast("string")).alias("bytes"),
        eid.alias("event_id"),
    )
    # The adapter stands for log files already on disk, whose fields are read
    # once per line.  Emitting the row through a generator keeps Catalyst from
    # substituting the derived fields into every pushed-down filter (where
    # each would be re-computed), whatever columns are used downstream.
    return ev.select(F.inline(F.array(fields)))


def access_log_lines(log: DataFrame) -> DataFrame:
    """The same hits as raw log text (``host - - [time zone] "request" code
    bytes``), one line per hit, in column ``value``; a missing field is ``""``."""
    text = lambda c: F.coalesce(c, F.lit('""'))
    line = F.concat_ws(
        " ",
        *(text(F.col(c)) for c in ("host", "hyphen_string1", "hyphen_string2", "timestamp", "timezone")),
        text(F.concat(F.lit('"'), F.col("request"), F.lit('"'))),
        *(text(F.col(c)) for c in ("http_response_code", "bytes")),
    )
    return log.select(line.alias("value"), "event_id")


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2-shaped rows from ``nation``."""
    n = F.col("n_nationkey").cast("bigint")
    first = F.lit(FIRST_IP) + n * RANGE_STRIDE
    code, name = _two_letters(n), F.col("n_name")

    def row(begin, width: int, code, name):
        end = begin + (width - 1)
        return F.struct(
            long_to_ipv4(begin).alias("begin_ip"),
            long_to_ipv4(end).alias("end_ip"),
            begin.cast("string").alias("begin_ip_int"),
            end.cast("string").alias("end_ip_int"),
            code.alias("country_code"),
            name.alias("country"),
        )

    text = F.lit(None).cast("string")
    over = F.when(n % 5 == 0, row(first + 200000, 1800000, F.upper(code), F.concat(F.lit("OVER, "), name)))
    blank = F.when(n % 5 == 1, row(first + 100000, 600000, text, text))
    bad = F.lit("x")
    nameless = F.when(
        n == 2,
        F.struct(
            bad.alias("begin_ip"), bad.alias("end_ip"), bad.alias("begin_ip_int"), bad.alias("end_ip_int"),
            code.alias("country_code"), text.alias("country"),
        ),
    )
    rows = F.array_compact(F.array(row(first, RANGE_WIDTH, code, name), over, blank, nameless))
    return table(spark, sf_dir, "nation").select(F.inline(rows))
