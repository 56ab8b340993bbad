"""Tag hits with a country, by IP range (numeric hosts) or by the last
label of the host name (named hosts).

One plan at every size:

* Hosts are reduced to their distinct set (a map-side combined aggregate)
  before any lookup, so a host with a third of all hits costs one row here.
* The IP range join (J1) has no equality key.  Ranges are clipped to the IPv4
  space, cut at ``/16`` borders and merged, per country, into disjoint spans
  (one window per bucket and country, linear in its ranges).  A bucket with
  more than ``DENSE`` spans is cut again at ``/24`` borders, where a country
  can have 128 spans at most.  Hosts meet spans by an equality join on the
  bucket plus ``BETWEEN``.
* Where the narrowest range wins, a sweep over the ranges' ends cuts each
  bucket into disjoint pieces, and each piece gets its owner from a segment
  tree over the pieces (:func:`narrowest_spans`): k ranges of a bucket cost
  k log k rows, however deep they overlap, and a host meets one piece.
* The host map joins back to the hits on host (J3).  Whether a side is
  broadcast, and whether a hot host's partition is split, is left to the
  adaptive plan, which measures sizes; neither changes a row.

A stream cannot be reduced to distinct hosts without state, so the hits of a
stream meet the same spans and codes directly (static joins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitscope.functions import host_suffix, ipv4_to_long, is_host_name, is_numeric_host
from hitscope.functions import patterns as P
from hitscope.sources.access_log import typed_ip_ranges

BUCKET_BITS = 16
DENSE = 256
MAX_IP = (1 << 32) - 1
_LEVELS = BUCKET_BITS + 1  # of a tree over the pieces of a bucket
_WHOLE = -1  # second key of a bucket that is not cut again


def distinct_hosts(hits: DataFrame, host: str = "host") -> DataFrame:
    """One row per host (with its hit count)."""
    return hits.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("hits"))


def numeric_hosts(hosts: DataFrame) -> DataFrame:
    """P8 + F3."""
    return hosts.where(is_numeric_host("host")).withColumn("ip_int", ipv4_to_long("host"))


def named_hosts(hosts: DataFrame) -> DataFrame:
    """P9 + F4."""
    return hosts.where(is_host_name("host")).withColumn("country_code", host_suffix("host"))


def host_kinds(hosts: DataFrame) -> DataFrame:
    """Per host: numeric IP, host name, or neither, with its suffix."""
    return hosts.select(
        "host",
        is_numeric_host("host").alias("is_ip"),
        is_host_name("host").alias("is_name"),
        F.when(is_host_name("host"), host_suffix("host")).alias("suffix"),
    )


def _range_rows(ranges: DataFrame, typed: bool) -> DataFrame:
    r = ranges if typed else typed_ip_ranges(ranges)
    return r.where(F.col("begin_ip_int").isNotNull() & F.col("end_ip_int").isNotNull())


def _clipped(r: DataFrame) -> DataFrame:
    """Ranges within the IPv4 space, so that a bad bound cannot explode."""
    return (
        r.withColumn("begin_ip_int", F.greatest("begin_ip_int", F.lit(0).cast("bigint")))
        .withColumn("end_ip_int", F.least("end_ip_int", F.lit(MAX_IP).cast("bigint")))
        .where("begin_ip_int <= end_ip_int")
    )


def range_spans(ranges: DataFrame, typed: bool = False) -> DataFrame:
    """Disjoint spans of each country: ``(bucket, sub, span_begin, span_end,
    country)``.  An address lies in at most one span of a country, so joining
    on spans gives each address the distinct countries of all ranges that
    contain it, a NULL country included.  ``sub`` is -1, or the ``/24`` in a
    dense bucket."""
    r = _clipped(_range_rows(ranges, typed)).select("begin_ip_int", "end_ip_int", "country")
    buckets = F.sequence(F.shiftright("begin_ip_int", BUCKET_BITS), F.shiftright("end_ip_int", BUCKET_BITS))
    lo = F.shiftleft(F.col("bucket"), BUCKET_BITS)
    cut = r.withColumn("bucket", F.explode(buckets)).select(
        "bucket", "country",
        F.greatest("begin_ip_int", lo).alias("b"), F.least(F.col("end_ip_int"), lo + ((1 << BUCKET_BITS) - 1)).alias("e"),
    )
    w = Window.partitionBy("bucket", "country").orderBy("b", "e")
    before = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    spans = (
        cut.withColumn("_new", F.when(before.isNull() | (F.col("b") > before + 1), 1).otherwise(0))
        .withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("bucket", "country", "_island")
        .agg(F.min("b").alias("b"), F.max("e").alias("e"))
    )
    return _keyed(spans)


def _keyed(spans: DataFrame) -> DataFrame:
    """Spans of a bucket under one key, or under their ``/24`` where many."""
    keyed = spans.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("bucket")))
    subs = F.when(F.col("_n") <= DENSE, F.array(F.lit(_WHOLE).cast("bigint"))).otherwise(F.sequence(F.shiftright("b", 8), F.shiftright("e", 8)))
    return keyed.select(
        "bucket", F.explode(subs).alias("sub"), F.col("b").alias("span_begin"), F.col("e").alias("span_end"), "country"
    )


def _tree_nodes(lo: str, hi: str):
    """The nodes (level, place) of a binary tree over the numbers from 0 that
    together cover ``lo`` to ``hi``: two on a level at most."""
    node = lambda level, at: F.struct(level.alias("level"), at.alias("at"))

    def climb(acc, level):
        left, right = acc["left"], acc["right"]
        odd_l, odd_r = (left < right) & (left % 2 == 1), (left < right) & (right % 2 == 1)
        taken = F.concat(
            acc["nodes"],
            F.when(odd_l, F.array(node(level, left))).otherwise(F.array().cast("array<struct<level:int,at:bigint>>")),
            F.when(odd_r, F.array(node(level, right - 1))).otherwise(F.array().cast("array<struct<level:int,at:bigint>>")),
        )
        up = lambda x: F.shiftright(x, 1)
        return F.struct(
            up(left + odd_l.cast("bigint")).alias("left"), up(right - odd_r.cast("bigint")).alias("right"), taken.alias("nodes")
        )

    start = F.struct(
        F.col(lo).cast("bigint").alias("left"),
        (F.col(hi).cast("bigint") + 1).alias("right"),
        F.array().cast("array<struct<level:int,at:bigint>>").alias("nodes"),
    )
    return F.aggregate(F.sequence(F.lit(0), F.lit(_LEVELS)), start, climb, lambda acc: acc["nodes"])


def narrowest_spans(ranges: DataFrame, typed: bool = False) -> DataFrame:
    """Disjoint spans, each with the country of the narrowest range that covers
    it (equal widths: the first country, NULL before all): ``(bucket, sub,
    span_begin, span_end, country)`` as in :func:`range_spans`.

    The ends of a bucket's ranges, in order, bound its pieces.  A range covers a
    row of pieces; it is noted at the nodes of a binary tree over the pieces
    that make up that row, each node keeps its narrowest range, and a piece's
    owner is the narrowest on its way to the root."""
    r = _clipped(_range_rows(ranges, typed)).select("begin_ip_int", "end_ip_int", "country")
    buckets = F.sequence(F.shiftright("begin_ip_int", BUCKET_BITS), F.shiftright("end_ip_int", BUCKET_BITS))
    lo = F.shiftleft(F.col("bucket"), BUCKET_BITS)
    rank = F.struct((F.col("end_ip_int") - F.col("begin_ip_int")).alias("w"), F.col("country").alias("c"))
    cut = r.withColumns({"bucket": F.explode(buckets), "rank": rank}).select(
        "bucket", "rank", F.greatest("begin_ip_int", lo).alias("b"), F.least(F.col("end_ip_int"), lo + ((1 << BUCKET_BITS) - 1)).alias("e")
    )
    # of ranges with the same ends in the bucket only the narrowest counts
    cut = cut.groupBy("bucket", "b", "e").agg(F.min("rank").alias("rank"))
    ends = cut.select("*", F.explode(F.array(F.col("b"), F.col("e") + 1)).alias("p")).withColumn(
        "k", F.dense_rank().over(Window.partitionBy("bucket").orderBy("p")) - 1
    )
    pieces = (
        ends.groupBy("bucket", "k").agg(F.min("p").alias("b"))
        .withColumn("e", F.lead("b").over(Window.partitionBy("bucket").orderBy("k")) - 1)
        .where("e is not null")
    )
    covered = ends.groupBy("bucket", "b", "e", "rank").agg(F.min("k").alias("first"), (F.max("k") - 1).alias("last"))
    nodes = (
        covered.select("bucket", "rank", F.explode(_tree_nodes("first", "last")).alias("node"))
        .groupBy("bucket", "node").agg(F.min("rank").alias("rank"))
    )
    way = F.array(*(F.struct(F.lit(x).alias("level"), F.shiftright(F.col("k").cast("bigint"), x).alias("at")) for x in range(_LEVELS + 1)))
    owned = (
        pieces.withColumn("node", F.explode(way)).join(nodes, ["bucket", "node"])
        .groupBy("bucket", "k", "b", "e").agg(F.min("rank").alias("rank"))
    )
    return _keyed(owned.select("bucket", "b", "e", F.col("rank.c").alias("country")))


def ip_range_country_bucketed(ips: DataFrame, ranges: DataFrame, typed: bool = False) -> DataFrame:
    """J1 + P18 on the ranges themselves: one row per host and range that
    contains it, by an equality join on ``ip >> 16`` plus ``BETWEEN``."""
    r = _clipped(_range_rows(ranges, typed))
    exploded = r.withColumn(
        "bucket",
        F.explode(F.sequence(F.shiftright("begin_ip_int", BUCKET_BITS), F.shiftright("end_ip_int", BUCKET_BITS))),
    )
    keyed = ips.where(F.col("ip_int").isNotNull()).withColumn("bucket", F.shiftright("ip_int", BUCKET_BITS))
    cond = (keyed["bucket"] == exploded["bucket"]) & keyed["ip_int"].between(exploded["begin_ip_int"], exploded["end_ip_int"])
    return keyed.join(exploded, cond, "inner").select(
        keyed["host"], exploded["country"], exploded["begin_ip_int"], exploded["end_ip_int"]
    )


def _in_spans(ips: DataFrame, spans: DataFrame) -> DataFrame:
    """Inner join of ``(host, ip_int)`` with spans: a bucket is either whole
    or cut, so each address asks under both keys and meets one of them."""
    keys = F.array(F.lit(_WHOLE).cast("bigint"), F.shiftright("ip_int", 8))
    asked = ips.where(F.col("ip_int").between(0, MAX_IP)).select(
        "host", "ip_int", F.shiftright("ip_int", BUCKET_BITS).alias("bucket"), F.explode(keys).alias("sub")
    )
    return asked.join(spans, ["bucket", "sub"]).where(F.col("ip_int").between(F.col("span_begin"), F.col("span_end"))).select("host", "country")


def ip_range_country(ips: DataFrame, ranges: DataFrame, overlap: str = "all", typed: bool = False) -> DataFrame:
    """Numeric hosts to the distinct countries of the ranges that contain
    them (hosts in no range are absent).  ``overlap='smallest'`` keeps, per
    host, the narrowest range's country instead."""
    if overlap == "smallest":
        return _in_spans(ips, narrowest_spans(ranges, typed))
    return _in_spans(ips, range_spans(ranges, typed))


def suffix_codes(ranges: DataFrame, typed: bool = False) -> DataFrame:
    """Distinct names of each code; a missing name is ``NA``."""
    r = ranges if typed else typed_ip_ranges(ranges)
    return r.where("country_code is not null").select("country_code", F.coalesce("country", F.lit(P.UNKNOWN_SUFFIX_COUNTRY)).alias("country")).distinct()


def suffix_country(names: DataFrame, ranges: DataFrame, typed: bool = False) -> DataFrame:
    """J2 + F11 + F15: host-name suffix to country; no match gives ``NA``.
    A code listed with two names yields two rows (kept, as in the original)."""
    return names.join(suffix_codes(ranges, typed), "country_code", "left").select(
        "host", F.coalesce("country", F.lit(P.UNKNOWN_SUFFIX_COUNTRY)).alias("country")
    )


def host_country_map(hits: DataFrame, ranges: DataFrame, overlap: str = "all", host: str = "host") -> DataFrame:
    """Distinct ``(host, country)`` pairs; a range without a country name
    gives a pair with NULL.  Hosts in no range, or matching neither pattern,
    have no pair."""
    hosts = distinct_hosts(hits, host).select("host")
    if overlap == "all":
        r = typed_ip_ranges(ranges)
        h = F.col("host")
        ip = F.when(is_numeric_host(h), ipv4_to_long(h))
        name = F.coalesce(is_host_name(h), F.lit(False))
        none = F.lit(None).cast("bigint")
        asked = hosts.select(  # an address asks under both keys of a bucket and meets spans under one
            "host",
            F.when(name, host_suffix(h)).alias("_suffix"),
            name.alias("_name"),
            ip.alias("_ip"),
            F.explode(F.when(ip.isNotNull(), F.array(F.lit(_WHOLE).cast("bigint"), F.shiftright(ip, 8))).otherwise(F.array(none))).alias("sub"),
        ).withColumn("bucket", F.shiftright("_ip", BUCKET_BITS))
        spans = range_spans(r, typed=True)
        met = (
            (asked["bucket"] == spans["bucket"]) & (asked["sub"] == spans["sub"])
            & F.col("_ip").between(F.col("span_begin"), F.col("span_end"))
        )
        codes = suffix_codes(r, typed=True).select(F.col("country_code").alias("_code"), F.col("country").alias("_code_country"))
        found = asked.join(spans, met, "left").join(codes, F.col("_suffix") == F.col("_code"), "left")
        country = F.when(F.col("_name"), F.coalesce("_code_country", F.lit(P.UNKNOWN_SUFFIX_COUNTRY))).otherwise(F.col("country"))
        return found.where(F.col("_name") | F.col("span_begin").isNotNull()).select("host", country.alias("country")).distinct()
    r = typed_ip_ranges(ranges)
    by_ip = ip_range_country(numeric_hosts(hosts), r, overlap, typed=True)
    return by_ip.unionByName(suffix_country(named_hosts(hosts), r, typed=True)).distinct()


def _looked_up(df: DataFrame, ranges: DataFrame, host: str) -> DataFrame:
    """``df`` with ``_country`` and ``_matched``: a row for each distinct
    country of its host, or one row where nothing matches.  A bucket is either
    whole or cut, so an address meets spans in one of the two joins only."""
    r = typed_ip_ranges(ranges)
    h = F.col(host)
    spans = range_spans(r, typed=True)
    out = df.withColumns(
        {
            "_ip": F.when(is_numeric_host(h), ipv4_to_long(h)),
            "_name": F.coalesce(is_host_name(h), F.lit(False)),
            "_suffix": F.when(is_host_name(h), host_suffix(h)),
        }
    )
    for name, sub in (("whole", F.lit(_WHOLE).cast("bigint")), ("cut", F.shiftright("_ip", 8))):
        side = spans.select(
            F.col("bucket").alias(f"_{name}_bucket"), F.col("sub").alias(f"_{name}_sub"),
            F.col("span_begin").alias(f"_{name}_b"), F.col("span_end").alias(f"_{name}_e"), F.col("country").alias(f"_{name}_country"),
        )
        out = out.join(
            side,
            (F.shiftright("_ip", BUCKET_BITS) == F.col(f"_{name}_bucket"))
            & (sub == F.col(f"_{name}_sub"))
            & F.col("_ip").between(F.col(f"_{name}_b"), F.col(f"_{name}_e")),
            "left",
        )
    codes = suffix_codes(r, typed=True).select(F.col("country_code").alias("_code"), F.col("country").alias("_code_country"))
    out = out.join(codes, F.col("_suffix") == F.col("_code"), "left")
    country = F.when(F.col("_name"), F.coalesce("_code_country", F.lit(P.UNKNOWN_SUFFIX_COUNTRY))).otherwise(
        F.coalesce("_whole_country", "_cut_country")
    )
    matched = F.col("_name") | F.col("_whole_bucket").isNotNull() | F.col("_cut_bucket").isNotNull()
    return out.select(*df.columns, country.alias("_country"), matched.alias("_matched"))


def tag_country_direct(hits: DataFrame, ranges: DataFrame, host: str = "host") -> DataFrame:
    """C2 without a host map: every hit meets the spans and codes itself.
    Same rows as :func:`tag_country`; the form that a stream can run."""
    return _looked_up(hits, ranges, host).select(*hits.columns, F.col("_country").alias("country"))


def tag_country(
    hits: DataFrame,
    ranges: DataFrame,
    overlap: str = "all",
    host: str = "host",
    unknown_label: str | None = None,
) -> DataFrame:
    """Every hit with a ``country`` column.

    Country is ``NA`` for a host name whose suffix has no country, NULL for
    an IP in no range or a host matching neither pattern; ``unknown_label``
    replaces both.  A host with several countries (overlapping ranges, or a
    code with several names) repeats its hits, once per distinct country."""
    if hits.isStreaming:
        if overlap != "all":
            raise ValueError("a stream takes every overlapping range")
        out = tag_country_direct(hits, ranges, host)
    else:
        m = host_country_map(hits, ranges, overlap, host).withColumnRenamed("host", "_map_host")
        out = hits.join(m, F.col(host) == F.col("_map_host"), "left").select(*hits.columns, "country")
    if unknown_label is not None:
        known = F.col("country").isNotNull() & (F.col("country") != P.UNKNOWN_SUFFIX_COUNTRY)
        out = out.withColumn("country", F.when(known, F.col("country")).otherwise(F.lit(unknown_label)))
    return out


def tag_country_bucketed(hits: DataFrame, ranges: DataFrame, keys: tuple[str, ...], overlap: str = "all", host: str = "host") -> DataFrame:
    """C2 over a log that is stored in buckets of ``keys``, which fix the host
    and are never NULL (host key and time chunk): same rows as
    :func:`tag_country`, and no hit is exchanged.  The host map goes to the
    distinct keys, one row per host and chunk, and these meet the hits in their
    buckets; a hot host's hits stay spread over its chunks."""
    m = host_country_map(hits, ranges, overlap, host).withColumnRenamed("host", "_map_host")
    chunks = hits.select(F.col(host).alias("_host"), *keys).distinct()
    found = chunks.join(m, F.col("_host") == F.col("_map_host"), "left").select(*keys, "country")
    return hits.join(found, list(keys), "left").select(*hits.columns, "country")


def ambiguous_hosts(country_map: DataFrame) -> DataFrame:
    """Hosts mapped to more than one country (they multiply their hits)."""
    return (
        country_map.groupBy("host")
        .agg(F.count(F.lit(1)).alias("countries"))
        .where(F.col("countries") > 1)
    )
