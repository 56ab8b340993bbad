"""URL filters: host and path rules, then a list of canonical URLs.

A blocked Bloom filter of the listed URLs (blocks of eight 32-bit words; a
key sets one bit in each word of one block) is built by one aggregation with
``bit_or`` and broadcast.  Its size is fixed by ``max_blocks`` whatever the
list's length is; a longer list only raises the share of false positives.
Pages whose bits are all set go to an exact hash join with the list, which
removes the false positives; all other pages skip that join.  A canonical
URL that a third of all pages share is split by the adaptive skew join.

Canonical form: host without a leading ``www.``, default port and final dot;
path without final slashes; query parameters sorted, without tracking
parameters; scheme and fragment dropped.

Defined cases: a null url, or one without ``://``, has an empty host and
path, fits no rule and is not listed (verdict allow).  Nulls in the list are
passed over; an empty list blocks nothing.  Repeated pages are judged one by
one.  Columns of the pages that share a name with a result column are not
carried: the result has the id and the verdict columns only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitscope.llm.runtime import lower_ascii, prepare, stored

BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 17  # 4 MB of filter words
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|msclkid)(=.*)?$"
#: Odd multipliers that pick the bit in each word of a block.
_SALTS = [0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0xD3A2646D, 0xFD7046C5, 0xB55A4F09]


def url_host(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty without ``://`` or url."""
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    rest = F.regexp_replace(_after_scheme(url), r"^[^/?#]*", "")
    return F.coalesce(F.regexp_extract(rest, r"^[^?#]*", 0), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def canonical_url(url: Column) -> Column:
    """The form under which URLs are listed; null without ``://``."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r"\.?(:80|:443)?$", ""), r"^www\.", "")
    path = F.regexp_replace(url_path(url), r"/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(
        F.locate("://", url) > 0,
        F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")),
    )


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (``host/path``, verdict) that fits, as a struct; null
    if none does.  Rules are a short configuration list, not data."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        h, p = rule[: rule.index("/")].lower(), rule[rule.index("/") :]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """A key's block, and the bit that it sets in each word of the block."""
    h = F.xxhash64(key)
    low = h.bitwiseAND(F.lit(0x7FFFFFFF))  # 31 bits: products stay in a long
    block = F.pmod(F.shiftright(h, 32), F.lit(blocks)).cast("int")
    bits = [F.call_function("shiftleft", F.lit(1), F.shiftright((low * F.lit(s)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int")) for s in _SALTS]
    return block, bits


def bloom_blocks(n_keys: int, bits_per_key: int = BITS_PER_KEY, max_blocks: int = MAX_BLOCKS) -> int:
    return min(max_blocks, 1 << max(0, ceil(log2(max(1, n_keys * bits_per_key / 256)))))


def build_bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """One row per block in use: (block, w0..w7)."""
    block, bits = _place(F.col("key"), blocks)
    rows = keys.select(block.alias("block"), *(b.alias(f"w{i}") for i, b in enumerate(bits)))
    return rows.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(len(_SALTS))))


def may_be_listed(df: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """``df`` with a boolean ``maybe``; no listed key gets false."""
    block, bits = _place(F.col(key), blocks)
    joined = df.withColumn("block", block).join(F.broadcast(bloom), "block", "left")
    words = [F.col(f"w{i}") for i in range(len(bits))]
    every = reduce(lambda a, b: a & b, [w.bitwiseAND(b) == b for w, b in zip(words, bits)])
    return joined.withColumn("maybe", F.col(key).isNotNull() & F.coalesce(every, F.lit(False))).drop(
        "block", *(f"w{i}" for i in range(len(bits)))
    )


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    listed_col: str = "url",
    bits_per_key: int = BITS_PER_KEY,
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """(id, host, path, rule, verdict, listed) for every page.  ``listed`` is
    looked at only where no rule decides, and is null elsewhere."""
    prepare(pages.sparkSession)
    url = F.col(f"`{url_col}`")
    keys = stored(listed.select(canonical_url(F.col(f"`{listed_col}`")).alias("key")).where("key is not null").distinct(), "listed")
    blocks = bloom_blocks(keys.count(), bits_per_key, max_blocks)
    page = pages.select(
        F.col(f"`{id_col}`").alias("id"), url_host(url).alias("host"), url_path(url).alias("path"), canonical_url(url).alias("canon")
    )
    page = page.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    open_ = page.withColumn("key", F.when(F.col("found").isNull(), F.col("canon"))).drop("canon")
    probed = may_be_listed(open_, "key", build_bloom(keys, blocks), blocks)
    hits = probed.where("maybe").join(keys.withColumn("listed", F.lit(True)), "key", "left")
    rest = probed.where("not maybe").withColumn("listed", F.lit(None).cast("boolean"))
    return hits.unionByName(rest).select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("listed"), "block"), F.lit("allow")).alias("verdict"),
        F.when(F.col("found").isNull(), F.coalesce("listed", F.lit(False))).alias("listed"),
    )
