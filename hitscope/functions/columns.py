"""Column functions (no Python UDFs): every helper returns a Catalyst
expression, so it is code-generated, null-safe and foldable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitscope.functions import patterns as P


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F1 -------------------------------------------------------------------------
def pseudonymize(c: str | Column, key_b64: str) -> Column:
    """Deterministic, reversible pseudonym: AES-CBC, PKCS padding, zero IV,
    Base64 of the bare ciphertext.

    Spark's ``aes_encrypt`` prepends the IV to its output, so the first 16
    bytes are cut off before encoding.  ``key_b64`` is the Base64 form of a
    16, 24 or 32 byte key and is always supplied by the caller.
    """
    if not key_b64:
        raise ValueError("a pseudonym key is required")
    key = F.unbase64(F.lit(key_b64))
    iv = F.unhex(F.lit(P.CIPHER_IV_HEX))
    enc = F.aes_encrypt(_col(c), key, F.lit(P.CIPHER_MODE), F.lit(P.CIPHER_PADDING), iv)
    return F.base64(F.substring(enc, 17, 1 << 30))


def depseudonymize(c: str | Column, key_b64: str) -> Column:
    """Inverse of :func:`pseudonymize`."""
    key = F.unbase64(F.lit(key_b64))
    iv = F.unhex(F.lit(P.CIPHER_IV_HEX))
    raw = F.concat(iv, F.unbase64(_col(c)))
    return F.aes_decrypt(raw, key, F.lit(P.CIPHER_MODE), F.lit(P.CIPHER_PADDING)).cast("string")


# F2 -------------------------------------------------------------------------
def request_resource(c: str | Column) -> Column:
    """Second space-separated token of a request line; NULL when absent."""
    return F.get(F.split(_col(c), " "), 1)


# F3 -------------------------------------------------------------------------
def ipv4_to_long(c: str | Column) -> Column:
    """``a.b.c.d`` -> a*2^24 + b*2^16 + c*2^8 + d.  Octets are not range
    checked (as in the original); non-numeric parts or overflow give NULL."""
    parts = F.split(_col(c), r"\.")

    def octet(i: int) -> Column:
        return F.get(parts, i).try_cast("bigint")

    acc = F.try_multiply(octet(0), F.lit(16777216))
    acc = F.try_add(acc, F.try_multiply(octet(1), F.lit(65536)))
    acc = F.try_add(acc, F.try_multiply(octet(2), F.lit(256)))
    return F.try_add(acc, octet(3))


def long_to_ipv4(c: str | Column) -> Column:
    """Dotted form of a non-negative integer below 2^32."""
    n = _col(c).cast("bigint")
    return F.concat_ws(
        ".",
        *[(F.floor(n / F.lit(d)) % 256).cast("string") for d in (16777216, 65536, 256, 1)],
    )


# F4 -------------------------------------------------------------------------
def host_suffix(c: str | Column) -> Column:
    """Last dot-separated label of a host name, trailing dots ignored; NULL
    when nothing is left (a host made only of dots)."""
    stripped = F.regexp_replace(_col(c), r"\.+$", "")
    return F.nullif(F.element_at(F.split(stripped, r"\."), -1), F.lit(""))


# F5 -------------------------------------------------------------------------
def timestamp_date_prefix(c: str | Column) -> Column:
    return F.substring(_col(c), 1, 10)


# F6 -------------------------------------------------------------------------
def strip_bracket(c: str | Column) -> Column:
    return F.translate(_col(c), "[", "")


# F7 -------------------------------------------------------------------------
def is_valid_request(c: str | Column) -> Column:
    return _col(c).rlike(P.REQUEST_PATTERN)


def is_page_url(c: str | Column) -> Column:
    return _col(c).rlike(P.PAGE_PATTERN)


def is_numeric_host(c: str | Column) -> Column:
    return _col(c).rlike(P.NUMERIC_HOST_PATTERN)


def is_host_name(c: str | Column) -> Column:
    return _col(c).rlike(P.HOST_NAME_PATTERN)


# F8 / F9 ------------------------------------------------------------------------
def parse_log_time(ts: str | Column, tz: str | Column | None = None) -> Column:
    """Parse ``dd/MMM/yyyy:HH:mm:ss``.  Without ``tz`` the wall time is read in
    the session time zone (the original behaviour); with ``tz`` the numeric
    offset token (``-0400``) is honoured.  Bad text gives NULL."""
    if tz is None:
        return F.try_to_timestamp(_col(ts), F.lit(P.TIMESTAMP_FORMAT))
    offset = F.regexp_replace(_col(tz), r"\]", "")
    return F.try_to_timestamp(
        F.concat_ws(" ", _col(ts), offset), F.lit(P.TIMESTAMP_WITH_OFFSET_FORMAT)
    )


def epoch_seconds(c: str | Column) -> Column:
    return F.unix_seconds(_col(c))


# F12 ------------------------------------------------------------------------
def session_key(host: str | Column, number: str | Column) -> Column:
    return F.concat(_col(host), F.lit(P.SESSION_ID_SEPARATOR), _col(number).cast("string"))


# F13 / F18 --------------------------------------------------------------------
def percent(numerator: str | Column, denominator: str | Column, scale: int = 2) -> Column:
    """``round(n / d * 100, scale)`` (HALF_UP), NULL when ``d`` is 0."""
    return F.round(F.try_divide(_col(numerator), _col(denominator)) * 100, scale)


# A1 -------------------------------------------------------------------------
def distinct_with_null(c: str | Column) -> Column:
    """``SELECT DISTINCT c`` row count: distinct values, NULL counted once."""
    return F.count_distinct(_col(c)) + F.coalesce(
        F.max(_col(c).isNull().cast("bigint")), F.lit(0).cast("bigint")
    )
