"""SQL surface (S5): the pipeline's DataFrames as temp views, and
sessionising as SQL text for users who work in ``spark.sql``.

The SQL text is the direct window plan (one shuffle on host).  For inputs where
one host can hold a large share of all hits, :func:`register_sessions` gives
the skew-proof plan's result as a view.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from hitscope.functions import patterns as P
from hitscope.operators.sessions import SESSION_COLUMNS, sessionize


def register_views(routes: dict[str, DataFrame], prefix: str = "hits") -> dict[str, str]:
    """Register every routed DataFrame as ``<prefix>_<route>``; returns the
    view names."""
    names = {}
    for route, df in routes.items():
        name = f"{prefix}_{route}"
        df.createOrReplaceTempView(name)
        names[route] = name
    return names


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def session_sql(
    view: str,
    columns: list[str],
    gap: int | str = P.SESSION_GAP_SECONDS,
    tie_break: str | None = None,
    host: str = "encrypted_host",
    time: str = "datetime",
    epoch: str = "epoch",
    url: str = "request_url",
) -> str:
    """Sessionising SQL over ``view`` (same output as ``sessionize``).  Column
    names may hold any character."""
    host, time, epoch, url = map(quoted, (host, time, epoch, url))
    tie_break = quoted(tie_break) if tie_break else None
    columns = [quoted(c) for c in columns]
    order = f"{time}, {tie_break}" if tie_break else time
    frame = f"{'ROWS' if tie_break else 'RANGE'} BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    keep = ", ".join(columns)
    return f"""
WITH timed AS (
  SELECT {keep}, {epoch} - lag({epoch}) OVER (PARTITION BY {host} ORDER BY {order}) AS session_time_difference
  FROM {view}
), counted AS (
  SELECT *, count_if(session_time_difference >= {gap}) OVER (PARTITION BY {host} ORDER BY {order} {frame}) AS session_no
  FROM timed
)
SELECT {keep}, session_time_difference,
       if(session_time_difference >= {gap}, 1, 0) AS is_new_session,
       {host} || '{P.SESSION_ID_SEPARATOR}' || session_no AS session_id,
       first_value({url}) OVER so_far AS first_visited_page,
       last_value({url}) OVER so_far AS last_visited_page,
       count({url}) OVER so_far AS page_count
FROM counted
WINDOW so_far AS (PARTITION BY {host}, session_no ORDER BY {order} {frame})"""


#: F1-F5 as SQL functions: name, arguments, result, body.  Bodies are the
#: expressions of ``hitscope.functions.columns`` in SQL.
FUNCTIONS = (
    (
        "pseudonym", "host STRING, key_b64 STRING", "STRING",
        f"base64(substring(aes_encrypt(host, unbase64(key_b64), '{P.CIPHER_MODE}', '{P.CIPHER_PADDING}', unhex('{P.CIPHER_IV_HEX}')), 17))",
    ),
    (
        "pseudonym_host", "token STRING, key_b64 STRING", "STRING",
        f"cast(aes_decrypt(concat(unhex('{P.CIPHER_IV_HEX}'), unbase64(token)), unbase64(key_b64), '{P.CIPHER_MODE}', '{P.CIPHER_PADDING}') AS STRING)",
    ),
    ("request_resource", "request STRING", "STRING", "get(split(request, ' '), 1)"),
    (
        "ipv4_to_long", "host STRING", "BIGINT",
        r"""aggregate(array(0, 1, 2, 3), cast(0 AS BIGINT),
             (n, i) -> try_add(try_multiply(n, 256L), try_cast(get(split(host, r'\.'), i) AS BIGINT)))""",
    ),
    ("host_suffix", "host STRING", "STRING", r"nullif(element_at(split(regexp_replace(host, r'\.+$', ''), r'\.'), -1), '')"),
    ("date_prefix", "time_text STRING", "STRING", "substring(time_text, 1, 10)"),
)


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """F1-F5 as temporary SQL functions, for users who write SQL text only;
    returns their names.  They are expanded into the plan like any expression."""
    names = []
    for name, arguments, result, body in FUNCTIONS:
        names.append(prefix + name)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {quoted(prefix + name)}({arguments}) RETURNS {result} RETURN {body}")
    return names


def register_session_function(spark: SparkSession, name: str, view: str, tie_break: str | None = None, **names: str) -> None:
    """A table function ``name(gap_seconds)``: the hits of ``view`` (a temporary
    one) with their session columns, by :func:`session_sql`."""
    fields = spark.table(view).schema.fields
    added = ("BIGINT", "INT", "STRING", "STRING", "STRING", "BIGINT")
    columns = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields]
    columns += [f"{c} {kind}" for c, kind in zip(SESSION_COLUMNS, added)]
    body = session_sql(view, [f.name for f in fields], f"{quoted(name)}.gap_seconds", tie_break, **names)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {quoted(name)}(gap_seconds BIGINT) RETURNS TABLE ({', '.join(columns)}) RETURN {body}")


def register_sessions(
    hits: DataFrame, name: str, gap: int = P.SESSION_GAP_SECONDS, tie_break: str | None = None
) -> None:
    """The chunked sessioniser's result as a temp view, for SQL over inputs in
    which one host can hold a large share of all hits."""
    sessionize(hits, gap=gap, tie_break=tie_break).createOrReplaceTempView(name)


def sessionize_sql(
    spark: SparkSession,
    hits: DataFrame,
    gap: int = P.SESSION_GAP_SECONDS,
    tie_break: str | None = None,
    **names: str,
) -> DataFrame:
    """Run :func:`session_sql` over ``hits`` through a temp view; ``names`` as
    there."""
    view = f"hits_{uuid.uuid4().hex[:10]}"
    hits.createOrReplaceTempView(view)
    return spark.sql(session_sql(view, hits.columns, gap, tie_break, **names))
