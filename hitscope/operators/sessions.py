"""Sessionise hits per host by inactivity gap.

Semantics (kept from the original jobs):

* ``session_time_difference`` is ``epoch - LAG(epoch)`` per host in time
  order (NULL for a host's first hit).
* ``is_new_session`` is 1 when that gap is ``>= gap`` (so a gap of exactly
  ``gap`` seconds opens a session), else 0; the first hit has 0, and session
  numbers start at ``_0``.
* ``session_id`` is ``host || '_' || running SUM(is_new_session)``.
* ``first_visited_page`` is the session's entry URL, ``last_visited_page``
  and ``page_count`` are *running* values (the page so far and the number of
  hits so far); the session totals sit on its last hit.
* With a ``tie_break`` column, hits are ordered by ``(datetime, tie_break)``
  and frames are ROWS.  Without one, equal times are peers (RANGE frames),
  which is what an un-framed SQL window does.

``chunked`` is the plan at every size; ``window`` is the direct form of the
same rows, for reading and comparison:

``window``
    The direct form: one hash shuffle on host, LAG + running SUM, then the
    per-session values over ``(host, session number)`` (which re-uses the
    host partitioning, so there is no second shuffle).  Every host is one
    window group, so one very busy host is one task.

``chunked``
    Skew-proof.  Each host's timeline is cut into fixed time chunks no
    wider than the gap (``min(gap, chunk_seconds)``); the windows run per
    ``(host, chunk)``, so a host with a third of all hits is spread over as
    many tasks as it has chunks.  Because a chunk is narrower than the gap,
    a session can only begin at a chunk's first hit, so what crosses a
    chunk border is a per-chunk summary of order-free aggregates (first and
    last epoch, hit count, entry page by ``min_by``), combined map-side
    straight from the hits.  A window over these summaries (one row per host
    and chunk) carries the previous chunk's last epoch, the session number,
    the session's entry page and its hits so far; the result is joined back
    on ``(host, chunk)``, the key the hits are already partitioned by.

:func:`sessionize_from` goes on from a *state*, one row per host seen so far
(its last epoch, session number, entry page and hits of its open session).  A
host's state takes part in the carry as one more chunk, before all others, so
a new day is sessionised from its own hits and the state alone.

:func:`sessionize_bucketed` reads a log whose table is bucketed by host and
chunk; the windows and the join then work inside the buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitscope.functions import patterns as P
from hitscope.functions import session_key

SESSION_COLUMNS = [
    "session_time_difference",
    "is_new_session",
    "session_id",
    "first_visited_page",
    "last_visited_page",
    "page_count",
]
DEFAULT_CHUNK_SECONDS = 600
# Sort key for hits without a time: before every real chunk, as NULL times
# sort first in an ascending window order.
_NO_TIME_CHUNK = -(2**63)
_NO_TIME_ROWS_PER_CHUNK = 1 << 16
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _order(time: str, tie_break: str | None) -> list[Column]:
    return [F.col(time).asc()] + ([F.col(tie_break).asc()] if tie_break else [])


def order_number(time: str, tie_break: str | None) -> Column:
    """Time and whole-number tie-break as one number, a buffer that hash
    aggregation can hold; hits without a time come first."""
    micros = F.coalesce(F.unix_micros(time), F.lit(-9 * 10**17)).cast("decimal(38,0)")
    if not tie_break:
        return micros
    shift = F.lit("100000000000000000000").cast("decimal(21,0)")  # 10^20, over twice the range of a bigint
    return micros * shift + F.coalesce(F.col(tie_break).cast("decimal(20,0)"), F.lit(-(2**63)).cast("decimal(20,0)"))


def _running(w: Window, tie_break: str | None) -> Window:
    if tie_break:
        return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return w.rangeBetween(Window.unboundedPreceding, Window.currentRow)


def sessionize(
    hits: DataFrame,
    gap: int = P.SESSION_GAP_SECONDS,
    host: str = "encrypted_host",
    time: str = "datetime",
    epoch: str = "epoch",
    url: str = "request_url",
    tie_break: str | None = None,
    strategy: str = "chunked",
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
) -> DataFrame:
    """Add the six session columns to every hit (row count unchanged).  Hits
    without a host form one group, as in a window."""
    if strategy == "window":
        return _sessionize_window(hits, gap, host, time, epoch, url, tie_break)
    if strategy == "chunked":
        return _sessionize_chunked(hits, gap, host, time, epoch, url, tie_break, chunk_seconds)
    raise ValueError(f"unknown strategy {strategy!r}")


def _sessionize_window(hits, gap, host, time, epoch, url, tie_break) -> DataFrame:
    by_host = Window.partitionBy(host).orderBy(*_order(time, tie_break))
    td = F.col(epoch) - F.lag(epoch).over(by_host)
    s = (
        hits.withColumn("session_time_difference", td)
        .withColumn(
            "is_new_session",
            F.when(F.col("session_time_difference") >= gap, 1).otherwise(0),
        )
        .withColumn("_sess_no", F.sum("is_new_session").over(_running(by_host, tie_break)))
    )
    by_session = _running(Window.partitionBy(host, "_sess_no").orderBy(*_order(time, tie_break)), tie_break)
    s = (
        s.withColumn("session_id", session_key(host, "_sess_no"))
        .withColumn("first_visited_page", F.first(url).over(by_session))
        .withColumn("last_visited_page", F.last(url).over(by_session))
    )
    s = s.withColumn("page_count", F.count("last_visited_page").over(by_session))
    return s.drop("_sess_no")


#: One row per host: ``host_key`` ("=" and the host; empty for hits without
#: one), then what the carry needs to go on.
STATE_SCHEMA = "host_key string, last_epoch bigint, session_no bigint, entry_page string, session_hits bigint"


def sessionize_from(
    hits: DataFrame,
    state: DataFrame | None,
    gap: int = P.SESSION_GAP_SECONDS,
    host: str = "encrypted_host",
    time: str = "datetime",
    epoch: str = "epoch",
    url: str = "request_url",
    tie_break: str | None = None,
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
) -> tuple[DataFrame, DataFrame]:
    """The session columns of ``hits``, which all come after those that
    ``state`` (:data:`STATE_SCHEMA`; none at the start) has seen, and the state
    after them.  Hosts without new hits keep their state row.  Rows are those of
    :func:`sessionize` over all hits at once."""
    if state is None:
        state = hits.sparkSession.createDataFrame([], STATE_SCHEMA)
    args = (gap, host, time, epoch, url, tie_break, chunk_seconds)
    return _sessionize_chunked(hits, *args, state=state), _next_state(hits, state, *args)


def _sessionize_chunked(hits, gap, host, time, epoch, url, tie_break, chunk_seconds, state=None) -> DataFrame:
    keyed, carry = _carried(hits, gap, host, time, epoch, url, tie_break, chunk_seconds, state)
    return _joined(_chunk_rows(keyed, time, epoch, url, tie_break), carry, gap, host, hits.columns)


def _chunk_rows(keyed, time, epoch, url, tie_break) -> DataFrame:
    """Running values inside each (key, chunk): the only shuffle of the hits."""
    in_chunk = Window.partitionBy("_key", "_chunk").orderBy(*_order(time, tie_break))
    running = _running(in_chunk, tie_break)
    return keyed.withColumns(
        {
            "_rn": F.row_number().over(in_chunk),
            "_lag_gap": F.col(epoch) - F.lag(epoch).over(in_chunk),
            "_cnt": F.count(url).over(running),
            "_last_url": F.last(url).over(running),
        }
    )


def _joined(rows, carry, gap, host, columns) -> DataFrame:
    """The carry joined on the key that the rows are partitioned by."""
    carry = carry.select("_key", "_chunk", "_head_gap", "_sess_no", "_entry", (F.col("_cum") - F.col("_n") - F.col("_start")).alias("_before"))
    j = rows.join(carry, ["_key", "_chunk"], "left")
    td = F.when(F.col("_rn") == 1, F.col("_head_gap")).otherwise(F.col("_lag_gap"))
    out = j.withColumn("session_time_difference", td).withColumns(
        {
            "is_new_session": F.when(F.col("session_time_difference") >= gap, 1).otherwise(0),
            "session_id": session_key(host, "_sess_no"),
            "first_visited_page": F.col("_entry"),
            "last_visited_page": F.col("_last_url"),
            "page_count": F.col("_before") + F.col("_cnt"),
        }
    )
    return out.select(*columns, *SESSION_COLUMNS)


def sessionize_bucketed(
    log: DataFrame,
    width: int,
    gap: int = P.SESSION_GAP_SECONDS,
    host: str = "encrypted_host",
    time: str = "datetime",
    epoch: str = "epoch",
    url: str = "request_url",
    tie_break: str | None = None,
) -> DataFrame:
    """The rows of :func:`sessionize` over a log that is stored by (host, chunk)
    buckets (``sinks.tables.save_bucketed_log``, chunks of ``width`` seconds):
    no hit is exchanged.  A chunk's summary is its first row, with the chunk's
    last time and number of urls; only these rows meet across buckets."""
    if not 1 <= width <= gap:
        raise ValueError(f"chunks of {width} seconds are wider than the gap")
    columns = [c for c in log.columns if c not in LAYOUT]
    rows = _chunk_rows(log.withColumnsRenamed(dict(zip(LAYOUT, ("_key", "_chunk")))), time, epoch, url, tie_break)
    whole = Window.partitionBy("_key", "_chunk").orderBy(*_order(time, tie_break)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    heads = rows.withColumns({"_tail_e": F.max(epoch).over(whole), "_n": F.count(url).over(whole)}).where("_rn = 1")
    summary = heads.select(
        "_key", "_chunk", F.col(epoch).alias("_head_e"), "_tail_e", "_n", F.struct(F.col(url).alias("u")).alias("_head"),
        F.lit(1).alias("_later"), F.lit(0).cast("bigint").alias("_no"),
    )
    return _joined(rows, _carry(summary, gap), gap, host, columns)


def _next_state(hits, state, gap, host, time, epoch, url, tie_break, chunk_seconds) -> DataFrame:
    """The last row of the carry of each host: its state from now on."""
    _, carry = _carried(hits, gap, host, time, epoch, url, tie_break, chunk_seconds, state)
    after = Window.partitionBy("_key").orderBy("_later", "_chunk")
    last = carry.withColumn("_next", F.lead("_key").over(after)).where("_next is null")
    return last.select(
        F.col("_key").alias("host_key"),
        F.col("_tail_e").alias("last_epoch"),
        F.col("_sess_no").cast("bigint").alias("session_no"),
        F.col("_entry").alias("entry_page"),
        (F.col("_cum") - F.col("_start")).alias("session_hits"),
    )


#: Columns of a log that is stored by (host, chunk) buckets.
LAYOUT = ("host_key", "time_chunk")


def with_chunks(
    hits: DataFrame, width: int, host: str = "encrypted_host", epoch: str = "epoch", tie_break: str | None = None,
    key: str = LAYOUT[0], chunk: str = LAYOUT[1],
) -> DataFrame:
    """Every hit with its host's key (never NULL) and its chunk of ``width`` seconds."""
    no_time = F.lit(_NO_TIME_CHUNK)
    if tie_break and isinstance(hits.schema[tie_break].dataType, _INTEGRAL):
        # Hits without a time sort first, in tie-break order; spread them over
        # chunks of tie-break ranges below every real chunk, so a host whose
        # times do not parse is not one task either.
        no_time = no_time + F.coalesce(
            F.floor(F.greatest(F.col(tie_break), F.lit(0)) / F.lit(_NO_TIME_ROWS_PER_CHUNK)), F.lit(0)
        )
    # A key that is never NULL: hits without a host are a group like any other,
    # and the carry meets them by plain equality on the hits' own partitioning.
    chunks = F.coalesce(F.floor(F.col(epoch) / F.lit(width)), no_time)
    return hits.withColumn(chunk, chunks).withColumn(key, F.coalesce(F.concat(F.lit("="), F.col(host)), F.lit("")))


def _carried(hits, gap, host, time, epoch, url, tie_break, chunk_seconds, state) -> tuple[DataFrame, DataFrame]:
    """The hits with their key and chunk, and one row per key and chunk (and per
    row of ``state``) with what comes before it."""
    if gap < 1:
        raise ValueError("gap must be at least 1 second")
    # Chunks are never wider than the gap: two hits of one chunk are less
    # than ``gap`` apart, so a session can only start at a chunk's first hit
    # and the per-chunk summary needs no ordering inside the chunk.
    width = min(int(gap), int(chunk_seconds))
    keyed = with_chunks(hits, width, host, epoch, tie_break, "_key", "_chunk")
    order = F.struct(F.col(time), F.col(tie_break)) if tie_break else F.struct(F.col(time))

    # Summary: one row per (host, chunk), combined map-side straight from the
    # hits (only partial aggregates cross the network).
    summary = keyed.groupBy("_key", "_chunk").agg(
        F.min(epoch).alias("_head_e"),
        F.max(epoch).alias("_tail_e"),
        F.count(url).alias("_n"),
        F.min_by(F.struct(F.col(url).alias("u")), order).alias("_head"),
    )

    summary = summary.withColumns({"_later": F.lit(1), "_no": F.lit(0).cast("bigint")})
    if state is not None:  # as a chunk before all others, which ends its open session's hits so far
        summary = summary.unionByName(
            state.select(
                F.col("host_key").alias("_key"),
                F.lit(_NO_TIME_CHUNK).alias("_chunk"),
                F.col("last_epoch").alias("_head_e"),
                F.col("last_epoch").alias("_tail_e"),
                F.col("session_hits").alias("_n"),
                F.struct(F.col("entry_page").alias("u")).alias("_head"),
                F.lit(0).alias("_later"),
                F.col("session_no").alias("_no"),
            )
        )

    return keyed, _carry(summary, gap)


def _carry(summary: DataFrame, gap: int) -> DataFrame:
    """What comes before each chunk, per host in chunk order: at most one row
    per chunk, so even the busiest host is a small group here."""
    by_chunk = Window.partitionBy("_key").orderBy("_later", "_chunk")
    upto = by_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        summary.withColumn("_head_gap", F.col("_head_e") - F.lag("_tail_e").over(by_chunk))
        .withColumn("_head_flag", F.when(F.col("_head_gap") >= gap, 1).otherwise(0))
        .withColumn("_resets", (F.row_number().over(by_chunk) == 1) | (F.col("_head_flag") == 1))
        .withColumn("_cum", F.sum("_n").over(upto))
        .withColumns(
            {
                "_sess_no": F.sum(F.col("_head_flag") + F.col("_no")).over(upto),
                "_entry": F.last(F.when(F.col("_resets"), F.col("_head")), ignorenulls=True)
                .over(upto)
                .getField("u"),
                "_start": F.last(F.when(F.col("_resets"), F.col("_cum") - F.col("_n")), ignorenulls=True).over(
                    upto
                ),
            }
        )
    )


def session_rollup(
    sessions: DataFrame,
    duration_gap: int = P.DURATION_GAP_SECONDS,
    time: str = "datetime",
    tie_break: str | None = None,
    host: str = "encrypted_host",
) -> DataFrame:
    """One row per session: totals that sit on its last hit.

    ``duration`` sums the gaps ``<= duration_gap`` (NULL when the session has
    none, A7).  The hits are aggregated by hash, one number for the latest hit
    of each page of a session; text is compared over those rows only.  Both
    steps combine map-side, so a huge session is never gathered in one place.
    Equal times without a tie-break go to the larger page."""
    td = F.col("session_time_difference")
    pages = sessions.groupBy("session_id", host, "first_visited_page", "last_visited_page").agg(
        F.min(time).alias("_start"),
        F.max(time).alias("_end"),
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(td <= duration_gap, td)).alias("_duration"),
        F.max(order_number(time, tie_break)).alias("_last"),
    )
    return pages.groupBy("session_id", host).agg(
        F.min("_start").alias("session_start"),
        F.max("_end").alias("session_end"),
        F.sum("_n").alias("hits"),
        F.sum("_duration").alias("duration"),
        F.first("first_visited_page").alias("entry_page"),
        F.max(F.struct("_last", "last_visited_page")).getField("last_visited_page").alias("exit_page"),
    )
