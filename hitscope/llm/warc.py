"""WARC archives: write, read, and assemble transactions.

Writing: each page gives a response (or revisit), a request and a metadata
record; the last two name the first through WARC-Concurrent-To.  Among pages
with equal payloads of at least ``min_bytes`` bytes, the one with the largest
page id is the response, the others revisit it.  Spark's text writer puts the
records into gzip files with the record separator as line end, so files land
by its commit protocol, on any store, and survive lost executors.

Reading: the text reader cuts files at version lines (WARC/1.0 and 1.1); a
Python step takes Content-Length and puts pieces back together where a payload
held such a line itself.  It keeps one record at a time, ``MAX_RECORD`` bytes at
most.  Nothing is lost: a record must end as its length says, and what does not
becomes a row of type ``malformed`` with its bytes and the problem (no length,
wrong length, cut off, too long, no version line), after which reading goes on
at the next version line.  ``record_bytes`` of all rows add up to the files.

Assembly: requests and metadata join their response through the concurrent-to
identifier, revisits join the response that they refer to, and each capture
becomes one nested row.

Defined cases: null html is an empty payload; a null url is written as
``urn:unknown``; a null page id is written as an empty field, read back as
null, and never is the response of a group with another id; rows with the
group's largest id, repeats included, are all responses.  Columns beyond id,
url and html are not archived.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitscope.config import scratch_path
from hitscope.llm.runtime import prepare, stored

MIN_BYTES = 1000
VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
LINE = "WARC/1."  # how the version line of any record begins
MAX_RECORD = 256 << 20
MAX_HEAD = 1 << 20
RECORDS_PER_FILE = 30_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

RECORD = (
    "record_id string, type string, target_uri string, concurrent_to string, refers_to string, content_type string, "
    "digest string, block_bytes long, payload_bytes long, payload_digest string, payload binary, record_bytes long, problem string"
)


def _urn(*parts: Column) -> Column:
    """A stable record id."""
    h = F.md5(F.concat_ws("\n", *(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts)))
    piece = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *piece), F.lit(">"))


def _record(kind: str, fields: list[tuple[str, Column]], block: Column) -> Column:
    head = [F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")) for k, v in fields]
    return F.concat(
        F.lit(f"{VERSION}WARC-Type: {kind}\r\n"), *head,
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block,
    )


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = MIN_BYTES, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes ``pages`` as gzip archives into the folder ``path``."""
    prepare(pages.sparkSession)
    page = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("payload"),
    ).withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    # only groups of equal large payloads meet the pages again; as a written
    # table, so that the adaptive plan can split a hot payload's partition
    groups = stored(
        page.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes")
        .agg(F.max(F.struct("id", "url")).alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(F.col("digest").alias("g_digest"), F.col("bytes").alias("g_bytes"), "head"),
        "groups",
    )
    joined = page.join(groups, (F.col("digest") == F.col("g_digest")) & (F.col("bytes") == F.col("g_bytes")), "left")
    own = _urn(F.col("id"), F.col("url"), F.col("digest"))
    first = _urn(F.col("head.id"), F.col("head.url"), F.col("digest"))
    revisit = F.col("head").isNotNull() & ~F.col("id").eqNullSafe(F.col("head.id"))
    target = F.coalesce(F.regexp_replace("url", r"[\r\n]", " "), F.lit("urn:unknown"))
    stamp = lambda i: [("WARC-Record-ID", i), ("WARC-Date", F.lit(date)), ("WARC-Target-URI", target)]
    http = F.concat(F.lit(f"{HTTP}Content-Length: "), F.col("bytes").cast("string"), F.lit(END))
    sha1 = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"))
    answer = ("Content-Type", F.lit("application/http;msgtype=response"))
    line = F.regexp_replace(F.regexp_extract(target, r"^[^:]*://[^/?#]*([^#]*)", 1), r"\s", "%20")
    host = F.regexp_extract(target, r"^[^:]*://([^/?#\s]*)", 1)
    records = F.array(
        F.when(revisit, _record("revisit", [*stamp(own), ("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", first), sha1, answer], http))
        .otherwise(_record("response", [*stamp(own), sha1, answer], F.concat(http, "payload"))),
        _record(
            "request", [*stamp(_urn(F.lit("request"), own)), ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/http;msgtype=request"))],
            F.concat(F.lit("GET "), F.when(line == "", "/").otherwise(line), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END)),
        ),
        _record(
            "metadata", [*stamp(_urn(F.lit("metadata"), own)), ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/warc-fields"))],
            F.concat(F.lit("page-id: "), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("\r\n")),
        ),
    )
    joined.select(F.explode(records).alias("value")).write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).text(path)


def _headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


class _Reader:
    """Pieces of one file, in order, to rows of ``RECORD``."""

    def __init__(self, with_payload: bool, most: int):
        self.with_payload, self.most = with_payload, most
        self.rows: list[tuple] = []
        self.held: list[bytes] = []
        self.clear()

    def clear(self):
        self.held, self.size, self.need, self.head, self.start = [], 0, None, {}, 0

    def bad(self, piece: bytes, problem: str):
        seen = piece if self.with_payload else None
        self.rows.append((None, "malformed", *[None] * 5, len(piece), None, None, seen, len(piece), problem))

    def good(self, record: bytes):
        h, kind = self.head, self.head.get("warc-type")
        block = record[self.start : self.need]
        payload = None
        if h.get("content-type", "").startswith("application/http"):
            payload = block.partition(END.encode())[2]
        elif kind != "warcinfo":
            payload = block
        seen = payload if kind != "revisit" else None
        self.rows.append((
            h.get("warc-record-id"), kind, h.get("warc-target-uri"), h.get("warc-concurrent-to"), h.get("warc-refers-to"),
            h.get("content-type"), h.get("warc-payload-digest", "").removeprefix("sha1:") or None, len(block),
            None if seen is None else len(seen), None if seen is None else hashlib.sha1(seen).hexdigest(),
            seen if self.with_payload or kind == "metadata" else None, len(record), None,
        ))

    def again(self, problem: str):
        """The first held piece is malformed; the others are read anew."""
        first, *rest = self.held
        self.clear()
        self.bad(LINE.encode() + first, problem)
        for piece in rest:
            self.push(piece)

    def push(self, piece: bytes):
        """The next piece, without the ``LINE`` before it."""
        if not self.held and piece[:3] not in (b"0\r\n", b"1\r\n"):
            self.bad(LINE.encode() + piece, "no version line")
            return
        self.held.append(piece)
        self.size += len(LINE) + len(piece)
        if self.need is None:
            record = self.record()
            cut = record.find(END.encode())
            if cut < 0:
                if len(record) > MAX_HEAD:
                    self.again("no end of headers")
                return
            self.head, self.start = _headers(record[:cut]), cut + len(END)
            length = self.head.get("content-length", "")
            if not (length.isascii() and length.isdigit()):
                self.again("no length")
                return
            self.need = self.start + int(length)
        if self.need > self.most:
            self.again("too long")
        elif self.size >= self.need + len(END):
            self.end()

    def record(self) -> bytes:
        return b"".join(LINE.encode() + p for p in self.held)

    def end(self):
        """All bytes that the length asks for are there."""
        record = self.record()
        if record[self.need :].strip(b"\r\n"):
            self.again("wrong length")
        else:
            self.good(record)
            self.clear()

    def finish(self):
        """The file ends."""
        while self.held:
            if self.need is not None and self.size >= self.need:
                self.end()
            else:
                self.again("cut off")


def _parse(with_payload: bool, most: int = MAX_RECORD):
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]] for f in RECORD.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, file = _Reader(with_payload, most), None
        for b in batches:
            for name, piece in zip(b.column("file").to_pylist(), b.column("value").to_pylist()):
                if name != file:  # what stands before the first version line is usually empty
                    reader.finish()
                    file = name
                    if piece:
                        reader.bad(piece, "no version line")
                else:
                    reader.push(piece)
            if reader.rows:
                yield batch(reader.rows)
                reader.rows = []
        reader.finish()
        if reader.rows:
            yield batch(reader.rows)

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record (see ``RECORD``); digests and lengths are taken from
    the bytes read.  Gzip files only: they are not split within a record."""
    prepare(spark)
    raw = spark.read.option("lineSep", LINE).text(path)
    pieces = raw.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    return pieces.mapInArrow(_parse(with_payload), RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: record_id, target_uri, type, response,
    request, metadata, and for a revisit the response that it refers to
    (without payload) and that one's metadata: original, original_metadata."""
    names = records.columns
    nest = lambda df, name: df.select(F.struct(*df.columns).alias(name))
    # a repeated capture has repeated records; one of each is enough to describe it
    beside = lambda kind, name: nest(records.where(F.col("type") == kind).dropDuplicates(["concurrent_to"]), name)
    captures = nest(records.where(F.col("type").isin("response", "revisit")).select(*names), "response")
    needed = records.where("type = 'revisit'").select(F.col("refers_to").alias("record_id")).distinct()
    originals = stored(nest(
        records.where("type = 'response'").drop("payload").dropDuplicates(["record_id"]).join(needed, "record_id"), "original"
    ).join(beside("metadata", "original_metadata"), F.col("original.record_id") == F.col("original_metadata.concurrent_to"), "left"), "originals")
    return (
        captures.join(beside("request", "request"), F.col("response.record_id") == F.col("request.concurrent_to"), "left")
        .join(beside("metadata", "metadata"), F.col("response.record_id") == F.col("metadata.concurrent_to"), "left")
        .join(originals, F.col("response.refers_to") == F.col("original.record_id"), "left")
        .select(F.col("response.record_id").alias("record_id"), F.col("response.target_uri").alias("target_uri"),
                F.col("response.type").alias("type"), "response", "request", "metadata", "original", "original_metadata")
    )


def page_id_of(metadata: str) -> Column:
    """The page id in a metadata record's payload."""
    return F.expr(f"try_cast(nullif(regexp_extract(cast({metadata}.payload as string), 'page-id: ([0-9-]*)', 1), '') as bigint)")


def round_trip(pages: DataFrame, with_payload: bool = True, **columns) -> DataFrame:
    """Writes archives under the shared checkpoint folder and assembles what
    is read back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, **columns)
    return assemble(stored(read_archives(pages.sparkSession, path, with_payload), "records"))
