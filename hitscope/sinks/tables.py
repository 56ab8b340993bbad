"""Sinks: routed outputs (S6), the partitioned log (S7, S9, C4), tables over
output folders (S8), idempotent insight publishing (S10, C11) and landing of
new days only (S11, C12).

All writes go through Spark's commit protocol, so a lost executor's tasks
are retried without partial output.  Files are Parquet between stages (CSV
does not survive a country name with a comma).  Reruns are per-day dynamic
partition overwrites: writing a day replaces that day and nothing else.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitscope import schemas
from hitscope.config import scratch_path
from hitscope.operators.sessions import DEFAULT_CHUNK_SECONDS, LAYOUT, with_chunks

LOG_PARTITIONS = ["year", "month", "day"]


# S6 ---------------------------------------------------------------------------------
def write_routed(routes: dict[str, DataFrame], out_dir: str) -> None:
    """One overwritten folder per routed stream: the raw 8 fields for null
    hits, the 5 routed fields for rejected / page / non-page, the enriched
    11 fields for the tagged log, the 17 session fields for session hits."""
    shapes = {
        "null": schemas.ACCESS_LOG_FIELDS,
        "rejected": schemas.ROUTED_FIELDS,
        "page": schemas.ROUTED_FIELDS,
        "non_page": schemas.ROUTED_FIELDS,
        "enriched": schemas.ENRICHED_FIELDS,
        "session": schemas.SESSION_FIELDS,
    }
    for name, cols in shapes.items():
        if name in routes:
            routes[name].select(*cols).write.mode("overwrite").parquet(f"{out_dir}/{name}")


# S7 / S9 / C4 ---------------------------------------------------------------------------
def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: list[str] = LOG_PARTITIONS,
    sort_cols: list[str] | None = None,
) -> None:
    """Dynamic-partition overwrite: only the partitions present in ``df``
    are replaced.  Rows are clustered by partition before writing with a
    ``rebalance`` hint: AQE splits a partition that is too large (one busy
    day is spread over many tasks) and merges small ones, so tasks write
    few, reasonably sized files.  Instead of a global sort, rows are sorted
    within each task by ``sort_cols``.  A folder that a stream writes is
    refused: its readers list only the stream's own files."""
    fs, root, jvm = _hadoop_fs(df.sparkSession, path)
    if fs.exists(jvm.org.apache.hadoop.fs.Path(root, "_spark_metadata")):
        raise ValueError(f"{path} belongs to a stream")
    out = df.hint("rebalance", *partition_cols)
    if sort_cols:
        out = out.sortWithinPartitions(*partition_cols, *sort_cols)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def write_sessions(sessions: DataFrame, path: str, keep: list[str] | None = None) -> None:
    """Session hits by day, in (host, time) order within each file: what a
    later run reads back as its history."""
    write_partitioned(
        sessions.select(*schemas.SESSION_FIELDS, *(keep or [])), path, sort_cols=["encrypted_host", "datetime", *(keep or [])]
    )


def save_partitioned_table(df: DataFrame, name: str, partition_cols: list[str] = LOG_PARTITIONS) -> None:
    """A managed, partitioned catalog table (dynamic overwrite)."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df.select(*spark.table(name).columns).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).insertInto(name)
    else:
        df.write.partitionBy(*partition_cols).format("parquet").saveAsTable(name)


_CHUNK_PROPERTY = "hitscope.chunk_seconds"


def save_bucketed_log(
    df: DataFrame, name: str, buckets: int, chunk_seconds: int = DEFAULT_CHUNK_SECONDS, sort_cols: Iterable[str] = ("datetime",),
    host: str = "encrypted_host", epoch: str = "epoch", tie_break: str | None = None,
) -> None:
    """S9 in a layout for sessions and country tags: a managed table bucketed
    and sorted by the host's key and its chunk of ``chunk_seconds``.  A bucket
    is one file, written by one task; a host with a third of all hits lies in
    as many buckets as it has chunks.  The chunk width goes with the table."""
    keyed = with_chunks(df, chunk_seconds, host, epoch, tie_break)
    writer = keyed.repartition(buckets, *LAYOUT).write.bucketBy(buckets, *LAYOUT).sortBy(*LAYOUT, *sort_cols)
    writer.format("parquet").mode("overwrite").saveAsTable(name)
    df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_CHUNK_PROPERTY}' = '{int(chunk_seconds)}')")


def read_bucketed_log(spark: SparkSession, name: str) -> tuple[DataFrame, int]:
    """A table of :func:`save_bucketed_log` and its chunk width."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if _CHUNK_PROPERTY not in found:
        raise ValueError(f"{name} is not stored by host and chunk")
    return spark.table(name), int(found[_CHUNK_PROPERTY])


def create_external_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partition_cols: list[str] | None = None
) -> DataFrame:
    """A catalog table over an output folder, with a declared schema; the
    partitions present in the folder are registered."""
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    cols = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    by = f" PARTITIONED BY ({', '.join(map(quoted, partition_cols))})" if partition_cols else ""
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{by} LOCATION '{place}'")
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


# O4 --------------------------------------------------------------------------------
def write_ordered(df: DataFrame, path: str, cols: list[str], files: int | None = None) -> None:
    """One total order over all files: the rows of a file come after those
    of all files with smaller numbers, and each file is in order.  Rows are
    range partitioned on all of ``cols``, so a host that holds a third of them
    spans files if a time follows it in ``cols``."""
    ranged = df.repartitionByRange(files, *cols) if files else df.repartitionByRange(*cols)
    ranged.sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_ordered` wrote, each row with its ``position`` from 1 in
    the order of all files (file number, then place in the file)."""
    rows = spark.read.parquet(path).withColumns(
        {"_file": F.regexp_extract(F.col("_metadata.file_name"), "part-([0-9]+)", 1).cast("int"), "_at": F.col("_metadata.row_index")}
    )
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))  # a row per file
    w = Window.partitionBy(F.lit(0)).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_file", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    return rows.join(before, "_file").withColumn("position", F.col("_before") + F.col("_at") + 1).drop("_file", "_at", "_before")


# S10 / C11 -----------------------------------------------------------------------------
def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def drop_partitions(spark: SparkSession, path: str, column: str, values: Iterable[str]) -> None:
    """Remove ``column=value`` partition folders (a rerun that produces no
    rows for a day must still clear that day)."""
    fs, root, jvm = _hadoop_fs(spark, path)
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(root, f"{column}={v}")
        if fs.exists(p):
            fs.delete(p, True)


def publish(
    df: DataFrame, path: str, dates: Iterable[str] | None = None, key: str = "insight_date", sort_cols: Iterable[str] = ()
) -> None:
    """Idempotent publish keyed by day: the days in ``dates`` (or in ``df``)
    are replaced as a whole; other days stay.  Rows keep their full natural
    key (no collapsing of rows that share a measure) and are sorted by
    ``sort_cols`` within each file.

    The new rows are written first, by a dynamic overwrite that commits at its
    end, so a job that fails leaves the published days as they were.  Only
    then are those of ``dates`` cleared that the new data has no rows for."""
    dates = None if dates is None else list(dates)
    out = df if dates is None else df.where(F.col(key).isin(dates))
    before = _partition_files(df.sparkSession, path, key, dates or ())
    (
        out.hint("rebalance", key)
        .sortWithinPartitions(key, *(F.col(c).desc() if c.endswith("count") or c == "measure_value" else F.col(c) for c in sort_cols))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )
    # a day that still has its old files was not written: it has no rows now
    after = _partition_files(df.sparkSession, path, key, dates or ())
    drop_partitions(df.sparkSession, path, key, [d for d, files in before.items() if files and files == after[d]])


def _partition_files(spark: SparkSession, path: str, column: str, values: Iterable[str]) -> dict[str, set[str]]:
    """File names in each ``column=value`` folder (every write gives new ones)."""
    fs, root, jvm = _hadoop_fs(spark, path)
    out = {}
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(root, f"{column}={v}")
        out[v] = {s.getPath().getName() for s in fs.listStatus(p)} if fs.exists(p) else set()
    return out


def upsert(df: DataFrame, path: str, keys: Iterable[str], partition: str = "insight_date") -> None:
    """S10 by primary key (the partition column and ``keys``): rows of ``df``
    replace the rows that have their keys and join the others.  Only partitions
    that ``df`` touches are read, and one dynamic overwrite, which commits at its
    end, replaces them.  A NULL in a key is a value; of rows of ``df`` with
    equal keys the one with the greatest other columns stays."""
    spark = df.sparkSession
    by = [partition, *keys]
    rest = [c for c in df.columns if c not in by]
    one = df.groupBy(*by).agg(F.max(F.struct(*rest)).alias("row")).select(*by, "row.*") if rest else df.select(*by).distinct()
    # stored first: it is read three times, and the target must not change while it is read
    new = _staged(one.select(*df.columns), "upsert")
    touched = [r[0] for r in new.select(partition).distinct().collect()]  # partitions, a few
    if not touched:
        return
    fs, root, _ = _hadoop_fs(spark, path)
    if fs.exists(root):
        old = spark.read.schema(new.schema).option("basePath", path).parquet(path)
        same = [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in by]
        old = old.where(F.col(partition).isin(touched)).select(*df.columns).alias("old")
        met = same[0]
        for c in same[1:]:
            met = met & c
        new = _staged(old.join(new.alias("new"), met, "left_anti").unionByName(new), "upsert")
    write_partitioned(new, path, [partition], sort_cols=list(keys))


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def publish_insights(
    daily: DataFrame,
    pages: DataFrame,
    countries: DataFrame,
    root: str,
    dates: Iterable[str] | None = None,
) -> None:
    """C11: the three insight tables under ``root``."""
    ds = list(dates) if dates is not None else None
    publish(daily, f"{root}/daily_insights", ds)
    publish(pages, f"{root}/page_insights", ds, sort_cols=["query_type", "measure_value", "request_url"])
    publish(countries, f"{root}/country_insights", ds, sort_cols=["page_request_count", "country_name"])


def read_published(spark: SparkSession, root: str, table: str, key: str = "insight_date") -> DataFrame:
    """A published table; the day key is read back as the text it was
    written as (partition discovery would otherwise type it as a date)."""
    df = spark.read.option("basePath", f"{root}/{table}").parquet(f"{root}/{table}")
    return df.withColumn(key, F.col(key).cast("string"))


# S11 / C12 -----------------------------------------------------------------------------
LANDED = "_landed"  # one empty file for each landed day, written after its rows


def source_days(spark: SparkSession, root: str, column: str = "day") -> list[str]:
    """Days that have a folder under ``root`` (one listing; days, not rows,
    come to the driver)."""
    fs, p, _ = _hadoop_fs(spark, root)
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()] if fs.exists(p) else []
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def landed_days(spark: SparkSession, root: str, column: str = "day") -> list[str]:
    """Days whose landing was committed: those with a marker.  A folder alone
    may be half a day."""
    fs, p, jvm = _hadoop_fs(spark, f"{root}/{LANDED}")
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def land_new_days(spark: SparkSession, src_root: str, dst_root: str, column: str = "day") -> list[str]:
    """Copy raw log days from ``src_root`` to ``dst_root`` unless the day is
    already landed; a rerun lands nothing twice.  The days to land become a
    partition filter, so no other day is read.  A dynamic overwrite replaces
    what an earlier, failed run may have left of them, and the markers are set
    after its commit.  Returns the newly landed days."""
    done = set(landed_days(spark, dst_root, column))
    fresh = [d for d in source_days(spark, src_root, column) if d not in done]
    if fresh:
        src = spark.read.schema(f"value string, {column} string").text(src_root)
        (
            src.where(F.col(column).isin(fresh))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(column)
            .text(dst_root)
        )
        fs, p, jvm = _hadoop_fs(spark, f"{dst_root}/{LANDED}")
        for d in fresh:
            fs.create(jvm.org.apache.hadoop.fs.Path(p, d), True).close()
    return fresh


MANIFEST = "_manifest"  # one row for each landed file, written after its rows
_MANIFEST_SCHEMA = "name string, length bigint, modified timestamp, batch string"


def _source_files(spark: SparkSession, root: str, column: str) -> DataFrame:
    """Files under the day folders of ``root``, from a listing (no content)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.select(
        F.regexp_extract("path", f"({column}=[^/]*/[^/]+)$", 1).alias("name"), "length", F.col("modificationTime").alias("modified")
    ).where("name != ''")


def _manifest(spark: SparkSession, dst_root: str) -> DataFrame:
    fs, p, _ = _hadoop_fs(spark, f"{dst_root}/{MANIFEST}")
    if not fs.exists(p):
        return spark.createDataFrame([], _MANIFEST_SCHEMA)
    return spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{dst_root}/{MANIFEST}")


def land_new_files(spark: SparkSession, src_root: str, dst_root: str, column: str = "day") -> list[str]:
    """C12 by file: lands the files of ``src_root/day=.../`` that the manifest
    does not list with their length and time, so a file that arrives late in a
    landed day is landed too, alone.  The rows of a run are one batch folder; the
    manifest rows, written after them, commit it.  What a failed run left has no
    manifest row: it is not read, and the next run removes it.  A file that has
    changed is landed again and replaces its old rows.  Returns the names."""
    keys = ["name", "length", "modified"]
    done = _manifest(spark, dst_root)
    fresh = _source_files(spark, src_root, column).join(done, keys, "left_anti").orderBy("name").collect()  # names, as a scan lists them
    fs, root, jvm = _hadoop_fs(spark, dst_root)
    committed = {r[0] for r in done.select("batch").distinct().collect()}
    for s in fs.listStatus(root) if fs.exists(root) else []:
        name = s.getPath().getName()
        if name.startswith("batch=") and name[6:] not in committed:
            fs.delete(s.getPath(), True)
    if fresh:
        batch = uuid.uuid4().hex[:12]
        reader = spark.read.schema(f"value string, {column} string").option("basePath", src_root)
        rows = reader.text([f"{src_root}/{r['name']}" for r in fresh])
        rows.withColumn("file", F.col("_metadata.file_name")).write.partitionBy(column).parquet(f"{dst_root}/batch={batch}")
        listed = [(r["name"], r["length"], r["modified"], batch) for r in fresh]
        spark.createDataFrame(listed, _MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{dst_root}/{MANIFEST}")
    return [r["name"] for r in fresh]


def read_landed_files(spark: SparkSession, dst_root: str, column: str = "day") -> DataFrame:
    """(value, day) of all committed files, each in its newest version."""
    newest = _manifest(spark, dst_root).groupBy("name").agg(F.max_by("batch", "modified").alias("batch"))
    rows = spark.read.schema(f"value string, file string, batch string, {column} string").parquet(dst_root)
    rows = rows.withColumn("name", F.concat(F.lit(f"{column}="), F.col(column), F.lit("/"), F.col("file")))
    return rows.join(newest, ["name", "batch"], "left_semi").select("value", column)
