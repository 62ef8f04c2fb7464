"""Time-chunked Parquet tables: partitioned write, insert-if-absent, pruned read.

Layout per table: ``partitionBy(chunk)`` where ``chunk`` is the table's time
column truncated to a week or month (the reference's 7- and 30-day chunks).
Rows are range-partitioned on (chunk, lookup keys, time) before the write,
so one hot chunk is split over many tasks, and each file is sorted by the
lookup order: Parquet min/max statistics then skip row groups for the key and
time filters that serve queries use (the reference's indexes).

Writes are idempotent by key: new rows are de-duplicated within the batch and
anti-joined with the existing table on (chunk, key...). ``chunk`` is the
partition column and the existing side is filtered to the chunks the batch
touches, so the anti-join reads only those partitions, never the table.

A table with ``counted`` columns keeps a small table beside it, ``<path>_counts``: rows
per chunk and value of these columns, one set of rows a write. The newest rows are then
read from the newest chunks that are known to hold enough of them (``read_newest``).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.columns import keep_first


@dataclass(frozen=True)
class TableSpec:
    name: str
    time_col: str
    key: tuple[str, ...]
    lookup: tuple[str, ...]
    chunk: str = "week"      # 'week' (7-day chunks) or 'month' (30-day chunks)
    # Rows per chunk and value of these are kept beside the table: columns of a few fixed values.
    counted: tuple[str, ...] | None = None


# Intended keys: the reference declares none, so reruns duplicate there.
RAW_LEAD = TableSpec("raw_lead", "event_time_utc", ("instrument_id", "event_time_utc", "source"),
                     ("instrument_id",))
RAW_REFERENCE = TableSpec("raw_reference", "event_time_utc",
                          ("instrument_id", "event_time_utc", "source"), ("instrument_id",))
# Daily rows: a week of a symbol is five bars, so these tables take wider chunks than the raw ones.
BARS = TableSpec("aligned_bars", "date", ("date", "horizon", "symbol"), ("horizon", "symbol"), chunk="month")
METRICS = TableSpec("relationship_metrics", "date", ("date", "horizon", "symbol", "metric"),
                    ("metric", "horizon", "symbol"), chunk="month")
ALERTS = TableSpec("alerts", "fired_at", ("fired_at", "kind", "symbol", "horizon"), (),
                   chunk="month", counted=("kind",))


def chunk_of(time_col: str | Column, unit: str = "week") -> Column:
    c = F.col(time_col) if isinstance(time_col, str) else time_col
    return F.date_trunc(unit, c).cast("date")


def with_chunk(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumn("chunk", chunk_of(spec.time_col, spec.chunk))


def write_partitioned(df: DataFrame, path: str, spec: TableSpec, *,
                      mode: str = "append") -> None:
    """Write ``df`` partitioned by chunk, range-partitioned and sorted by the
    lookup order within each chunk. The number of ranges is left to the
    adaptive plan, which joins small ones, so little data makes few files."""
    d = df if "chunk" in df.columns else with_chunk(df, spec)
    order = ["chunk", *spec.lookup, spec.time_col]
    (d.repartitionByRange(*order)
      .sortWithinPartitions(*order)
      .write.mode(mode).partitionBy("chunk").parquet(path))


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table at ``path`` or None when it does not exist yet."""
    try:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e) \
                or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def read_text(spark: SparkSession, path: str) -> str | None:
    """The first text line at ``path`` that looks like JSON, or None when there is no file."""
    try:
        rows = [r[0] for r in spark.read.text(path).head(5)]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise
    return next((x for x in rows if x.startswith("{")), None)


def declare(df: DataFrame, path: str) -> None:
    """An empty file with ``df``'s schema in the oldest chunk: a table without rows can be read."""
    df.drop("chunk").limit(0).write.mode("append").parquet(f"{path}/chunk=1970-01-01")


def absent(rows: DataFrame, existing: DataFrame, chunks: list, spec: TableSpec) -> DataFrame:
    """``rows`` whose key is not in the ``chunks`` of the table yet.

    The join sorts both sides: stored keys are many times their compressed files, by whose
    size Spark would send them whole through the driver.
    """
    touched = existing.where(F.col("chunk").isin(chunks)).select("chunk", *spec.key)
    return rows.join(touched.hint("merge"), ["chunk", *spec.key], "left_anti")


def insert_if_absent(new: DataFrame, path: str, spec: TableSpec, *,
                     order: list[Column] | None = None) -> int:
    """Append rows whose key is not in the table yet; return rows written.

    Only the partitions (chunks) the new rows fall in are read from the
    existing table: the distinct chunk values of the batch -- a list bounded
    by its time span (about 53 per year), not by its size -- become a
    partition filter, so the anti-join never scans or shuffles the rest.
    """
    spark = new.sparkSession
    rows = with_chunk(new, spec)
    # The batch is computed once and kept: its chunks, the count and the write all read it.
    # (Observed counts are not delivered inside a streaming foreachBatch.)
    rows = keep_first(rows, spec.key, order or [F.col(c) for c in rows.columns]).persist()
    fresh, existing = rows, read_table(spark, path)
    try:
        if existing is not None:
            chunks = [r[0] for r in rows.select("chunk").distinct().collect()]
            fresh = absent(rows, existing, chunks, spec).persist()
        counted = spec.counted or ()
        if counted:
            # Taken before the write, after which Spark refreshes what is cached from this path.
            per = fresh.groupBy("chunk", *counted).agg(F.count(F.lit(1)).alias("n_rows"))
            noted = per.collect()
            n = sum(r["n_rows"] for r in noted)
        else:
            n = fresh.count()
        if n:
            write_partitioned(fresh, path, spec, mode="append")
            # The counts follow the rows: a write that is cut short between them leaves
            # counts too low, which only makes readers take more chunks.
            if counted:
                spark.createDataFrame(noted, per.schema).coalesce(1).write.mode("append").parquet(f"{path}_counts")
        elif existing is None:
            declare(fresh, path)
        return n
    finally:
        fresh.unpersist()
        rows.unpersist()


def newest_chunk(spark: SparkSession, path: str, spec: TableSpec, limit: int,
                 where: dict | None = None):
    """The oldest chunk that is needed for the ``limit`` newest rows, or None for all of them.

    ``where`` holds equal values of ``counted`` columns. The counts, summed per chunk, are a row a
    chunk, bounded by the table's time span. Rows without a time are the oldest and have no chunk.
    """
    counts = read_table(spark, f"{path}_counts")
    if counts is None:
        return None
    for k, v in (where or {}).items():
        counts = counts.where(F.col(k) == F.lit(v))
    per = (counts.where(F.col("chunk").isNotNull()).groupBy("chunk").agg(F.sum("n_rows").alias("n_rows"))
                 .orderBy(F.col("chunk").desc()).collect())
    have = 0
    for r in per:
        have += r["n_rows"]
        if have >= limit:
            return r["chunk"]
    return None


def read_newest(spark: SparkSession, path: str, spec: TableSpec, limit: int,
                where: dict | None = None) -> DataFrame:
    """Rows among which the ``limit`` newest with these values are: whole chunks from the newest on.

    Chunks follow the time column, so every row left out is older than all of ``limit`` rows
    that are read, and ties at the cut lie in one chunk. Rows that are not counted do no harm,
    wherever they lie; rows are never taken out of a counted table. With fewer than ``limit``
    known, without counts, or with other columns in ``where``, the table is read whole.
    """
    df = spark.read.parquet(path)
    start = None
    if set(where or {}) <= set(spec.counted or ()):
        start = newest_chunk(spark, path, spec, limit, where)
    if start is not None:
        df = df.where(F.col("chunk") >= F.lit(start))
    for k, v in (where or {}).items():
        df = df.where(F.col(k) == F.lit(v))
    return df


def input_stamp(spark: SparkSession, *paths: str) -> str:
    """Names the present files under the paths by their names, sizes and times; no content is read."""
    sums = []
    for p in paths:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(p)
        mark = F.xxhash64("path", "length", "modificationTime")
        sums.append(tuple(files.agg(F.count(F.lit(1)), F.bit_xor(mark)).first()))
    return hashlib.sha256(repr(sums).encode()).hexdigest()[:12]


def read_range(spark: SparkSession, path: str, spec: TableSpec, *,
               start=None, end=None, where: dict | None = None) -> DataFrame:
    """Table rows with ``start <= time <= end`` and column equalities.

    The time bounds are also applied to the chunk partition column, so whole
    partitions outside the range are never listed or read.
    """
    df = spark.read.parquet(path)
    t = F.col(spec.time_col)
    if start is not None:
        df = df.where((F.col("chunk") >= chunk_of(F.lit(start).cast("date"), spec.chunk)) &
                      (t >= F.lit(start).cast(df.schema[spec.time_col].dataType)))
    if end is not None:
        df = df.where((F.col("chunk") <= F.lit(end).cast("date")) &
                      (t <= F.lit(end).cast(df.schema[spec.time_col].dataType)))
    for k, v in (where or {}).items():
        df = df.where(F.col(k) == F.lit(v))
    return df
