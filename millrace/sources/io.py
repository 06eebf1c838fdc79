"""Tables and streams.

Tables are parquet tables in the session catalog (``saveAsTable``) or parquet
folders; streams are Structured Streaming queries with a checkpoint each.
"""

from __future__ import annotations

import json
import os
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.session import scratch_path


# ------------------------------------------------------------------ batch
def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Batch scan of a catalog table."""
    return spark.table(name)


def load_dir(spark: SparkSession, path: str, fmt: str = "parquet",
             schema: StructType | str | None = None, **options) -> DataFrame:
    """Batch load of a folder (parquet / csv / json)."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", options.get("header", "true"))
    return r.load(path)


def write_table(df: DataFrame, name: str, mode: str = "overwrite",
                partition_by: list[str] | None = None, path: str | None = None) -> None:
    """Overwrite / append / create a catalog table (parquet)."""
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def merge_schema_write(df: DataFrame, name: str, spark: SparkSession | None = None) -> None:
    """Append rows whose schema may add columns.  New columns are added
    to the table (older rows read as null), then the rows are appended by
    name, with null for columns they lack; nothing is rewritten."""
    spark = spark or df.sparkSession
    if not spark.catalog.tableExists(name):
        write_table(df, name)
        return
    have = spark.table(name).schema
    new = [f for f in df.schema.fields if f.name not in have.fieldNames()]
    if new:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
    full = spark.table(name).schema
    rows = df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in full.fields])
    rows.write.insertInto(name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: a lineage cut (the layer boundary of a bronze/silver/gold pipeline)
    that survives executor loss.  Never a machine-local folder on a cluster:
    the folder comes from ``spark.checkpoint.dir``."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def ensure_database(spark: SparkSession, db: str, use: bool = True) -> None:
    """S11."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    if use:
        spark.sql(f"USE {db}")


def reset_database(spark: SparkSession, db: str) -> None:
    """Drop with everything in it, then create."""
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db}")


def drop_table(spark: SparkSession, name: str) -> None:
    """S11."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def database_exists(spark: SparkSession, db: str) -> bool:
    """S11."""
    return spark.catalog.databaseExists(db)


# ------------------------------------------------------------------ streams
def read_stream_table(spark: SparkSession, name: str) -> DataFrame:
    """Incremental scan of a table written by an append stream."""
    return spark.readStream.table(name)


def read_stream_dir(spark: SparkSession, path: str, schema: StructType,
                    fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """S2 for folder-backed tables."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def _merge_struct(old: StructType, new: StructType) -> StructType:
    """Keep every field of ``old``; add fields that only ``new`` has (nested
    structs merged recursively)."""
    fields = {f.name: f for f in old.fields}
    out = list(old.fields)
    for f in new.fields:
        if f.name not in fields:
            out.append(f)
        elif isinstance(f.dataType, StructType) and isinstance(fields[f.name].dataType, StructType):
            merged = _merge_struct(fields[f.name].dataType, f.dataType)
            out = [type(f)(f.name, merged, True) if g.name == f.name else g for g in out]
    return StructType(out)


def _read_kept_schema(spark: SparkSession, location: str) -> tuple[StructType | None, str | None]:
    """The kept schema and when its inference began; (None, None) where nothing is kept yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None, None
    rows = spark.read.text(location).collect()   # one line: the schema JSON
    if not rows:
        return None, None
    kept = json.loads(rows[0][0])
    return StructType.fromJson(kept["schema"]), kept["since"]


def _infer(reader, path: str, kept: StructType | None) -> StructType:
    """Schema of the files that ``reader`` sees; the kept one where it sees none."""
    try:
        return reader.json(path).schema
    except AnalysisException as e:
        if kept is not None and "UNABLE_TO_INFER_SCHEMA" in str(e):
            return kept
        raise


def ingest_json_files(spark: SparkSession, src_dir: str, schema_location: str,
                      max_files: int | None = 16, sample_files: str | None = None) -> DataFrame:
    """S3: incremental JSON file ingest with a persisted inferred schema.

    The first start infers the schema from the files present (one batch
    job) and keeps it as one JSON line at ``schema_location``.  Later starts
    reuse it and merge in fields that new files add.  The schema is read and
    written with Spark's text source, so the location may be on any file
    system the cluster shares; later starts infer only from files modified
    since it was kept.  At most ``max_files`` new files per micro-batch (None:
    no limit)."""
    # a little early, so that a file written meanwhile is looked at again
    began = (datetime.now(timezone.utc) - timedelta(seconds=5)).strftime("%Y-%m-%dT%H:%M:%S")
    kept, kept_at = _read_kept_schema(spark, schema_location)
    fresh = spark.read.option("modifiedAfter", kept_at) if kept_at else spark.read
    inferred = _infer(fresh, sample_files or src_dir, kept)
    schema = _merge_struct(kept, inferred) if kept is not None else inferred
    line = json.dumps({"schema": schema.jsonValue(), "since": began})
    (spark.createDataFrame([(line,)], "value string")
          .coalesce(1).write.mode("overwrite").text(schema_location))
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(src_dir)


def append_stream(df: DataFrame, table: str, checkpoint: str, trigger: dict | None = None,
                  query_name: str | None = None, path: str | None = None) -> StreamingQuery:
    """S6 + S7: append-only sink into a table (or folder) with its own
    checkpoint.  ``trigger`` is passed to ``.trigger`` (e.g.
    ``{"availableNow": True}`` or ``{"processingTime": "30 seconds"}``)."""
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    if path:
        return w.format("parquet").start(path)
    return w.toTable(table)


def foreach_batch(df: DataFrame, fn, checkpoint: str, trigger: dict | None = None,
                  query_name: str | None = None) -> StreamingQuery:
    """Micro-batch sink.  ``fn(batch_df, batch_id)`` must be idempotent
    per batch id (see ``idempotent_append``)."""
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def committed_append(path: str, transform=None):
    """Build a foreachBatch function that appends each batch to ``path`` exactly once.

    A batch's rows (``transform``ed) go to a folder of their own; then a commit
    record names that folder under the stream's query id and the batch id.  A
    batch that is replayed after its commit is skipped.  The query id belongs to
    the checkpoint, so a stream that starts over with a new checkpoint adds to
    the table and never replaces what an older one wrote.  Readers follow the
    records (:func:`read_committed`): rows of a batch that failed half-way are
    never seen."""
    def _write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        record = f"{path}/_commits/{stream}/{batch_id}"
        if _exists(spark, f"{record}/_SUCCESS"):
            return
        folder = f"data-{uuid.uuid4().hex}"
        (transform(batch) if transform else batch).write.parquet(f"{path}/{folder}")
        spark.createDataFrame([(stream, batch_id, folder)], _COMMIT).coalesce(1).write.mode("overwrite").parquet(record)
    return _write


_COMMIT = "stream string, batch_id long, folder string"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def committed_batches(spark: SparkSession, path: str) -> DataFrame:
    """(stream, batch_id, folder) of every committed batch."""
    if not _exists(spark, f"{path}/_commits"):
        return spark.createDataFrame([], _COMMIT)
    return spark.read.schema(_COMMIT).option("recursiveFileLookup", "true").parquet(f"{path}/_commits")


def read_committed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all committed batches (one folder a batch reaches the driver, no data)."""
    folders = [f"{path}/{r['folder']}" for r in committed_batches(spark, path).select("folder").collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def stop_all_streams(spark: SparkSession) -> int:
    """Stop every active query; returns how many were stopped."""
    n = 0
    for q in spark.streams.active:
        try:
            q.stop()
            n += 1
        except Exception:  # noqa: BLE001 - keep stopping the rest
            pass
    return n


def run_available_now(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait until an ``availableNow`` query has drained its input (it
    ends by itself).  With a ``timeout`` that runs out, the query is stopped
    and ``TimeoutError`` raised: a layer that is not complete is never read."""
    if not (query.awaitTermination() if timeout is None else query.awaitTermination(timeout)) and timeout is not None:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} was still running after {timeout} seconds")
    return query
