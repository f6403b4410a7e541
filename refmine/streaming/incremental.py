"""Incremental loads: only files that weren't seen, and the latest version of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery


def _new_files(spark: SparkSession, input_folder: str, schema: T.StructType | str, glob: str, files_per_batch: int) -> DataFrame:
    lines = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).json(input_folder)
    return lines.withColumn("file_path", F.col("_metadata.file_path")).withColumn("file_time", F.col("_metadata.file_modification_time"))


def _run(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def ingest_new_files(spark: SparkSession, input_folder: str, output: str, checkpoint: str, schema: T.StructType | str, glob: str = "*.{jsonl,ndjson,gz}", files_per_batch: int = 1000) -> None:
    """Append the rows of files that no earlier call took in, with the file's path and time.

    A file source with a checkpoint: exactly once, whatever fails in between. The call ends
    when all present files are in.
    """
    lines = _new_files(spark, input_folder, schema, glob, files_per_batch)
    _run(lines.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).option("compression", "zstd").trigger(availableNow=True).start())


def stage_new_files(spark: SparkSession, input_folder: str, pending: str, checkpoint: str, schema: T.StructType | str, glob: str = "*.{jsonl,ndjson,gz}", files_per_batch: int = 1000) -> None:
    """The rows of files that no earlier call took in, in a folder a batch below ``pending``, which the caller empties.

    A batch that is done again after a failure overwrites its own folder.
    """
    name = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{pending}/{name}-{number}")

    _run(_new_files(spark, input_folder, schema, glob, files_per_batch).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_by_key(df: DataFrame, key: str, time: str = "file_time") -> DataFrame:
    """One row a key: that of the latest file; among equals the greatest row as text. Null keys are left out."""
    rest = [c for c in df.columns if c != key]
    row = F.struct(*rest)
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(row, F.struct(F.col(time), F.to_json(row))).alias("_r")).select(key, "_r.*")


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Tumbling-window counts by key; on a stream, events later than ``late`` are dropped and windows close."""
    if events.isStreaming:
        events = events.withWatermark(time, late)
    counted = events.groupBy(F.window(time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), key, "n")
