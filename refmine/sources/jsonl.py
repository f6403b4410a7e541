"""JSON Lines dumps: discovery, reading with a pinned schema, conversion to Parquet."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from refmine import storage
from refmine.functions.text import FILE_SUFFIXES, strip_file_suffix

#: Names that are taken for JSON Lines.
PATTERNS = ("*.jsonl.gz", "*.jsonl", "*.ndjson.gz", "*.ndjson", "*.gz")


def find_input_files(spark: SparkSession, folder: str, patterns=PATTERNS) -> list[str]:
    """Paths below a folder that match a pattern, sorted, each once. A missing folder raises."""
    return sorted({p for p in storage.files_below(spark, folder) if any(fnmatch(p.rsplit("/", 1)[-1], pattern) for pattern in patterns)})


def first_file_schema(spark: SparkSession, path: str) -> T.StructType:
    """The schema that one file shows, every field nullable."""
    return spark.read.json(path).schema


def read_jsonl(spark: SparkSession, paths, schema: T.StructType | str, strict: bool = False) -> DataFrame:
    """Lines under a pinned schema: missing fields are null, other fields are dropped.

    ``strict`` raises on a bad line; else it is a row of nulls.
    """
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(paths)


def output_path(path: str, input_folder: str, output_folder: str) -> str:
    """Where a file's Parquet goes: its path below the input folder, without the suffix."""
    below = path.rpartition(input_folder.partition(":")[2].rstrip("/") + "/" if ":" in input_folder else input_folder.rstrip("/") + "/")[2]
    return f"{output_folder.rstrip('/')}/{re.sub(FILE_SUFFIXES, '', below)}.parquet"


@dataclass(frozen=True)
class Converted:
    path: str
    output: str
    ok: bool
    message: str
    rows: int


def convert_files(spark: SparkSession, input_folder: str, output_folder: str, schema: T.StructType | str | None = None, force: bool = False, patterns=PATTERNS, workers: int = 8) -> list[Converted]:
    """One Parquet output (zstd) for each input file; one that exists is skipped unless forced.

    With a schema all files are one job. Without, each file's own is used, ``workers`` files
    at a time. An empty file gives no output. A file that can't be read or cast fails alone
    and leaves nothing behind.
    """
    todo, report = [], []
    for path in find_input_files(spark, input_folder, patterns):
        out = output_path(path, input_folder, output_folder)
        if storage.exists(spark, out) and not force:
            report.append(Converted(path, out, True, "skipped", 0))
        else:
            todo.append((path, out))
    if schema is not None:
        report += _convert_together(spark, todo, schema, f"{output_folder.rstrip('/')}/_staged") if todo else []
    else:
        with ThreadPoolExecutor(workers) as pool:
            report += pool.map(lambda x: _convert_one(spark, *x), todo)
    return sorted(report, key=lambda r: r.path)


def _convert_one(spark: SparkSession, path: str, out: str) -> Converted:
    try:
        own = first_file_schema(spark, path)
        if not own.fields:
            return Converted(path, out, True, "empty", 0)
        read_jsonl(spark, path, own, strict=True).write.mode("overwrite").option("compression", "zstd").parquet(out)
        rows = spark.read.parquet(out).count()
        if not rows:
            storage.delete(spark, out)
        return Converted(path, out, True, "converted" if rows else "empty", rows)
    except Exception as e:  # noqa: BLE001 - one bad file must not end the others
        storage.delete(spark, out)
        return Converted(path, out, False, str(e).splitlines()[0][:200], 0)


def _convert_together(spark: SparkSession, todo: list[tuple[str, str]], schema: T.StructType | str, staged: str) -> list[Converted]:
    """All files in one job, each into a folder of its own, which is then moved to its place."""
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    numbers = spark.createDataFrame([(p.split(":", 1)[-1].lstrip("/"), n) for n, (p, _) in enumerate(todo)], "_path string, _file int")
    lines = spark.read.schema(T.StructType([*wanted.fields, T.StructField("_bad", T.StringType())])).option("columnNameOfCorruptRecord", "_bad").json([p for p, _ in todo])
    own = lines.withColumn("_path", F.regexp_replace(F.col("_metadata.file_path"), "^[a-z0-9]*:?/+", "")).withColumn("_ok", F.col("_bad").isNull().cast("int"))
    own.join(F.broadcast(numbers), "_path").drop("_path", "_bad").write.mode("overwrite").option("compression", "zstd").partitionBy("_file", "_ok").parquet(staged)
    told: dict[int, int] = {}
    if storage.folder_names(spark, staged):
        counted = spark.read.parquet(staged).groupBy("_file", "_ok").agg(F.count(F.lit(1)).alias("n"))
        for r in counted.toLocalIterator():  # two rows a file at most
            told[r["_file"]] = -1 if not r["_ok"] or told.get(r["_file"]) == -1 else r["n"]
    report = []
    for n, (path, out) in enumerate(todo):
        rows = told.get(n, 0)
        if rows < 0:
            report.append(Converted(path, out, False, "a line can't be read", 0))
        elif not rows:
            report.append(Converted(path, out, True, "empty", 0))
        else:
            storage.delete(spark, out)
            storage.make_folder(spark, out.rpartition("/")[0])
            storage.rename(spark, f"{staged}/_file={n}/_ok=1", out)
            report.append(Converted(path, out, True, "converted", rows))
    storage.delete(spark, staged)
    return report


def ingest_jsonl(spark: SparkSession, input_folder: str, output: str, schema: T.StructType | str, partitions: int | None = None, cluster_by: str | None = None) -> DataFrame:
    """All files below a folder as one Parquet table; returns it.

    gzip files can't be split, so ``partitions`` spreads their rows; ``cluster_by`` sorts the
    table by ranges of a key, for pruning by its statistics.
    """
    df = read_jsonl(spark, find_input_files(spark, input_folder), schema)
    if cluster_by:
        df = (df.repartitionByRange(partitions, cluster_by) if partitions else df.repartitionByRange(cluster_by)).sortWithinPartitions(cluster_by)
    elif partitions:
        df = df.repartition(partitions)
    df.write.mode("overwrite").option("compression", "zstd").parquet(output)
    return spark.read.schema(df.schema).parquet(output)


def rows_by_file(df: DataFrame) -> DataFrame:
    """(path, name, stem, rows) of the files that a file-based table was read from."""
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    return df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows")).select("path", name.alias("name"), strip_file_suffix(name).alias("stem"), "rows")
