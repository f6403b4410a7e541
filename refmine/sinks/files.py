"""Results as single files: pretty JSON with backups, TSV, in-place rewrites.

Large results are better written by Spark (Parquet, JSON Lines, CSV). What must be one file
streams through the driver, which holds a partition at most.
"""

from __future__ import annotations

import csv
import json
import math
import os
from collections.abc import Callable, Iterable
from datetime import date, datetime
from fnmatch import fnmatch
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from refmine import storage
from refmine.functions.text import dedup_link_cell, finite
from refmine.session import ship
from refmine.sources.documents import read_tsv


def clean_columns(df: DataFrame) -> DataFrame:
    """NaN and infinite doubles as null, in columns and in arrays of doubles."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(finite(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, (T.DoubleType, T.FloatType)):
            out.append(F.transform(f.name, finite).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def plain(value):
    """A value that JSON can hold: rows as objects, NaN and infinities as null, times as text."""
    if hasattr(value, "asDict"):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [plain(v) for v in value]
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if hasattr(value, "tolist"):
        return plain(value.tolist())
    return value


def rotate_backup(path: str, spark: SparkSession | None = None) -> str | None:
    """Move a file to the first free of .backup, .backup_1, ...; None if there is none to move."""
    own = storage.local_path(path)
    there = os.path.exists if own else lambda p: storage.exists(spark, p)
    path = own or path
    if not there(path):
        return None
    target, n = path + ".backup", 0
    while there(target):
        n += 1
        target = f"{path}.backup_{n}"
    os.rename(path, target) if own else storage.rename(spark, path, target)
    return target


_SCALAR = json.JSONEncoder(ensure_ascii=False).encode


def _json(value, depth: int) -> str:
    """Indented JSON of a value that stands so many blanks deep."""
    return _laid_out(plain(value), "\n" + " " * depth)


def _laid_out(value, line: str) -> str:
    """As the standard library with indent=2, whose fast encoder doesn't indent: it gets the scalars."""
    if not value or not isinstance(value, (dict, list)):
        return _SCALAR(value)
    inner = line + "  "
    if isinstance(value, dict):
        return "{" + ",".join([f"{inner}{_SCALAR(k)}: {_laid_out(v, inner)}" for k, v in value.items()]) + line + "}"
    return "[" + ",".join([inner + _laid_out(v, inner) for v in value]) + line + "]"


def save_json(data, path: str, backup: bool = True) -> bool:
    """Indented UTF-8 JSON; an earlier file is kept as a backup. False on any failure."""
    try:
        text = _json(data, 0)
        with storage.TextFile(None, path, (lambda: rotate_backup(path)) if backup else None) as f:
            f.write(text)
        return True
    except (OSError, TypeError, ValueError):
        return False


def save_document(df: DataFrame, path: str, key: str, header: dict | None = None, backup: bool = True, within: str | None = None) -> bool:
    """One JSON document: the header's entries, then the rows under ``key``, in their order. False where it can't be written.

    Rows pass through the driver one partition at a time, whatever their number; where all
    are texts, whole numbers and truth values, as text that the tasks made. ``within``:
    a column of structs; consecutive rows that are equal in all others make one object, with
    their structs in a list of that name, also written as they come. ``path`` may be on any
    file system that Spark knows.
    """
    spark = df.sparkSession
    by_spark = _plain_text(df.schema) and (within is None or len(df.columns) > 1)
    rows = (_text_batches(df, within) if by_spark else clean_columns(df)).toLocalIterator()
    write = _write_batches if by_spark else _write_rows if within is None else _write_groups
    try:
        with storage.TextFile(spark, path, (lambda: rotate_backup(path, spark)) if backup else None) as f:
            f.write("{\n" + "".join(f"  {json.dumps(k)}: {_json(v, 2)},\n" for k, v in (header or {}).items()) + f"  {json.dumps(key)}: [")
            n = write(f, rows, within)
            f.write("\n  ]\n}" if n else "]\n}")
        return True
    except (OSError, TypeError, ValueError):
        return False


def _write_rows(f: storage.TextFile, rows: Iterable, _: None = None) -> int:
    n = 0
    for n, row in enumerate(rows, 1):
        f.write((",\n    " if n > 1 else "\n    ") + _json(row, 4))
    return n


def _write_groups(f: storage.TextFile, rows: Iterable, within: str) -> int:
    n = 0
    for n, (own, members) in enumerate(groupby(rows, lambda r: {k: v for k, v in r.asDict().items() if k != within}), 1):
        f.write((",\n    " if n > 1 else "\n    ") + _json(own, 4).removesuffix("\n    }") + f",\n      {json.dumps(within)}: [")
        for i, m in enumerate(members):
            f.write((",\n        " if i else "\n        ") + _json(m[within], 8))
        f.write("\n      ]\n    }")
    return n


def _plain_text(kind: T.DataType) -> bool:
    """Whether Spark writes values of a type as Python's JSON does."""
    if isinstance(kind, T.StructType):
        return 0 < len(kind) == len(set(kind.names)) and all(_plain_text(x.dataType) for x in kind)
    if isinstance(kind, T.ArrayType):
        return _plain_text(kind.elementType)
    return type(kind) in (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _quoted(c: Column) -> Column:
    """A JSON string as Python's encoder writes it."""
    text = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    rare = text
    for n in range(32):
        rare = F.replace(rare, F.lit(chr(n)), F.lit(_SCALAR(chr(n))[1:-1]))
    return F.concat(F.lit('"'), F.when(c.rlike(r"[\x00-\x1f]"), rare).otherwise(text), F.lit('"'))


def _text(c: Column, kind: T.DataType, line: str) -> Column:
    """``_laid_out`` as an expression."""
    inner = line + "  "
    if isinstance(kind, T.StructType):
        fields = [p for i, x in enumerate(kind) for p in (F.lit(f"{',' if i else '{'}{inner}{_SCALAR(x.name)}: "), _text(c.getField(x.name), x.dataType, inner))]
        out = F.concat(*fields, F.lit(line + "}"))
    elif isinstance(kind, T.ArrayType):
        each = F.transform(c, lambda x: F.concat(F.lit(inner), _text(x, kind.elementType, inner)))
        out = F.when(F.size(c) == 0, F.lit("[]")).otherwise(F.concat(F.lit("["), F.array_join(each, ","), F.lit(line + "]")))
    else:
        out = _quoted(c) if isinstance(kind, T.StringType) else c.cast("string")
    return F.when(c.isNull(), F.lit("null")).otherwise(out)


def _opening(within: str) -> str:
    return f",\n      {json.dumps(within)}: ["


def _text_batches(df: DataFrame, within: str | None) -> DataFrame:
    """(first, text, last): the text of consecutive rows; with ``within`` the first and the last object's own text, of which the text has what lies between."""
    ship(df.sparkSession)

    def text(names: list[str], line: str) -> Column:
        return _text(F.struct(*[F.col(f"`{n}`") for n in names]), T.StructType([df.schema[n] for n in names]), line)

    if within is None:
        columns = [F.lit(None).cast("string").alias("own"), text(df.columns, "\n    ").alias("member")]
    else:
        own = F.expr("substr(own, 1, length(own) - 6)")
        columns = [text([c for c in df.columns if c != within], "\n    ").alias("own"), _text(F.col(f"`{within}`"), df.schema[within].dataType, "\n        ").alias("member")]
    texts = df.select(*columns)
    if within is not None:
        texts = texts.select(own.alias("own"), "member")
    same, between = ",\n    " if within is None else ",\n        ", _opening(within or "")

    def join(batches):
        for b in batches:
            owns, members = (c.cast(pa.binary()).to_pylist() for c in b.columns)
            if not members:
                continue
            parts, was = [members[0]], owns[0]
            for own, member in zip(owns[1:], members[1:]):
                parts += (same.encode(), member) if own == was else (b"\n      ]\n    },\n    ", own, f"{between}\n        ".encode(), member)
                was = own
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (owns[0], b"".join(parts), was)], ["first", "text", "last"])

    return texts.mapInArrow(join, "first binary, text binary, last binary")


def _write_batches(f: storage.TextFile, batches: Iterable, within: str | None) -> int:
    n, was = 0, None
    for n, b in enumerate(batches, 1):
        if within is None:
            f.write(",\n    " if n > 1 else "\n    ")
        elif n > 1 and b.first == was:
            f.write(",\n        ")
        else:
            f.write(("\n      ]\n    },\n    " if n > 1 else "\n    ") + b.first.decode("utf-8", "replace") + _opening(within) + "\n        ")
        f.write(b.text.decode("utf-8", "replace"))
        was = b.last
    if n and within is not None:
        f.write("\n      ]\n    }")
    return n


def save_tsv(df: DataFrame, path: str, keep: Callable[[], object] | None = None) -> None:
    """One TSV file with header, quoted where needed, null as empty, in the order of the rows, which pass as in ``save_document``."""
    with storage.TextFile(df.sparkSession, path, keep) as f:
        w = csv.writer(f, delimiter="\t", lineterminator="\n")
        w.writerow(df.columns)
        w.writerows(["" if v is None else v for v in r] for r in df.toLocalIterator())


def write_tsv(df: DataFrame, folder: str) -> None:
    """A table as TSV files in a folder, by Spark."""
    df.write.mode("overwrite").options(sep="\t", header=True, escape='"', emptyValue="", nullValue="").csv(folder)


def rewrite_tsv(spark: SparkSession, path: str, columns: list[str], change: Callable[[Column], Column] = dedup_link_cell, dry_run: bool = False) -> bool:
    """Rewrite columns of a TSV file in place where that changes anything; whether it does.

    The first original is kept as .bak. A null cell that becomes '' is a change.
    """
    df = read_tsv(spark, path)
    present = [c for c in columns if c in df.columns]
    if not present:
        return False
    after = df.select(*[(change(F.col(f"`{c}`")) if c in present else F.col(f"`{c}`")).alias(c) for c in df.columns])
    differs = [~change(F.col(f"`{c}`")).eqNullSafe(F.col(f"`{c}`")) for c in present]
    some = differs[0]
    for d in differs[1:]:
        some = some | d
    changed = df.where(some).limit(1).count() > 0
    if changed and not dry_run:
        save_tsv(after, path, lambda: _keep_original(spark, path))
    return changed


def _keep_original(spark: SparkSession, path: str) -> None:
    own = storage.local_path(path)
    if own and not os.path.exists(own + ".bak"):
        os.rename(own, own + ".bak")
    elif not own and not storage.exists(spark, path + ".bak"):
        storage.rename(spark, path, path + ".bak")


def rewrite_link_tables(spark: SparkSession, folders: list[str], columns: tuple[str, ...] = ("Citing Article", "Citied Article"), pattern: str = "*_merged_analysis_table.tsv", dry_run: bool = False) -> dict[str, bool]:
    """Every matching TSV below the folders: path and whether it changed (or would)."""
    paths = sorted({storage.local_path(p) or p for f in folders if storage.exists(spark, f) for p in storage.files_below(spark, f) if fnmatch(p.rsplit("/", 1)[-1], pattern)})
    return {p: rewrite_tsv(spark, p, list(columns), dry_run=dry_run) for p in paths}
