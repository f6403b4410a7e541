"""JSON Lines files whose schemas drift: one table of all of them, and a log of every change.

A file's schema is what its lines hold: for each top-level field, how many values are of
each JSON type. Lines are parsed once, in parallel, and written as (field, type, digest of
the text); schemas and renamings are aggregates over that table (map-side combine, so a
file that holds most rows leaves one row a task and field), never a look at the lines on
the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from json.encoder import encode_basestring

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from refmine.operators.components import components
from refmine.session import materialize, ship

#: JSON types as the change log names them.
TYPES = ("string", "boolean", "array", "object", "integer", "decimal")
#: The promotion lattice: two different types meet in the first of these that is above both.
ABOVE = {
    "boolean": ("boolean", "string"),
    "integer": ("integer", "decimal", "string"),
    "decimal": ("decimal", "string"),
    "array": ("array", "string"),
    "object": ("object", "string"),
    "string": ("string",),
}
#: Spark's type for each lattice type; nested values stay JSON text.
SPARK_TYPES = {"boolean": "boolean", "integer": "bigint", "decimal": "double", "array": "string", "object": "string", "string": "string"}


#: Spark's integer types.
_INTEGERS = ("tinyint", "smallint", "int", "bigint")
#: An id written as text behind the name of its kind, as in CorpusId:7.
_PREFIXED = r"^\s*\p{L}\w*[:#/\s-]+(\d+)\s*$"

#: Closes a line when it is parsed; a line can't hold it by chance.
_END = "end-of-line-9f1c7be2"


def with_objects(df: DataFrame, keep: list[str], raw: str) -> DataFrame:
    """(keep..., _raw, _v): each line with its VARIANT, null unless it is one whole JSON value.

    The parser alone would pass over text after the value. The pair is a column of its own
    so that a line is parsed once.
    """
    pairs = df.select(*keep, F.col(raw).alias("_raw"), F.try_parse_json(F.concat(F.lit("["), F.col(raw), F.lit(f',"{_END}"]'))).alias("_p"))
    return pairs.select(*keep, "_raw", F.when(F.try_variant_get("_p", "$[1]", "string") == _END, F.try_variant_get("_p", "$[0]", "variant")).alias("_v"))


class _Whole(str):
    """A number without decimal point, as written."""


class _Broken(str):
    """A number with decimal point or exponent, as written."""


_KIND = {str: 0, bool: 1, list: 2, dict: 3, _Whole: 4, _Broken: 5}


def _fields_once(pairs: list[tuple]) -> dict:
    found = dict(pairs)
    if len(found) != len(pairs):
        raise ValueError("a field is named twice")
    return found


def _refuse(constant: str):
    raise ValueError(constant)


_JSON = json.JSONDecoder(object_pairs_hook=_fields_once, parse_int=_Whole, parse_float=_Broken, parse_constant=_refuse)


def whole_object(line: str | None) -> dict | None:
    """The object of a line that is one whole JSON object, numbers as written; else None."""
    if not line:
        return None
    try:
        value = _JSON.decode(line)
    except (ValueError, RecursionError):
        return None
    return value if type(value) is dict else None


def written(value, inner: bool = False) -> str:
    """A scalar as it was written, an array or object in compact form with sorted keys."""
    kind = type(value)
    if kind is str:
        return encode_basestring(value) if inner else value
    if kind is bool:
        return "true" if value else "false"
    if value is None:
        return "null"
    if kind is list:
        return "[" + ",".join([written(x, True) for x in value]) + "]"
    if kind is dict:
        return "{" + ",".join([f"{encode_basestring(k)}:{written(v, True)}" for k, v in sorted(value.items())]) + "}"
    return str(value)


def _utf8(texts: list) -> pa.Array:
    try:
        return pa.array(texts, pa.string())
    except UnicodeEncodeError:  # a lone surrogate, as JSON can name it
        return pa.array([None if x is None else x.encode("utf-8", "replace").decode() for x in texts], pa.string())


_FIELDS = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.ByteType()), T.StructField("value", T.LongType())]))


def parsed_lines(df: DataFrame, feed: str, seq: str, raw: str, edge: str) -> DataFrame:
    """(feed, seq, edge, fields): one row a whole JSON object, ``fields`` with name, type and value of each top-level field.

    ``type`` is the place in TYPES, -1 for a JSON null; ``value`` is a 64-bit digest of the
    value as written; ``edge`` is the text of the field of that name. Lines that aren't one
    whole object, or that name a field twice, give nothing. The JVM's parsers give either
    the types or the texts as written, so a line would need two; here it takes one.
    """
    ship(df.sparkSession)
    picked = df.select(F.col(feed).alias("feed"), F.col(seq).alias("seq"), F.col(raw).alias("raw"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            rows, edges, offsets, names, kinds, values = [], [], [0], [], [], []
            for n, line in enumerate(b.column(2).to_pylist()):
                found = whole_object(line)
                if found is None:
                    continue
                rows.append(n)
                at = found.get(edge)
                edges.append(None if at is None else written(at))
                names += found
                for v in found.values():
                    if v is None:
                        kinds.append(-1)
                        values.append(0)
                    else:
                        kinds.append(_KIND[type(v)])
                        values.append(digest(written(v).encode("utf-8", "replace")))
                offsets.append(len(names))
            if rows:
                struct = pa.StructArray.from_arrays([_utf8(names), pa.array(kinds, pa.int8()), pa.array(np.array(values, np.uint64).view(np.int64))], ["name", "type", "value"])
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), _utf8(edges), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)], ["feed", "seq", "edge", "fields"])

    kind = T.StructType([*picked.schema.fields[:2], T.StructField("edge", T.StringType()), T.StructField("fields", _FIELDS)])
    return picked.mapInArrow(parse, kind)


def _schemas(parsed: DataFrame) -> DataFrame:
    values = parsed.select("feed", "seq", F.explode("fields").alias("f")).select("feed", "seq", F.col("f.name").alias("field"), F.col("f.type").alias("_t"))
    counted = values.groupBy("feed", "seq", "field").agg(F.count(F.lit(1)).alias("lines"), *[F.count_if(F.col("_t") == i).alias(f"_{t}") for i, t in enumerate(TYPES)])
    most = F.greatest(*[F.col(f"_{t}") for t in TYPES])
    typ = F.coalesce(*[F.when((F.col(f"_{t}") == most) & (most > 0), t) for t in TYPES])
    return counted.select("feed", "seq", "field", "lines", typ.alias("type"))


def file_schemas(df: DataFrame, feed: str = "feed", seq: str = "file_seq", raw: str = "raw") -> DataFrame:
    """(feed, seq, field, lines, type): each file's fields and the type of most of their values.

    ``type`` is null where all values are null; equal counts go to the first of TYPES.
    """
    return _schemas(parsed_lines(df, feed, seq, raw, "")).select(F.col("feed").alias(feed), F.col("seq").alias(seq), "field", "lines", "type")


def _survey(df: DataFrame, feed: str, seq: str, edge: str, raw: str) -> tuple[DataFrame, DataFrame]:
    """The parsed lines and the file schemas, each written once."""
    parsed = materialize(parsed_lines(df, feed, seq, raw, edge), "lines-parsed")
    return parsed, materialize(_schemas(parsed), "schemas")


def schema_changes(df: DataFrame, feed: str = "feed", seq: str = "file_seq", edge: str = "edge_uid", raw: str = "raw") -> DataFrame:
    """The change log: (feed, seq, change_kind, old_field, new_field), each file against its feed's file before.

    A field that is gone and one that is new are a renaming when their values, as text,
    agree in all records (by ``edge``, a field of the lines) that both files hold, nulls
    aside, and at least one such record has both. The values of a record enter as the
    smallest and largest digest of each field, so repeated lines multiply nothing. A type
    that no value tells (all null) changes nothing. Rows without feed or seq are left out;
    an empty table gives an empty log.
    """
    log = _changes(df.select(F.col(feed).alias("feed"), F.col(seq).alias("seq")).distinct(), *_survey(df, feed, seq, edge, raw))
    return log.select(F.col("feed").alias(feed), F.col("seq").alias(seq), "change_kind", "old_field", "new_field")


def _changes(files: DataFrame, parsed: DataFrame, schemas: DataFrame) -> DataFrame:
    files = files.where("feed IS NOT NULL AND seq IS NOT NULL").withColumn("before", F.lag("seq").over(Window.partitionBy("feed").orderBy("seq"))).where("before IS NOT NULL")
    new = schemas.join(files, ["feed", "seq"]).select("feed", "seq", "before", "field", F.col("type").alias("new_type"), F.lit(True).alias("in_new"))
    old = schemas.withColumnRenamed("seq", "before").join(files, ["feed", "before"]).select("feed", "seq", "before", "field", F.col("type").alias("old_type"), F.lit(True).alias("in_old"))
    both = materialize(old.join(new, ["feed", "seq", "before", "field"], "full_outer"), "schema-pairs")
    gone, fresh = both.where("in_new IS NULL"), both.where("in_old IS NULL")
    # Only files in which something went and something came can hold a renaming.
    either = both.where("in_new IS NULL OR in_old IS NULL")
    changed = either.groupBy("feed", "seq").agg(F.count("in_new").alias("_n"), F.count("in_old").alias("_o")).where("_n > 0 AND _o > 0").select("feed", "seq")
    older = F.col("in_new").isNull()
    wanted = either.join(changed, ["feed", "seq"], "left_semi").select("feed", "seq", F.when(older, F.col("before")).otherwise(F.col("seq")).alias("at"), F.col("field").alias("name"), older.alias("older"))
    renamed = materialize(_renamed(parsed, materialize(wanted, "fields-moved")), "renamed")
    across = (
        renamed.join(gone.select("feed", "seq", F.col("field").alias("old_field"), "old_type"), ["feed", "seq", "old_field"])
        .join(fresh.select("feed", "seq", F.col("field").alias("new_field"), "new_type"), ["feed", "seq", "new_field"])
    )
    none = F.lit("")
    parts = [
        renamed.select("feed", "seq", F.lit("renamed").alias("change_kind"), "old_field", "new_field"),
        across.where("old_type <> new_type").select("feed", "seq", F.lit("retyped").alias("change_kind"), "old_field", "new_field"),
        both.where("in_old AND in_new AND old_type <> new_type").select("feed", "seq", F.lit("retyped").alias("change_kind"), F.col("field").alias("old_field"), F.col("field").alias("new_field")),
        gone.withColumnRenamed("field", "old_field").join(renamed, ["feed", "seq", "old_field"], "left_anti").select("feed", "seq", F.lit("removed").alias("change_kind"), "old_field", none.alias("new_field")),
        fresh.withColumnRenamed("field", "new_field").join(renamed, ["feed", "seq", "new_field"], "left_anti").select("feed", "seq", F.lit("added").alias("change_kind"), none.alias("old_field"), "new_field"),
    ]
    log = parts[0]
    for p in parts[1:]:
        log = log.unionByName(p)
    return log


def _renamed(parsed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(feed, seq, old_field, new_field) of the renamings among the wanted (feed, seq, at, name, older).

    Two counts a pair of fields must be equal: the records that hold both, and those in
    which the two agree. The first comes from how many records have which fields at all, of
    which there are few kinds; for the second a record gives its equal pairs only.
    """
    values = parsed.where("edge IS NOT NULL").select("feed", F.col("seq").alias("at"), "edge", F.explode("fields").alias("f")).where("f.type >= 0")
    states = (
        values.select("feed", "at", "edge", F.col("f.name").alias("name"), F.col("f.value").alias("value")).join(wanted, ["feed", "at", "name"])
        .groupBy("feed", "seq", "edge", "older", "name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    )
    # One row a record, as wide as the record: no field occurs twice.
    records = states.groupBy("feed", "seq", "edge").agg(F.sort_array(F.collect_list(F.struct("name", "older", "lo", "hi"))).alias("f"))
    sides = records.select("feed", "seq", F.filter("f", lambda x: x["older"]).alias("olds"), F.filter("f", lambda x: ~x["older"]).alias("news")).where("size(olds) > 0 AND size(news) > 0")
    same = F.flatten(F.transform("olds", lambda o: F.transform(F.filter("news", lambda n: (n["lo"] == o["lo"]) & (n["hi"] == o["hi"]) & (o["lo"] == o["hi"])), lambda n: F.struct(o["name"].alias("old_field"), n["name"].alias("new_field")))))
    agree = sides.select("feed", "seq", F.explode(same).alias("p")).groupBy("feed", "seq", "p.old_field", "p.new_field").agg(F.count(F.lit(1)).alias("agree"))
    kinds = sides.groupBy("feed", "seq", F.col("olds.name").alias("olds"), F.col("news.name").alias("news")).agg(F.count(F.lit(1)).alias("n"))
    pairs = kinds.select("feed", "seq", "n", "news", F.explode("olds").alias("old_field")).select("feed", "seq", "n", "old_field", F.explode("news").alias("new_field"))
    held = pairs.groupBy("feed", "seq", "old_field", "new_field").agg(F.sum("n").alias("held"))
    return agree.join(held, ["feed", "seq", "old_field", "new_field"]).where("agree = held").select("feed", "seq", "old_field", "new_field")


def _join_types(types: Column) -> Column:
    """Fold an array of lattice types (nulls are the bottom) to their join."""
    above = F.create_map(*[x for t, ups in ABOVE.items() for x in (F.lit(t), F.array(*[F.lit(u) for u in ups]))])

    def meet(acc: Column, t: Column) -> Column:
        common = F.array_intersect(F.try_element_at(above, acc), F.try_element_at(above, t))
        return F.when(acc.isNull(), t).when(t.isNull(), acc).otherwise(F.get(common, F.lit(0)))

    return F.aggregate(types, F.lit(None).cast("string"), meet)


def union_schema(df: DataFrame, feed: str = "feed", seq: str = "file_seq", edge: str = "edge_uid", raw: str = "raw") -> DataFrame:
    """The schema that all files are cast to: (column, names, type, lines, files), most lines first.

    Names that the change log ties by renamings, in any feed, are one column, named after
    the name with the most lines; its type is the join of its files' types in the lattice.
    """
    parsed, schemas = _survey(df, feed, seq, edge, raw)
    ties = _changes(schemas.select("feed", "seq").distinct(), parsed, schemas).where("change_kind = 'renamed'").select("old_field", "new_field").distinct()
    link = F.concat_ws("\u0001", "old_field", "new_field")
    tied = ties.select(F.explode(F.array("old_field", "new_field")).alias("field"), link.alias("link"))
    members = schemas.select("field", F.col("field").alias("link")).distinct().unionByName(tied)
    group = components(members, "field", "link")
    by_name = schemas.groupBy("field").agg(F.sum("lines").alias("lines"), F.collect_set("type").alias("types"), F.count_distinct("feed", "seq").alias("files"))
    ranked = by_name.join(group, "field")
    order = F.struct((-F.col("lines")).alias("l"), F.col("field").alias("f"))
    return ranked.groupBy("component").agg(
        F.min(order)["f"].alias("column"),
        F.transform(F.sort_array(F.collect_list(order)), lambda x: x["f"]).alias("names"),
        _join_types(F.array_sort(F.flatten(F.collect_list("types")))).alias("type"),
        F.sum("lines").alias("lines"),
        F.sum("files").alias("files"),
    ).drop("component")


def unified(df: DataFrame, keep: list[str], schema: DataFrame, targets: Mapping[str, str] | None = None, raw: str = "raw") -> DataFrame:
    """Every whole line as a row of the union schema: ``keep``, then a column a union column.

    ``targets`` gives wanted Spark types by column, under any of its names, and the column
    then has that name; other columns take the lattice's type.
    For a scalar target a value wrapped in an object (its ``id``) or in a list (its first
    item) is unwrapped; for an array target a lone value becomes a list of one; for a wanted
    integer type an id behind a prefix (``CorpusId:7``) gives its digits. A value that can't
    be cast is null there and kept, as text, in the map column ``rest``. Of several names of
    a column in one line the first that isn't null holds. The union schema is metadata and
    read on the driver, whole. Columns of ``keep`` win over fields of the same name, which
    stay in ``rest``; of union columns whose names differ in case only, the later ones get a
    number, so that the table can be written.
    """
    targets = dict(targets or {})
    known = [(r, next((n for n in targets if n in r["names"]), None)) for r in schema.orderBy(F.desc("lines"), "column").collect()]
    kept = {k.lower() for k in keep}
    taken_names = kept | {"rest"}
    v = F.col("_v")
    out, used, casts, taken = [], [], [], []
    for r, target in sorted(known, key=lambda x: x[1] is None):  # wanted names first
        column = target or r["column"]
        if column.lower() in kept:
            continue
        used += list(r["names"])
        to = targets.get(column, SPARK_TYPES[r["type"] or "string"])
        own = []
        for n in r["names"]:
            # A path can't name a field with both kinds of quotes: such a field is looked up in a map.
            odd = "'" in n and '"' in n
            mark = '"' if "'" in n else "'"
            at, p = (F.try_element_at(F.try_variant_get(v, "$", "map<string,variant>"), F.lit(n)), "$") if odd else (v, f"$[{mark}{n}{mark}]")
            tries = [F.try_variant_get(at, p, to)]
            if to.startswith("array<"):
                tries.append(F.when(F.try_variant_get(at, p, to[6:-1]).isNotNull(), F.array(F.try_variant_get(at, p, to[6:-1]))))
            elif to != "string":
                tries += [F.try_variant_get(at, p + ".id", to), F.try_variant_get(at, p + "[0]", to)]
            if target and to in _INTEGERS:
                tries += [F.regexp_extract(F.try_variant_get(at, p + q, "string"), _PREFIXED, 1).try_cast(to) for q in ("", ".id", "[0]")]
            own.append(f"_cast{len(casts)}")
            casts.append(F.coalesce(*tries).alias(own[-1]))
            taken.append(F.when(F.col(own[-1]).isNotNull(), F.lit(n)))
        alias, number = column, 1
        while alias.lower() in taken_names:
            number += 1
            alias = f"{column}_{number}"
        taken_names.add(alias.lower())
        out.append(F.coalesce(*own).alias(alias))
    parsed = with_objects(df, keep, raw).where(F.schema_of_variant("_v").startswith("OBJECT")).select(*keep, "_v", *casts)
    names = F.array(*[F.lit(n) for n in used]) if used else F.array().cast("array<string>")
    held = F.array_compact(F.array(*taken)) if used else F.array().cast("array<string>")
    # Of the columns' names only what none of the casts could take.
    rest = F.map_filter(F.try_variant_get(v, "$", "map<string,string>"), lambda k, x: ~F.array_contains(names, k) | (x.isNotNull() & ~F.array_contains(held, k)))
    return parsed.select(*keep, *out, rest.alias("rest"))
