"""Whole-document JSON and TSV readers."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from refmine.operators.contexts import from_merged, from_papers

# Ids are read as text and cast afterwards: one of another type must not cost a document its other rows.
_ELEMENT = "array<struct<{}: string, contexts: array<string>>>"
_PAPER = f"struct<corpusid: string, cited_corpusid: string, citations: {_ELEMENT.format('cited_corpusid')}, citing_papers: {_ELEMENT.format('citing_corpusid')}>"
_CONTEXT = "struct<context: string, citing_paper_id: string, cited_paper_id: string, source: string>"
PAPERS_DOCUMENT = f"papers array<{_PAPER}>"
MERGED_DOCUMENT = f"query string, total_contexts string, contexts array<{_CONTEXT}>"
EXTRACTION_DOCUMENT = (
    "source_file string, topic string, total_contexts bigint, contexts_with_datasets bigint, processing_time double, extractions array<struct<context: string, datasets: array<string>, "
    "descriptions: map<string,string>, citation_intent: array<string>, resource_type: array<string>, confidence: double, citing_paper_id: string, cited_paper_id: string>>"
)


def read_documents(spark: SparkSession, path: str | list[str], schema: str, skip_bad: bool = True, but: list[str] | None = None) -> DataFrame:
    """One row a file. A value of another type is null and costs nothing else; a file that is no JSON gives a row of nulls, or raises.

    ``unreadable`` tells which files had something that couldn't be read. ``but``: paths, as
    Spark's metadata has them, that aren't read.
    """
    df = spark.read.schema(schema + ", _bad string").option("multiLine", "true").option("columnNameOfCorruptRecord", "_bad").option("mode", "PERMISSIVE" if skip_bad else "FAILFAST").json(path)
    if but:
        df = df.where(~F.col("_metadata.file_path").isin(but))
    df = df.select("*", F.col("_metadata.file_name").alias("file_name"))
    return df.drop("_bad")


def unreadable(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """(file_name) of the documents that are no JSON or hold a value that doesn't fit the schema."""
    df = spark.read.schema(schema + ", _bad string").option("multiLine", "true").option("columnNameOfCorruptRecord", "_bad").json(path)
    # The reader wants another column beside the one of bad records.
    seen = df.select("*", F.col("_metadata.file_name").alias("file_name")).groupBy("file_name").agg(F.max("_bad").alias("bad"), F.count(df.columns[0]).alias("n"))
    return seen.where("bad IS NOT NULL AND n >= 0").select("file_name")


# Documents with two blanks a level, as they are written here, are read in pieces by many tasks: a JSON string
# holds no line break, so these characters stand nowhere but before an element and behind the last one.
_BEFORE, _BEHIND = "\n    {", "\n  ]"
#: Characters around the elements of a document beyond which it isn't taken apart.
_FRAME = 1 << 16


def _pieces(spark: SparkSession, path: str | list[str], which: Column) -> DataFrame:
    """(path, file_name, block, at, value): the files' text cut before each element; block and at give the order within a file."""
    where = [F.col(f"_metadata.{c}").alias(n) for c, n in (("file_path", "path"), ("file_name", "file_name"), ("file_block_start", "block"))]
    return spark.read.option("lineSep", _BEFORE).text(path).where(which).select("value", *where).select("path", "file_name", "block", F.monotonically_increasing_id().alias("at"), "value")


def _list_key(frame: str, opening: str) -> str | None:
    """The key of the only list of papers or contexts, which ``opening`` opens; ``frame`` is the document without the list's elements."""
    try:
        key = [*json.loads(opening + "]}")][-1]
        pairs = json.loads(frame, object_pairs_hook=list) if opening.startswith("{") else []
    except (ValueError, AttributeError, IndexError, TypeError):
        return None
    return key if [(k, v) for k, v in pairs if k in ("papers", "contexts")] == [(key, [])] else None


def _divisible(spark: SparkSession, path: str | list[str], which: Column) -> dict[str, str | None]:
    """By path the key of the list that can be read in pieces; None for a document of another layout, or with a flaw anywhere."""
    last = F.contains("value", F.lit(_BEHIND))
    inside = F.when(last, F.concat(F.substring_index("value", _BEHIND, 1), F.lit(","))).otherwise(F.col("value"))
    # Exactly one object fits here: an element more, or an end too early, gives other sizes or no JSON.
    tried = F.from_json(F.concat(F.lit("[[{"), inside, F.lit("{}],[]]")), "array<array<struct<_: string>>>")
    whole = F.transform(tried, F.size) == F.array(F.lit(2), F.lit(0))
    short = lambda c: F.when(F.length(c) <= _FRAME, c)
    # The text before the first element is the only piece that is no element, the last piece the only one with an end.
    rest = F.when(F.col("last"), short(F.expr("substr(value, instr(value, '\\n  ]'))")))
    pieces = _pieces(spark, path, which).select("path", F.coalesce(whole, F.lit(False)).alias("whole"), last.alias("last"), "value")
    seen = pieces.where("NOT whole OR last").groupBy("path").agg(
        F.max(F.when(~F.col("whole"), short(F.col("value")))).alias("opening"), F.max(rest).alias("rest"), F.count_if(~F.col("whole")).alias("others"), F.count_if("last").alias("ends")
    )
    good = F.expr("others = 1 AND ends = 1")
    found = seen.select("path", F.when(good, F.col("opening")).alias("opening"), F.when(good, F.col("rest")).alias("rest")).collect()
    return {r.path: _list_key(r.opening + r.rest, r.opening) if r.opening and r.rest else None for r in found}


def _elements(spark: SparkSession, path: str | list[str], paths: list[str], kind: str) -> DataFrame:
    """(file_name, block, at, p): elements of documents that can be read in pieces."""
    pieces = _pieces(spark, path, F.col("_metadata.file_path").isin(paths)).where(~F.startswith("value", F.lit("{")))
    # Exploded, so that no later projection parses the text again.
    return pieces.select("file_name", "block", "at", F.explode(F.array(F.from_json(F.concat(F.lit("{"), "value"), kind))).alias("p"))


def read_contexts(spark: SparkSession, path: str, legacy_roles: bool = False) -> DataFrame:
    """Contexts of one document of either format; the merged one wins if a document has both keys."""
    keys = _divisible(spark, path, F.lit(True))
    key = next(iter(keys.values())) if len(keys) == 1 else None
    if key == "contexts" or key is None and read_documents(spark, path, MERGED_DOCUMENT).where("contexts IS NOT NULL").limit(1).count():
        if key:
            rows = _elements(spark, path, [*keys], _CONTEXT).select(F.struct("block", "at").alias("ord"), "p.*")
        else:
            rows = read_documents(spark, path, MERGED_DOCUMENT).select(F.posexplode("contexts").alias("ord", "c")).select("c.*", "ord")
        return from_merged(rows, "ord").select("context", "citing_paper_id", "cited_paper_id", F.struct("ord").alias("ord"))
    if key:
        rows = _elements(spark, path, [*keys], _PAPER).select(F.struct("block", "at").alias("row"), "p.*")
    else:
        rows = read_documents(spark, path, PAPERS_DOCUMENT).select(F.posexplode("papers").alias("row", "p")).select("row", "p.*")
    flat = from_papers(rows, "row", legacy_roles)
    return flat.select("context", F.col("citing_paper_id").cast("string"), F.col("cited_paper_id").cast("string"), "ord")


def read_context_files(spark: SparkSession, folder: str, merged_name: str = "all_contexts.json") -> DataFrame:
    """Contexts of all papers-format documents of a folder, with ``source`` the file's name; earlier merged output is left out."""
    path = f"{folder.rstrip('/')}/*.json"
    own = [p for p, key in _divisible(spark, path, F.col("_metadata.file_name") != merged_name).items() if key == "papers"]
    docs = read_documents(spark, path, PAPERS_DOCUMENT, but=own).where(F.col("file_name") != merged_name)
    at = F.lit(0).cast("bigint").alias("block"), F.col("at").cast("bigint").alias("at")
    papers = docs.select("file_name", F.posexplode("papers").alias("at", "p")).select("file_name", *at, "p")
    if own:
        papers = papers.unionByName(_elements(spark, path, own, _PAPER))
    flat = from_papers(papers.select(F.struct("file_name", "block", "at").alias("row"), "p.*"), "row")
    return flat.withColumn("source", F.col("ord.row.file_name"))


def read_extractions(spark: SparkSession, path: str, skip_bad: bool = True) -> DataFrame:
    """Rows of extraction documents with their place as ``ord``."""
    return read_documents(spark, path, EXTRACTION_DOCUMENT, skip_bad).select(F.posexplode("extractions").alias("ord", "e")).select("ord", "e.*")


def read_tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A TSV with header, all columns text, empty cells null."""
    return spark.read.csv(path, sep="\t", header=True, escape='"', multiLine=True)
