"""Queries of the general data problems: uneven keys, packed cells, drifting schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from refmine.operators.packed import split_packed
from refmine.operators.skew import eager_join_aggregate, top_items
from refmine.session import table
from refmine.sources.drift import schema_changes, unified, union_schema

#: Types that the edge table wants, whatever the files hold.
EDGE_TYPES = {
    "edge_uid": "bigint", "corpusid": "bigint", "cited_corpusid": "bigint", "contexts": "array<string>",
    "year": "int", "score": "double", "is_influential": "boolean",
}


def citing_entries(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """(paper_id, citing_id) of both fields, without null and zero ids; only ids are read."""
    flat = table(spark, folder, "citation_contexts").select(F.col("cited_paper_id").alias("paper_id"), F.col("citing_paper_id").alias("citing_id"))
    nested = table(spark, folder, "context_papers").select(F.col("corpusid").alias("paper_id"), F.explode("citing_papers.citing_corpusid").alias("citing_id"))
    return {n: df.where("paper_id <> 0 AND citing_id <> 0") for n, df in (("cited_paper_id", flat), ("citing_papers", nested))}


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return top_items(citing_entries(spark, folder), "paper_id", "citing_id").select("field_name", "paper_id", F.col("top_item").alias("top_citing_id"))


def p1_paper_counts(spark: SparkSession, folder: str) -> DataFrame:
    return top_items(citing_entries(spark, folder), "paper_id", "citing_id").select("field_name", "paper_id", "entries", F.col("items").alias("citing_papers"), "top_entries")


def p1_joined_by_source(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of contexts and nested entries of one cited paper, by source file, without making the pairs."""
    contexts = table(spark, folder, "citation_contexts").select("source", F.col("cited_paper_id").alias("paper_id"), F.length("context").alias("chars"))
    nested = table(spark, folder, "context_papers").select(F.col("corpusid").alias("paper_id"), F.explode("citing_papers.citing_corpusid").alias("citing_id"))
    out = eager_join_aggregate(contexts, nested, "paper_id", ["chars"], [], rollup="source")
    return out.select("source", F.col("pairs").cast("bigint").alias("pairs"), F.col("sum_chars").cast("bigint").alias("sum_chars"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return split_packed(table(spark, folder, "analyzed_datasets"), "row_id", ["variants", "citing_article"], "table_file")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return schema_changes(table(spark, folder, "context_files"))


def p4_schema(spark: SparkSession, folder: str) -> DataFrame:
    schema = union_schema(table(spark, folder, "context_files"))
    return schema.select("column", F.array_join("names", " ").alias("names"), "type", "lines", "files")


def p4_edges(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "context_files")
    return unified(lines, ["feed", "file_seq", "line_id"], union_schema(lines), EDGE_TYPES)


def p4_edge_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The ends of every edge of the one table."""
    return p4_edges(spark, folder).select("line_id", "edge_uid", "corpusid", "cited_corpusid", "year")


QUERIES = {f.__name__: f for f in (p1_found, p1_paper_counts, p1_joined_by_source, p3_found, p4_found, p4_schema, p4_edges, p4_edge_ids)}

_ENTRIES = """
WITH e AS (
  SELECT 'cited_paper_id' AS field_name, cited_paper_id AS paper_id, citing_paper_id AS citing_id FROM citation_contexts
  UNION ALL
  SELECT 'citing_papers', corpusid, x.citing_corpusid FROM (SELECT corpusid, unnest(citing_papers) AS x FROM context_papers)
), n AS (
  SELECT field_name, paper_id, citing_id, count(*) AS n FROM e WHERE paper_id <> 0 AND citing_id <> 0 GROUP BY ALL
)"""

_DRIFT = """
WITH RECURSIVE l AS (
  SELECT line_id, feed, file_seq AS seq, CAST(raw AS JSON) AS j FROM (SELECT * FROM context_files WHERE json_valid(raw)) WHERE json_type(raw) = 'OBJECT'
), v AS (
  SELECT line_id, feed, seq, j ->> '$.edge_uid' AS edge, field, j -> ('$."' || field || '"') AS value FROM (SELECT *, unnest(json_keys(j)) AS field FROM l)
), t AS (
  SELECT *, value ->> '$' AS text, CASE json_type(value) WHEN 'VARCHAR' THEN 1 WHEN 'BOOLEAN' THEN 2 WHEN 'ARRAY' THEN 3 WHEN 'OBJECT' THEN 4 WHEN 'UBIGINT' THEN 5 WHEN 'BIGINT' THEN 5 WHEN 'DOUBLE' THEN 6 END AS typ FROM v
), c AS (
  SELECT feed, seq, field, typ, count(typ) AS n, count(*) AS lines FROM t WHERE feed IS NOT NULL AND seq IS NOT NULL GROUP BY ALL
), s AS (
  SELECT feed, seq, field, arg_min(typ, (-n, typ)) FILTER (n > 0) AS typ, sum(lines) AS lines FROM c GROUP BY ALL
), f AS (
  SELECT * FROM (SELECT feed, seq, lag(seq) OVER (PARTITION BY feed ORDER BY seq) AS old FROM (SELECT DISTINCT feed, file_seq AS seq FROM context_files WHERE feed IS NOT NULL AND file_seq IS NOT NULL)) WHERE old IS NOT NULL
), n AS (SELECT f.*, s.field, s.typ FROM f JOIN s USING (feed, seq)), o AS (SELECT f.*, s.field, s.typ FROM f JOIN s ON s.feed = f.feed AND s.seq = f.old),
gone AS (FROM o ANTI JOIN n USING (feed, seq, field)), fresh AS (FROM n ANTI JOIN o USING (feed, seq, field)),
e AS (SELECT feed, seq, edge, field, min(text) AS lo, max(text) AS hi FROM t WHERE typ IS NOT NULL AND edge IS NOT NULL GROUP BY ALL),
renamed AS (
  SELECT g.feed, g.seq, g.field AS old_field, h.field AS new_field, any_value(g.typ) AS old_typ, any_value(h.typ) AS new_typ
  FROM gone g JOIN fresh h ON g.feed = h.feed AND g.seq = h.seq
  JOIN e a ON a.feed = g.feed AND a.seq = g.old AND a.field = g.field JOIN e b ON b.feed = h.feed AND b.seq = h.seq AND b.field = h.field AND a.edge = b.edge
  GROUP BY ALL HAVING bool_and(a.lo = a.hi AND b.lo = b.hi AND a.lo = b.lo)
)"""


def _sql_id(name: str) -> str:
    """A whole number under any of a column's names: the names with most lines first."""
    return f"(SELECT first(x ORDER BY lines DESC, field) FROM ids WHERE ids.line_id = l.line_id AND ids.target = '{name}' AND x IS NOT NULL) AS {name}"


ORACLE = {
    "p4_found": _DRIFT + """
SELECT feed, seq AS file_seq, 'renamed' AS change_kind, old_field, new_field FROM renamed
UNION ALL SELECT feed, seq, 'retyped', old_field, new_field FROM renamed WHERE old_typ <> new_typ
UNION ALL SELECT n.feed, n.seq, 'retyped', n.field, n.field FROM n JOIN o ON n.feed = o.feed AND n.seq = o.seq AND n.field = o.field WHERE n.typ <> o.typ
UNION ALL SELECT g.feed, g.seq, 'removed', g.field, '' FROM gone g ANTI JOIN renamed r ON g.feed = r.feed AND g.seq = r.seq AND g.field = r.old_field
UNION ALL SELECT h.feed, h.seq, 'added', '', h.field FROM fresh h ANTI JOIN renamed r ON h.feed = r.feed AND h.seq = r.seq AND h.field = r.new_field""",
    "p4_schema": _DRIFT + """, near AS (
  SELECT DISTINCT field AS x, field AS y FROM s UNION SELECT n.x, CASE WHEN r.old_field = n.y THEN r.new_field ELSE r.old_field END FROM near n JOIN renamed r ON n.y IN (r.old_field, r.new_field)
), own AS (SELECT x AS field, min(y) AS part FROM near GROUP BY x),
by_name AS (SELECT field, sum(lines) AS lines, count(DISTINCT (feed, seq)) AS files, list_filter(list_distinct(list(typ)), lambda x: x IS NOT NULL) AS types FROM s GROUP BY field),
merged AS (SELECT part, list(field ORDER BY lines DESC, field) AS names, sum(lines) AS lines, sum(files) AS files, list_sort(list_distinct(flatten(list(types)))) AS types FROM by_name JOIN own USING (field) GROUP BY part)
SELECT names[1] AS "column", array_to_string(names, ' ') AS names, CAST(lines AS BIGINT) AS lines, CAST(files AS BIGINT) AS files,
  CASE WHEN len(types) = 0 THEN NULL WHEN len(types) = 1 THEN ['string', 'boolean', 'array', 'object', 'integer', 'decimal'][types[1]] WHEN types = [5, 6] THEN 'decimal' ELSE 'string' END AS type FROM merged""",
    "p4_edge_ids": _DRIFT + """, alias AS (
  SELECT unnest(['edge_uid', 'corpusid', 'cited_corpusid', 'year']) AS target, target AS field
  UNION SELECT a.target, CASE WHEN r.old_field = a.field THEN r.new_field ELSE r.old_field END FROM alias a JOIN renamed r ON a.field IN (r.old_field, r.new_field)
), named AS (SELECT target, field, sum(lines) AS lines FROM alias JOIN s USING (field) GROUP BY ALL),
w AS (SELECT line_id, target, field, lines, CASE typ WHEN 4 THEN value ->> '$.id' WHEN 3 THEN value ->> '$[0]' ELSE text END AS x FROM t JOIN named USING (field)),
ids AS (SELECT line_id, target, field, lines, coalesce(CAST(trunc(TRY_CAST(x AS DOUBLE)) AS BIGINT), TRY_CAST(regexp_extract(x, '^\\s*\\p{L}\\w*[:#/\\s-]+(\\d+)\\s*$', 1) AS BIGINT)) AS x FROM w)
SELECT line_id, """ + ", ".join(_sql_id(n) for n in ("edge_uid", "corpusid", "cited_corpusid")) + ", CAST(" + _sql_id("year").replace(" AS year", "") + """ AS INTEGER) AS year FROM l""",
    "p1_found": _ENTRIES + """
SELECT field_name, paper_id, citing_id AS top_citing_id FROM n
QUALIFY row_number() OVER (PARTITION BY field_name, paper_id ORDER BY n DESC, citing_id) = 1""",
    "p1_paper_counts": _ENTRIES + """
SELECT field_name, paper_id, CAST(sum(n) AS BIGINT) AS entries, count(*) AS citing_papers, max(n) AS top_entries FROM n GROUP BY ALL""",
    "p1_joined_by_source": """
SELECT source, CAST(count(*) AS BIGINT) AS pairs, CAST(sum(length(context)) AS BIGINT) AS sum_chars
FROM citation_contexts c JOIN (SELECT corpusid, unnest(citing_papers) AS x FROM context_papers) p ON c.cited_paper_id = p.corpusid
GROUP BY source""",
}
