"""Queries of the training-data problems, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from refmine.llm.leakage import leaked_items
from refmine.llm.ledger import CopyLedger, batch_numbers, canonical_items, canonical_text, key_digest
from refmine.llm.splitting import split_oversized
from refmine.llm.survivors import PLACEHOLDERS, surviving_fields, surviving_records
from refmine.llm.terms import term_frequencies
from refmine.llm.tokenizer import encode_corpus, vocabulary_path
from refmine.session import materialize, table


#: Batches in which the ledger takes in the tables.
BATCHES = 3


#: Three quarters of a passage's words in order; or six tenths, if the words that tell the item are held or its answer is.
PARAPHRASED = "run < least(12, words) AND (lcs >= 0.75 * least(24, words) OR (lcs >= 0.6 * least(24, words) AND (held >= 0.6 OR answer)))"


def _copy_keys(spark: SparkSession, folder: str) -> DataFrame:
    """(scope, key, id, batch) of both tables, keys computed once; rows that aren't compared have no key and are left out."""
    e, a = table(spark, folder, "extraction_results"), table(spark, folder, "analyzed_datasets")
    number = batch_numbers(e.select("ingested_at").unionByName(a.select("ingested_at")), "ingested_at", BATCHES).alias("batch")
    items = key_digest(F.col("citing_paper_id"), F.col("cited_paper_id"), canonical_items("extracted_datasets"))
    rows = (
        e.select(F.lit("extraction_results").alias("scope"), items.alias("key"), F.col("extraction_id").alias("id"), number)
        .unionByName(a.select(F.lit("analyzed_datasets").alias("scope"), key_digest(canonical_text("dataset")).alias("key"), F.col("row_id").alias("id"), number))
    )
    return materialize(rows.where("key IS NOT NULL"), "copy-keys", "batch")


def _ledger(rows: DataFrame) -> CopyLedger:
    ledger = CopyLedger(rows.sparkSession)
    for n in range(BATCHES):
        ledger.update(rows.where(F.col("batch") == n), f"arrival-{n}")
    return ledger


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = _copy_keys(spark, folder)
    return _ledger(rows).copies(rows).select(F.col("scope").alias("table_name"), "first_id", "copy_id")


def p2_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row a distinct record, with its number of copies."""
    return _ledger(_copy_keys(spark, folder)).entries.select(F.col("scope").alias("table_name"), "first_id", "copies")


def _terms(spark: SparkSession, folder: str) -> DataFrame:
    return term_frequencies(table(spark, folder, "extraction_results"), ["extracted_datasets", "resource_type"])


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _terms(spark, folder).where("mark IS NOT NULL").select("field_name", "term", "mark")


def p5_terms(spark: SparkSession, folder: str) -> DataFrame:
    return _terms(spark, folder).select("field_name", "term", "occurrences", "records")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return surviving_fields(table(spark, folder, "merged_datasets"), table(spark, folder, "extraction_results"))


def p6_records(spark: SparkSession, folder: str) -> DataFrame:
    """One built record a group."""
    rows = surviving_records(table(spark, folder, "merged_datasets"), table(spark, folder, "extraction_results"))
    return rows.withColumn("variants", F.array_join("variants", " | "))


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return encode_corpus(docs, "text", vocabulary_path()).select("doc_id", "ids")


def p8_candidates(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "eval_items")
    return leaked_items(docs, items, "doc_id", "text", "item_id", "text", "gold_labels")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "eval_items")
    found = leaked_items(docs, items, "doc_id", "text", "item_id", "text", share=None)
    return found.where("run >= least(12, words)").select("doc_id", "item_id")


def p8_paraphrased(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold no whole run of an item but most of its words in order."""
    return p8_candidates(spark, folder).where(PARAPHRASED).select("doc_id", "item_id", "words", "run", "lcs", "answer")


def p9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return split_oversized(table(spark, folder, "documents"), "doc_id", "text", vocabulary_path())


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_pieces(spark, folder).where("piece = 1").select("doc_id")


QUERIES = {f.__name__: f for f in (p2_found, p2_records, p5_found, p5_terms, p6_found, p6_records, p7_ids, p8_found, p8_paraphrased, p9_found, p9_pieces)}

_BARE = r"lower(regexp_replace({}, '[^\p{{L}}\p{{N}}]+', '', 'g'))"
_KEYS = f"""
WITH e AS (
  SELECT extraction_id AS id, citing_paper_id AS a, cited_paper_id AS b,
    list_sort(list_distinct(list_filter(list_transform(extracted_datasets, lambda x: {_BARE.format("x")}), lambda x: x <> ''))) AS k
  FROM extraction_results WHERE citing_paper_id IS NOT NULL AND cited_paper_id IS NOT NULL
), keys AS (
  SELECT 'extraction_results' AS table_name, id, a || '/' || b || '/' || array_to_string(k, chr(31)) AS k FROM e WHERE len(k) > 0
  UNION ALL
  SELECT 'analyzed_datasets', row_id, {_BARE.format("dataset")} FROM analyzed_datasets WHERE {_BARE.format("dataset")} <> ''
)"""
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_TERMS = f"""
WITH i AS (
  SELECT extraction_id AS id, 'extracted_datasets' AS field_name, unnest(extracted_datasets) AS x FROM extraction_results
  UNION ALL
  SELECT extraction_id, 'resource_type', unnest(resource_type) FROM extraction_results
), t AS (
  SELECT id, field_name, trim(regexp_replace(lower(x), '{_WHITE}+', ' ', 'g')) AS term FROM i
), n AS (
  SELECT field_name, term, count(*) AS occurrences, count(DISTINCT id) AS records FROM t WHERE term <> '' GROUP BY ALL
), h AS (
  SELECT field_name, count(DISTINCT id) AS holding FROM t WHERE term <> '' GROUP BY ALL
)"""

_SURVIVORS = f"""
WITH RECURSIVE m AS (
  SELECT record_id AS id, name, variants, trust, updated_at AS tm, mention_ids, list_filter(list_distinct(variants), lambda x: {_BARE.format("x")} <> '') AS own,
    list_filter(list_distinct(list_transform(list_append(coalesce(variants, []), name), lambda x: {_BARE.format("x")})), lambda x: x <> '') AS forms
  FROM merged_datasets
), f AS (SELECT id, unnest(forms) AS form FROM m), l AS (SELECT DISTINCT a.id AS x, b.id AS y FROM f a JOIN f b USING (form)),
reach AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM reach r JOIN l ON r.y = l.x),
g AS (SELECT x AS id, min(y) AS group_id FROM reach GROUP BY x HAVING count(*) > 1),
r AS (SELECT g.group_id, m.* FROM m JOIN g USING (id)),
known AS (SELECT DISTINCT group_id, form FROM f JOIN g USING (id)),
said AS (SELECT extraction_id AS eid, confidence_score AS c, extracted_at AS tm, unnest(map_entries(dataset_descriptions)) AS e FROM extraction_results),
d AS (
  SELECT DISTINCT eid, c, tm, {_BARE.format("e.key")} AS form FROM said
  WHERE {_BARE.format("e.value")} <> '' AND {_BARE.format("e.value")} NOT IN ({", ".join(repr(p) for p in PLACEHOLDERS)})
), o AS (
  SELECT DISTINCT group_id, eid, c, d.tm FROM (SELECT group_id, unnest(mention_ids) AS eid FROM r) JOIN d USING (eid) JOIN known USING (group_id, form)
), ranked AS (
  SELECT group_id, 'name' AS field_name, id AS source_id, row_number() OVER (PARTITION BY group_id ORDER BY trust DESC NULLS LAST, tm DESC NULLS LAST, id) AS n FROM r WHERE {_BARE.format("name")} <> ''
  UNION ALL
  SELECT group_id, 'variants', id, row_number() OVER (PARTITION BY group_id ORDER BY len(own) DESC, tm DESC NULLS LAST, id) FROM r WHERE len(own) > 0
  UNION ALL
  SELECT group_id, 'dataset_descriptions', eid, row_number() OVER (PARTITION BY group_id ORDER BY c DESC NULLS LAST, tm DESC NULLS LAST, eid) FROM o
)"""

ORACLE: dict[str, str] = {
    "p8_found": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents), i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
n AS (SELECT item_id, w, least(12, len(w)) AS n FROM i WHERE len(w) > 0),
g AS (SELECT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k:k + n - 1], ' '))) AS gram FROM n),
p AS (SELECT doc_id, s.n, unnest(list_transform(range(1, len(w) - s.n + 2), lambda k: array_to_string(w[k:k + s.n - 1], ' '))) AS gram FROM d, (SELECT DISTINCT n FROM n) s)
SELECT DISTINCT doc_id, item_id FROM g JOIN p USING (n, gram)""",
    "p6_records": _SURVIVORS + f""", q AS (
  SELECT id, eid, row_number() OVER (PARTITION BY id ORDER BY c DESC NULLS LAST, d.tm DESC NULLS LAST, eid) AS n
  FROM (SELECT group_id, id, unnest(list_distinct(mention_ids)) AS eid FROM r) JOIN d USING (eid) JOIN known USING (group_id, form)
), pt AS (
  SELECT r.group_id, r.id, r.name, r.variants, q.eid, coalesce({_BARE.format("r.name")} <> '', false) AS named, coalesce(len(r.own) > 0, false) AS spelled,
    CAST(coalesce({_BARE.format("r.name")} <> '', false) AS INT) + CAST(coalesce(len(r.own) > 0, false) AS INT) + CAST(q.eid IS NOT NULL AS INT) AS filled,
    coalesce(epoch_us(r.tm), -9223372036854775807) AS tm, coalesce(r.trust, -2147483648) AS trust
  FROM r LEFT JOIN q ON q.id = r.id AND q.n = 1
), dom AS (
  SELECT y.id AS y, x.id AS x FROM pt y JOIN pt x ON x.group_id = y.group_id AND y.filled >= x.filled AND y.tm >= x.tm AND y.trust >= x.trust AND (y.filled > x.filled OR y.tm > x.tm OR y.trust > x.trust)
), chain AS (SELECT id, 0 AS n FROM pt UNION SELECT dom.x, chain.n + 1 FROM chain JOIN dom ON dom.y = chain.id),
layer AS (SELECT id, least(4, max(n)) AS layer FROM chain GROUP BY id),
pick AS (
  SELECT *, row_number() OVER (PARTITION BY group_id, named ORDER BY layer, trust DESC, tm DESC, id) AS by_name, row_number() OVER (PARTITION BY group_id, spelled ORDER BY layer, trust DESC, tm DESC, id) AS by_spelling,
    row_number() OVER (PARTITION BY group_id, eid IS NOT NULL ORDER BY layer, trust DESC, tm DESC, id) AS by_text FROM pt JOIN layer USING (id)
), x AS (
  SELECT group_id, said.eid, min_by(e.value, e.key) AS description FROM pick JOIN said USING (eid) JOIN known USING (group_id)
  WHERE eid IS NOT NULL AND by_text = 1 AND known.form = {_BARE.format("e.key")} AND {_BARE.format("e.value")} <> '' AND {_BARE.format("e.value")} NOT IN ({", ".join(repr(p) for p in PLACEHOLDERS)})
  GROUP BY ALL
)
SELECT group_id, n.name, array_to_string(v.variants, ' | ') AS variants, x.description, n.layer AS name_layer, v.layer AS variants_layer, t.layer AS description_layer
FROM (SELECT DISTINCT group_id FROM pt WHERE filled > 0) LEFT JOIN (SELECT * FROM pick WHERE named AND by_name = 1) n USING (group_id) LEFT JOIN (SELECT * FROM pick WHERE spelled AND by_spelling = 1) v USING (group_id)
LEFT JOIN (SELECT * FROM pick WHERE eid IS NOT NULL AND by_text = 1) t USING (group_id) LEFT JOIN x USING (group_id)""",
    "p6_found": _SURVIVORS + " SELECT group_id, field_name, source_id FROM ranked WHERE n = 1",
    "p2_found": _KEYS + """
SELECT * FROM (SELECT table_name, min(id) OVER (PARTITION BY table_name, k) AS first_id, id AS copy_id FROM keys) WHERE first_id <> copy_id""",
    "p2_records": _KEYS + " SELECT table_name, min(id) AS first_id, count(*) AS copies FROM keys GROUP BY table_name, k",
    "p5_found": _TERMS + """
SELECT field_name, term, CASE WHEN records < 3 THEN 'rare' ELSE 'common' END AS mark FROM n JOIN h USING (field_name)
WHERE records < 3 OR records > 0.1 * holding""",
    "p5_terms": _TERMS + " SELECT * FROM n",
}
