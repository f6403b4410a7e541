"""Queries of the literature operators over the test tables, each with SQL where SQL can express it."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from refmine.functions import text as X
from refmine.model.client import RuleClient
from refmine.model.operator import RELEVANCE_TYPE, ask, extract_datasets, extraction_counters, extraction_rows, filter_relevant
from refmine.model.responses import relevance_record
from refmine.operators import consolidate as C, contexts as N, graph as G
from refmine.plans.pipeline import ContextQuery, Store, export_contexts, extraction_document, merge_contexts
from refmine.plans.rules import NAME_RULE, extraction_rule, relevance_rule
from refmine.session import materialize, shared_dir, table
from refmine.sinks.files import clean_columns, rewrite_link_tables, save_tsv
from refmine.sources.documents import read_contexts, read_extractions, read_tsv
from refmine.sources.jsonl import convert_files, ingest_jsonl
from refmine.sources.search import search_local
from refmine.streaming.incremental import ingest_new_files, latest_by_key, windowed_counts

QUERIES, ORACLE = {}, {}
#: The topic that the graph queries start from.
TOPIC = "entity linking"

_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def _sql_trim(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _sql_norm(x: str) -> str:
    inner = _sql_trim(f"lower({x})")
    return rf"regexp_replace(regexp_replace({inner}, '[^\p{{L}}\p{{N}}_\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]', '', 'g'), '{_WS}+', ' ', 'g')"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


# Mentions and ranks -----------------------------------------------------------------------

_MENTIONS = f"""
WITH x AS (
  SELECT extraction_id, coalesce(confidence_score, 0.5) AS confidence, dataset_descriptions AS d, citing_paper_id, cited_paper_id,
    unnest(extracted_datasets) AS raw, generate_subscripts(extracted_datasets, 1) - 1 AS pos
  FROM extraction_results
), m AS (
  SELECT *, {_sql_trim("raw")} AS name, {_sql_norm(_sql_trim("raw"))} AS norm FROM x WHERE regexp_matches(raw, '[^' || '\\s\\x0b\\x1c-\\x1f\\x{{85}}\\p{{Z}}' || ']')
)"""
_GROUPS = _MENTIONS + """, s AS (
  SELECT norm, name, count(*) AS n, min((extraction_id, pos)) AS first, sum(CAST(confidence AS DECIMAL(18,6))) AS c FROM m GROUP BY ALL
), g AS (
  SELECT norm, arg_min(name, (-n, first)) AS name, list(name ORDER BY first) AS variants, CAST(sum(n) AS BIGINT) AS mention_count,
    CAST(sum(c) AS DOUBLE) / sum(n) AS avg_confidence, min(first) AS first_ord FROM s GROUP BY norm
), p AS (
  SELECT norm, count(DISTINCT nullif(citing_paper_id, '')) AS citing_paper_count, count(DISTINCT nullif(cited_paper_id, '')) AS cited_paper_count FROM m GROUP BY norm
)"""


def _mentions(spark: SparkSession, folder: str) -> DataFrame:
    return C.mentions_of(table(spark, folder, "extraction_results"))


def _groups(spark: SparkSession, folder: str) -> DataFrame:
    return C.consolidate(_mentions(spark, folder))


@query(_MENTIONS + """ SELECT extraction_id, CAST(pos AS INTEGER) AS pos, name, coalesce(d[raw], '') AS description, confidence FROM m""")
def mention_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _mentions(spark, folder).select(F.col("row").alias("extraction_id"), "pos", "name", "description", "confidence")


@query(_GROUPS + """
SELECT row_number() OVER (ORDER BY mention_count DESC, first_ord) AS rank, name, mention_count, citing_paper_count, cited_paper_count, avg_confidence,
  array_to_string(variants[1:5], ', ') AS variants FROM g JOIN p USING (norm)""")
def mention_rank(spark: SparkSession, folder: str) -> DataFrame:
    ranked = C.with_ranks(_groups(spark, folder), [F.desc("mention_count"), F.asc("first_ord")])
    return ranked.select(F.col("rank").cast("bigint").alias("rank"), "name", "mention_count", "citing_paper_count", "cited_paper_count", "avg_confidence", F.array_join(F.slice("variants", 1, 5), ", ").alias("variants"))


_RANKED = _GROUPS + """, k AS (
  SELECT row_number() OVER (ORDER BY mention_count DESC, first_ord) AS "Rank", name AS "Dataset", mention_count AS "Mentions", citing_paper_count AS "Citing Papers", cited_paper_count AS "Cited Papers",
    CAST(format('{:.2f}', avg_confidence) AS DOUBLE) AS "Avg Confidence", array_to_string(variants[1:5], ', ') AS "Variants" FROM g JOIN p USING (norm)
)"""


@query(_RANKED + " SELECT * FROM k")
def rank_table(spark: SparkSession, folder: str) -> DataFrame:
    """The ranked table as written, averages rounded as Python does."""
    return C.rank_table(_groups(spark, folder), round_exactly=True)


@query(_GROUPS + " SELECT norm AS normalized_name, mention_count AS mentions, len(variants) AS spellings, cited_paper_count AS cited_papers FROM g JOIN p USING (norm)")
def norm_groups(spark: SparkSession, folder: str) -> DataFrame:
    return _groups(spark, folder).select("normalized_name", F.col("mention_count").alias("mentions"), "spellings", F.col("cited_paper_count").alias("cited_papers"))


@query(_GROUPS + " SELECT norm AS normalized_name, name FROM g")
def display_name(spark: SparkSession, folder: str) -> DataFrame:
    return _groups(spark, folder).select("normalized_name", "name")


@query(_GROUPS + " SELECT norm AS normalized_name, array_to_string(variants[1:5], ', ') AS variants, len(variants) AS n FROM g")
def variants_top5(spark: SparkSession, folder: str) -> DataFrame:
    return _groups(spark, folder).select("normalized_name", F.array_join("variants", ", ").alias("variants"), F.col("spellings").alias("n"))


@query(_GROUPS + " SELECT norm AS normalized_name, unnest(variants) AS name FROM g")
def all_spellings(spark: SparkSession, folder: str) -> DataFrame:
    return C.spellings_of(_mentions(spark, folder)).select("normalized_name", "name")


@query(_GROUPS + " SELECT norm AS normalized_name, mention_count AS n, avg_confidence FROM g")
def mean_confidence(spark: SparkSession, folder: str) -> DataFrame:
    return _groups(spark, folder).select("normalized_name", F.col("mention_count").alias("n"), "avg_confidence")


@query(_MENTIONS + """ SELECT norm AS normalized_name, (row_number() OVER (PARTITION BY norm ORDER BY extraction_id, pos) - 1) // 7 AS part, name, confidence FROM m""")
def mention_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Each group's mentions in order, in lists of seven, laid out again."""
    lists = C.collect_mentions(_mentions(spark, folder), 7)
    return lists.select("normalized_name", "part", F.explode("mentions").alias("m")).select("normalized_name", "part", "m.name", "m.confidence")


@query(_RANKED + """, b AS (
  SELECT dataset AS name, min(description) AS description FROM analyzed_datasets WHERE description IS NOT NULL AND dataset IS NOT NULL GROUP BY dataset
) SELECT k."Rank", k."Dataset", b.description AS "Description" FROM k LEFT JOIN b ON k."Dataset" = b.name""")
def desc_lookup(spark: SparkSession, folder: str) -> DataFrame:
    said = table(spark, folder, "analyzed_datasets").where("description IS NOT NULL AND dataset IS NOT NULL").groupBy(F.col("dataset").alias("name")).agg(F.min("description").alias("description"))
    return C.rank_table(_groups(spark, folder), said).select("Rank", "Dataset", "Description")


# Citation graph ---------------------------------------------------------------------------

_EDGES = f"""
WITH e AS (SELECT citing_paper_id AS citingcorpusid, cited_paper_id AS citedcorpusid, context FROM citation_contexts WHERE citing_paper_id <> 0 AND cited_paper_id <> 0),
found AS (
  SELECT corpusid FROM (SELECT corpusid, title, abstract FROM papers UNION ALL SELECT corpusid, title, abstract FROM seed_papers)
  WHERE corpusid <> 0 AND contains(lower(concat_ws(' ', title, abstract)), 'entity') AND contains(lower(concat_ws(' ', title, abstract)), 'linking')
), seeds AS (SELECT DISTINCT corpusid FROM found),
h_citing AS (SELECT * FROM e WHERE citingcorpusid IN (FROM seeds)), h_cited AS (SELECT * FROM e WHERE citedcorpusid IN (FROM seeds)),
c1 AS (SELECT DISTINCT citedcorpusid AS corpusid FROM h_citing WHERE citedcorpusid NOT IN (FROM seeds)),
x1 AS (SELECT DISTINCT citingcorpusid AS corpusid FROM h_cited)"""


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    return N.edges_from_contexts(table(spark, folder, "citation_contexts"))


def _papers(spark: SparkSession, folder: str) -> DataFrame:
    cols = ("corpusid", "title", "abstract")
    return table(spark, folder, "papers").select(*cols).unionByName(table(spark, folder, "seed_papers").select(*cols))


def _seeds(spark: SparkSession, folder: str) -> DataFrame:
    return G.seed_ids(search_local(_papers(spark, folder), TOPIC))


@query(_EDGES + " SELECT corpusid FROM seeds")
def topic_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return _seeds(spark, folder)


@query(_EDGES + " SELECT * FROM h_citing")
def cite_hop1_citing(spark: SparkSession, folder: str) -> DataFrame:
    return G.hop(_edges(spark, folder), _seeds(spark, folder), "citing")


@query(_EDGES + " SELECT * FROM h_cited")
def cite_hop1_cited(spark: SparkSession, folder: str) -> DataFrame:
    return G.hop(_edges(spark, folder), _seeds(spark, folder), "cited")


@query(_EDGES + " SELECT corpusid FROM c1")
def cite_frontier(spark: SparkSession, folder: str) -> DataFrame:
    seeds = _seeds(spark, folder)
    return G.frontier(G.hop(_edges(spark, folder), seeds, "citing"), "citing", seeds)


@query(_EDGES + " SELECT * FROM e WHERE citingcorpusid IN (FROM c1)")
def cite_hop2_citing(spark: SparkSession, folder: str) -> DataFrame:
    return G.second_hop(_edges(spark, folder), _seeds(spark, folder), "citing")


@query(_EDGES + " SELECT * FROM e WHERE citedcorpusid IN (FROM x1)")
def cite_hop2_cited(spark: SparkSession, folder: str) -> DataFrame:
    return G.second_hop(_edges(spark, folder), _seeds(spark, folder), "cited")


@query(_EDGES + """ SELECT 'citing' AS direction, count(DISTINCT citingcorpusid) AS found_ids, count(*) AS total_results FROM h_citing
UNION ALL SELECT 'cited', count(DISTINCT citedcorpusid), count(*) FROM h_cited""")
def hop_stats(spark: SparkSession, folder: str) -> DataFrame:
    edges, seeds = _edges(spark, folder), _seeds(spark, folder)
    parts = [G.hop_stats(G.hop(edges, seeds, d), d).select(F.lit(d).alias("direction"), "found_ids", "total_results") for d in ("citing", "cited")]
    return parts[0].unionByName(parts[1])


@query(_EDGES + """ SELECT direction, level, count(*) AS edges FROM (
  SELECT 'citing' AS direction, 1 AS level FROM h_citing UNION ALL SELECT 'cited', 1 FROM h_cited
  UNION ALL SELECT 'citing', 2 FROM e WHERE citingcorpusid IN (FROM c1) UNION ALL SELECT 'cited', 2 FROM e WHERE citedcorpusid IN (FROM x1)) GROUP BY ALL""")
def topic_walk(spark: SparkSession, folder: str) -> DataFrame:
    edges = _edges(spark, folder)
    walked = ContextQuery(TOPIC, None, "both", second=True).run(_papers(spark, folder), lambda _: edges)
    return walked.groupBy("direction", "level").agg(F.count(F.lit(1)).alias("edges"))


@query(_EDGES + """, l AS (
  SELECT corpusid, coalesce(title, '') AS title FROM papers WHERE corpusid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY corpusid ORDER BY updated_at DESC NULLS LAST, coalesce(title, '') DESC) = 1
) SELECT corpusid, title FROM l WHERE corpusid IN (FROM c1)""")
def paper_lookup(spark: SparkSession, folder: str) -> DataFrame:
    papers = G.latest_papers(table(spark, folder, "papers").select("corpusid", "title", "updated_at"))
    return G.lookup_papers(papers, cite_frontier(spark, folder), ["title"])


@query("""SELECT c.context_id, c.citing_paper_id AS citingcorpusid, c.cited_paper_id AS citedcorpusid, s.title AS cited_title, s.topic AS cited_topic
FROM citation_contexts c LEFT JOIN seed_papers s ON c.cited_paper_id = s.corpusid""")
def context_audit(spark: SparkSession, folder: str) -> DataFrame:
    edges = table(spark, folder, "citation_contexts").select("context_id", F.col("citing_paper_id").alias("citingcorpusid"), F.col("cited_paper_id").alias("citedcorpusid"))
    return G.with_paper_info(edges, table(spark, folder, "seed_papers"), "citedcorpusid", "cited_", ["title", "topic"]).select("context_id", "citingcorpusid", "citedcorpusid", "cited_title", "cited_topic")


def _titles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "papers").groupBy("corpusid").agg(F.min("title").alias("title"))


@query("""SELECT cited_paper_id AS corpusid, min(s.title) AS title, count(*) AS contexts, count(DISTINCT citing_paper_id) AS citing
FROM citation_contexts c LEFT JOIN (SELECT corpusid, min(title) AS title FROM papers GROUP BY corpusid) s ON s.corpusid = c.cited_paper_id
WHERE citing_paper_id <> 0 AND cited_paper_id <> 0 GROUP BY cited_paper_id""")
def citing_export(spark: SparkSession, folder: str) -> DataFrame:
    """What the export of citing papers holds of each cited one, counted."""
    rows = G.export_rows(_edges(spark, folder), _titles(spark, folder), "cited")
    return rows.groupBy("corpusid").agg(F.min("title").alias("title"), F.count(F.lit(1)).alias("contexts"), F.count_distinct("far").alias("citing"))


@query("""SELECT c.citing_paper_id AS corpusid, s.title, c.cited_paper_id AS cited, coalesce(c.context, '') AS context
FROM citation_contexts c LEFT JOIN (SELECT corpusid, min(title) AS title FROM papers GROUP BY corpusid) s ON s.corpusid = c.citing_paper_id
WHERE c.citing_paper_id <> 0 AND c.cited_paper_id <> 0""")
def context_export(spark: SparkSession, folder: str) -> DataFrame:
    """What the JSON export holds, an edge a row."""
    rows = G.export_rows(_edges(spark, folder), _titles(spark, folder), "citing")
    return rows.select("corpusid", "title", F.col("far").alias("cited"), F.array_join("contexts", "|").alias("context"))


@query("SELECT DISTINCT corpusid FROM (SELECT corpusid FROM seed_papers UNION ALL SELECT corpusid FROM papers) WHERE corpusid IS NOT NULL")
def store_update(spark: SparkSession, folder: str) -> DataFrame:
    """A paper table built from one folder of dumps and updated from another."""
    base = f"{shared_dir(spark)}/{_unique('store')}"
    for name in ("seed_papers", "papers"):
        table(spark, folder, name).select("corpusid", "title", "abstract").write.option("compression", "gzip").json(f"{base}/{name}")
    with Store(spark, f"{base}/store") as store:
        store.build_papers(f"{base}/seed_papers")
        return store.update_papers(f"{base}/papers").select("corpusid")


@query("SELECT count(*) AS rows, min(corpusid) AS min_key, max(corpusid) AS max_key FROM papers")
def store_info(spark: SparkSession, folder: str) -> DataFrame:
    return G.table_info(table(spark, folder, "papers"), "corpusid").select("rows", "min_key", "max_key")


# Contexts ---------------------------------------------------------------------------------

_SOLID = r"'[^\s\x0b\x1c-\x1f\x{85}\p{Z}]'"
_FLAT = f"""
WITH b AS (SELECT row_id, coalesce(nullif(corpusid, 0), nullif(cited_corpusid, 0)) AS paper, citations, citing_papers FROM context_papers),
a AS (SELECT row_id, paper, unnest(citations) AS x FROM b), c AS (SELECT row_id, paper, unnest(citing_papers) AS x FROM b),
f AS (
  SELECT row_id, 0 AS list, paper AS citing_paper_id, nullif(x.cited_corpusid, 0) AS cited_paper_id, unnest(x.contexts) AS context FROM a
  UNION ALL
  SELECT row_id, 1, nullif(x.citing_corpusid, 0), paper, unnest(x.contexts) FROM c
), flat AS (SELECT * FROM f WHERE regexp_matches(context, {_SOLID}))"""


@query(_FLAT + " SELECT row_id, CAST(list AS INTEGER) AS list, context, citing_paper_id, cited_paper_id FROM flat")
def context_unnest(spark: SparkSession, folder: str) -> DataFrame:
    flat = N.from_papers(table(spark, folder, "context_papers"), "row_id")
    return flat.select(F.col("ord.row").alias("row_id"), F.col("ord.list").alias("list"), "context", "citing_paper_id", "cited_paper_id")


@query("SELECT context_id, context, CAST(nullif(citing_paper_id, 0) AS VARCHAR) AS citing_paper_id, CAST(nullif(cited_paper_id, 0) AS VARCHAR) AS cited_paper_id FROM citation_contexts WHERE context <> ''")
def context_merged(spark: SparkSession, folder: str) -> DataFrame:
    return N.from_merged(table(spark, folder, "citation_contexts"), "context_id").withColumnRenamed("ord", "context_id").select("context_id", "context", "citing_paper_id", "cited_paper_id")


@query(_FLAT + f""" SELECT context, citing_paper_id, cited_paper_id FROM flat
UNION ALL SELECT context, nullif(citing_paper_id, 0), nullif(cited_paper_id, 0) FROM citation_contexts WHERE regexp_matches(context, {_SOLID})""")
def contexts_union(spark: SparkSession, folder: str) -> DataFrame:
    cols = ("context", "citing_paper_id", "cited_paper_id")
    nested = N.from_papers(table(spark, folder, "context_papers"), "row_id").select(*cols)
    flat = table(spark, folder, "citation_contexts").where(X.not_blank("context"))
    return nested.unionByName(flat.select("context", X.truthy_id("citing_paper_id").alias("citing_paper_id"), X.truthy_id("cited_paper_id").alias("cited_paper_id")))


@query("""WITH c AS (SELECT row_id, coalesce(nullif(cited_corpusid, 0), nullif(corpusid, 0)) AS corpusid, coalesce(len(citations), 0) + coalesce(len(citing_papers), 0) AS n FROM context_papers)
SELECT corpusid, CAST(arg_max(n, row_id) AS BIGINT) AS citations FROM c WHERE corpusid IS NOT NULL GROUP BY corpusid""")
def citation_counts(spark: SparkSession, folder: str) -> DataFrame:
    return C.citation_counts(table(spark, folder, "context_papers"))


@query("SELECT context_id, CAST(nullif(citing_paper_id, 0) AS VARCHAR) AS citing, CAST(nullif(cited_paper_id, 0) AS VARCHAR) AS cited, coalesce(nullif(cited_paper_id, 0), nullif(citing_paper_id, 0)) AS either FROM citation_contexts")
def id_truthy(spark: SparkSession, folder: str) -> DataFrame:
    citing, cited = X.truthy_id("citing_paper_id"), X.truthy_id("cited_paper_id")
    return table(spark, folder, "citation_contexts").select("context_id", citing.cast("string").alias("citing"), cited.cast("string").alias("cited"), F.coalesce(cited, citing).alias("either"))


# Model operators, with a rule in the model's place ------------------------------------------

_LABELS = f"regexp_extract_all(substr(regexp_replace(substr(context, 1, 2000), '[\\r\\n]+', ' ', 'g'), 1), '{NAME_RULE}')"
_FOUND = f"WITH r AS (SELECT context_id, context, {_LABELS} AS names FROM citation_contexts WHERE context <> '')"


def _extracted(spark: SparkSession, folder: str) -> DataFrame:
    contexts = table(spark, folder, "citation_contexts").where("context <> ''").select("context_id", "context")
    return extract_datasets(contexts, lambda: RuleClient(extraction_rule))


@query(_FOUND + """ SELECT context_id, substr(context, 1, 500) AS context, array_to_string(names, '|') AS datasets, CASE WHEN len(names) = 1 THEN 0.9::DOUBLE ELSE 0.7::DOUBLE END AS confidence FROM r WHERE len(names) > 0""")
def extract_fake(spark: SparkSession, folder: str) -> DataFrame:
    return extraction_rows(_extracted(spark, folder)).select("context_id", "context", F.array_join("datasets", "|").alias("datasets"), "confidence")


@query(_FOUND + " SELECT count(*) AS total_contexts, count(*) FILTER (len(names) > 0) AS contexts_with_datasets, count(*) FILTER (len(names) = 0) AS contexts_without FROM r")
def extract_counters(spark: SparkSession, folder: str) -> DataFrame:
    return extraction_counters(_extracted(spark, folder))


@query("""SELECT corpusid, title FROM papers WHERE strpos(lower(regexp_replace(substr(title, 1, 300), '[\\r\\n]+', ' ', 'g')), 'resources') BETWEEN 1 AND 30""")
def relevance_filter(spark: SparkSession, folder: str) -> DataFrame:
    papers = table(spark, folder, "papers").select("corpusid", "title", "abstract")
    return filter_relevant(papers, lambda: RuleClient(relevance_rule("resources")), "resources").select("corpusid", "title")


@query(_FOUND + " SELECT substr(context, 1, 500) AS context, array_to_string(names, '|') AS datasets, CASE WHEN len(names) = 1 THEN 0.9::DOUBLE ELSE 0.7::DOUBLE END AS confidence FROM r WHERE len(names) > 0")
def extraction_file(spark: SparkSession, folder: str) -> DataFrame:
    """Extractions written as one document and read again."""
    path = f"{shared_dir(spark)}/{_unique('extractions')}.json"
    contexts = table(spark, folder, "citation_contexts").where("context <> ''").select(F.col("context_id").alias("ord"), "context", F.col("citing_paper_id").cast("string"), F.col("cited_paper_id").cast("string"))
    extraction_document(materialize(extract_datasets(contexts, lambda: RuleClient(extraction_rule)), "extracted"), path, TOPIC, folder, datetime.now())
    return read_extractions(spark, path).select("context", F.array_join("datasets", "|").alias("datasets"), "confidence")


# Files ------------------------------------------------------------------------------------


@query(f"""SELECT context, CAST(citing_paper_id AS VARCHAR) AS citing_paper_id, CAST(cited_paper_id AS VARCHAR) AS cited_paper_id FROM citation_contexts, range(2)
WHERE citing_paper_id <> 0 AND cited_paper_id <> 0 AND regexp_matches(context, {_SOLID})""")
def context_files(spark: SparkSession, folder: str) -> DataFrame:
    """All contexts exported in both directions, merged into one document, and read again."""
    base, edges, titles = f"{shared_dir(spark)}/{_unique('contexts')}", _edges(spark, folder), _titles(spark, folder)
    for direction in ("citing", "cited"):
        export_contexts(edges, titles, direction, f"{base}/{direction}.json", TOPIC)
    merge_contexts(spark, base, TOPIC)
    return read_contexts(spark, f"{base}/all_contexts.json").select("context", "citing_paper_id", "cited_paper_id")


@query("SELECT event_id, user_id, event_type FROM events")
def converted_files(spark: SparkSession, folder: str) -> DataFrame:
    """Events in JSON Lines files, each converted to Parquet of its own, and read again."""
    base = f"{shared_dir(spark)}/{_unique('convert')}"
    table(spark, folder, "events").select("event_id", "user_id", "event_type").repartition(5, "event_id").write.option("compression", "gzip").json(base + "/in")
    report = convert_files(spark, base + "/in", base + "/out", "event_id bigint, user_id bigint, event_type string", patterns=("*.json.gz",))
    return spark.read.parquet(*[r.output for r in report if r.rows])


# Text functions -----------------------------------------------------------------------------


@query("""SELECT event_id, value > 50 AS relevant, value / 128 AS confidence, event_type AS reason FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL""")
def json_response(spark: SparkSession, folder: str) -> DataFrame:
    """Answers with JSON in the midst of talk, read by the parser of the model operator; the rule says what it is told."""
    events = table(spark, folder, "events").where("value IS NOT NULL AND event_type IS NOT NULL").select("event_id", "event_type", "value")
    said = F.concat(F.lit('Sure: {"relevant": '), (F.col("value") > 50).cast("string"), F.lit(', "confidence": '), (F.col("value") / 128).cast("string"), F.lit(', "reason": "'), "event_type", F.lit('"} - anything else?'))
    return ask(events, said, "", lambda: RuleClient(lambda user: user), relevance_record, RELEVANCE_TYPE).select("event_id", "answer.*")


@query(r"""SELECT event_id, regexp_extract('so: ' || props || ' and ' || props || ' end', '(?s)\{.*\}', 0) AS wide, regexp_extract('so: ' || props || ' and ' || props, '\{[^}]+\}', 0) AS narrow FROM events""")
def brace_extract(spark: SparkSession, folder: str) -> DataFrame:
    said = F.concat(F.lit("so: "), "props", F.lit(" and "), "props")
    return table(spark, folder, "events").select("event_id", X.first_braces(F.concat(said, F.lit(" end")), greedy=True).alias("wide"), X.first_braces(said, greedy=False).alias("narrow"))


_WORDS = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def _sql_doi(x: str) -> str:
    t = _sql_trim(x)
    url = rf"regexp_extract({t}, '(?i)^https?://doi\.org/([^\n]+)', 1)"
    return rf"CASE WHEN {url} <> '' THEN {_sql_trim(url)} ELSE nullif(rtrim(regexp_extract({t}, '10\.\p{{Nd}}{{4,9}}/{_WORDS}', 0), ').,;'), '') END"


_LONGER = "(citing_article || chr(8195) || 'x.')"


@query(f"SELECT row_id, {_sql_doi(_LONGER)} AS doi, {_sql_doi(chr(39).join(['replace(citing_article, ', 'doi.example', ', ', 'doi.org', ')']))} AS resolver_doi FROM analyzed_datasets")
def doi_extract(spark: SparkSession, folder: str) -> DataFrame:
    """DOIs before an em space and more text, and behind a resolver's address."""
    cells = table(spark, folder, "analyzed_datasets")
    return cells.select("row_id", X.extract_doi(F.concat("citing_article", F.lit("\u2003x."))).alias("doi"), X.extract_doi(F.replace("citing_article", F.lit("doi.example"), F.lit("doi.org"))).alias("resolver_doi"))


_CORE = _sql_trim(rf"regexp_replace(x, '{_WS}*\(\+\p{{Nd}}+\)$', '')")
_KEY = f"CASE WHEN {_sql_doi(_CORE)} <> '' THEN 'doi:' || lower({_sql_doi(_CORE)}) ELSE 'url:' || lower({_sql_trim(f"rtrim({_CORE}, ').,;')")}) END"


@query(f"""WITH c AS (
  SELECT row_id, citing_article AS cell, list_filter(list_transform(string_split(citing_article || ', ' || citing_article || ' (+2), ' || citing_article || chr(160) || '.,', ','), lambda x: {_sql_trim("x")}), lambda x: x <> '') AS items FROM analyzed_datasets
), k AS (SELECT *, list_transform(items, lambda x: {_KEY}) AS keys FROM c)
SELECT row_id, CASE WHEN cell IS NULL THEN '' ELSE array_to_string(list_filter(items, lambda x, i: list_position(keys, keys[i]) = i), ', ') END AS links FROM k""")
def link_cell_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Each cell joined with itself under another suffix and before punctuation, so that every link occurs three times."""
    thrice = F.concat("citing_article", F.lit(", "), "citing_article", F.lit(" (+2), "), "citing_article", F.lit("\u00a0.,"))
    return table(spark, folder, "analyzed_datasets").select("row_id", X.dedup_link_cell(thrice).alias("links"))


@query(f"""WITH c AS (
  SELECT row_id, list_filter(list_transform(string_split(citing_article || ', ' || citing_article, ','), lambda x: {_sql_trim("x")}), lambda x: x <> '') AS items FROM analyzed_datasets
), k AS (SELECT *, list_transform(items, lambda x: {_KEY}) AS keys FROM c)
SELECT CAST(row_id AS VARCHAR) AS row_id, nullif(array_to_string(list_filter(items, lambda x, i: list_position(keys, keys[i]) = i), ', '), '') AS links FROM k""")
def link_tables(spark: SparkSession, folder: str) -> DataFrame:
    """A TSV table with every link twice, rewritten in its place and read again."""
    base = f"{shared_dir(spark)}/{_unique('tables')}"
    save_tsv(table(spark, folder, "analyzed_datasets").select("row_id", F.concat("citing_article", F.lit(", "), "citing_article").alias("Citing Article")), f"{base}/x_merged_analysis_table.tsv")
    rewrite_link_tables(spark, [base])
    return read_tsv(spark, f"{base}/x_merged_analysis_table.tsv").select("row_id", F.col("Citing Article").alias("links"))


@query(rf"""SELECT corpusid, title, regexp_replace(regexp_replace(translate(lower(title), ' -/', '___'), '[^\p{{L}}\p{{N}}_]', '', 'g'), '^_+|_+$', '', 'g') || '_citing_contexts_100.json' AS file_name FROM papers""")
def safe_filename(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "papers").select("corpusid", "title", X.context_file_name("title", "citing", 100).alias("file_name"))


@query(r"""SELECT context_id, regexp_replace(list_last(string_split('dumps/' || source || 'l.gz', '/')), '((\.jsonl|\.ndjson)(\.gz)?|\.gz)$', '') AS stem FROM citation_contexts""")
def file_stem(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat(F.lit("dumps/"), "source", F.lit("l.gz"))
    return table(spark, folder, "citation_contexts").select("context_id", X.strip_file_suffix(X.base_name(path)).alias("stem"))


@query("""SELECT event_id, CASE WHEN value > 100 THEN NULL WHEN value < 1 THEN NULL ELSE value END AS value FROM events""")
def clean_nan(spark: SparkSession, folder: str) -> DataFrame:
    """Large values made infinite and small ones NaN, then cleaned."""
    odd = F.when(F.col("value") > 100, F.lit(float("inf"))).when(F.col("value") < 1, F.lit(float("nan"))).otherwise(F.col("value"))
    return clean_columns(table(spark, folder, "events").select("event_id", odd.alias("value")))


# Search, ingest, windows ----------------------------------------------------------------------


@query("""SELECT corpusid, title FROM papers WHERE corpusid <> 0 AND contains(lower(concat_ws(' ', title, abstract)), 'crop') AND contains(lower(concat_ws(' ', title, abstract)), 'mapping')""")
def search_topic(spark: SparkSession, folder: str) -> DataFrame:
    return search_local(table(spark, folder, "papers"), "crop mapping").select("corpusid", "title")


@query("""SELECT corpusid, title FROM seed_papers WHERE contains(lower(concat_ws(' ', title, abstract)), 'resources') ORDER BY corpusid LIMIT 20 OFFSET 10""")
def search_page(spark: SparkSession, folder: str) -> DataFrame:
    """One page of a paged search: the limit is the feature."""
    return search_local(table(spark, folder, "seed_papers"), "resources", limit=20, offset=10).select("corpusid", "title")


@query("SELECT event_id, user_id, event_type, value FROM events")
def ingest_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON Lines, gzipped, and back through a pinned schema into Parquet."""
    base = f"{shared_dir(spark)}/{_unique('roundtrip')}"
    table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", "props").write.option("compression", "gzip").json(base + "/in")
    return ingest_jsonl(spark, base + "/in", base + "/out", "event_id bigint, user_id bigint, event_type string, value double")


@query("SELECT user_id, max(event_id) AS event_id, max(ts) AS ts FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def ingest_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries by the streaming file source, then the latest row a user."""
    base, schema = f"{shared_dir(spark)}/{_unique('incremental')}", "event_id bigint, user_id bigint, micros bigint"
    events = table(spark, folder, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"))
    middle = events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    for part in (events.where(F.col("event_id") <= middle), events.where(F.col("event_id") > middle)):
        part.write.mode("append").json(base + "/in")
        ingest_new_files(spark, base + "/in", base + "/table", base + "/seen", schema, "*.json")
    latest = latest_by_key(spark.read.parquet(base + "/table").select("event_id", "user_id", "micros"), "user_id", "event_id")
    return latest.select("user_id", "event_id", F.timestamp_micros("micros").alias("ts"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def hourly_events(spark: SparkSession, folder: str) -> DataFrame:
    return windowed_counts(table(spark, folder, "events"), "ts", "event_type")


def _unique(label: str) -> str:
    return f"{label}-{uuid.uuid4().hex}"
