"""The stages end to end: tables, context query, extraction, ranking, link clean-up."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from refmine import storage
from refmine.functions.text import context_file_name
from refmine.model.client import LLMClient
from refmine.model.operator import extract_datasets, extraction_rows, filter_relevant
from refmine.operators.consolidate import citation_counts, consolidate, mentions_of, rank_table
from refmine.operators.graph import CITED, CITING, DIRECTIONS, export_rows, frontier, hop, hop_stats, lookup_papers, seed_ids, table_info, with_paper_info
from refmine.session import materialize
from refmine.sinks.files import save_document, save_tsv
from refmine.sources.documents import PAPERS_DOCUMENT, read_context_files, read_contexts, read_documents, read_extractions
from refmine.sources.jsonl import find_input_files, read_jsonl
from refmine.sources.search import search_local
from refmine.streaming.incremental import latest_by_key, stage_new_files

PAPER_SCHEMA = "corpusid bigint, title string, abstract string"
CITATION_SCHEMA = "citingcorpusid bigint, citedcorpusid bigint, contexts array<string>"


@dataclass
class Store:
    """Paper and citation tables in a folder; papers are clustered by id, citations by either end.

    The citation table is kept twice, clustered by citing and by cited id, so that a hop in
    either direction prunes row groups by statistics. A table is a folder of versions, of
    which the last whole one counts; an update writes the next, and what was planned on the
    one before can still run. A context manager.
    """

    spark: SparkSession
    folder: str

    def __enter__(self) -> Store:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Forget what the session holds of the tables; the folder stays."""
        for name in ("papers", "by_citing", "by_cited"):
            if self.exists(name):
                self.spark.catalog.refreshByPath(self._current(name))

    def _path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def _versions(self, name: str) -> list[str]:
        return [f"{self._path(name)}/{v}" for v in storage.folder_names(self.spark, self._path(name)) if storage.exists(self.spark, f"{self._path(name)}/{v}/_SUCCESS")]

    def _current(self, name: str) -> str:
        versions = self._versions(name)
        if not versions:
            raise FileNotFoundError(f"{self._path(name)} isn't built yet")
        return versions[-1]

    def _save(self, name: str, df: DataFrame, key: str) -> None:
        versions = self._versions(name)
        number = int(versions[-1][-6:]) + 1 if versions else 1
        df.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").option("compression", "zstd").parquet(f"{self._path(name)}/v{number:06d}")
        for old in versions[:-1]:
            storage.delete(self.spark, old)

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def ready(self) -> bool:
        return all(self.exists(n) for n in ("papers", "by_citing", "by_cited"))

    def check_files(self, folder: str) -> list[str]:
        """The JSON Lines files below a folder; raises where there are none."""
        found = find_input_files(self.spark, folder)
        if not found:
            raise FileNotFoundError(f"no JSON Lines files below {folder}")
        return found

    def build_papers(self, jsonl_folder: str, force: bool = False) -> DataFrame:
        """The paper table from a folder of dumps; one that exists is kept, or built anew with ``force``."""
        if force:
            for name in ("papers_pending", "papers_seen"):
                storage.delete(self.spark, self._path(name))
        if force or not self.exists("papers"):
            self._take_in(jsonl_folder, keep=False)
        return self.papers

    def update_papers(self, jsonl_folder: str) -> DataFrame:
        """Take in the files of a folder that no build or update saw; a repeated corpusid is that of the latest file.

        The folder may be another one than before. Only new files are read; their rows wait
        in the store until the table with them is whole, so a failed update loses nothing.
        """
        self._take_in(jsonl_folder, keep=True)
        return self.papers

    def _take_in(self, jsonl_folder: str, keep: bool) -> None:
        pending = self._path("papers_pending")
        seen = f"{self._path('papers_seen')}/{hashlib.md5(jsonl_folder.rstrip('/').encode()).hexdigest()}"
        stage_new_files(self.spark, jsonl_folder, pending, seen, PAPER_SCHEMA)
        batches = [f"{pending}/{n}" for n in storage.folder_names(self.spark, pending)]
        if not batches and self.exists("papers") and keep:
            return
        staged = T.StructType.fromDDL(PAPER_SCHEMA + ", file_path string, file_time timestamp")
        rows = self.spark.read.schema(staged).parquet(*batches) if batches else self.spark.createDataFrame([], staged)
        fresh = latest_by_key(rows, "corpusid").select("corpusid", "title", "abstract")
        if keep and self.exists("papers"):
            fresh = materialize(fresh, "papers-new")
            fresh = self.papers.join(fresh.select("corpusid"), "corpusid", "left_anti").unionByName(fresh)
        self._save("papers", fresh, "corpusid")
        storage.delete(self.spark, pending)

    def build_citations(self, edges: DataFrame, force: bool = False) -> None:
        for name, key in (("by_citing", CITING), ("by_cited", CITED)):
            if force or not self.exists(name):
                self._save(name, edges, key)

    def build_citations_from(self, jsonl_folder: str, force: bool = False) -> None:
        """Citations from a folder of dumps."""
        self.check_files(jsonl_folder)
        lines = read_jsonl(self.spark, find_input_files(self.spark, jsonl_folder), CITATION_SCHEMA)
        self.build_citations(lines.where(f"{CITING} IS NOT NULL AND {CITED} IS NOT NULL"), force)

    @property
    def papers(self) -> DataFrame:
        return self.spark.read.parquet(self._current("papers"))

    def edges(self, direction: str) -> DataFrame:
        return self.spark.read.parquet(self._current("by_citing" if direction == "citing" else "by_cited"))

    def info(self) -> dict[str, DataFrame]:
        return {"papers": table_info(self.papers, "corpusid"), "citations": table_info(self.edges("citing"), CITING)}


@dataclass
class ContextQuery:
    """A topic's papers and the citation edges around them.

    ``search`` gives papers for (query, limit); by default the paper table is searched.
    ``relevance`` makes a model client for the optional filter of papers before each hop.
    The second level runs in every direction.
    """

    query: str
    limit: int | None = 100
    direction: str = "both"
    second: bool = False
    relevance: Callable[[], LLMClient] | None = None
    min_confidence: float = 0.5
    search: Callable[[str, int | None], DataFrame] | None = None
    stats: dict[str, DataFrame] = field(default_factory=dict)
    levels: dict[tuple[str, int], DataFrame] = field(default_factory=dict)

    def run(self, papers: DataFrame, edges: Callable[[str], DataFrame]) -> DataFrame:
        """(direction, level, citingcorpusid, citedcorpusid, ...) of all hops; ``levels`` has each hop's own."""
        if self.direction not in DIRECTIONS:
            raise ValueError(f"direction must be one of {DIRECTIONS}")
        found = self.search(self.query, self.limit) if self.search else search_local(papers, self.query, self.limit)
        if self.relevance:
            found = filter_relevant(found.select("corpusid", "title", "abstract"), self.relevance, self.query, self.min_confidence)
        seeds = materialize(seed_ids(found), "seeds")
        out = None
        for direction in ("citing", "cited") if self.direction == "both" else (self.direction,):
            table = edges(direction)
            first = hop(table, seeds, direction)
            levels = [first]
            if self.second:
                ids = frontier(first, direction, seeds if direction == "citing" else None)
                if self.relevance:
                    ids = filter_relevant(lookup_papers(papers, ids), self.relevance, self.query, self.min_confidence)
                levels.append(hop(table, materialize(ids.select("corpusid"), "frontier"), direction))
            for n, level in enumerate(levels, 1):
                self.stats[f"{direction}_{n}"] = hop_stats(level, direction)
                self.levels[direction, n] = level
                rows = level.select(F.lit(direction).alias("direction"), F.lit(n).alias("level"), *level.columns)
                out = rows if out is None else out.unionByName(rows)
        return out

    def file_name(self, spark: SparkSession, stamp: bool = False) -> str:
        name = context_file_name(F.lit(self.query), self.direction, self.limit, F.current_timestamp() if stamp else None)
        return spark.range(1).select(name).first()[0]


def extract(contexts: DataFrame, client: Callable[[], LLMClient], output: str, topic: str | None = None) -> DataFrame:
    """Extractions of contexts, written once as Parquet before anything else uses them; rows with a dataset."""
    extract_datasets(contexts, client, topic).write.mode("overwrite").parquet(output)
    return extraction_rows(contexts.sparkSession.read.parquet(output))


def export_contexts(edges: DataFrame, papers: DataFrame, direction: str, path: str, topic: str, backup: bool = True) -> bool:
    """The export document of one direction: each paper with its title and its citations."""
    name, other = ("citations", "cited_corpusid") if direction == "citing" else ("citing_papers", "citing_corpusid")
    rows = export_rows(edges, papers, direction).orderBy("corpusid", "far", F.array_join("contexts", "\u001f"))
    return save_document(rows.select("corpusid", "title", F.struct(F.col("far").alias(other), "contexts").alias(name)), path, "papers", {"query": topic}, backup, within=name)


def export_audit(edges: DataFrame, papers: DataFrame, folder: str) -> None:
    """Every edge and context with both titles, as CSV written by Spark."""
    named = with_paper_info(with_paper_info(edges, papers, CITING, "citing_"), papers, CITED, "cited_")
    if "contexts" in named.columns:
        named = named.select(*[c for c in named.columns if c != "contexts"], F.explode_outer("contexts").alias("context"))
    named.write.mode("overwrite").options(header=True, escape='"').csv(folder)


def query_contexts(query: ContextQuery, store: Store, folder: str, stamp: bool = False, backup: bool = True, merge: bool = False) -> dict[str, str]:
    """Run a query and write its documents into a folder: their paths by what they hold. Hops without edges give none."""
    spark, out = store.spark, {}
    papers = store.papers
    query.run(papers, store.edges)
    base = f"{folder.rstrip('/')}/{query.file_name(spark, stamp)}".removesuffix(".json")
    both = query.direction == "both"
    tails = {("citing", 1): "_citing" if both else "", ("cited", 1): "_cited_by" if both else "", ("citing", 2): "_2nd_citing", ("cited", 2): "_2nd_cited"}
    titles = papers.select("corpusid", "title")
    for (direction, level), edges in query.levels.items():
        edges = materialize(edges, "hop")
        if edges.isEmpty():
            continue
        path = f"{base}{tails[direction, level]}.json"
        if not export_contexts(edges, titles, direction, path, query.query, backup):
            raise OSError(f"can't write {path}")
        out[f"{direction}_{level}"] = path
        if (direction, level) == ("citing", 1):
            out["audit"] = path.removesuffix(".json") + "_audit.csv"
            export_audit(edges, titles, out["audit"])
    if merge:
        out["merged"] = f"{folder.rstrip('/')}/all_contexts.json"
        merge_contexts(spark, folder, query.query)
    return out


def merge_contexts(spark: SparkSession, folder: str, topic: str, name: str = "all_contexts.json") -> bool:
    """One merged document of all context documents of a folder, earlier merged output left out."""
    rows = materialize(read_context_files(spark, folder, name), "merged-contexts")
    flat = rows.orderBy("ord").select("context", "citing_paper_id", "cited_paper_id", "source")
    return save_document(flat, f"{folder.rstrip('/')}/{name}", "contexts", {"query": topic, "total_contexts": rows.count()}, backup=False)


def extract_file(spark: SparkSession, contexts_path: str, output_path: str, client: Callable[[], LLMClient], topic: str | None = None) -> bool:
    """A context document of either format to an extraction document; False without contexts."""
    started = datetime.now()
    contexts = read_contexts(spark, contexts_path)
    if contexts.isEmpty():
        return False
    done = materialize(extract_datasets(contexts, client, topic), "extractions")
    return extraction_document(done, output_path, topic, contexts_path, started)


def extraction_document(extracted: DataFrame, path: str, topic: str | None, source_file: str, started: datetime, backup: bool = True) -> bool:
    """The extraction document: counts, duration, topic and source around the rows with a dataset, in the order of ``ord``."""
    total, some = extracted.agg(F.count(F.lit(1)), F.count_if(F.size("datasets") > 0)).first()
    header = {"source_file": source_file, "topic": topic, "total_contexts": total, "contexts_with_datasets": some, "processing_time": (datetime.now() - started).total_seconds()}
    rows = extraction_rows(extracted)
    return save_document(rows.orderBy("ord").drop("ord") if "ord" in rows.columns else rows, path, "extractions", header, backup)


def analyze(extractions: DataFrame, order: str = "extraction_id", names: str = "extracted_datasets", descriptions: str = "dataset_descriptions", confidence: str = "confidence_score", summaries: DataFrame | None = None, output: str | None = None) -> DataFrame:
    """The ranked table of extractions, exactly rounded; also as a TSV file where ``output`` is given."""
    ranked = rank_table(consolidate(mentions_of(extractions, order, names, descriptions, confidence)), summaries, round_exactly=True)
    if output:
        save_tsv(ranked.orderBy("Rank"), output)
    return ranked


def analyze_files(spark: SparkSession, extraction_file: str, contexts_file: str | None = None, output_file: str = "analyzed_datasets.tsv", citations_file: str | None = None) -> bool:
    """An extraction document to the ranked table; the contexts document gives the papers' citation counts. False where a file can't be read.

    ``citations_file``: where the counts (corpusid, citations) are written, as TSV.
    """
    try:
        if contexts_file:
            papers = read_documents(spark, contexts_file, PAPERS_DOCUMENT, skip_bad=False).select(F.posexplode("papers").alias("row_id", "p")).select("row_id", "p.*")
            counts = citation_counts(papers).orderBy("corpusid")
            if citations_file:
                save_tsv(counts, citations_file)
        analyze(materialize(read_extractions(spark, extraction_file, skip_bad=False), "extractions"), "ord", "datasets", "descriptions", "confidence", output=output_file)
        return True
    except (PySparkException, Py4JJavaError, OSError) as e:
        print(f"analysis failed: {str(e).splitlines()[0][:300]}", file=sys.stderr)
        return False
