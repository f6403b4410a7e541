"""Command line of the stages: ``python -m refmine {build,query,extract,rank,links,convert} ...``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import SparkSession

from refmine import storage
from refmine.model.client import LLMClient, ModelSettings, served
from refmine.operators.contexts import edges_from_contexts
from refmine.plans.pipeline import ContextQuery, Store, analyze_files, extract_file, query_contexts
from refmine.session import build_session, tidy
from refmine.sinks.files import rewrite_link_tables
from refmine.sources.documents import read_context_files
from refmine.sources.jsonl import convert_files
from refmine.sources.search import SEARCH_URL, PaperSearchSource

#: Validation modes that the ranking stage takes; none of them changes the table.
VALIDATION = ("off", "basic", "smart", "strict", "llm")
#: The relevance filter asks shorter questions than the extraction.
FILTER_SETTINGS = {"timeout_s": 60.0, "max_concurrency": 100}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="refmine")
    sub = parser.add_subparsers(dest="stage", required=True)
    p = sub.add_parser("build", help="paper and citation tables from dumps")
    p.add_argument("--papers", action="store_true", help="build the paper table")
    p.add_argument("--citations", action="store_true", help="build the citation tables")
    p.add_argument("--all", action="store_true", help="build all tables")
    p.add_argument("-i", "--incremental", action="store_true", help="take in files that weren't seen")
    p.add_argument("--from-jsonl", metavar="DIR", help="folder of new dumps for an incremental update")
    p.add_argument("--contexts", metavar="DIR", help="take citations from a folder of context documents")
    p.add_argument("--force", action="store_true", help="build anew")
    p.add_argument("--data-dir", default="data", help="dumps: papers and citations below it")
    p.add_argument("--cache-dir", default="cache", help="where the tables are")
    p = sub.add_parser("query", help="citation contexts around a topic's papers, as documents")
    p.add_argument("-q", "--query", default="topic modeling")
    p.add_argument("-l", "--limit", type=int, default=100)
    p.add_argument("--context-type", choices=("citing", "cited", "both"), default="citing")
    p.add_argument("--second", action="store_true", help="a second hop")
    p.add_argument("--llm-prefilter", action="store_true", help="keep the papers that the model finds relevant")
    p.add_argument("-o", "--output-dir", default=".")
    p.add_argument("--remote", action="store_true", help="search by the service instead of the paper table")
    p.add_argument("--search-url", default=SEARCH_URL)
    p.add_argument("--api-key", help="key of the search service; implies --remote")
    p.add_argument("--timestamp", action="store_true")
    p.add_argument("--no-backup", action="store_true")
    p.add_argument("--merge", action="store_true", help="also one document of all contexts")
    p.add_argument("--cache-dir", default="cache")
    _model_flags(p)
    p = sub.add_parser("extract", help="what datasets the contexts of a document name")
    extract_flags(p)
    p = sub.add_parser("rank", help="ranked table of an extraction document")
    p.add_argument("-e", "--extraction", required=True)
    p.add_argument("-c", "--contexts", help="context document; gives the papers' citation counts")
    p.add_argument("-o", "--output", default="analyzed_datasets.tsv")
    p.add_argument("-t", "--topic", default="topic modeling")
    p.add_argument("--validation", choices=VALIDATION, default="smart")
    p.add_argument("--citation-counts", metavar="FILE", help="write the counts of the contexts document here")
    p = sub.add_parser("links", help="drop repeated links from merged tables")
    p.add_argument("--dirs", nargs="+", required=True)
    p.add_argument("--dry-run", action="store_true")
    p = sub.add_parser("convert", help="JSON Lines files to Parquet, file by file")
    p.add_argument("-i", "--input", required=True)
    p.add_argument("-o", "--output", required=True)
    p.add_argument("--workers", type=int, default=8)
    p.add_argument("--force", action="store_true")
    return parser


def _model_flags(p: argparse.ArgumentParser) -> None:
    p.add_argument("--model", help="name of the served model")
    p.add_argument("--base-url", help="address of the served model")


def extract_flags(p: argparse.ArgumentParser) -> None:
    p.add_argument("-i", "--input", required=True)
    p.add_argument("-o", "--output", default="extracted_datasets.json")
    p.add_argument("-t", "--topic", default="topic modeling")
    p.add_argument("--no-filter", action="store_true", help="don't name the topic to the model")
    _model_flags(p)


def _settings(a: argparse.Namespace, **more) -> ModelSettings:
    given = {"model": getattr(a, "model", None), "base_url": getattr(a, "base_url", None)}
    return replace(ModelSettings(), **{k: v for k, v in given.items() if v}, **more)


def run_build(spark: SparkSession, a: argparse.Namespace) -> int:
    if not (a.papers or a.citations or a.all or a.contexts):
        print("say what to build: --papers, --citations, --contexts or --all", file=sys.stderr)
        return 1
    with Store(spark, a.cache_dir) as store:
        if a.papers or a.all:
            own = f"{a.data_dir.rstrip('/')}/papers"
            folder = a.from_jsonl or (own if storage.exists(spark, own) else a.data_dir)
            store.check_files(folder)
            store.update_papers(folder) if a.incremental else store.build_papers(folder, a.force)
        if a.contexts:
            store.build_citations(edges_from_contexts(read_context_files(spark, a.contexts)), a.force)
        elif a.citations or a.all:
            store.build_citations_from(f"{a.data_dir.rstrip('/')}/citations", a.force)
        for name in ("papers", "by_citing"):
            if store.exists(name):
                print(name, store.info()["papers" if name == "papers" else "citations"].first().asDict() if store.ready() else "built")
    return 0


def run_query(spark: SparkSession, a: argparse.Namespace, client: Callable[[], LLMClient] | None) -> int:
    with Store(spark, a.cache_dir) as store:
        if not store.ready():
            print("the tables aren't built yet", file=sys.stderr)
            return 1
        search = None
        if a.remote or a.api_key:
            spark.dataSource.register(PaperSearchSource)
            options = {"url": a.search_url, "api_key": a.api_key or ""}
            search = lambda q, n: spark.read.format("paper_search").options(**options, query=q, limit=str(n)).load()
        relevance = (client or served(_settings(a, **FILTER_SETTINGS))) if a.llm_prefilter else None
        query = ContextQuery(a.query, a.limit, a.context_type, a.second, relevance, search=search)
        written = query_contexts(query, store, a.output_dir, a.timestamp, not a.no_backup, a.merge)
    for what, path in written.items():
        print(f"{what}: {path}")
    return 0


def run_extract(spark: SparkSession, a: argparse.Namespace, client: Callable[[], LLMClient] | None) -> int:
    try:
        done = extract_file(spark, a.input, a.output, client or served(_settings(a)), None if a.no_filter else a.topic)
    except FileNotFoundError as e:
        print(e, file=sys.stderr)
        return 1
    return 0 if done else 1


def main(argv: list[str] | None = None, client: Callable[[], LLMClient] | None = None) -> int:
    """``client``: makes a model client; by default one of the served model."""
    a = _parser().parse_args(argv)
    spark = build_session()
    try:
        return _run(spark, a, client)
    finally:
        tidy(spark)


def _run(spark: SparkSession, a: argparse.Namespace, client: Callable[[], LLMClient] | None) -> int:
    if a.stage == "build":
        return run_build(spark, a)
    if a.stage == "query":
        return run_query(spark, a, client)
    if a.stage == "extract":
        return run_extract(spark, a, client)
    if a.stage == "rank":
        return 0 if analyze_files(spark, a.extraction, a.contexts, a.output, a.citation_counts) else 1
    if a.stage == "convert":
        report = convert_files(spark, a.input, a.output, force=a.force, workers=a.workers)
        for r in report:
            print(f"{r.path}: {r.message} ({r.rows} rows)")
        return 0 if all(r.ok for r in report) else 1
    changed = rewrite_link_tables(spark, a.dirs, dry_run=a.dry_run)
    print(f"{sum(changed.values())} of {len(changed)} tables changed")
    return 0


if __name__ == "__main__":
    sys.exit(main())
