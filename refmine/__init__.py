"""Finding the data resources that a body of literature uses, and the data processing around it, on PySpark."""

from __future__ import annotations

from importlib import import_module

__version__ = "0.2.0"

#: What the package exports, by module; loaded where it is used, so that optional libraries are not needed before.
_EXPORTS = {
    "refmine.session": ("build_session",),
    "refmine.plans.pipeline": ("ContextQuery", "Store", "analyze", "analyze_files", "extract", "extract_file", "merge_contexts", "query_contexts"),
    "refmine.model.client": ("LLMClient", "ModelSettings", "RuleClient", "ServedClient", "served"),
    "refmine.model.operator": ("extract_datasets", "extraction_rows", "filter_relevant"),
    "refmine.operators.consolidate": ("citation_counts", "collect_mentions", "consolidate", "mentions_of", "rank_table", "spellings_of"),
    "refmine.operators.graph": ("frontier", "hop", "lookup_papers", "second_hop", "seed_ids"),
    "refmine.operators.packed": ("split_packed",),
    "refmine.operators.skew": ("eager_join_aggregate", "hot_key_join", "top_items"),
    "refmine.sources.drift": ("file_schemas", "schema_changes", "unified", "union_schema"),
    "refmine.sources.jsonl": ("convert_files", "find_input_files", "ingest_jsonl"),
    "refmine.sources.search": ("PaperSearchSource", "paper_by_id", "search_local"),
    "refmine.sinks.files": ("rewrite_link_tables", "save_document", "save_json", "save_tsv"),
}
_MODULE = {name: module for module, names in _EXPORTS.items() for name in names}
__all__ = sorted(_MODULE)


def __getattr__(name: str):
    if name not in _MODULE:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(_MODULE[name]), name)


def __dir__() -> list[str]:
    return sorted([*globals(), *_MODULE])
