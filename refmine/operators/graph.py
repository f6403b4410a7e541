"""Walks over the citation graph: edges (citingcorpusid, citedcorpusid, ...) around seed papers.

Edge and id tables stay lazy; ids are made distinct before they meet the edges. The side of
ids is left to the planner, which broadcasts it only below its size threshold and lets
adaptive execution split a hot paper's edges otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from refmine.functions.text import truthy_id

CITING, CITED = "citingcorpusid", "citedcorpusid"
DIRECTIONS = ("citing", "cited", "both")


def seed_ids(papers: DataFrame, id_column: str = "corpusid") -> DataFrame:
    """Distinct ids of a paper table, without nulls and zeros."""
    return papers.select(truthy_id(id_column).alias("corpusid")).where("corpusid IS NOT NULL").distinct()


def hop(edges: DataFrame, ids: DataFrame, direction: str) -> DataFrame:
    """Edges that leave the ids ('citing': the ids cite) or reach them ('cited')."""
    if direction not in ("citing", "cited"):
        raise ValueError("direction must be citing or cited")
    key = CITING if direction == "citing" else CITED
    return edges.join(ids.select(F.col("corpusid").alias(key)), key, "left_semi").select(*edges.columns)


def frontier(edges_of_hop: DataFrame, direction: str, seeds: DataFrame | None = None) -> DataFrame:
    """Distinct papers at the far end of a hop, without nulls; seeds are left out where given."""
    far = CITED if direction == "citing" else CITING
    ids = edges_of_hop.select(F.col(far).alias("corpusid")).where("corpusid IS NOT NULL").distinct()
    return ids if seeds is None else ids.join(seeds.select("corpusid"), "corpusid", "left_anti")


def second_hop(edges: DataFrame, seeds: DataFrame, direction: str, keep: DataFrame | None = None) -> DataFrame:
    """Edges one hop beyond the first: citing walks leave the seeds out of the frontier, cited walks don't.

    ``keep`` restricts the frontier, to what a relevance filter kept, say.
    """
    ids = frontier(hop(edges, seeds, direction), direction, seeds if direction == "citing" else None)
    if keep is not None:
        ids = ids.join(keep.select("corpusid"), "corpusid", "left_semi")
    return hop(edges, ids, direction)


def hop_stats(edges_of_hop: DataFrame, direction: str) -> DataFrame:
    """One row: (found_ids, total_results)."""
    key = CITING if direction == "citing" else CITED
    return edges_of_hop.agg(F.count_distinct(key).alias("found_ids"), F.count(F.lit(1)).alias("total_results"))


def lookup_papers(papers: DataFrame, ids: DataFrame, fields: Sequence[str] = ("title", "abstract")) -> DataFrame:
    """The papers of the ids, missing ones absent; text fields that are null are empty."""
    kinds = dict(papers.dtypes)
    out: list[Column] = [F.coalesce(F.col(f), F.lit("")).alias(f) if kinds[f] == "string" else F.col(f) for f in fields]
    return papers.join(ids.select("corpusid"), "corpusid", "left_semi").select("corpusid", *out)


def latest_papers(papers: DataFrame, order: str = "updated_at") -> DataFrame:
    """One version a corpusid: the latest, then the first title; null ids are left out."""
    rest = [c for c in papers.columns if c != "corpusid"]
    best = F.max_by(F.struct(*rest), F.struct(F.col(order), F.coalesce("title", F.lit(""))))
    return papers.where("corpusid IS NOT NULL").groupBy("corpusid").agg(best.alias("_p")).select("corpusid", *[F.col(f"_p.{c}").alias(c) for c in rest])


def with_paper_info(edges: DataFrame, papers: DataFrame, key: str, prefix: str, fields: Sequence[str] = ("title",)) -> DataFrame:
    """Edges with the fields of the paper in ``key``, null where it is unknown; ``papers`` is unique in corpusid."""
    info = papers.select(F.col("corpusid").alias(key), *[F.col(f).alias(f"{prefix}{f}") for f in fields])
    return edges.join(info, key, "left")


def export_rows(edges: DataFrame, papers: DataFrame, direction: str, fields: Sequence[str] = ("title",)) -> DataFrame:
    """(corpusid, fields..., far, contexts), one row an edge: what an export document holds, paper by paper.

    The paper is the edge's near end ('citing': the one that cites), ``far`` the other end,
    ``contexts`` an array whichever form the edges have. ``papers`` is unique in corpusid.
    Nothing is grouped: a paper with a third of all edges is as many rows, which a document
    takes in one after the other.
    """
    near, far = (CITING, CITED) if direction == "citing" else (CITED, CITING)
    held = F.col("contexts") if "contexts" in edges.columns else F.when(F.col("context").isNotNull(), F.array("context")).otherwise(F.array().cast("array<string>"))
    rows = edges.select(F.col(near).alias("corpusid"), F.col(far).alias("far"), held.alias("contexts"))
    return with_paper_info(rows, papers, "corpusid", "", fields).select("corpusid", *fields, "far", "contexts")


def table_info(df: DataFrame, key: str) -> DataFrame:
    """One row: (rows, approx_keys, min_key, max_key)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(key).alias("approx_keys"), F.min(key).alias("min_key"), F.max(key).alias("max_key"))
