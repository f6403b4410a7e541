"""Citation contexts as a flat table (context, citing_paper_id, cited_paper_id, source, ord)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from refmine.functions.text import not_blank, truthy_id


def _first_truthy(*ids: Column) -> Column:
    return F.coalesce(*[truthy_id(i) for i in ids])


def from_merged(contexts: DataFrame, ord_column: str | None = None) -> DataFrame:
    """Rows of the merged format: any text but null and '' stays (blank ones too), ids as strings, 0 as null."""
    out = [F.col("context"), truthy_id("citing_paper_id").cast("string").alias("citing_paper_id"), truthy_id("cited_paper_id").cast("string").alias("cited_paper_id")]
    if ord_column:
        out.append(F.col(ord_column).alias("ord"))
    return contexts.where("context <> ''").select(*out)


def _far_ends(elements: str, other: str) -> Column:
    return F.transform(elements, lambda x: F.struct(truthy_id(x[other]).alias("far"), x["contexts"].alias("contexts")))


def from_papers(papers: DataFrame, row_order: str, legacy_roles: bool = False, source: Column | None = None) -> DataFrame:
    """Rows of the papers format, one a context that isn't blank, with ord (row, list, element, context).

    A paper's ``citations`` are (paper cites element), its ``citing_papers`` (element cites
    paper). ``legacy_roles`` gives the second kind with swapped roles. The paper is corpusid,
    or cited_corpusid where that is null or 0; ids are BIGINT, 0 as null.
    """
    paper = _first_truthy(F.col("corpusid"), F.col("cited_corpusid"))
    base = papers.select(F.col(row_order).alias("_row"), paper.alias("_paper"), "citations", "citing_papers")
    # Both lists in one pass: what the papers come from is read and parsed once.
    lists = [_far_ends(field, other) for field, other in (("citations", "cited_corpusid"), ("citing_papers", "citing_corpusid"))]
    each = base.select("_row", "_paper", F.posexplode(F.array(*lists)).alias("_l", "_list")).select("_row", "_paper", "_l", F.posexplode("_list").alias("_e", "_x"))
    flat = each.select("_row", "_paper", "_l", "_e", F.col("_x.far").alias("_far"), F.posexplode("_x.contexts").alias("_c", "context")).where(not_blank("context"))
    paper_cites = F.lit(True) if legacy_roles else F.col("_l") == 0
    return flat.select(
        "context",
        F.when(paper_cites, F.col("_paper")).otherwise(F.col("_far")).alias("citing_paper_id"),
        F.when(paper_cites, F.col("_far")).otherwise(F.col("_paper")).alias("cited_paper_id"),
        *([source.alias("source")] if source is not None else []),
        F.struct(F.col("_row").alias("row"), F.col("_l").alias("list"), F.col("_e").alias("element"), F.col("_c").alias("context")).alias("ord"),
    )


def edges_from_contexts(contexts: DataFrame) -> DataFrame:
    """Citation edges (citingcorpusid, citedcorpusid, contexts) of a flat context table; zero and null ids are left out."""
    ids = contexts.select(truthy_id("citing_paper_id").alias("citingcorpusid"), truthy_id("cited_paper_id").alias("citedcorpusid"), "context")
    return ids.where("citingcorpusid IS NOT NULL AND citedcorpusid IS NOT NULL")
