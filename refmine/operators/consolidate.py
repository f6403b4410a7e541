"""From extractions to ranked datasets: mentions, name groups, display names, ranks.

Order matters in every tie, so mentions carry ``ord``; nothing depends on how rows lie.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from refmine.functions.text import normalize_name, not_blank, trim_u, truthy_id
from refmine.operators.skew import hot_key_join
from refmine.session import materialize, ship

DEFAULT_CONFIDENCE = 0.5


def mentions_of(extractions: DataFrame, order: str = "extraction_id", names: str = "extracted_datasets", descriptions: str = "dataset_descriptions", confidence: str = "confidence_score", keep: Sequence[str] = ("citing_paper_id", "cited_paper_id")) -> DataFrame:
    """One row a name that isn't blank: (ord, row, pos, name trimmed, description, confidence, keep...).

    ``order`` is an integer that orders the extractions; ``ord`` packs it with the name's
    place in the list (below 10^9) into one DECIMAL, so that its minimum stays a hash
    aggregate of fixed width. The description is looked up under the name as extracted; '' where there is none. A
    missing confidence is 0.5.
    """
    base = extractions.select(F.col(order).alias("_o"), F.coalesce(F.col(confidence), F.lit(DEFAULT_CONFIDENCE)).alias("confidence"), F.col(descriptions).alias("_d"), *keep, F.posexplode(names).alias("_p", "_raw"))
    said = F.coalesce(F.try_element_at("_d", F.col("_raw")), F.lit(""))
    return base.where(not_blank("_raw")).select((F.col("_o").cast("decimal(19,0)") * F.lit(10**9) + F.col("_p")).cast("decimal(38,0)").alias("ord"), F.col("_o").alias("row"), F.col("_p").alias("pos"), trim_u("_raw").alias("name"), said.alias("description"), "confidence", *keep)


def spellings_of(mentions: DataFrame) -> DataFrame:
    """(normalized_name, name, mentions, first_ord, confidence): one row a spelling, with its sum of confidences.

    A hot name, or the empty one, is reduced map-side to its spellings before it meets itself.
    """
    base = mentions.select(normalize_name("name").alias("normalized_name"), "name", "confidence", "ord")
    return base.groupBy("normalized_name", "name").agg(F.count(F.lit(1)).alias("mentions"), F.min("ord").alias("first_ord"), F.sum(F.col("confidence").cast("decimal(18,6)")).alias("confidence"))


def consolidate(mentions: DataFrame, citing: str = "citing_paper_id", cited: str = "cited_paper_id", first: int = 5) -> DataFrame:
    """Groups of mentions by normalised name.

    (normalized_name, name, variants, spellings, mention_count, citing_paper_count,
    cited_paper_count, avg_confidence, first_ord): ``name`` is the most frequent spelling, the
    first seen among equals; ``variants`` are the ``first`` spellings in order of first sight,
    of so many ``spellings`` (``spellings_of`` has all, as rows); empty ids don't count.

    Two aggregations, by spelling and then by normalised name; the first spellings of a name
    are picked map-side too (a window with a limit); distinct papers are counted apart by
    Spark's two-phase distinct aggregation.
    """
    spelled = spellings_of(mentions)
    groups = spelled.groupBy("normalized_name").agg(
        F.min_by("name", F.struct((-F.col("mentions")).alias("n"), F.col("first_ord"))).alias("name"),
        F.count(F.lit(1)).alias("spellings"),
        F.sum("mentions").alias("mention_count"),
        (F.sum("confidence").cast("double") / F.sum("mentions")).alias("avg_confidence"),
        F.min("first_ord").alias("first_ord"),
    )
    early = spelled.select("normalized_name", "name", "first_ord").withColumn("_r", F.row_number().over(Window.partitionBy("normalized_name").orderBy("first_ord"))).where(F.col("_r") <= first)
    variants = early.groupBy("normalized_name").agg(F.transform(F.sort_array(F.collect_list(F.struct("first_ord", "name"))), lambda x: x["name"]).alias("variants"))
    ids = mentions.select(normalize_name("name").alias("normalized_name"), F.nullif(F.col(citing).cast("string"), F.lit("")).alias("_a"), F.nullif(F.col(cited).cast("string"), F.lit("")).alias("_b"))
    papers = ids.groupBy("normalized_name").agg(F.count_distinct("_a").alias("citing_paper_count"), F.count_distinct("_b").alias("cited_paper_count"))
    joined = groups.join(variants, "normalized_name").join(papers, "normalized_name")
    return joined.select("normalized_name", "name", "variants", "spellings", "mention_count", "citing_paper_count", "cited_paper_count", "avg_confidence", "first_ord")


def collect_mentions(mentions: DataFrame, size: int = 10_000) -> DataFrame:
    """(normalized_name, part, mentions): the mention rows of each group in order, in arrays of at most ``size``.

    Parts are numbered from 0 within a group. Rows are numbered over ranges of (name, order),
    so that a hot group is spread over as many tasks as it has parts and ranges.
    """
    rows = mentions.withColumn("normalized_name", normalize_name("name"))
    numbered = with_ranks(rows, [F.asc("normalized_name"), F.asc("ord")], "_rank")
    firsts = numbered.groupBy("normalized_name").agg(F.min("_rank").alias("_first"))
    parts = hot_key_join(numbered, firsts, ["normalized_name"]).withColumn("part", F.floor((F.col("_rank") - F.col("_first")) / size).cast("long"))
    fields = [c for c in mentions.columns if c not in ("ord", "row", "pos")]
    return parts.groupBy("normalized_name", "part").agg(F.sort_array(F.collect_list(F.struct("ord", *fields))).alias("mentions"))


def exact_round2(values):
    """Python's rounding to two places, half-even on the exact binary value."""
    return pa.array([None if v is None else round(v, 2) for v in values.to_pylist()], pa.float64())


def with_ranks(df: DataFrame, order: Sequence, rank: str = "rank") -> DataFrame:
    """Numbers 1..n by a total order, without moving all rows into one task.

    Rows are range-partitioned and sorted, and written once with the number of their range;
    each task numbers its own from the sum of the counts before it, of which there is one a task.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    fixed = materialize(ordered, "ranked")
    counts = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = Window.partitionBy("_part").orderBy(*order)
    numbered = fixed.withColumn(rank, F.row_number().over(within)).join(F.broadcast(before.select("_part", "_before")), "_part")
    return numbered.withColumn(rank, F.col(rank) + F.col("_before")).drop("_part", "_before")


def rank_table(groups: DataFrame, summaries: DataFrame | None = None, round_exactly: bool = False) -> DataFrame:
    """The ranked table: Rank, Dataset, Mentions, Citing Papers, Cited Papers, Avg Confidence, Variants[, Description].

    Ranks are sequential: ties are numbered in order of first sight. Variants are the first five.
    """
    order = [F.desc("mention_count"), F.asc("first_ord")]
    ranked = with_ranks(groups, order)
    if round_exactly:
        ship(groups.sparkSession)
    average = F.arrow_udf(exact_round2, T.DoubleType())("avg_confidence") if round_exactly else F.col("avg_confidence")
    out = [
        F.col("rank").alias("Rank"), F.col("name").alias("Dataset"), F.col("mention_count").alias("Mentions"), F.col("citing_paper_count").alias("Citing Papers"),
        F.col("cited_paper_count").alias("Cited Papers"), average.alias("Avg Confidence"), F.array_join(F.slice("variants", 1, 5), ", ").alias("Variants"),
    ]
    if summaries is not None:
        ranked = ranked.join(summaries.select(F.col("name"), F.col("description").alias("_s")), "name", "left")
        out.append(F.col("_s").alias("Description"))
    return ranked.select(*out)


def citation_counts(papers: DataFrame, order: str = "row_id") -> DataFrame:
    """(corpusid, citations): elements of both lists; the last row of a paper wins; zero and null ids are left out."""
    paper = F.coalesce(truthy_id("cited_corpusid"), truthy_id("corpusid"))
    n = F.coalesce(F.size("citing_papers"), F.lit(0)) + F.coalesce(F.size("citations"), F.lit(0))
    return papers.select(paper.alias("corpusid"), n.cast("long").alias("n"), F.col(order).alias("_o")).where("corpusid IS NOT NULL").groupBy("corpusid").agg(F.max_by("n", "_o").alias("citations"))
