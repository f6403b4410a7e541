"""Model calls over a DataFrame: asynchronous within a partition, order kept, one row out for each row in."""

from __future__ import annotations

import asyncio
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from refmine.model.client import LLMClient
from refmine.model.prompts import EXTRACTION_SYSTEM, RELEVANCE_SYSTEM, extraction_prompt, relevance_prompt
from refmine.model.responses import extraction_record, relevance_record
from refmine.session import ship

EXTRACTION_TYPE = T.StructType([
    T.StructField("datasets", T.ArrayType(T.StringType())), T.StructField("citation_intent", T.ArrayType(T.StringType())), T.StructField("resource_type", T.ArrayType(T.StringType())),
    T.StructField("descriptions", T.MapType(T.StringType(), T.StringType())), T.StructField("confidence", T.DoubleType()), T.StructField("reasoning", T.StringType()),
])
RELEVANCE_TYPE = T.StructType([T.StructField("relevant", T.BooleanType()), T.StructField("confidence", T.DoubleType()), T.StructField("reason", T.StringType())])


def ask(df: DataFrame, prompt: Column, system: str, client: Callable[[], LLMClient], parse: Callable[[str | None], dict], kind: T.StructType, answer: str = "answer", in_flight: int = 64) -> DataFrame:
    """``df`` with a struct column ``answer``: the parsed answer to each row's prompt.

    ``client`` makes a client, once a partition; ``in_flight`` bounds the calls of a
    partition, so a service sees at most in_flight x running tasks. A call that fails is
    parsed as no answer. Calls may be repeated when a task is; write the result once before
    using it twice. ``parse`` must return the fields of ``kind``.
    """
    ship(df.sparkSession)
    asked = df.withColumn("_prompt", prompt)
    place = len(df.columns)

    async def one(c: LLMClient, gate: asyncio.Semaphore, text: str) -> dict:
        async with gate:
            try:
                return parse(await c.complete(system, text))
            except Exception:  # noqa: BLE001 - any failure of a call is an answer that can't be read
                return parse(None)

    async def batch(c: LLMClient, texts: list[str]) -> list[dict]:
        gate = asyncio.Semaphore(in_flight)
        return list(await asyncio.gather(*[one(c, gate, t) for t in texts]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with asyncio.Runner() as loop:
            c = client()
            try:
                for b in batches:
                    rows = loop.run(batch(c, b.column(place).to_pylist()))
                    typed = pa.array([{k: list(v.items()) if isinstance(v, dict) else v for k, v in r.items()} for r in rows], to_arrow_type(kind))
                    yield pa.RecordBatch.from_arrays([*b.columns[:place], typed], [*b.schema.names[:place], answer])
            finally:
                loop.run(c.close())

    return asked.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(answer, kind)]))


def extract_datasets(contexts: DataFrame, client: Callable[[], LLMClient], topic: str | None = None, context: str = "context", cited_title: str | None = None, in_flight: int = 64) -> DataFrame:
    """Contexts with what the model found: datasets, descriptions, citation_intent, resource_type, confidence, reasoning."""
    prompt = extraction_prompt(context, topic, F.col(cited_title) if cited_title else None)
    asked = ask(contexts, prompt, EXTRACTION_SYSTEM, client, extraction_record, EXTRACTION_TYPE, "_a", in_flight)
    return asked.select(*contexts.columns, "_a.*")


def extraction_rows(extracted: DataFrame, context: str = "context") -> DataFrame:
    """Rows with a dataset, the context cut to 500 characters."""
    return extracted.where(F.size("datasets") > 0).withColumn(context, F.substring(context, 1, 500))


def extraction_counters(extracted: DataFrame) -> DataFrame:
    """One row: (total_contexts, contexts_with_datasets, contexts_without)."""
    some = F.count_if(F.size("datasets") > 0)
    return extracted.agg(F.count(F.lit(1)).alias("total_contexts"), some.alias("contexts_with_datasets"), (F.count(F.lit(1)) - some).alias("contexts_without"))


def filter_relevant(papers: DataFrame, client: Callable[[], LLMClient], topic: str, min_confidence: float = 0.5, expert_domain: str | None = None, in_flight: int = 64) -> DataFrame:
    """Papers that the model finds relevant with enough confidence, with confidence and reason."""
    system = RELEVANCE_SYSTEM.format(expert=f", as an expert in {expert_domain}" if expert_domain else "")
    asked = ask(papers, relevance_prompt("title", "abstract", topic), system, client, relevance_record, RELEVANCE_TYPE, "_a", in_flight)
    return asked.where("_a.relevant AND _a.confidence >= " + repr(float(min_confidence))).select(*papers.columns, F.col("_a.confidence").alias("relevance"), F.col("_a.reason").alias("reason"))
