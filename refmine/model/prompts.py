"""Prompts as Column expressions; texts are cut before they reach a Python worker."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from refmine.model.client import CONTEXT_MARK, TITLE_MARK

# Characters of each part that a prompt holds.
CONTEXT_CHARS, TITLE_CHARS, ABSTRACT_CHARS = 2000, 300, 500

EXTRACTION_SYSTEM = """You read one sentence in which a paper cites another, and list the data resources it names.
Answer with one JSON object and nothing else:
{"citation intent": list of background, methodology, result comparison; "resource type": list such as dataset, benchmark, database, software;
"dataset labels": list of names exactly as written; "dataset_descriptions": object from name to a short description;
"confidence": number from 0 to 1; "reasoning": one sentence}.
Give only names that stand in the sentence; an empty list if there are none."""

RELEVANCE_SYSTEM = """You decide whether a paper is about a topic{expert}.
Answer with one JSON object and nothing else: {{"relevant": true or false, "confidence": number from 0 to 1, "reason": one sentence}}."""


def _cut(c: Column | str, n: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.substring(c, 1, n), F.lit(""))


def _line(mark: str, text: Column) -> Column:
    return F.when(text != "", F.concat(F.lit(mark), text, F.lit("\n"))).otherwise(F.lit(""))


def extraction_prompt(context: Column | str, topic: str | None = None, cited_title: Column | None = None) -> Column:
    # Line breaks would end a part early.
    body = F.regexp_replace(_cut(context, CONTEXT_CHARS), r"[\r\n]+", " ")
    title = _cut(cited_title, TITLE_CHARS) if cited_title is not None else F.lit("")
    return F.concat(_line("Topic: ", F.lit(topic or "")), _line("Cited paper: ", title), F.lit(CONTEXT_MARK), body)


def relevance_prompt(title: Column | str, abstract: Column | str, topic: str) -> Column:
    return F.concat(F.lit(f"Topic: {topic}\n"), F.lit(TITLE_MARK), F.regexp_replace(_cut(title, TITLE_CHARS), r"[\r\n]+", " "), F.lit("\nAbstract: "), _cut(abstract, ABSTRACT_CHARS))
