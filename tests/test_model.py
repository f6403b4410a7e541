import json

import pytest
from pyspark.sql import functions as F

from refmine.model.client import RuleClient
from refmine.plans.rules import extraction_rule, relevance_rule
from refmine.model.operator import ask, extract_datasets, extraction_counters, extraction_rows, filter_relevant
from refmine.model.prompts import extraction_prompt, relevance_prompt
from refmine.model.operator import RELEVANCE_TYPE
from refmine.model.responses import extraction_record, relevance_record


@pytest.mark.parametrize("answer,labels,confidence", [
    ('ok {"dataset labels":["A"],"confidence":0.9}', ["A"], 0.9), ('{"dataset labels":[],"confidence":0.9}', [], 0.6), ('{"dataset labels":"A","confidence":0.9}', [], 0.6),
    ('{"dataset labels":["A"]}', ["A"], 0.5), ("no braces", [], 0.3), ('{"dataset labels":["A"]} tail}', [], 0.3), ('{"dataset labels":[],"confidence":"high"}', [], 0.3), (None, [], 0.3),
    ('{"dataset labels":["A",3,null],"dataset_descriptions":{"A":null,"B":2}}', ["A", "3"], 0.5),
])
def test_extraction_answers(answer, labels, confidence):
    r = extraction_record(answer)
    assert (r["datasets"], r["confidence"]) == (labels, confidence)


@pytest.mark.parametrize("answer,relevant,confidence", [
    ('{"relevant":true,"confidence":0.5}', True, 0.5), ('{"relevant":true,"confidence":0.49}', True, 0.49), ('{"relevant":true}', True, 0.0), ('{"relevant":"false","confidence":0.9}', True, 0.9),
    ("True, I think", True, 0.5), ("not related", False, 0.5), ('{"relevant":true,"x":{"y":1}}', False, 0.0), (None, False, 0.5), ('{"relevant":true,"confidence":"x"}', False, 0.0),
])
def test_relevance_answers(answer, relevant, confidence):
    r = relevance_record(answer)
    assert (r["relevant"], r["confidence"]) == (relevant, confidence)


def test_extraction_over_rows(spark):
    rows = [(1, "We use Pozi Tree Survey and Kago QA.", "a"), (2, "Nothing here.", "b"), (3, None, "c"), (4, "x" * 3000, "d"), (4, "Kago QA\nZed Bench", "d")]
    df = spark.createDataFrame(rows, "id int, context string, extra string").repartition(3)
    out = extract_datasets(df, lambda: RuleClient(extraction_rule), "topic")
    got = sorted((r.id, tuple(r.datasets), r.confidence) for r in out.collect())
    assert got == [(1, ("Pozi Tree Survey", "Kago QA"), 0.7), (2, (), 0.6), (3, (), 0.6), (4, (), 0.6), (4, ("Kago QA", "Zed Bench"), 0.7)]
    assert extraction_rows(out).count() == 2 and tuple(extraction_counters(out).first()) == (5, 2, 3)
    assert extract_datasets(df.limit(0), lambda: RuleClient(extraction_rule)).count() == 0


def test_failing_calls_are_answers_too(spark):
    def broken(user):
        raise RuntimeError("down")

    out = extract_datasets(spark.createDataFrame([("a",), ("b",)], "context string"), lambda: RuleClient(broken))
    assert [r.confidence for r in out.collect()] == [0.3, 0.3]


def test_relevance_filter(spark):
    df = spark.createDataFrame([(1, "Crop maps", None), (2, "a" * 40 + " crop", ""), (3, None, "crop"), (4, "other", "x")], "corpusid int, title string, abstract string")
    assert [r.corpusid for r in filter_relevant(df, lambda: RuleClient(relevance_rule("crop")), "crop").collect()] == [1]
    assert sorted(r.corpusid for r in filter_relevant(df, lambda: RuleClient(relevance_rule("crop")), "crop", min_confidence=0.3).collect()) == [1, 2]


def test_order_and_any_record(spark):
    df = spark.range(500, numPartitions=2)
    client = lambda: RuleClient(lambda u: json.dumps({"relevant": True, "confidence": int(u)}))
    out = ask(df, F.col("id").cast("string"), "s", client, relevance_record, RELEVANCE_TYPE, in_flight=7).collect()
    assert [r.id for r in out] == list(range(500)) and all(r.answer.confidence == r.id for r in out)


def test_prompts(spark):
    df = spark.createDataFrame([("c" * 5000, "t" * 900, "a" * 900)], "context string, title string, abstract string")
    a, b = df.select(extraction_prompt("context", "T"), relevance_prompt("title", "abstract", "T")).first()
    assert "c" * 2000 in a and "c" * 2001 not in a and "t" * 300 in b and "t" * 301 not in b and "a" * 500 in b and "a" * 501 not in b
