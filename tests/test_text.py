from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
import pytest

from refmine.functions import text as X


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_normalize(spark):
    cases = {"CIFAR-10": "cifar10", "CIFAR 10": "cifar 10", "MS  COCO (2017)": "ms coco 2017", "- Foo": " foo", "Foo -": "foo ", "---": "", "Café_Größe": "café_größe"}
    assert apply(spark, X.normalize_name, list(cases)) == list(cases.values())
    assert apply(spark, X.normalize_name, [None]) == [None]


def test_doi(spark):
    cases = [
        ("HTTPS://DOI.org/10.1000/ABC", "10.1000/ABC"), ("https://doi.org/10.1000/abc.", "10.1000/abc."), ("see 10.1000/abc).", "10.1000/abc"),
        ("https://dx.doi.org/10.1000/abc", "10.1000/abc"), ("10.12/abc", None), ("", None), (None, None),
        ("10.1234/ab\u00a0cd", "10.1234/ab"), ("10.1234/ab\u2003x", "10.1234/ab"), ("\u2003https://doi.org/10.1/a\u00a0b\u2003", "10.1/a\u00a0b"), ("10.\u0661\u0662\u0663\u0664/x", "10.\u0661\u0662\u0663\u0664/x"),
    ]
    assert apply(spark, X.extract_doi, [a for a, _ in cases]) == [b for _, b in cases]


def test_link_cells(spark):
    cases = [
        ("https://doi.org/10.1000/ABC, 10.1000/abc., https://doi.org/10.1000/abc (+3), https://example.org/x., https://example.org/X", "https://doi.org/10.1000/ABC, https://example.org/x."),
        ("https://a.org/1 (+2), https://a.org/1 (+5)", "https://a.org/1 (+2)"),
        ("https://doi.org/10.1000/abc., 10.1000/abc", "https://doi.org/10.1000/abc., 10.1000/abc"),
        ("nan", ""), (" ", ""), (None, ""), ("a,,b, ", "a, b"), ("http://x, http://x .,", "http://x"), ("http://x, http://x\u00a0)", "http://x"), ("u\u2003(+2), u", "u\u2003(+2)"), ("10.1234/a\u00a0b, 10.1234/a", "10.1234/a\u00a0b"),
    ]
    assert apply(spark, X.dedup_link_cell, [a for a, _ in cases]) == [b for _, b in cases]


def test_file_names(spark):
    def name(q, kind, limit):
        return spark.range(1).select(X.context_file_name(F.lit(q), kind, limit)).first()[0]

    assert name("Multi-modal Knowledge Graph/Reasoning!", "citing", 100) == "multi_modal_knowledge_graph_reasoning_citing_contexts_100.json"
    assert name("topic model", "both", 0) == "topic_model_combined_contexts.json"
    assert name(" -x- ", "other", None) == "x_contexts.json"


def test_bare_form_and_blanks(spark):
    assert apply(spark, X.bare_form, ["Ab-1 é!", "---", None, "中文 2"]) == ["ab1é", "", None, "中文2"]
    assert apply(spark, X.not_blank, ["a", " \t 　", "", None]) == [True, False, False, False]
    assert apply(spark, X.collapse_ws, ["  a \t  b\n"]) == ["a b"]


def test_braces_and_ids(spark):
    assert apply(spark, lambda c: X.first_braces(c, True), ['x {"a":{"b":1}} y } z', "none", None]) == ['{"a":{"b":1}} y }', None, None]
    assert apply(spark, lambda c: X.first_braces(c, False), ['x {"a":{"b":1}} y', "{}"]) == ['{"a":{"b":1}', None]
    df = spark.createDataFrame([(0,), (3,), (None,)], "v bigint")
    assert [r[0] for r in df.select(X.truthy_id("v")).collect()] == [None, 3, None]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aB1é .,;:/()+-_ \t"), max_size=30), min_size=1, max_size=30))
def test_properties(spark, values):
    once = apply(spark, X.normalize_name, values)
    assert all(v == v.lower() and not any(c in v for c in ".,;:/()+-") for v in once)
    cells = apply(spark, X.dedup_link_cell, values)
    assert apply(spark, X.dedup_link_cell, cells) == cells


@pytest.mark.parametrize("size", [200_000])
def test_very_long(spark, size):
    long = "a, " * size
    assert apply(spark, X.bare_form, [long]) == ["a" * size]
    assert apply(spark, X.normalize_name, ["x" * size]) == ["x" * size]
