import random
from collections import Counter, defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from refmine.operators.components import components
from refmine.operators.skew import eager_join_aggregate, hot_key_join, hot_keys, top_items


def test_top_items_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([5, 6, 7, -4, 2**63 - 1, -(2**63) + 1, None])) for _ in range(3000)]
    a = spark.createDataFrame(rows, "k bigint, i bigint")
    b = spark.createDataFrame([(9, 1), (9, 1), (9, 0)], "k bigint, i bigint")
    got = {(r.field_name, r.k): (r.top_item, r.top_entries, r.entries, r.items) for r in top_items({"a": a, "b": b}, "k", "i").collect()}
    want = {("b", 9): (1, 2, 3, 2)}
    by = defaultdict(Counter)
    for k, i in rows:
        if k is not None and i is not None:
            by[k][i] += 1
    for k, c in by.items():
        top = min(c, key=lambda i: (-c[i], i))
        want[("a", k)] = (top, c[top], sum(c.values()), len(c))
    assert got == want


def test_top_items_empty(spark):
    e = spark.createDataFrame([], "k bigint, i bigint")
    assert top_items({"a": e, "b": e}, "k", "i").count() == 0


def test_eager_join_matches_the_join(spark):
    rng = random.Random(2)
    left = spark.createDataFrame([(rng.choice([1, 1, 2, None]), rng.choice("xyz"), rng.choice([1, 5, None])) for _ in range(300)], "k int, pairs string, v int")
    right = spark.createDataFrame([(rng.choice([1, 2, 2, 3, None]), rng.randrange(9)) for _ in range(200)], "k int, v2 int")
    got = sorted(tuple(r) for r in eager_join_aggregate(left, right, "k", ["v"], ["v2"]).collect())
    want = sorted(
        (r[0], Decimal(r[1]), r[2] and Decimal(r[2]), Decimal(r[3]))
        for r in left.join(right, "k").groupBy("k").agg(F.count(F.lit(1)), F.sum("v"), F.sum("v2")).collect()
    )
    assert got == want
    by = eager_join_aggregate(left.withColumnRenamed("pairs", "s"), right, "k", [], [], rollup="s")
    assert {r.s: int(r.pairs) for r in by.collect()} == {r[0]: r[1] for r in left.join(right, "k").groupBy("pairs").count().collect()}


def test_hot_key_join(spark):
    rows = [(1, i) for i in range(3000)] + [(k, k) for k in range(2, 700)] + [(None, 0)]
    big = spark.createDataFrame(rows, "k int, v int").repartition(4)
    states = spark.createDataFrame([(k, str(k)) for k in range(0, 700, 2)] + [(1, "one")], "k int, s string")
    assert [r.k for r in hot_keys(big, ["k"]).collect()] == [1]
    for how in ("inner", "left"):
        got = sorted(map(str, hot_key_join(big, states, ["k"], how).select("k", "v", "s").collect()))
        assert got == sorted(map(str, big.join(states, "k", how).select("k", "v", "s").collect()))


def _union_find(rows):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for n, f in rows:
        if n is not None and f is not None:
            a, b = find(("n", n)), find(("f", f))
            if a != b:
                parent[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for n in {n for n, f in rows if n is not None and f is not None}:
        groups[find(("n", n))].append(n)
    return {n: min(g) for g in groups.values() for n in g}


def test_components(spark):
    rng = random.Random(3)
    rows = [(i, f"c{i}") for i in range(60)] + [(i + 1, f"c{i}") for i in range(59)]  # a long chain
    rows += [(1000 + i, "hot") for i in range(500)] + [(rng.randrange(2000, 2300), f"r{rng.randrange(250)}") for _ in range(300)]
    rows += [(None, "x"), (5000, None), (5001, "alone"), (3, "c3")]
    got = {r.n: r.component for r in components(spark.createDataFrame(rows, "n int, f string"), "n", "f").collect()}
    assert got == _union_find(rows)
    assert components(spark.createDataFrame([], "n int, f string"), "n", "f").count() == 0
