import random
import unicodedata
from collections import Counter, defaultdict
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from refmine.llm.ledger import CopyLedger, batch_numbers, canonical_items, canonical_text, key_digest
from refmine.llm.queries import ORACLE
from refmine.llm.survivors import Field, _peel, dominance_layers, layered_survivors, says_something, surviving_fields, surviving_records
from refmine.llm.terms import BurstTrie, _bounds, _merged, _routed, term_frequencies


def bare(s):
    return "" if s is None else "".join(c for c in s.lower() if unicodedata.category(c)[0] in "LN")


def test_ledger_over_batches(spark):
    rng = random.Random(1)
    names = ["Ab c", "AB-C", "abc ", "x", "X!", "--", None, "", "é", "é", "hot", "H o t"]
    rows = [(i, rng.choice(names + ["hot"] * 12), datetime(2024, 1, 1 + rng.randrange(28)) if rng.random() < 0.9 else None) for i in range(2500)]
    df = spark.createDataFrame(rows, "id bigint, name string, at timestamp")
    keyed = df.select(F.lit("t").alias("scope"), key_digest(canonical_text("name")).alias("key"), "id", "at")
    numbered = keyed.withColumn("n", batch_numbers(keyed, "at", 3))
    batches = [numbered.where(F.col("n") == i).drop("n", "at") for i in range(3)]
    assert sum(b.count() for b in batches) == 2500
    ledger = CopyLedger(spark, buckets=4)
    odd = keyed.limit(3).select(F.lit(None).cast("string").alias("scope"), "key", "id", F.lit(1).alias("copies"), F.lit(2).alias("first_id"))
    for b in [*batches, keyed.limit(0), odd]:
        ledger.update(b)
    groups = defaultdict(list)
    for i, n, _ in rows:
        if bare(n):
            groups[bare(n)].append(i)
    assert sorted((r.copies, r.first_id) for r in ledger.entries.collect()) == sorted((len(g), min(g)) for g in groups.values())
    assert {(r.first_id, r.copy_id) for r in ledger.copies(keyed).collect()} == {(min(g), i) for g in groups.values() for i in g if i != min(g)}


def test_ledger_goes_on_where_it_was(spark, tmp_path):
    """Opened by its path; a batch counts once; an update shuffles the batch only and writes the buckets that it touches."""
    def rows(names):
        df = spark.createDataFrame([(i, n) for i, n in names], "id bigint, name string")
        return df.select(F.lit("t").alias("scope"), key_digest(canonical_text("name")).alias("key"), "id")

    path = f"file://{tmp_path}/ledger"
    assert CopyLedger(spark, path, buckets=8).update(rows([(i, f"name {i % 40}") for i in range(100)]), "first")
    again = CopyLedger(spark, path)
    assert again.buckets == 8 and not again.update(rows([(1, "name 1")]), "first")
    before = again._latest()["files"]
    assert again.update(rows([(0, "NAME-1"), (500, "name 7 "), (501, "new")]), "second")
    found, after = again._latest(), CopyLedger(spark, path)._latest()["files"]
    changed = [b for b in after if after[b] != before.get(b)]
    assert 1 <= len(changed) <= 3 and found["version"] == 2 and found["rows"] == 103 and sorted(found["batches"]) == ["first", "second"]
    counts = sorted((r.first_id, r.copies) for r in CopyLedger(spark, path).entries.collect())
    assert counts[:3] == [(0, 3), (0, 4), (2, 3)] and (7, 4) in counts and counts[-1] == (501, 1) and sum(n for _, n in counts) == 103
    for n in range(3):
        again.update(rows([(n, "name 1")]), f"more {n}")
    left = {p.name for p in (tmp_path / "ledger" / "data").glob("*.parquet")}
    assert len(left - set(again._latest()["files"].values())) == 1  # what the last update replaced
    assert len(list((tmp_path / "ledger" / "manifests").glob("*.json"))) == 2 and not list((tmp_path / "ledger" / "staged").glob("*"))

    def fails(*_):
        raise RuntimeError

    kept, sums = again._commit, lambda: sorted((r.first_id, r.copies) for r in CopyLedger(spark, path).entries.collect())
    before, again._commit = sums(), fails
    try:
        again.update(rows([(7, "name 3")]), "lost")
    except RuntimeError:
        again._commit = kept
    assert sums() == before
    again.vacuum()
    data = {p.name for p in (tmp_path / "ledger" / "data").glob("*.parquet")}
    assert sums() == before and len(data) == len(left) and again.update(rows([(7, "name 3")]), "lost")
    after = again._latest()["files"]

    old, new = again._rows(list(after.values())), again._rows(list(after.values()))
    plan = again._merged(old, new)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_canonical_items(spark):
    df = spark.createDataFrame([(["B-1", "a ", None, "--"],), (["A", "b1", "a!"],), (["--", None],), ([],), (None,)], "v array<string>")
    assert [r[0] for r in df.select(canonical_items("v")).collect()] == ["a\u001fb1", "a\u001fb1", None, None, None]
    pair = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "c")], "x string, y string").select(key_digest(F.col("x"), F.col("y"))).collect()
    assert pair[0][0] != pair[1][0] and pair[2][0] is None


def test_burst_trie():
    rng = random.Random(2)
    words = ["".join(rng.choices("ab", k=rng.randint(0, 9))) for _ in range(5000)]
    trie, want = BurstTrie(), Counter()
    for w in words:
        trie.add(w, 2, 1)
        want[w] += 1
    got = {p + s: tuple(c) for p, suffixes, counters in trie.leaves() for s, c in zip(suffixes, counters)}
    assert got == {w: (2 * n, n) for w, n in want.items()} and trie.size == len(want)


def test_merged_tries_equal_the_counts(spark):
    """Subtrees of several tries, deep and shallow ones, parted at the bounds and merged range by range."""
    rng = random.Random(5)
    want, rows = Counter(), []
    for size in (3000, 3000, 40, 1, 800):
        trie = BurstTrie()
        for _ in range(size):
            w = rng.choice(["", "the ", "the term "]) + "".join(rng.choices("abé𝄞", k=rng.randint(1, 7)))
            trie.add(w, 2, 1)
            want[w] += 1
        rows += [(0, p, s, [c[0] for c in cs], [c[1] for c in cs]) for p, s, cs in trie.leaves()]
    leaves = spark.createDataFrame(rows, "field int, prefix string, suffixes array<string>, occurrences array<bigint>, records array<bigint>").repartition(3)
    bounds = _bounds(leaves, 6)
    assert 2 <= len(bounds) <= 5
    routed = leaves.mapInArrow(_routed(bounds), "part int, " + "field int, prefix string, suffixes array<string>, occurrences array<bigint>, records array<bigint>")
    seen = routed.select("part", F.explode("suffixes").alias("s"), "prefix").select("part", F.concat("prefix", "s").alias("t")).groupBy("t").agg(F.count_distinct("part").alias("n")).where("n > 1")
    assert seen.count() == 0
    merged = routed.repartitionById(6, F.col("part")).sortWithinPartitions("field", "prefix").mapInArrow(_merged, "field int, term string, occurrences bigint, records bigint").collect()
    assert len(merged) == len(want) and {r.term: (r.occurrences, r.records) for r in merged} == {w: (2 * n, n) for w, n in want.items()}


def test_term_frequencies(spark):
    rng = random.Random(3)
    pool = ["Data Set", " data  set ", "x", "", " ", None, "Common", "y" * 5000, "Ünï"]
    rows = [([rng.choice(pool + ["common"] * 8) for _ in range(rng.randrange(4))] if rng.random() < 0.9 else None, ["t"], 1) for _ in range(900)]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>, term int").repartition(3)
    got = {(r.field_name, r.term): (r.occurrences, r.records, r.holding, r.mark) for r in term_frequencies(df, ["a", "b"]).collect()}
    occ, rec, holding = Counter(), Counter(), Counter()
    for a, b, _ in rows:
        for f, v in (("a", a), ("b", b)):
            terms = [" ".join(x.lower().split()) for x in v or [] if x and x.strip()]
            holding[f] += bool(terms)
            occ.update((f, t) for t in terms)
            rec.update((f, t) for t in set(terms))
    mark = lambda k: "rare" if rec[k] < 3 else "common" if rec[k] > 0.1 * holding[k[0]] else None
    assert got == {k: (occ[k], rec[k], holding[k[0]], mark(k)) for k in occ}
    assert term_frequencies(df.limit(0), ["a", "b"]).count() == 0


def test_layers_against_pairwise_comparison():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(150):
        n, k, most = int(rng.integers(1, 50)), int(rng.integers(1, 4)), int(rng.integers(1, 4))
        group = np.unique(rng.integers(0, 4, n), return_inverse=True)[1]
        dims = rng.integers(0, 4, (n, k)).astype(float)
        dims[rng.random((n, k)) < 0.1] = -np.inf
        want = np.full(n, most)
        for g in set(group.tolist()):
            left = [i for i in range(n) if group[i] == g]
            for depth in range(most):
                front = [i for i in left if not any((dims[j] >= dims[i]).all() and (dims[j] > dims[i]).any() for j in left)]
                want[front] = depth
                left = [i for i in left if i not in front]
        assert (_peel(group, dims, most) == want).all()
        for g in set(group.tolist()):
            assert (dominance_layers(dims[group == g], most) == want[group == g]).all()


def brute_layers(points):
    left, layer, depth = set(points), {}, 0
    while left:
        front = {p for p in left if not any(q != p and all(a >= b for a, b in zip(q, p)) for q in left)}
        layer |= dict.fromkeys(front, depth)
        left, depth = left - front, depth + 1
    return layer


def test_layered_survivors_against_brute_force(spark):
    rng = random.Random(4)
    maybe = lambda v: v if rng.random() < 0.4 else None
    rows = []
    for i in range(3000):
        x, y = maybe(rng.random()), maybe(rng.random())
        rows.append((rng.choice(["hot"] * 6 + ["a", "b", None]), (x is not None) + (y is not None), rng.choice([None, *range(30)]), rng.randrange(5), x, y, i))
    df = spark.createDataFrame(rows, "g string, n int, t int, z int, x double, y double, id bigint").repartition(4)
    low = lambda v: float("-inf") if v is None else float(v)
    fields = [Field(c, F.col(c).isNotNull(), F.col(a), F.col(b), F.col("id")) for c, a, b in (("x", "z", "t"), ("y", "y", "t"), ("none", "z", "t"))]
    fields[2] = Field("none", F.lit(False), F.col("z"), F.col("t"), F.col("id"))
    for layers in (1, 2, 50):
        for by_layer in (True, False):
            want = set()
            for g in ("hot", "a", "b"):
                own = [r for r in rows if r[0] == g]
                deep = brute_layers([(r[1], low(r[2]), r[3]) for r in own])
                for f, at in (("x", 4), ("y", 5)):
                    key = (lambda r: (-r[3], -low(r[2]), r[6])) if f == "x" else (lambda r: (-r[5], -low(r[2]), r[6]))
                    tier = lambda r: min(layers, deep[(r[1], low(r[2]), r[3])])  # noqa: E731, B023
                    best = min((r for r in own if r[at] is not None), key=lambda r: (tier(r), *key(r)) if by_layer else key(r))  # noqa: B023
                    want.add((g, f, tier(best), best[6]))
            got = layered_survivors(df, "g", [F.col("n"), F.col("t"), F.col("z")], fields, layers, by_layer)
            assert {tuple(r) for r in got.collect()} == want, (layers, by_layer)
    assert layered_survivors(df.limit(0), "g", [F.col("n")], fields).count() == 0


def test_layers_decide_what_fills_a_gap(spark):
    """The record of the second layer is more trusted than the one of the first that has the name."""
    t = lambda d: datetime(2024, 1, d)
    records = [(1, None, ["a b", "x"], None, 6, t(2)), (2, "AB", None, None, 1, t(10)), (3, "a.b", None, None, 5, t(1)), (4, None, ["--"], None, 9, None)]
    r = spark.createDataFrame(records, "record_id bigint, name string, variants array<string>, mention_ids array<bigint>, trust int, updated_at timestamp")
    e = spark.createDataFrame([(7, {"ab": "text"}, 0.5, t(1))], "extraction_id bigint, dataset_descriptions map<string,string>, confidence_score double, extracted_at timestamp")
    assert [tuple(x) for x in surviving_records(r, e).collect()] == [(1, "AB", ["a b", "x"], None, 0, 0, None)]
    by_rule = {(x.field_name, x.source_id) for x in surviving_fields(r, e).collect()}
    assert by_rule == {("name", 3), ("variants", 1)}
    assert surviving_records(r.limit(0), e).count() == 0


def test_built_record(spark):
    t = lambda d: datetime(2024, 1, d)
    records = [(1, "Foo", ["FOO", "foo!"], [10, 11], 3, t(1)), (1, "Foo", ["FOO", "foo!"], [10, 11], 3, t(1)), (2, "foo ", None, [12], 3, t(1))]
    r = spark.createDataFrame(records, "record_id bigint, name string, variants array<string>, mention_ids array<bigint>, trust int, updated_at timestamp").withColumn("group_id", F.lit(0))
    e = spark.createDataFrame([(10, {"foo": "good", "Foo.": "also", "x": "no"}, 0.9, t(1)), (11, {"foo": "n/a"}, 1.0, t(1)), (12, {"foo": "other"}, 1.0, t(1))], "extraction_id bigint, dataset_descriptions map<string,string>, confidence_score double, extracted_at timestamp")
    assert [tuple(x) for x in surviving_records(r, e).collect()] == [(1, "Foo", ["FOO", "foo!"], "also", 0, 0, 0)]


def test_surviving_fields(spark):
    t = lambda d: datetime(2024, 1, d)
    records = [
        (1, "Foo Set", ["foo-set", None], [10, 11], 1, t(5)), (2, "FOO  set", ["Bar", "Bar", "Baz"], [12], 3, None), (3, None, ["bar", "--"], None, 3, t(1)), (4, " ", ["FooSet", "q", "r"], [], 4, t(2)),
        (5, "lonely", None, [10], 9, t(9)), (6, None, None, None, 1, None), (7, "pair", None, [13], 1, None), (8, "PAIR", [], None, 1, None),
    ]
    extractions = [(10, {"Foo set": "N/A", "lonely": "text"}, 0.9, t(1)), (11, {"foo_set": "good", "zzz": "x"}, 0.5, t(1)), (12, {"BAZ": "better"}, 0.5, t(2)), (13, {"pair": None}, 1.0, t(3)), (14, {"Foo set": "unmentioned"}, 1.0, t(3))]
    r = spark.createDataFrame(records, "record_id bigint, name string, variants array<string>, mention_ids array<bigint>, trust int, updated_at timestamp")
    e = spark.createDataFrame(extractions, "extraction_id bigint, dataset_descriptions map<string,string>, confidence_score double, extracted_at timestamp")
    got = {(x.group_id, x.field_name, x.source_id) for x in surviving_fields(r, e).collect()}
    assert got == {(1, "name", 2), (1, "variants", 4), (1, "dataset_descriptions", 12), (7, "name", 7)}
    assert surviving_fields(r.limit(0), e).count() == 0 and surviving_fields(r, e.limit(0)).count() == 3


def test_fields_by_rule_make_no_layers(spark, tmp_path, monkeypatch):
    """Layers can't change what each field's own policy picks, so none are made; odd qualities are ordered as in the SQL."""
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(9)
    far = datetime(9990, 1, 1)
    when = lambda: rng.choice([None, datetime(2024, 1, 1), far, far.replace(microsecond=1)])
    records = []
    for i in [-(2**63), 2**63 - 1, *range(-30, 170)]:
        j = rng.randrange(40)
        variants = rng.choice([None, [], [f"N{j}", f"n_{j}", None], [f"n{j}", "--"]])
        records.append((i, rng.choice([None, "", f"n {j}", f"N {j}"]), variants, rng.choice([None, rng.sample(range(60), 6)]), rng.choice([None, 1, 2]), when()))
    odd = [None, 0.5, 0.0, -0.0, float("nan"), float("inf"), float("-inf")]
    extractions = [(i, {f"N-{rng.randrange(40)}": rng.choice(["text", "n/a", None]) for _ in range(20)}, rng.choice(odd), when()) for i in range(60)]
    r = spark.createDataFrame(records, "record_id bigint, name string, variants array<string>, mention_ids array<bigint>, trust int, updated_at timestamp")
    e = spark.createDataFrame(extractions, "extraction_id bigint, dataset_descriptions map<string,string>, confidence_score double, extracted_at timestamp")
    db = duckdb.connect()
    db.execute("SET timezone = 'UTC'")
    for name, df in (("merged_datasets", r), ("extraction_results", e)):
        pq.write_table(df.toArrow(), tmp_path / f"{name}.parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    want = db.execute(ORACLE["p6_found"]).fetchall()
    monkeypatch.setattr("refmine.llm.survivors.layered_survivors", None)
    got = surviving_fields(r, e)
    assert len(want) > 50 and sorted(tuple(x) for x in got.collect()) == sorted(want)
    assert "MapInArrow" not in got._jdf.queryExecution().executedPlan().toString()


def test_placeholders(spark):
    df = spark.createDataFrame([(v,) for v in ("text", "N/A", "None.", "--", " ", None, "not available", "tbd", "?")], "v string")
    assert [r[0] for r in df.select(says_something("v")).collect()] == [True] + [False] * 8
