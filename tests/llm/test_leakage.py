import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from refmine.llm.leakage import ItemIndex, common_subsequence, leaked_items, longest_run, numbers_of, passage_windows, stretches, words_of
from refmine.llm.queries import PARAPHRASED


def brute_words(text):
    out, word = [], ""
    for c in text + " ":
        if unicodedata.category(c)[0] in "LN":
            word += c
        elif word:
            out.append(word.lower())
            word = ""
    return out


def test_words():
    for t in ("Don't_stop é ½ 中文x", "İstanbul ΟΔΟΣ", "", "--", "a​b"):
        assert words_of(t) == brute_words(t)


def test_common_parts():
    rng = random.Random(7)
    for _ in range(200):
        a, b = [rng.randrange(-1, 4) for _ in range(rng.randint(0, 12))], [rng.randrange(4) for _ in range(rng.randint(1, 12))]
        runs = max((n for n in range(1, 13) for i in range(len(a) - n + 1) for j in range(len(b) - n + 1) if a[i : i + n] == b[j : j + n]), default=0)
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert longest_run(np.array(a, np.int32), np.array(b, np.int32)) == runs and common_subsequence(a, b) == table[-1][-1]


def test_every_short_run_lies_in_a_passage_window():
    vocab = {f"w{i}": i for i in range(200)}
    rng = random.Random(8)
    for _ in range(50):
        words = [f"w{rng.randrange(200)}" if rng.random() < 0.9 else "foreign" for _ in range(rng.randint(0, 120))]
        windows = [w.tolist() for s in stretches(numbers_of(words, vocab), 7, 2) for w in passage_windows(s)]
        ids = [vocab.get(w, -1) for w in words]
        for k in range(len(ids) - 11):
            run = ids[k : k + 12]
            if min(run) >= 0:
                assert any(run == w[i : i + 12] for w in windows for i in range(len(w) - 11))


def planted(rng, n_items=30, n_docs=300):
    common, rare = [f"c{i}" for i in range(300)], [f"r{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(common[:40] + rare, k=rng.choice([7, 9, 12, 20, 60]))), ["r1 r2"]) for i in range(n_items)]
    docs = []
    for d in range(n_docs):
        words = rng.choices(common, k=rng.randint(0, 80))
        for _ in range(rng.choice([0, 1, 1, 2])):
            w = rng.choice(items)[1].split()
            n = rng.choice([11, 12, 13, len(w)])
            at = rng.randrange(max(1, len(w) - n + 1))
            part = [x.upper() if rng.random() < 0.3 else x for x in w[at : at + n]]
            if rng.random() < 0.2:
                part.insert(len(part) // 2, "other")
            k = rng.randint(0, len(words))
            words[k:k] = part
        docs.append((d, rng.choice([" ", ", ", "\n- "]).join(words)))
    return items, docs


def brute(items, docs):
    out = set()
    for d, t in docs:
        w = brute_words(t or "")
        for i, x, _ in items:
            v = brute_words(x or "")
            n = min(12, len(v))
            grams = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if v else set()
            if any(tuple(w[k : k + n]) in grams for k in range(len(w) - n + 1)) and v:
                out.add((d, i))
    return out


def test_exact_leaks_whatever_the_rank(spark):
    items, docs = planted(random.Random(9))
    docs += [(9000, None), (9001, ""), (9002, "--")]
    items += [(900, "...", None), (901, None, None), (902, "", [])]
    d = spark.createDataFrame(docs, "doc_id int, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id int, text string, gold array<string>")
    want = brute(items, docs)
    assert want
    for rank, block, share in ((192, 200_000, None), (4, 200_000, None), (64, 300, None)):
        found = leaked_items(d, i, "doc_id", "text", "item_id", "text", "gold", rank=rank, block_words=block, share=share)
        got = {(r.doc_id, r.item_id) for r in found.where("run >= least(12, words)").collect()}
        assert got == want, rank


def test_paraphrase_and_empty(spark):
    item = "the quaint ferry crossed a tidal furrow before seven muted beacons bundled every crooked anvil beside that frosted orchard lantern gully loom"
    words = item.split()
    words[8], words[15] = "quickly", "slowly"
    d = spark.createDataFrame([(1, " ".join(words)), (2, "nothing of it")], "doc_id int, text string")
    i = spark.createDataFrame([(5, item)], "item_id int, text string")
    rows = leaked_items(d, i, "doc_id", "text", "item_id", "text").collect()
    assert [(r.doc_id, r.item_id, r.run < 12, r.lcs >= 18) for r in rows] == [(1, 5, True, True)]
    assert leaked_items(d.limit(0), i, "doc_id", "text", "item_id", "text").count() == 0
    assert leaked_items(d, i.limit(0), "doc_id", "text", "item_id", "text").count() == 0
    assert leaked_items(d.withColumn("item", F.lit(1)), i.withColumn("doc", F.lit(2)), "doc_id", "text", "item_id", "text").count() == 1


def test_paraphrase_at_any_place(spark):
    item = "the quaint ferry crossed a tidal furrow before seven muted beacons bundled every crooked anvil beside that frosted orchard lantern gully loom"
    other = "amber basalt cedar delta ember fjord granite harbour ivory juniper kelp lagoon"
    words = item.split()
    words[8], words[15] = "quickly", "slowly"
    split = item.split()
    split[10:14] = ["w", "x", "y", "z"]
    long = [f"l{i}" for i in range(28)]
    changed = [f"z{i}" if 10 <= i < 17 else w for i, w in enumerate(long)]
    docs = [(n, " ".join(other.split()[:n] + words)) for n in range(13)] + [(20 + n, " ".join(["foreign"] * n + split)) for n in range(3)] + [(30 + n, " ".join(other.split()[:n] + changed)) for n in range(5)]
    d = spark.createDataFrame([*docs, (90, other)], "doc_id int, text string")
    i = spark.createDataFrame([(5, item), (6, other), (7, " ".join(long))], "item_id int, text string")
    rows = leaked_items(d, i, "doc_id", "text", "item_id", "text").where(PARAPHRASED).collect()
    got = {(r.doc_id, r.item_id): r.lcs for r in rows if r.item_id != 6}
    assert got == {**{(n, 5): 20 for n in range(13)}, **{(20 + n, 5): 18 for n in range(3)}, **{(30 + n, 7): 21 for n in range(5)}}


def test_runs_longer_than_a_window_holds_for_sure_are_refused():
    with pytest.raises(ValueError, match="at most 13"):
        leaked_items(None, None, "doc_id", "text", "item_id", "text", gram=14)


def test_runs_and_windows_without_a_ceiling(spark):
    words = [f"w{i}" for i in range(90)]
    d = spark.createDataFrame([(1, " ".join(["x"] * 5 + words[10:85] + ["y"]))], "doc_id int, text string")
    i = spark.createDataFrame([(5, " ".join(words))], "item_id int, text string")
    assert leaked_items(d, i, "doc_id", "text", "item_id", "text").select("run", "lcs").collect() == [(75, 75)]


def test_postings_hold_every_window_that_can_be():
    rng = np.random.default_rng(3)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 60, rng.integers(3, 40))), None) for i in range(20)]
    index = ItemIndex(items, 12)
    weight = rng.random(len(index.vocab)).astype(np.float32) + 0.1
    for loss in (0.0, 0.3):
        post = index.postings(weight, loss)
        for w in range(len(index.owner)):
            row = index.windows(np.array([w]))[0]
            row = row[row < len(weight)]
            assert np.isclose(post.total[w], (weight[row] ** 2).sum(), rtol=1e-4)
            under = [x for x in row if w in post.windows[post.starts[x] : post.starts[x + 1]]]
            left = (weight[[x for x in row if x not in under]] ** 2).sum()
            assert under and np.isclose(post.rest[w], left, atol=1e-4) and left < (1 - loss) * post.total[w]


def planted_paraphrases(rng, replaced, docs=200):
    """Excerpts of 40 words of 60-word items, in ordinary words, some of the words replaced by others of the corpus."""
    common = [f"c{i}" for i in range(400)]
    pick = lambda k: [common[min(399, int(rng.expovariate(1 / 60)))] if rng.random() < 0.6 else f"r{rng.randrange(3000)}" for _ in range(k)]
    items = [(i, " ".join(pick(60))) for i in range(60)]
    rows, want = [], set()
    for d in range(docs):
        i, at = rng.randrange(60), rng.randrange(21)
        part = [x if rng.random() >= replaced else rng.choice(pick(3)) for x in items[i][1].split()[at : at + 40]]
        rows.append((d, " ".join(pick(rng.randint(0, 60)) + part + pick(rng.randint(0, 60)))))
        want.add((d, i))
    return items, rows + [(docs + d, " ".join(pick(120))) for d in range(docs)], want


def test_recall_of_paraphrases(spark):
    rng = random.Random(11)
    for replaced in (0.1, 0.2, 0.3):
        items, rows, want = planted_paraphrases(rng, replaced)
        d, i = spark.createDataFrame(rows, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")
        found = leaked_items(d, i, "doc_id", "text", "item_id", "text").withColumn("p", F.expr(f"run >= least(12, words) OR ({PARAPHRASED})")).where("p").collect()
        got = {(r.doc_id, r.item_id) for r in found}
        print(f"{replaced}: recall {len(got & want) / len(want):.3f}, precision {len(got & want) / len(got):.3f}")
        assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.9 * len(got)
