import json
import random

from pyspark.sql import functions as F

from refmine.__main__ import main
from refmine.model.client import RuleClient
from refmine.operators import consolidate as C, contexts as N, graph as G
from refmine.plans.pipeline import ContextQuery, Store, analyze, export_audit, export_contexts, extract, extract_file, merge_contexts
from refmine.plans.rules import extraction_rule, relevance_rule


def toy_extractions(spark):
    rows = [(1, ["CIFAR-10", "ImageNet "], 0.9, "1", "11", {"CIFAR-10": "d", "ImageNet ": "e"}), (2, ["cifar10"], 0.7, "2", "11", None), (3, ["imagenet"], 0.8, "1", "12", {}), (4, ["CIFAR-10", "  ", None], None, "3", None, None), (5, None, 1.0, "9", "9", None)]
    return spark.createDataFrame(rows, "extraction_id int, extracted_datasets array<string>, confidence_score double, citing_paper_id string, cited_paper_id string, dataset_descriptions map<string,string>").repartition(3)


def test_consolidation(spark, tmp_path):
    out = analyze(toy_extractions(spark), output=str(tmp_path / "r.tsv"))
    rows = [tuple(r) for r in out.orderBy("Rank").collect()]
    assert rows == [(1, "CIFAR-10", 3, 3, 1, 0.7, "CIFAR-10, cifar10"), (2, "ImageNet", 2, 1, 2, 0.85, "ImageNet, imagenet")]
    assert (tmp_path / "r.tsv").read_text().splitlines()[1] == "1\tCIFAR-10\t3\t3\t1\t0.7\tCIFAR-10, cifar10"
    said = {r.name: r.description for r in C.mentions_of(toy_extractions(spark)).collect()}
    assert said["ImageNet"] == "e" and said["cifar10"] == ""
    summaries = spark.createDataFrame([("ImageNet", "pictures")], "name string, description string")
    ranked = C.rank_table(C.consolidate(C.mentions_of(toy_extractions(spark))), summaries)
    assert {r.Dataset: r.Description for r in ranked.collect()} == {"CIFAR-10": None, "ImageNet": "pictures"}
    grouped = {r.normalized_name: [m.name for m in r.mentions] for r in C.collect_mentions(C.mentions_of(toy_extractions(spark))).collect()}
    assert grouped == {"cifar10": ["CIFAR-10", "cifar10", "CIFAR-10"], "imagenet": ["ImageNet", "imagenet"]}
    assert analyze(toy_extractions(spark).limit(0)).count() == 0


def test_ranks_are_a_permutation_whatever_the_partitions(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(5), i) for i in range(500)]
    want = {i: n + 1 for n, (_, i) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}
    for parts in (1, 8):
        df = spark.createDataFrame(rows, "n int, o int").repartition(parts)
        assert {r.o: r["rank"] for r in C.with_ranks(df, [F.desc("n"), F.asc("o")]).collect()} == want


def test_exact_rounding():
    import pyarrow as pa

    assert C.exact_round2(pa.array([2.675, 0.125, 1.005, 0.285, None])).to_pylist() == [2.67, 0.12, 1.0, 0.28, None]


EDGES = [(1, 11), (1, 12), (2, 1), (11, 21), (12, 11)]


def test_graph_walk(spark):
    edges = spark.createDataFrame(EDGES, "citingcorpusid bigint, citedcorpusid bigint")
    seeds = spark.createDataFrame([(1,), (2,), (0,), (None,), (1,)], "corpusid bigint")
    ids = G.seed_ids(seeds)
    pairs = lambda df: sorted(tuple(r) for r in df.select("citingcorpusid", "citedcorpusid").collect())
    assert pairs(G.hop(edges, ids, "citing")) == [(1, 11), (1, 12), (2, 1)]
    assert sorted(r[0] for r in G.frontier(G.hop(edges, ids, "citing"), "citing", ids).collect()) == [11, 12]
    assert pairs(G.second_hop(edges, ids, "citing")) == [(11, 21), (12, 11)]
    assert pairs(G.hop(edges, ids, "cited")) == [(2, 1)]
    assert [r[0] for r in G.frontier(G.hop(edges, ids, "cited"), "cited").collect()] == [2]
    assert pairs(G.second_hop(edges, ids, "cited")) == []
    assert tuple(G.hop_stats(G.hop(edges, ids, "citing"), "citing").first()) == (2, 3)


def test_flattening(spark):
    kind = "row_id int, corpusid bigint, cited_corpusid bigint, citations array<struct<cited_corpusid:bigint,contexts:array<string>>>, citing_papers array<struct<citing_corpusid:bigint,contexts:array<string>>>"
    rows = [(1, 1, None, [(11, ["We use X.", "  ", None])], None), (2, 1, None, None, [(5, ["Y"])]), (3, 0, 7, [(0, ["Z"]), None, (1, None)], []), (4, None, None, None, None)]
    df = spark.createDataFrame(rows, kind)
    get = lambda d: sorted((r.context, r.citing_paper_id, r.cited_paper_id) for r in d.collect())
    assert get(N.from_papers(df, "row_id")) == [("We use X.", 1, 11), ("Y", 5, 1), ("Z", 7, None)]
    assert get(N.from_papers(df, "row_id", legacy_roles=True)) == [("We use X.", 1, 11), ("Y", 1, 5), ("Z", 7, None)]
    merged = spark.createDataFrame([("  ", 0, 3), ("", 1, 2), (None, 1, 2), ("a", None, 4)], "context string, citing_paper_id bigint, cited_paper_id bigint")
    assert [tuple(r) for r in N.from_merged(merged).collect()] == [("  ", None, "3"), ("a", None, "4")]


def test_citation_counts(spark):
    kind = "row_id int, corpusid bigint, cited_corpusid bigint, citations array<int>, citing_papers array<int>"
    df = spark.createDataFrame([(1, 1, None, [1, 2], None), (2, 1, None, None, [3]), (3, 0, None, [1, 2, 3], None)], kind)
    assert [tuple(r) for r in C.citation_counts(df).collect()] == [(1, 1)]


def test_store_and_query(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert not store.ready()
    papers = tmp_path / "in"
    papers.mkdir()
    (papers / "a.jsonl").write_text('{"corpusid":1,"title":"crop maps","abstract":null}\n{"corpusid":11,"title":"crop yields"}\n{"corpusid":0,"title":"crop zero"}\n')
    store.build_papers(str(papers))
    edges = spark.createDataFrame([(a, b, "c") for a, b in EDGES], "citingcorpusid bigint, citedcorpusid bigint, context string")
    store.build_citations(edges)
    assert store.ready() and store.papers.count() == 3 and store.info()["citations"].first()["rows"] == 5
    (papers / "b.jsonl").write_text('{"corpusid":1,"title":"crop maps, new"}\n')
    assert {r.corpusid for r in store.update_papers(str(papers)).collect()} == {0, 1, 11}
    assert store.update_papers(str(papers)).count() == 3
    q = ContextQuery("crop", None, "both", second=True, relevance=lambda: RuleClient(relevance_rule("crop")))
    got = sorted((r.direction, r.level, r.citingcorpusid, r.citedcorpusid) for r in q.run(store.papers, store.edges).collect())
    assert got == [("cited", 1, 1, 11), ("cited", 1, 2, 1), ("cited", 1, 12, 11), ("cited", 2, 2, 1), ("citing", 1, 1, 11), ("citing", 1, 1, 12), ("citing", 1, 11, 21)]
    assert tuple(q.stats["cited_1"].first()) == (2, 3)
    assert q.file_name(spark) == "crop_combined_contexts.json"
    contexts = spark.createDataFrame([(1, "Pozi QA is used"), (2, "none")], "id int, context string")
    assert extract(contexts, lambda: RuleClient(extraction_rule), str(tmp_path / "ex")).count() == 1


def test_exports_feed_the_next_stage(spark, tmp_path):
    edges = spark.createDataFrame([(1, 11, "We use Pozi QA."), (1, 12, "none"), (2, 11, None)], "citingcorpusid bigint, citedcorpusid bigint, context string")
    papers = spark.createDataFrame([(1, "one"), (11, "eleven")], "corpusid bigint, title string")
    path = tmp_path / "x_citing_contexts.json"
    assert export_contexts(edges, papers, "citing", str(path), "t")
    doc = json.loads(path.read_text())
    assert {p["corpusid"]: (p["title"], len(p["citations"])) for p in doc["papers"]} == {1: ("one", 2), 2: (None, 1)}
    export_audit(edges, papers, str(tmp_path / "audit"))
    assert spark.read.csv(str(tmp_path / "audit"), header=True).where("cited_title = 'eleven'").count() == 2
    # The documents that the merge reads hold lists of contexts.
    path.write_text(json.dumps({"papers": [{"corpusid": 1, "citations": [{"cited_corpusid": 11, "contexts": ["We use Pozi QA.", " "]}]}]}))
    assert merge_contexts(spark, str(tmp_path), "t") and merge_contexts(spark, str(tmp_path), "t")
    merged = json.loads((tmp_path / "all_contexts.json").read_text())
    assert merged["total_contexts"] == 1 and merged["contexts"][0]["source"] == path.name
    out = tmp_path / "extractions.json"
    assert extract_file(spark, str(tmp_path / "all_contexts.json"), str(out), lambda: RuleClient(extraction_rule), "t")
    found = json.loads(out.read_text())
    assert found["contexts_with_datasets"] == 1 and found["extractions"][0]["datasets"] == ["Pozi QA"]


def test_an_update_keeps_what_is_built(spark, tmp_path):
    def put(name, *rows):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(json.dumps(r) + "\n" for r in rows))

    put("one/a.jsonl", *[{"corpusid": i, "title": f"t{i}"} for i in (1, 2, 3)])
    put("two/b.jsonl", {"corpusid": 3, "title": "new"}, {"corpusid": 4, "title": "t4"}, "cut off")
    titles = lambda df: {r.corpusid: r.title for r in df.collect()}
    with Store(spark, str(tmp_path / "store")) as store:
        assert titles(store.build_papers(str(tmp_path / "one"))) == {1: "t1", 2: "t2", 3: "t3"}
        assert titles(store.update_papers(str(tmp_path / "two"))) == {1: "t1", 2: "t2", 3: "new", 4: "t4"}
        version = store._current("papers")
        assert titles(store.update_papers(str(tmp_path / "one"))) == {1: "t1", 2: "t2", 3: "new", 4: "t4"} and store._current("papers") == version
        put("one/c.jsonl", {"corpusid": 1, "title": "t1, later"})
        assert titles(store.update_papers(str(tmp_path / "one"))) == {1: "t1, later", 2: "t2", 3: "new", 4: "t4"}
        assert len(store._versions("papers")) == 2 and titles(store.build_papers(str(tmp_path / "one"), force=True)).keys() == {1, 2, 3}
    again = Store(spark, str(tmp_path / "store"))
    assert again.papers.count() == 3 and not again.ready()
    put("empty/readme.txt")
    for folder in ("empty", "nowhere"):
        try:
            again.check_files(str(tmp_path / folder))
        except FileNotFoundError:
            continue
        raise AssertionError(folder)


def test_the_stages_one_after_the_other_through_files(spark, tmp_path, capsys):
    data, cache, out = tmp_path / "data", str(tmp_path / "cache"), tmp_path / "out"
    for name, rows in {
        "papers/p.jsonl": [{"corpusid": 1, "title": "crop maps", "abstract": "a"}, {"corpusid": 2, "title": "other"}, {"corpusid": 11, "title": "crop yields"}, {"corpusid": 12, "title": "twelve"}],
        "citations/c.jsonl": [{"citingcorpusid": 1, "citedcorpusid": 11, "contexts": ["We use Pozi QA.", " "]}, {"citingcorpusid": 1, "citedcorpusid": 12, "contexts": ["Pozi QA and Rezu Bench"]}, {"citingcorpusid": 2, "citedcorpusid": 1, "contexts": ["none"]}, {"citingcorpusid": 12, "citedcorpusid": 2, "contexts": None}],
        "new/n.jsonl": [{"corpusid": 2, "title": "crop, added"}],
    }.items():
        (data / name).parent.mkdir(parents=True, exist_ok=True)
        (data / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    said = lambda user: relevance_rule("crop")(user) if user.startswith("Topic: crop\nTitle") else extraction_rule(user)
    run = lambda *a: main([str(x) for x in a], client=lambda: RuleClient(said))
    assert run("build", "--data-dir", data) == 1
    assert run("query", "-q", "crop", "--cache-dir", cache) == 1
    assert run("build", "--all", "--data-dir", data, "--cache-dir", cache) == 0
    assert run("build", "--papers", "-i", "--from-jsonl", data / "new", "--cache-dir", cache) == 0
    assert run("query", "-q", "crop", "-l", 10, "--context-type", "both", "--second", "--llm-prefilter", "--merge", "-o", out, "--cache-dir", cache) == 0
    names = {p.name for p in out.glob("*")}
    assert {"crop_combined_contexts_10_citing.json", "crop_combined_contexts_10_cited_by.json", "crop_combined_contexts_10_citing_audit.csv", "all_contexts.json"} <= names
    citing = json.loads((out / "crop_combined_contexts_10_citing.json").read_text())
    assert {p["corpusid"]: [(c["cited_corpusid"], len(c["contexts"])) for c in p["citations"]] for p in citing["papers"]} == {1: [(11, 2), (12, 1)], 2: [(1, 1)]}
    assert run("query", "-q", "crop", "-o", out, "--no-backup", "--cache-dir", cache) == 0 and (out / "crop_citing_contexts_100.json").exists()
    assert run("extract", "-i", out / "all_contexts.json", "-o", out / "found.json", "-t", "crop") == 0
    assert run("extract", "-i", out / "crop_citing_contexts_100.json", "-o", out / "found2.json", "--no-filter") == 0
    found = json.loads((out / "found.json").read_text())
    assert found["topic"] == "crop" and {d for x in found["extractions"] for d in x["datasets"]} == {"Pozi QA", "Rezu Bench"}
    table = out / "x_merged_analysis_table.tsv"
    assert run("rank", "-e", out / "found.json", "-c", out / "crop_combined_contexts_10_citing.json", "-o", table, "--validation", "basic", "--citation-counts", out / "counts.tsv") == 0
    lines = table.read_text().splitlines()
    assert lines[0].split("\t")[:3] == ["Rank", "Dataset", "Mentions"] and lines[1].split("\t")[1] == "Pozi QA"
    assert (out / "counts.tsv").read_text().splitlines() == ["corpusid\tcitations", "1\t2", "2\t1"]
    assert run("rank", "-e", out / "missing.json", "-o", table) == 1
    table.write_text("Citing Article\tDataset\nhttp://x, http://x .,\td\n")
    assert run("links", "--dirs", out) == 0 and table.read_text().splitlines()[1] == "http://x\td"
    capsys.readouterr()


def test_exports_of_the_package():
    import refmine

    assert "Store" in dir(refmine) and refmine.Store is Store and all(getattr(refmine, n) is not None for n in refmine.__all__)
    try:
        refmine.nothing
    except AttributeError:
        return
    raise AssertionError


def test_mentions_in_bounded_lists(spark):
    rows = [(i, ["Hot", "x"] if i % 3 else ["HOT!"], 0.5, "1", "2", None) for i in range(100)]
    df = spark.createDataFrame(rows, "extraction_id int, extracted_datasets array<string>, confidence_score double, citing_paper_id string, cited_paper_id string, dataset_descriptions map<string,string>").repartition(3)
    lists = C.collect_mentions(C.mentions_of(df), 30).collect()
    sizes = {(r.normalized_name, r.part): len(r.mentions) for r in lists}
    assert sizes == {("hot", 0): 30, ("hot", 1): 30, ("hot", 2): 30, ("hot", 3): 10, ("x", 0): 30, ("x", 1): 30, ("x", 2): 6}
    hot = [m.name for r in sorted(lists, key=lambda r: r.part) if r.normalized_name == "hot" for m in r.mentions]
    assert hot == ["Hot" if i % 3 else "HOT!" for i in range(100)]
