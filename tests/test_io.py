import gzip
import json

import pytest
from pyspark.sql import functions as F

from refmine.__main__ import main
from refmine.sinks.files import clean_columns, rewrite_link_tables, rotate_backup, save_document, save_json, save_tsv, write_tsv
from refmine.sources.documents import PAPERS_DOCUMENT, read_context_files, read_contexts, read_extractions, read_tsv, unreadable
from refmine.sources.jsonl import convert_files, find_input_files, ingest_jsonl, rows_by_file
from refmine.sources.search import PaperSearchSource, fetch_page, paper_by_id, search_local
from refmine.streaming.incremental import ingest_new_files, latest_by_key, windowed_counts


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    data = "".join(json.dumps(x) + "\n" if not isinstance(x, str) else x + "\n" for x in lines)
    path.write_bytes(gzip.compress(data.encode()) if path.suffix == ".gz" else data.encode())


def test_conversion(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    write(src / "a.jsonl", [{"a": 1, "b": "x"}, {"a": 2, "c": True}])
    write(src / "deep" / "a.jsonl.gz", [{"a": 3, "b": "z"}])
    write(src / "bad.ndjson", ['{"a": 1}', '{"a": '])
    write(src / "empty.jsonl", [])
    (src / "note.txt").write_text("no")
    files = find_input_files(spark, str(src))
    assert [f.rsplit("/in/")[1] for f in files] == ["a.jsonl", "bad.ndjson", "deep/a.jsonl.gz", "empty.jsonl"]
    with pytest.raises(FileNotFoundError):
        find_input_files(spark, str(tmp_path / "missing"))
    report = {r.path.rsplit("/in/")[1]: r for r in convert_files(spark, str(src), str(out), "a int, b string")}
    assert {k: (r.ok, r.rows) for k, r in report.items()} == {"a.jsonl": (True, 2), "bad.ndjson": (False, 0), "deep/a.jsonl.gz": (True, 1), "empty.jsonl": (True, 0)}
    assert spark.read.parquet(report["a.jsonl"].output).columns == ["a", "b"] and not (out / "bad.parquet").exists()
    again = {r.message for r in convert_files(spark, str(src), str(out), "a int, b string") if r.rows == 0 and r.ok}
    assert "skipped" in again
    table = ingest_jsonl(spark, str(src / "deep"), str(out / "all"), "a int, b string", cluster_by="a")
    assert table.count() == 1
    assert [(r["name"], r["stem"], r["rows"]) for r in rows_by_file(spark.read.schema("a int").json(str(src / "a.jsonl"))).collect()] == [("a.jsonl", "a", 2)]


def test_incremental(spark, tmp_path):
    src = tmp_path / "in"
    run = lambda: ingest_new_files(spark, str(src), str(tmp_path / "t"), str(tmp_path / "c"), "k int, v string")
    write(src / "1.jsonl", [{"k": 1, "v": "a"}, {"k": 2, "v": "b"}])
    run()
    run()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    write(src / "2.ndjson", [{"k": 1, "v": "c"}, {"k": None, "v": "d"}])
    run()
    t = spark.read.parquet(str(tmp_path / "t"))
    assert t.count() == 4 and t.select("file_path").distinct().count() == 2
    newest = t.withColumn("file_time", F.when(F.col("file_path").endswith("2.ndjson"), F.lit("2")).otherwise(F.lit("1")))
    assert {(r.k, r.v) for r in latest_by_key(newest.drop("file_path"), "k").collect()} == {(1, "c"), (2, "b")}


def test_windows(spark):
    df = spark.createDataFrame([("2024-01-01 10:05:00", "a"), ("2024-01-01 10:55:00", "a"), ("2024-01-01 11:00:00", "a")], "t string, k string").withColumn("t", F.to_timestamp("t"))
    assert sorted(r.n for r in windowed_counts(df, "t", "k").collect()) == [1, 2]


def test_json_and_backups(spark, tmp_path):
    path = str(tmp_path / "x" / "r.json")
    assert save_json({"a": float("nan"), "é": [1, float("inf")]}, path) and json.load(open(path)) == {"a": None, "é": [1, None]}
    assert "é" in open(path, encoding="utf-8").read()
    for _ in range(2):
        save_json([1], path)
    assert (tmp_path / "x" / "r.json.backup").exists() and (tmp_path / "x" / "r.json.backup_1").exists()
    assert rotate_backup(str(tmp_path / "none")) is None
    assert save_json(object(), path) is False
    df = spark.createDataFrame([(1.0, [1.0, float("nan")]), (float("inf"), None)], "v double, a array<double>")
    assert [tuple(r) for r in clean_columns(df).collect()] == [(1.0, [1.0, None]), (None, None)]
    assert save_document(df, path, "rows", {"n": 2}) and json.load(open(path))["rows"][0] == {"v": 1.0, "a": [1.0, None]}


def test_link_tables(spark, tmp_path, capsys):
    path = tmp_path / "d" / "x_merged_analysis_table.tsv"
    path.parent.mkdir()
    text = 'Dataset\tCiting Article\tCitied Article\n"a\tb"\thttps://a.org/1, https://a.org/1\t\n""\tx\ty\n'
    path.write_text(text)
    assert rewrite_link_tables(spark, [str(tmp_path)], dry_run=True) == {str(path): True} and path.read_text() == text
    assert main(["links", "--dirs", str(tmp_path)]) == 0 and "1 of 1" in capsys.readouterr().out
    assert path.read_text().splitlines()[1] == '"a\tb"\thttps://a.org/1\t' and path.with_suffix(".tsv.bak").read_text() == text
    assert [r["Citing Article"] for r in read_tsv(spark, str(path)).collect()] == ["https://a.org/1", "x"]
    save_tsv(read_tsv(spark, str(path)), str(tmp_path / "copy.tsv"))
    write_tsv(read_tsv(spark, str(path)), str(tmp_path / "folder"))
    assert read_tsv(spark, str(tmp_path / "folder")).count() == 2


def test_documents(spark, tmp_path):
    paper = {"papers": [{"corpusid": 1, "citations": [{"cited_corpusid": 11, "contexts": ["We use X.", " ", None]}], "citing_papers": [{"citing_corpusid": 5, "contexts": ["Y"]}]}]}
    (tmp_path / "p.json").write_text(json.dumps(paper, indent=2))
    (tmp_path / "all_contexts.json").write_text(json.dumps({"contexts": [{"context": "  ", "citing_paper_id": 0, "cited_paper_id": 2}, {"context": None}]}))
    (tmp_path / "broken.json").write_text('{"papers": [')
    rows = sorted((r.context, r.citing_paper_id, r.cited_paper_id, r.source) for r in read_context_files(spark, str(tmp_path)).collect())
    assert rows == [("We use X.", 1, 11, "p.json"), ("Y", 5, 1, "p.json")]
    assert [tuple(r)[:3] for r in read_contexts(spark, str(tmp_path / "all_contexts.json")).collect()] == [("  ", None, "2")]
    assert sorted(tuple(r)[:3] for r in read_contexts(spark, str(tmp_path / "p.json"), legacy_roles=True).collect()) == [("We use X.", "1", "11"), ("Y", "1", "5")]
    (tmp_path / "e.json").write_text(json.dumps({"topic": "t", "extractions": [{"context": "c", "datasets": ["A"], "descriptions": {"A": "d"}, "confidence": 0.5}]}))
    assert [(r.ord, r.datasets) for r in read_extractions(spark, str(tmp_path / "e.json")).collect()] == [(0, ["A"])]
    assert main(["rank", "-e", str(tmp_path / "e.json"), "-o", str(tmp_path / "rank.tsv")]) == 0
    assert (tmp_path / "rank.tsv").read_text().splitlines()[1].startswith("1\tA\t1\t")


def test_one_odd_value_costs_no_document(spark, tmp_path):
    papers = [{"corpusid": 1, "citations": [{"cited_corpusid": "11", "contexts": ["A"]}]}, {"corpusid": "3", "citations": [{"cited_corpusid": {"x": 1}, "contexts": ["B"]}, {"cited_corpusid": 4, "contexts": "no list"}]}]
    (tmp_path / "p.json").write_text(json.dumps({"papers": papers}))
    (tmp_path / "broken.json").write_text("{")
    assert sorted((r.context, r.citing_paper_id, r.cited_paper_id) for r in read_context_files(spark, str(tmp_path)).collect()) == [("A", 1, 11), ("B", 3, None)]
    assert {r.file_name for r in unreadable(spark, str(tmp_path / "*.json"), PAPERS_DOCUMENT).collect()} == {"broken.json", "p.json"}


def test_documents_are_streamed(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", i) for i in range(5)] + [(2, None, 9)], "p int, t string, v int").repartition(4).orderBy("p", "v")
    path = tmp_path / "deep" / "d.json"
    rows = df.select("p", "t", F.struct("v").alias("m"))
    assert save_document(rows, f"file://{path}", "x", {"q": ["é", None]}, within="m")
    want = {"q": ["é", None], "x": [{"p": 1, "t": "a", "m": [{"v": i} for i in range(5)]}, {"p": 2, "t": None, "m": [{"v": 9}]}]}
    assert path.read_text() == json.dumps(want, ensure_ascii=False, indent=2)
    assert save_document(df, str(path), "x") and len(json.loads(path.read_text())["x"]) == 6
    assert (tmp_path / "deep" / "d.json.backup").exists() and not list(path.parent.glob("*.new"))
    assert save_document(df.limit(0), str(path), "x", {}, backup=False) and json.loads(path.read_text()) == {"x": []}
    save_tsv(df, str(tmp_path / "d.tsv"))
    assert (tmp_path / "d.tsv").read_text().splitlines()[-1] == "2\t\t9"


def test_layout_of_json(tmp_path):
    value = {"a": [], "b": {}, "c": [1, [2.5, None], {"d": "é\n\"", "e": True}], "": "", "z": {"y": [[]]}}
    assert save_json(value, str(tmp_path / "x.json"))
    assert (tmp_path / "x.json").read_text() == json.dumps(value, ensure_ascii=False, indent=2)


def test_documents_on_another_file_system(spark, tmp_path, monkeypatch):
    from refmine import storage

    monkeypatch.setattr(storage, "local_path", lambda path: None)
    df, path = spark.range(3).coalesce(1), f"file://{tmp_path}/far/d.json"
    for n in range(3):
        assert save_document(df, path, "x", {"n": n})
    assert json.loads((tmp_path / "far" / "d.json").read_text()) == {"n": 2, "x": [{"id": i} for i in range(3)]}
    assert (tmp_path / "far" / "d.json.backup").exists() and (tmp_path / "far" / "d.json.backup_1").exists() and not (tmp_path / "far" / "d.json.new").exists()
    table = tmp_path / "far" / "t.tsv"
    table.write_text("Citing Article\nhttp://x, http://x\n")
    (tmp_path / "far" / ".t.tsv.crc").unlink(missing_ok=True)
    assert rewrite_link_tables(spark, [f"file://{tmp_path}/far"], pattern="*.tsv") and table.read_text().splitlines()[1] == "http://x" and (tmp_path / "far" / "t.tsv.bak").exists()


def test_conversion_by_own_schemas(spark, tmp_path):
    for i in range(5):
        write(tmp_path / "in" / f"{i}.jsonl", [{f"k{i}": i}])
    write(tmp_path / "in" / "bad.jsonl", ["{"])
    report = convert_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), workers=3)
    assert [(r.ok, r.rows) for r in report] == [(True, 1)] * 5 + [(False, 0)]
    assert spark.read.parquet(report[3].output).columns == ["k3"]


def test_local_search(spark):
    df = spark.createDataFrame([(3, "Crop Mapping", None), (1, None, "mapping a crop"), (0, "crop mapping", ""), (None, "crop mapping", "")], "corpusid int, title string, abstract string")
    assert [r.corpusid for r in search_local(df, "crop mapping", limit=5).collect()] == [1, 3]
    assert [r.corpusid for r in search_local(df, "crop", limit=1, offset=1).collect()] == [3]
    assert paper_by_id(df, 3, ["title"]).first()[0] == "Crop Mapping"


def stub(url, params, headers):
    total = 230
    n = max(0, min(params["limit"], total - params["offset"]))
    return 200, {"total": total, "data": [{"corpusId": params["offset"] + i + 1, "title": params["query"]} for i in range(n)]}


class StubSource(PaperSearchSource):
    getter = staticmethod(stub)


def test_rest_source(spark):
    spark.dataSource.register(StubSource)
    read = lambda limit: spark.read.format("paper_search").options(url="stub", query="q", limit=limit, pause=0).load()
    assert sorted(r.corpusid for r in read(150).collect()) == list(range(1, 151))
    assert read(1000).count() == 230


def test_retries():
    calls, naps = [], []

    def busy(url, params, headers):
        calls.append(headers)
        if len(calls) == 1:
            raise OSError
        return (429, {}) if len(calls) < 4 else (200, {"total": 1, "data": [{"corpusId": 1}]})

    assert fetch_page("u", "q", 10, 0, busy, naps.append, api_key="k") == ([{"corpusId": 1}], 1)
    assert naps == [5.0] * 3 and calls[0] == {"x-api-key": "k"}
    naps.clear()
    with pytest.raises(ConnectionError, match="10 attempts"):
        fetch_page("u", "q", 10, 0, lambda *a: (500, {}), naps.append)
    assert len(naps) == 9


def test_fields_of_study_and_settings(spark, monkeypatch):
    from refmine.model.client import ModelSettings
    from refmine.sources.search import KEY_VARIABLE

    df = spark.createDataFrame([(1, "crop", None, ["Biology"]), (2, "crop", None, ["Physics", "Biology"]), (3, "crop", None, None)], "corpusid int, title string, abstract string, fields_of_study array<string>")
    assert {r.corpusid for r in search_local(df, "crop", fields_of_study=["Physics"]).collect()} == {2}
    asked = []
    fetch_page("u", "q", 5, 7, lambda u, p, h: asked.append((p, h)) or (200, {}), fields_of_study=["Biology", "Physics"], api_key="k")
    assert asked[0][0]["fieldsOfStudy"] == "Biology,Physics" and asked[0][0]["offset"] == 7 and asked[0][1] == {"x-api-key": "k"}
    assert ModelSettings().timeout_s == 360.0 and ModelSettings().max_concurrency == 500 and KEY_VARIABLE.isupper()


def test_shared_folder_is_removed(spark):
    from refmine import storage
    from refmine.session import materialize, shared_dir, tidy

    assert materialize(spark.range(3), "x").count() == 3 and storage.exists(spark, shared_dir(spark))
    was = shared_dir(spark)
    tidy(spark)
    assert not storage.exists(spark, was)
    assert materialize(spark.range(3), "x").count() == 3


def test_documents_are_read_in_pieces(spark, tmp_path):
    from refmine.plans.pipeline import merge_contexts

    papers = [{"corpusid": i, "title": 'a"\\\u0001\n    {\n  ]é', "citations": [{"cited_corpusid": 10 * i + j, "contexts": [f"use {j}\n    {{", " "]} for j in range(i % 4)]} for i in range(1, 400)]
    (tmp_path / "p.json").write_text(json.dumps({"query": "q", "papers": papers}, indent=2, ensure_ascii=False))
    papers = [{"corpusid": 5, "citing_papers": [{"citing_corpusid": "7", "contexts": ["seven"]}, {"citing_corpusid": 8, "contexts": "no list"}]}, {"corpusid": {"x": 1}, "citing_papers": [{"citing_corpusid": 9, "contexts": ["nine"]}]}]
    (tmp_path / "q.json").write_text(json.dumps({"papers": papers, "n": {"papers": 1}}, indent=2) + "\n")
    want = [(f"use {j}\n    {{", str(i), str(10 * i + j)) for i in range(1, 400) for j in range(i % 4)]
    tail = [("seven", "7", "5"), ("nine", "9", None)]
    rows = lambda df: [(r.context, r.citing_paper_id, r.cited_paper_id) for r in df.orderBy("ord").collect()]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        one = read_contexts(spark, str(tmp_path / "p.json"))
        assert one.select(F.spark_partition_id()).distinct().count() > 2 and rows(one) == want
        assert rows(read_contexts(spark, str(tmp_path / "q.json"))) == tail
        assert merge_contexts(spark, str(tmp_path), "q")
        merged = read_contexts(spark, str(tmp_path / "all_contexts.json"))
        assert merged.select(F.spark_partition_id()).distinct().count() > 2 and rows(merged) == want + tail
        assert merge_contexts(spark, str(tmp_path), "q") and rows(read_contexts(spark, str(tmp_path / "all_contexts.json"))) == want + tail
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    there = json.loads((tmp_path / "all_contexts.json").read_text())
    assert (tmp_path / "all_contexts.json").read_text() == json.dumps(there, ensure_ascii=False, indent=2)


@pytest.mark.parametrize("text, found", [
    ('{\n  "papers": [\n    {A},\n    {B}\n  ]\n}', "AB"),
    ('{\n  "papers": [\n    {A},\n    {B}\n  ]\n', ""),
    ('{\n  "papers": [\n    {A},\n    {B\n  ]\n}', ""),
    ('{\n  "papers": [\n    {A} {A},\n    {B}\n  ]\n}', ""),
    ('{\n  "papers": [\n    {A}, {C},\n    {B}\n  ]\n}', "ACB"),
    ('{\n  "papers": [\n    {A},\n    null,\n    {B}\n  ], "x": [\n    {C}\n  ]\n}', "AB"),
    ('{\n  "papers": [\n    {A}], "x": [{C},\n    {B}\n  ]\n}', "A"),
    ('{\n  "x": [\n    {A}\n  ],\n  "papers": [\n    {B}\n  ]\n}', "B"),
    ('{\n  "x": {\n  "papers": [\n    {A}\n  ]\n}}', ""),
    ('{\n  "papers": [{A},\n    {B}\n  ]\n}', "AB"),
    ('{\n "papers": [\n  {"corpusid": 1, "citations": [\n    {"cited_corpusid": 2, "contexts": ["A"]},\n    {"cited_corpusid": 2, "contexts": ["B"]}\n  ]}]}', "AB"),
])
def test_layouts_of_documents(spark, tmp_path, text, found):
    for c in "ABC":
        text = text.replace(f"{{{c}", f'{{"corpusid": 1, "citations": [{{"cited_corpusid": 2, "contexts": ["{c}"]}}]')
    (tmp_path / "p.json").write_text(text)
    assert "".join(r.context for r in read_contexts(spark, str(tmp_path / "p.json")).orderBy("ord").collect()) == found
    assert "".join(r.context for r in read_context_files(spark, str(tmp_path)).orderBy("ord").collect()) == found


def test_text_of_documents_made_by_spark(spark, tmp_path):
    odd = "".join(map(chr, range(32))) + '"\\\x7f/é 😀\\u001f'
    rows = [(1, odd, [odd, None], (True, [])), (1, odd, None, (None, [5, None])), (2, None, [], None), (None, "", ["x"], (False, None)), (None, "", ["y"], (False, None))]
    df = spark.createDataFrame(rows, 'a int, `b"` string, c array<string>, d struct<e: boolean, f: array<bigint>>').coalesce(1)
    path = tmp_path / "d.json"
    want = [{"a": a, 'b"': b, "c": c, "d": d and {"e": d[0], "f": d[1]}} for a, b, c, d in rows]
    assert save_document(df, str(path), "x", {}) and path.read_text() == json.dumps({"x": want}, ensure_ascii=False, indent=2)
    for parts in (1, 5):
        near = df.select("a", 'b"', F.struct("c", "d").alias("m")).repartitionByRange(parts, F.col("a").desc_nulls_last()) if parts > 1 else df.select("a", 'b"', F.struct("c", "d").alias("m"))
        assert save_document(near, str(path), "x", {}, within="m")
        got = json.loads(path.read_text())
        assert path.read_text() == json.dumps(got, ensure_ascii=False, indent=2)
        assert sorted(map(str, got["x"])) == sorted(map(str, [{"a": a, 'b"': b, "m": [{"c": w["c"], "d": w["d"]} for w in want if (w["a"], w['b"']) == (a, b)]} for a, b in ((1, odd), (2, None), (None, ""))]))
