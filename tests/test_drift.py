import json

from refmine.sources.drift import file_schemas, schema_changes, unified, union_schema, whole_object, written


def lines(spark, files):
    rows = []
    for (feed, seq), objects in files.items():
        for o in objects:
            rows.append((len(rows), feed, seq, o if isinstance(o, str) or o is None else json.dumps(o)))
    return spark.createDataFrame(rows, "line_id int, feed string, file_seq int, raw string")


def test_changes(spark):
    a = [{"edge_uid": i, "corpusid": 100 + i, "year": 2000, "gone": 1, "flag": None} for i in range(5)]
    b = [{"edge_uid": i, "corpusId": str(100 + i), "year": "2000", "note": {"b": 1, "a": [1, 2]}, "flag": True} for i in range(3, 8)]
    c = [{"edge_uid": i, "corpusId": str(100 + i), "year": 2000.0, "remark": {"a": [1, 2], "b": 1}, "flag": True} for i in range(6, 9)]
    bad = ['{"edge_uid": 1', "[1]", '"x"', "null", "", None, '{"other": 1} tail']
    got = {tuple(r) for r in schema_changes(lines(spark, {("f", 1): a + bad, ("f", 4): b + b, ("f", 5): c, ("g", 1): a})).collect()}
    assert got == {
        ("f", 4, "renamed", "corpusid", "corpusId"), ("f", 4, "retyped", "corpusid", "corpusId"), ("f", 4, "retyped", "year", "year"), ("f", 4, "removed", "gone", ""),
        ("f", 4, "added", "", "note"), ("f", 5, "retyped", "year", "year"), ("f", 5, "renamed", "note", "remark"),
    }


def test_no_renaming_without_evidence_or_with_a_conflict(spark):
    a = [{"edge_uid": 1, "x": 5, "y": 1}, {"edge_uid": 2, "x": 6, "y": None}]
    b = [{"edge_uid": 1, "z": 5, "w": None}, {"edge_uid": 2, "z": 7, "w": 3}, {"edge_uid": 2, "z": 6}]
    got = {tuple(r)[2:] for r in schema_changes(lines(spark, {("f", 1): a, ("f", 2): b})).collect()}
    assert got == {("removed", "x", ""), ("removed", "y", ""), ("added", "", "z"), ("added", "", "w")}


def test_types_by_majority(spark):
    df = lines(spark, {("f", 1): [{"v": 1}, {"v": 2}, {"v": 1.0}, {"v": "s"}, {"v": None}, {"n": None}]})
    got = {r.field: (r.lines, r.type) for r in file_schemas(df).collect()}
    assert got == {"v": (5, "integer"), "n": (1, None)}


def test_one_table(spark):
    files = {("f", 1): [{"edge_uid": 1, "corpusid": 7, "contexts": ["a"], "extra": 1}], ("f", 2): [{"edge_uid": 1, "src": 7, "contexts": "b", "extra": 2.5}, {"edge_uid": 2, "src": {"id": 8}, "it's": True, "a\"'b": 4}, {"edge_uid": 3, "src": [9]}]}
    df = lines(spark, files)
    schema = union_schema(df)
    by = {r.column: r for r in schema.collect()}
    assert sorted(by["src"].names) == ["corpusid", "src"] and by["extra"].type == "decimal"
    rows = {(r.file_seq, r.edge_uid): r for r in unified(df, ["feed", "file_seq", "line_id"], schema, {"corpusid": "bigint", "contexts": "array<string>", "edge_uid": "bigint"}).collect()}
    assert [rows[k].corpusid for k in sorted(rows)] == [7, 7, 8, 9]
    assert rows[(2, 1)].contexts == ["b"] and rows[(2, 1)].extra == 2.5 and rows[(2, 2)]["it's"] is True and rows[(2, 2)]["a\"'b"] == 4


def test_the_table_can_be_saved(spark, tmp_path):
    """Fields named like kept columns, names that differ in case only, more fields than a page of columns."""
    wide = {f"c{i}": i for i in range(230)}
    files = {("f", 1): [{"edge_uid": 1, "feed": "own", "corpusid": 7, "rest": "r", **wide}], ("f", 2): [{"edge_uid": 2, "corpusId": 8, "CORPUSID": 9, "Line_ID": 3}]}
    df = lines(spark, files)
    unified(df, ["feed", "line_id"], union_schema(df), {"edge_uid": "bigint"}).write.parquet(str(tmp_path / "t"))
    rows = sorted(spark.read.parquet(str(tmp_path / "t")).collect(), key=lambda r: r.line_id)
    assert len({c.lower() for c in rows[0].asDict()}) == len(rows[0].asDict()) == 2 + 1 + 230 + 3 + 1 + 1
    assert [r.edge_uid for r in rows] == [1, 2] and rows[0].feed == "f" and rows[0].rest == {"feed": "own"} and rows[1].rest == {"Line_ID": "3"}
    assert {r.asDict()[c] for r in rows for c in r.asDict() if c.lower().startswith("corpusid")} == {7, 8, 9, None} and rows[0].rest_2 == "r" and rows[0].c229 == 229


def test_many_fields_multiply_nothing(spark):
    """A hundred gone and new fields, with equal values throughout, against the pairwise comparison."""
    old, new = [f"o{i}" for i in range(40)], [f"n{i}" for i in range(40)]
    a = [{"edge_uid": e, **{f: (e * (i % 7 + 1)) % 3 for i, f in enumerate(old) if (e + i) % 5}} for e in range(12)]
    b = [{"edge_uid": e, **{f: (e * (i % 7 + 1)) % 3 for i, f in enumerate(new) if (e + i) % 4}} for e in range(6, 18)]
    want = set()
    for o in old:
        for n in new:
            both = [(x[o], y[n]) for x in a for y in b if x["edge_uid"] == y["edge_uid"] and o in x and n in y]
            if both and all(p == q for p, q in both):
                want.add((o, n))
    got = schema_changes(lines(spark, {("f", 1): a, ("f", 2): b})).where("change_kind = 'renamed'").collect()
    assert want and {(r.old_field, r.new_field) for r in got} == want


def test_whole_objects():
    for line in ('{"a": 1, "a": 2}', "[1]", "1", '{"a": NaN}', '{"a": 01}', '{"a": 1} x', "", None, '{"a": "\x01"}', "[" * 100_000):
        assert whole_object(line) is None, line
    found = whole_object(' {"n": 1.50, "e": 1e3, "i": 12345678901234567890123, "s": "1", "b": true, "x": {"b": [1, "1", null], "a": 2.0}} ')
    assert [written(v) for v in found.values()] == ["1.50", "1e3", "12345678901234567890123", "1", "true", '{"a":2.0,"b":[1,"1",null]}']


def test_no_value_is_lost(spark):
    values = ["CorpusId:200065346", 7, {"id": "CorpusId:8"}, ["S2CID 9"], "n/a", "2018-05", "CorpusId:99999999999999999999", None, {"x": 1}]
    df = lines(spark, {("f", 1): [{"edge_uid": i, "corpusid": x, "n": "many" if i == 1 else i} for i, x in enumerate(values)]})
    rows = sorted(unified(df, ["line_id"], union_schema(df), {"corpusid": "bigint", "edge_uid": "bigint"}).collect(), key=lambda r: r.line_id)
    assert [r.corpusid for r in rows] == [200065346, 7, 8, 9, None, None, None, None, None]
    assert [r.n for r in rows] == [0, None, 2, 3, 4, 5, 6, 7, 8]
    assert [r.rest for r in rows] == [{}, {"n": "many"}, {}, {}, {"corpusid": "n/a"}, {"corpusid": "2018-05"}, {"corpusid": "CorpusId:99999999999999999999"}, {}, {"corpusid": '{"x":1}'}]


def test_empty(spark):
    df = lines(spark, {("f", 1): [{"a": 1}]}).limit(0)
    assert schema_changes(df).count() == 0
    assert unified(df, ["line_id"], union_schema(df)).count() == 0
