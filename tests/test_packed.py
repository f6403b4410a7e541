import pytest
from hypothesis import given, strategies as st

from refmine.operators.packed import infer_delimiters, scan_cells, score_cell, split_cell, split_packed

CASES = [
    ('"Kegobivo, QA";Kegobivo QA;KGB-FFM', ["Kegobivo, QA", "Kegobivo QA", "KGB-FFM"]),
    (r'["the \"Misomoti\" release", "Misomoti, Bench v3"]', ['the "Misomoti" release', "Misomoti, Bench v3"]),
    ("'A, B', Gemama's Corpus, 'A; B'", ["A, B", "Gemama's Corpus", "A; B"]),
    (r'  "Tree, Survey",Tree Survey (PGZ),Tree Survey\; PGZ ', ["Tree, Survey", "Tree Survey (PGZ)", "Tree Survey; PGZ"]),
    ("forozidi v3 /  / FOROZIDI", ["forozidi v3", "FOROZIDI"]),
    ('"the ""Defo"" release"; "10.99784/419059 (+5)"', ['the "Defo" release', "10.99784/419059 (+5)"]),
    ('"https://a.b/c;d" (+3), x', ["https://a.b/c;d (+3)", "x"]),
    ("nan", []), (" NaN ", []), ("", []), (" \t\n", []), (None, []), ("[]", []), ('""', []),
    ('the "Fime" release', ['the "Fime" release']),
    ('"Foo" bar, "baz"', ['"Foo" bar', "baz"]),
    (";a;;b;", ["a", "b"]), ("a\tb\t\tc", ["a", "b", "c"]), ("a、b；c", ["a", "b", "c"]), ("x<br>\"A, B\"<BR/>c", ["x", "A, B", "c"]),
    ("https://p.invalid/1 / 10.99/x", ["https://p.invalid/1", "10.99/x"]),
    ('"a', ['"a']), ('a"', ['a"']), ("a\\", ["a\\"]), ("a, b; c | d", ["a", "b", "c", "d"]),
]


@pytest.mark.parametrize("cell,want", CASES)
def test_cells(cell, want):
    assert split_cell(cell) == want


@given(st.lists(st.text(alphabet="abAB12 .-()'", min_size=1, max_size=12).map(str.strip).filter(lambda v: v and v[0] not in "'[" and v[-1] != "]" and v.lower() != "nan"), min_size=1, max_size=6), st.sampled_from([",", ";", "|", "\t", "、"]))
def test_round_trip(values, delimiter):
    quoted = ['"' + v.replace('"', '""') + '"' for v in values]
    assert split_cell(delimiter.join(quoted)) == values
    assert split_cell((" " + delimiter + " ").join(values)) == values


def test_long_cells_take_linear_time():
    assert len(split_cell(",".join(["abc"] * 200_000))) == 200_000
    for hard in ("'" * 20_000, '"' + "a'b" * 50_000, "\\" * 50_000, '"' + "\\" * 50_000, "[" * 1000):
        split_cell(hard)


def test_scores_tell_fragments():
    whole = score_cell("https://a.org/x, https://b.org/y")
    assert whole == [{"delimiter": ",", "pieces": 2, "regular": 2, "times": 1}]
    assert score_cell("one value") == []


@given(st.text(alphabet="ab \"'[],;|\\\t()+1/", max_size=30))
def test_candidates_that_a_cell_lacks_change_nothing(cell):
    found = {d["delimiter"] for d in score_cell(cell)}
    assert split_cell(cell, found) == split_cell(cell) == split_cell(cell, found | {"、"})


def test_split_packed(spark):
    rows = [(1, "A; B", None, "f1", 0), (2, None, " ", "f1", 0), (3, "nan", "https://x.org/1|https://x.org/2|https://x.org/2", None, 0), (3, "nan", "10.9999/a", None, 0)]
    df = spark.createDataFrame(rows, "id int, v string, c string, src string, pos int")
    got = sorted(tuple(r) for r in split_packed(df, "id", ["v", "c"], "src").collect())
    assert got == [(1, "v", 1, "A"), (1, "v", 2, "B"), (3, "c", 1, "10.9999/a"), (3, "c", 1, "https://x.org/1"), (3, "c", 2, "https://x.org/2"), (3, "c", 3, "https://x.org/2")]
    assert split_packed(df.limit(0), "id", ["v", "c"], "src").count() == 0


def test_a_source_can_reject_a_delimiter(spark):
    # In one source semicolons only cut values into fragments without letters.
    rows = [("s", "f", f"name{i};{i};0") for i in range(40)] + [("t", "f", "name a;name b")] * 40
    got = {(r[0]): r[2] for r in infer_delimiters(scan_cells(spark.createDataFrame(rows, "_source string, _field string, _cell string"))).collect()}
    assert got == {"t": [";"]}


def test_alike_counts_make_up_for_some_odd_pieces(spark):
    even = ["name a;0"] * 85 + ["0;0"] * 15
    uneven = [";".join(["name a", "0"] * (1 << i % 7)) for i in range(85)] + ["0;0"] * 15
    rows = [("even", "f", c) for c in even] + [("uneven", "f", c) for c in uneven]
    got = {r[0]: r[2] for r in infer_delimiters(scan_cells(spark.createDataFrame(rows, "_source string, _field string, _cell string"))).collect()}
    assert got == {"even": [";"]}


def test_one_long_cell_rejects_nothing(spark):
    for odd in (20, 300, 700):
        long = "; ".join(["0"] * odd + [f"name {i}" for i in range(1000 - odd)])
        rows = [("s", "f", "a; b")] * 100 + [("s", "f", long)]
        got = infer_delimiters(scan_cells(spark.createDataFrame(rows, "_source string, _field string, _cell string"))).collect()
        assert [r[2] for r in got] == [[";"]], odd


def test_brackets_around_a_whole_list_only():
    assert split_cell("[A], [B]", [","]) == ["[A]", "[B]"]
    assert split_cell("[1] Foo, Bar [2]", [","]) == ["[1] Foo", "Bar [2]"]
    assert split_cell("[[A], [B]]", [","]) == ["[A]", "[B]"]
    assert split_cell('["a]", "b["]', [","]) == ["a]", "b["]
    assert split_cell("[A; B \\] C]", [";"]) == ["A", "B ] C"] and split_cell("[]", [","]) == []
