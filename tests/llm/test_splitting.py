import os
import random
import re

import pytest

from refmine.llm.splitting import natural_ends, split_oversized, split_text
from refmine.llm.tokenizer import PairMerger, encode_slices, load_merger, vocabulary_path

PATH = vocabulary_path()
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files here")


def tokens(text):
    return sum(len(i) for i in next(encode_slices([text], load_merger(PATH)))[1]) if text else 0


def samples():
    rng = random.Random(5)
    sentence = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randint(4, 20))).capitalize() + ". "
    return [
        "", "short", "".join(sentence() for _ in range(60)), "\n\n".join("".join(sentence() for _ in range(5)) for _ in range(20)), "\n".join(sentence() for _ in range(50)),
        " a" * 900, "中" * 1500, "x" * 3000, "".join(rng.choices("abcdef😀ü", k=2500)), "\n" * 2000, "कि" * 400, "w " * 300 + "z" * 900 + " w" * 300,
        "".join(chr(rng.randint(0x10000, 0x1FFFF)) for _ in range(400)), "a. " * 700, "\r\n".join(["b" * 300] * 9), "'" * 2000,
    ]


@pytest.mark.parametrize("limit,overlap", [(128, 16), (200, 0), (100, 24)])
def test_pieces(limit, overlap):
    merger = load_merger(PATH)
    for text in samples():
        pieces = split_text(text, merger, limit, overlap)
        total = tokens(text)
        assert (len(pieces) > 1) == (total > limit)
        if not text:
            assert pieces == []
            continue
        assert "".join(text[p["start"] + p["overlap"] : p["stop"]] for p in pieces) == text
        assert [p["piece"] for p in pieces] == list(range(1, len(pieces) + 1))
        for p in pieces:
            assert p["tokens"] == tokens(text[p["start"] : p["stop"]]) <= limit
            assert p["overlap"] >= 0


def test_natural_boundaries_come_first():
    merger = load_merger(PATH)
    text = "\n\n".join(["One two three four five six seven eight nine ten."] * 40)
    cuts = [p["cut"] for p in split_text(text, merger, 128, 16)]
    assert set(cuts[:-1]) == {"paragraph"} and cuts[-1] == "end"
    text = " ".join(["One two three four five six seven eight nine ten."] * 40)
    assert {p["cut"] for p in split_text(text, merger, 128, 16)[:-1]} == {"sentence"}


def test_natural_ends_against_patterns():
    paragraph = re.compile("(?>\\r\\n|[\\n\\r\u2028])[^\\S\\n\\r\u2028]*(?>\\r\\n|[\\n\\r\u2028])\\s*|\u2029\\s*")
    line = re.compile("[\\n\\r\u2028\x85]\\s*")
    sentence = re.compile("[.!?…]++[\"'”’»)\\]]*+(?=\\s)|[。！？]++[」』”’）)]*+")
    rng = random.Random(9)
    texts = [*samples(), *("".join(rng.choices("ab. \n\r\t\u2028\u2029\x85!?…\"')]。！」”😀\u3000", k=rng.randint(1, 60))) for _ in range(3000))]
    for text in filter(None, texts):
        found = natural_ends(text)
        for pattern, ends in zip((paragraph, line, sentence), found):
            assert sorted(set(ends.tolist())) == sorted({m.end() for m in pattern.finditer(text)}), (pattern, text)
        assert found[3].tolist() == [c.isspace() for c in text]


def test_overlap_is_about_as_wanted():
    merger = load_merger(PATH)
    text = " ".join(["One two three four five six seven eight nine ten."] * 200)
    for p in split_text(text, merger, 256, 64)[1:]:
        assert 48 <= tokens(text[p["start"] : p["start"] + p["overlap"]]) <= 80


def test_cost_is_least_against_all_ways():
    import itertools

    import numpy as np

    from refmine.llm.splitting import _best_cuts

    rng = np.random.default_rng(6)
    for _ in range(60):
        t = np.concatenate([[0], np.cumsum(rng.integers(5, 40, 9))])
        s = np.maximum.accumulate(np.maximum(0, t - rng.integers(0, 5, len(t))))
        penalty = rng.random(len(t))
        penalty[-1] = 0
        limit, target, least = 90, 60.0, 10

        def cost(path):
            total = 0.0
            for a, b in zip((0, *path), path):
                if t[b] - s[a] > limit or t[b] - t[a] < least:
                    return np.inf
                total += ((t[b] - s[a] - target) / limit) ** 2 + penalty[b]
            return total

        n = len(t) - 1
        ways = [(*c, n) for k in range(n) for c in itertools.combinations(range(1, n), k)]
        best = min(cost(w) for w in ways)
        found = _best_cuts(t, s, penalty, limit, target, least)
        assert (found is None and best == np.inf) or abs(cost(found) - best) < 1e-9


def test_text_without_places_for_a_cut_keeps_its_boundaries_elsewhere():
    """Tokens that begin and end within characters: only such a stretch is measured in bytes."""
    ranks = {bytes([i]): i for i in range(256)} | {b"\xa9\xc3": 256}
    body = "é" * 900
    text = "One two. " * 40 + body + " One two." * 40 + "\n\n" + body + "x"
    pieces = split_text(text, PairMerger(ranks), 200, 20)
    assert "".join(text[p["start"] + p["overlap"] : p["stop"]] for p in pieces) == text
    for p in pieces:
        own = sum(len(i) for i in next(encode_slices([text[p["start"] : p["stop"]]], PairMerger(ranks)))[1])
        assert p["tokens"] == own <= 200 and p["overlap"] >= 0
    assert {p["cut"] for p in pieces if p["stop"] <= 350} == {"sentence"} and "inside" in {p["cut"] for p in pieces}


def test_a_cut_that_makes_a_piece_too_long_is_taken_out(monkeypatch):
    import refmine.llm.splitting as m

    merger, text = load_merger(PATH), "\n\n".join(["One two three four five six seven eight nine ten."] * 40)
    plain, made = split_text(text, merger, 128, 16), []

    def heavy(*a):
        out = pieces(*a)
        if not made:
            made.append(out[1]["stop"])
            out[1]["tokens"] = 129
        return out

    pieces = m._pieces
    monkeypatch.setattr(m, "_pieces", heavy)
    again = split_text(text, merger, 128, 16)
    assert made[0] in {p["stop"] for p in plain} and made[0] not in {p["stop"] for p in again}
    assert {p["cut"] for p in again[:-1]} == {"paragraph"} and all(p["tokens"] <= 128 for p in again)


def test_operator(spark):
    rows = [(i, t, 1) for i, t in enumerate([None, *samples()])]
    df = spark.createDataFrame(rows + rows[:5], "doc_id int, text string, piece int")
    out = split_oversized(df, "doc_id", "text", PATH, 128, 16).collect()
    assert {r.doc_id for r in out} == {i for i, t, _ in rows if t and tokens(t) > 128}
    assert all(r.text == rows[r.doc_id][1][r.start : r.stop] for r in out)
    whole = split_oversized(df, "doc_id", "text", PATH, 128, 16, keep_small=True).collect()
    assert {r.doc_id for r in whole} == {i for i, t, _ in rows if t}
    assert split_oversized(df.limit(0), "doc_id", "text", PATH).count() == 0
