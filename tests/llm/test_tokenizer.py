import base64
import os
import random

import pytest

from refmine.llm.tokenizer import decode, encode_batch, encode_corpus, encode_slices, load_merger, merge_pairs, vocabulary_path

PATH = vocabulary_path()
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files here")
TEXTS = [
    None, "", " ", "\n\n", "a", "don't we'll I've they're 's ' ''s", "x  y\t\tz \n a", "naïve café ½ Ⅷ ²", "中文。字", "<|endoftext|>", "a\x00b", "😀👍🏽", "İstanbul", "  \x85\xa0",
    "'" * 50, " " * 3000 + "x", "word " * 5000, "ab" * 20000,
]


def ids_of(texts):
    flat, offsets = encode_batch(texts, load_merger(PATH))
    return [flat[offsets[i] : offsets[i + 1]].tolist() for i in range(len(texts))]


def reference():
    tiktoken = pytest.importorskip("tiktoken")
    P = pytest.importorskip("public_tokenizers")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equal_to_the_public_library():
    own = reference()
    rng = random.Random(4)
    parts = ["'", "'s", "'ll", "'v", "'ve", "'r", "'re", " ", "  ", "\n", "\t", "\xa0", "a", "Ab", "é", "é", "中", "。", "!", "''", "\x1c", "\x85", "😀", "l", "ll", "e", "7", "٣"]
    texts = TEXTS + ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(4000)]
    assert ids_of(texts) == [own.encode_ordinary(t or "") for t in texts]


def test_round_trip_and_slices():
    for text, ids in zip(TEXTS, ids_of(TEXTS)):
        assert decode(ids, PATH) == (text or "")
    for text, (starts, ids) in zip(TEXTS[1:], encode_slices(TEXTS[1:], load_merger(PATH))):
        ends = [*starts[1:], len(text)]
        assert [decode(list(i), PATH) for i in ids] == [text[a:b] for a, b in zip(starts, ends)] or "�" in text


def test_batches_do_not_matter():
    alone = [ids_of([t])[0] for t in TEXTS]
    assert ids_of(TEXTS) == alone


def test_long_texts_go_in_parts(monkeypatch):
    from refmine.llm import tokenizer

    rng = random.Random(6)
    texts = ["".join(rng.choices(["a", "b ", " c", "  ", "\n", "'s", "d'll", "é", " 1"], k=400)) for _ in range(30)] + ["x" * 500, " " * 500, "a " * 300]
    want = [next(encode_slices([t], load_merger(PATH))) for t in texts]
    monkeypatch.setattr(tokenizer, "_CHUNK_CHARS", 40)
    assert [next(encode_slices([t], load_merger(PATH))) for t in texts] == want
    assert all("".join(tokenizer.safe_parts(t, 40)) == t for t in texts)


def test_merging_takes_the_lowest_rank_leftmost():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"aaaa": 257, b"ab": 258}
    assert merge_pairs(b"aaaaa", ranks) == [257, 97]
    assert merge_pairs(b"aab", ranks) == [256, 98]
    assert merge_pairs(b"", ranks) == []


def test_operator(spark):
    rows = [(i, t, "keep") for i, t in enumerate(TEXTS[:10])] * 2
    df = spark.createDataFrame(rows, "doc_id int, text string, ids string")
    out = encode_corpus(df, "text", PATH).select("doc_id", "ids").collect()
    want = ids_of(TEXTS[:10])
    assert len(out) == 20 and all(r.ids == want[r.doc_id] for r in out)
    both = encode_corpus(df.drop("ids"), "text", PATH, slices="s").collect()
    assert all(sum(x.tokens for x in r.s) == len(r.ids) and r.ids == want[r.doc_id] for r in both)
    assert encode_corpus(df.limit(0), "text", PATH).count() == 0
