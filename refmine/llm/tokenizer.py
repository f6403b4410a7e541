"""Byte-level BPE encoding of a corpus, without regular expressions.

Text becomes an array of code points, each code point a class, and each class a transition
function of a small automaton. Functions compose associatively, and the few that occur
(the automaton's transition monoid) are numbered, so that a prefix scan over a batch of
documents is table look-ups on whole columns. The states tell where a token may begin;
the slices between go through a cache of merged byte pairs. Slice offsets are kept, so any
run of ids can be tied back to its text.
"""

from __future__ import annotations

import base64
import heapq
import math
import unicodedata
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from refmine.session import ship, ship_file, shipped_file

#: Where the public vocabularies lie unless a caller says otherwise.
TOKENIZER_DIR = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.tiktoken"

# Code point classes.
_L, _N, _SP, _W, _O, _AP, _SDMT, _LL, _V, _R, _E, _SEP = range(12)
# Symbols of the automaton: a class with one code point of look-ahead.
_SYM_L, _SYM_ONE, _SYM_TWO, _SYM_N, _SYM_RUN, _SYM_SP, _SYM_WS, _SYM_O, _SYM_AP, _SYM_SEP = range(10)
# States: what was read last. FRESH: a token begins next, whatever comes. PAIR: within 'll, 've, 're.
_FRESH, _IN_L, _IN_N, _IN_O, _IN_AP, _PAIR, _AFTER_SP, _IN_WS = range(8)

# White space of Unicode (property White_Space).
_WHITE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Characters scanned at once in a Python worker.
_CHUNK_CHARS = 1_000_000
#: Slices longer than this aren't cached; the cache starts anew beyond so many.
_CACHE_LEN, _CACHE_SIZE = 48, 400_000


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """step[symbol, state] -> state; begins[symbol, state] -> whether a token begins at the symbol."""
    step, begins = np.zeros((10, 8), np.uint8), np.ones((10, 8), bool)
    for sym in (_SYM_L, _SYM_ONE, _SYM_TWO):
        step[sym] = _IN_L
        begins[sym, [_IN_L, _AFTER_SP, _PAIR]] = False
        step[sym, _PAIR] = _FRESH
    step[_SYM_ONE, _IN_AP], begins[_SYM_ONE, _IN_AP] = _FRESH, False
    step[_SYM_TWO, _IN_AP], begins[_SYM_TWO, _IN_AP] = _PAIR, False
    step[_SYM_N] = _IN_N
    begins[_SYM_N, [_IN_N, _AFTER_SP]] = False
    step[_SYM_O] = _IN_O
    begins[_SYM_O, [_IN_O, _IN_AP, _AFTER_SP]] = False
    step[_SYM_AP] = _IN_AP
    step[_SYM_AP, [_IN_O, _IN_AP, _AFTER_SP]] = _IN_O
    begins[_SYM_AP, [_IN_O, _IN_AP, _AFTER_SP]] = False
    step[_SYM_RUN] = _IN_WS
    begins[_SYM_RUN, _IN_WS] = False
    step[_SYM_SP], step[_SYM_WS], step[_SYM_SEP] = _AFTER_SP, _FRESH, _FRESH
    return step, begins


@lru_cache(maxsize=1)
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The functions that symbols compose to: (number of each symbol, product table, apply[function, state], begins)."""
    step, begins = _automaton()
    known = {tuple(range(8)): 0}
    for f in step:
        known.setdefault(tuple(int(x) for x in f), len(known))
    generators = [known[tuple(int(x) for x in f)] for f in step]
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in step:
            h = tuple(int(g[x]) for x in f)  # f, then g
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    functions = list(known)
    size = len(functions)
    kind = np.uint8 if size <= 256 else np.uint16
    product = np.zeros((size, size), kind)
    for i, f in enumerate(functions):
        for j, g in enumerate(functions):
            product[i, j] = known[tuple(g[x] for x in f)]
    return np.array(generators, kind), product, np.array(functions, np.uint8), begins


def _prefixes(x: np.ndarray, product: np.ndarray) -> np.ndarray:
    """Inclusive prefix products of ``x``, by blocks: within blocks column by column, then over the blocks' totals."""
    n = len(x)
    width = min(256, max(8, math.isqrt(n)))
    if n <= 16:
        out = x.copy()
        for i in range(1, n):
            out[i] = product[out[i - 1], x[i]]
        return out
    blocks = -(-n // width)
    padded = np.zeros(blocks * width, x.dtype)  # function 0 is the identity
    padded[:n] = x
    columns = np.ascontiguousarray(padded.reshape(blocks, width).T)
    for i in range(1, width):
        columns[i] = product[columns[i - 1], columns[i]]
    totals = _prefixes(columns[-1].copy(), product)
    before = np.zeros(blocks, x.dtype)
    before[1:] = totals[:-1]
    return product[before[None, :], columns].T.reshape(-1)[:n]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point; one entry more for the mark between documents."""
    table = np.full(0x110001, _O, np.uint8)
    kinds = {"L": _L, "N": _N}
    for cp in range(0x110000):
        k = kinds.get(unicodedata.category(chr(cp))[0])
        if k is not None:
            table[cp] = k
    table[_WHITE] = _W
    table[0x20], table[ord("'")], table[0x110000] = _SP, _AP, _SEP
    for c in "sdmt":
        table[ord(c)] = _SDMT
    table[ord("l")], table[ord("v")], table[ord("r")], table[ord("e")] = _LL, _V, _R, _E
    return table


def token_slices(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """Where tokens may begin, for a batch: (joined text, marks, is_separator).

    The joined text has one separator before each document; marks are the ascending
    positions of separators and of slice beginnings. A slice ends where the next mark is.
    """
    joined = "\0".join(["", *texts])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    seps = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))[:-1] if len(texts) > 1 else np.zeros(0, np.int64)
    points[np.concatenate([[0], seps]).astype(np.int64)] = 0x110000
    base = _classes()[points]
    after = np.empty_like(base)
    after[:-1], after[-1] = base[1:], _SEP
    symbol = np.array([_SYM_L, _SYM_N, _SYM_RUN, _SYM_RUN, _SYM_O, _SYM_AP, _SYM_ONE, _SYM_L, _SYM_L, _SYM_L, _SYM_L, _SYM_SEP], np.uint8)[base]
    symbol[((base == _LL) & (after == _LL)) | (((base == _V) | (base == _R)) & (after == _E))] = _SYM_TWO
    # The last of a white-space run before other text stands apart from the run.
    last = (after != _SP) & (after != _W) & (after != _SEP)
    symbol[(base == _SP) & last], symbol[(base == _W) & last] = _SYM_SP, _SYM_WS
    generators, product, apply, begins = _monoid()
    done = _prefixes(generators[symbol], product)
    state = np.empty(len(base), np.uint8)
    state[0], state[1:] = _FRESH, apply[done[:-1], _FRESH]
    is_sep = base == _SEP
    marks = np.flatnonzero(begins[symbol, state] | is_sep)
    return joined, marks, is_sep[marks]


class PairMerger(dict):
    """Ids of a slice by its text; a missing one is merged and, if short, kept."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(raw)
        ids = (whole,) if whole is not None else tuple(merge_pairs(raw, self.ranks))
        if len(piece) <= _CACHE_LEN:
            if len(self) >= _CACHE_SIZE:
                self.clear()
            self[piece] = ids
        return ids


def merge_pairs(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent pair of lowest rank (leftmost first) until none is left; n log n by a heap."""
    n = len(raw)
    start, nxt, prv = list(range(n)), list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = nxt[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue  # one of the two has been merged since
        alive[j], end[i], nxt[i] = False, stop, nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
            r = ranks.get(raw[start[i] : end[nxt[i]]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[nxt[i]]))
        if (p := prv[i]) >= 0:
            r = ranks.get(raw[start[p] : stop])
            if r is not None:
                heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[raw[start[i] : end[i]]])
        i = nxt[i]
    return out


@lru_cache(maxsize=4)
def load_merger(path: str) -> PairMerger:
    """The ranks of a vocabulary file (base64 bytes, rank), once a worker."""
    lines = Path(shipped_file(path)).read_bytes().splitlines()
    return PairMerger({base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())})


def vocabulary_path(folder: str = TOKENIZER_DIR, name: str = BYTE_BPE) -> str:
    return str(Path(folder) / name)


def safe_parts(text: str, size: int) -> list[str]:
    """A text cut into parts of about ``size`` characters where a slice begins whatever is around:
    at a blank between two letters. Without such a place the rest stays whole."""
    parts, start = [], 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while 0 < at < len(text) - 1 and not (text[at - 1].isalpha() and text[at + 1].isalpha()):
            at = text.find(" ", at + 1)
        if not 0 < at < len(text) - 1:
            break
        parts.append(text[start:at])
        start = at
    parts.append(text[start:])
    return parts


def encode_slices(texts: list[str], merger: PairMerger):
    """For each text: (slice starts as a list, ids of each slice as a list of tuples).

    A single text beyond _CHUNK_CHARS is scanned in parts, so that its scan needs no more
    memory than other batches.
    """
    if len(texts) == 1 and len(texts[0]) > _CHUNK_CHARS:
        starts, ids, base = [], [], 0
        for part in safe_parts(texts[0], _CHUNK_CHARS):
            s, i = next(_encode_slices([part], merger))
            starts += [x + base for x in s]
            ids += i
            base += len(part)
        yield starts, ids
        return
    yield from _encode_slices(texts, merger)


def _encode_slices(texts: list[str], merger: PairMerger):
    if not texts:
        return
    joined, marks, is_sep = token_slices(texts)
    bounds = marks.tolist()
    at = np.flatnonzero(is_sep).tolist() + [len(bounds)]
    bounds.append(len(joined))
    for k in range(len(texts)):
        lo, hi = at[k] + 1, at[k + 1]
        base = bounds[at[k]] + 1
        cuts = bounds[lo : hi + 1]
        yield [c - base for c in cuts[:-1]], [merger[joined[a:b]] for a, b in zip(cuts, cuts[1:])]


def text_groups(texts: list[str]):
    """Runs of texts of about _CHUNK_CHARS together, to bound what a scan holds."""
    group, chars = [], 0
    for t in texts:
        if group and chars + len(t) > _CHUNK_CHARS:
            yield group
            group, chars = [], 0
        group.append(t)
        chars += len(t)
    if group:
        yield group


def encode_batch(texts: list[str | None], merger: PairMerger) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, offsets of each text's ids); null and empty texts have none."""
    parts, sizes = [], []
    for group in text_groups([t or "" for t in texts]):
        for _, ids in encode_slices(group, merger):
            flat = np.fromiter(chain.from_iterable(ids), np.int32)
            parts.append(flat)
            sizes.append(len(flat))
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), offsets


def decode(ids: list[int], path: str) -> str:
    """The text of ids; whole texts come back exactly."""
    back = _pieces(path)
    return b"".join(back[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _pieces(path: str) -> dict[int, bytes]:
    return {v: k for k, v in load_merger(path).ranks.items()}


def token_ids(text: Column | str, path: str) -> Column:
    """Column of token ids, without special tokens (their strings are ordinary text)."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pa.Array) -> pa.Array:
        flat, offsets = encode_batch(texts.to_pylist(), load_merger(path))
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, pa.int32()))

    return ids(text)


def encode_corpus(df: DataFrame, text: str, path: str, ids: str = "ids", slices: str | None = None) -> DataFrame:
    """``df`` with the token ids of ``text`` in a column ``ids``; a column of that name is replaced.

    Null and empty texts give the empty list. All other columns stay in the JVM untouched.
    One narrow stage: no exchange, memory bound by one batch, and a lost task is redone alone.

    ``slices``: a further column with array<struct<start int, tokens int>>, the code-point
    offset and token count of each slice, for tying ids back to text.
    """
    ship(df.sparkSession)
    ship_file(df.sparkSession, path)
    if slices is None:
        return df.withColumn(ids, token_ids(F.col(text), path))
    kind = T.StructType([
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("slices", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("tokens", T.IntegerType())]))),
    ])

    @F.arrow_udf(kind)
    def both(texts: pa.Array) -> pa.Array:
        merger, a, b = load_merger(path), [], []
        for group in text_groups([t or "" for t in texts.to_pylist()]):
            for starts, parts in encode_slices(group, merger):
                a.append(list(chain.from_iterable(parts)))
                b.append([{"start": s, "tokens": len(p)} for s, p in zip(starts, parts)])
        slice_type = pa.list_(pa.struct([("start", pa.int32()), ("tokens", pa.int32())]))
        return pa.StructArray.from_arrays([pa.array(a, pa.list_(pa.int32())), pa.array(b, slice_type)], ["ids", "slices"])

    out = df.withColumn("_both", both(F.col(text)))
    return out.withColumns({ids: F.col("_both.ids"), slices: F.col("_both.slices")}).drop("_both")
