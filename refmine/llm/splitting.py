"""Cutting oversized texts into pieces under a token limit, at natural boundaries, with overlap.

For each text a dynamic programme over its boundary positions picks the cuts: it minimises
the penalties of the cuts (paragraph < line < sentence < word < other) plus the imbalance
of the pieces' sizes, subject to the limit and to the overlap that each piece repeats. A
piece brings at least an eighth of the limit of new text wherever the boundaries allow it.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from refmine.llm.tokenizer import PairMerger, encode_slices, load_merger, text_groups
from refmine.session import ship, ship_file

PARAGRAPH, LINE, SENTENCE, WORD, SLICE, INSIDE = "paragraph", "line", "sentence", "word", "slice", "inside"
#: What a cut of each kind costs; an imbalance of the whole limit costs 1.
PENALTY = {PARAGRAPH: 0.0, LINE: 0.05, SENTENCE: 0.15, WORD: 0.6, SLICE: 1.2, INSIDE: 2.0}
_KINDS = list(PENALTY)
_COSTS = np.array(list(PENALTY.values()))
#: The overlap may miss the wanted one by so many tokens, for the sake of a word's beginning.
_SLACK = 16
# What a character is, one bit each: white space, a line break, a paragraph break, ends and closes a sentence (before white space, or by itself).
_SPACE, _BREAK, _NEXT_LINE, _PARTING, _END, _CLOSE, _FULL_END, _FULL_CLOSE = (1 << i for i in range(8))
_CLASSES = np.zeros(0x10000, np.uint8)
_CLASSES[[c for c in range(0x3002) if chr(c).isspace()]] |= _SPACE
for _bit, _chars in ((_BREAK, "\n\r\u2028"), (_NEXT_LINE, "\x85"), (_PARTING, "\u2029"), (_END, ".!?…"), (_CLOSE, "\"'”’»)]"), (_FULL_END, "。！？"), (_FULL_CLOSE, "」』”’）)")):
    _CLASSES[[ord(c) for c in _chars]] |= _bit


def natural_ends(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ends of paragraphs, of lines, of sentences, whether each character is white space), as places in the text.

    A run of white space with a line break ends a line, and with two (CR LF is one) or a
    paragraph separator a paragraph, where the run ends. A sentence ends behind its marks
    and closing quotes, before white space; full-width marks need none.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _CLASSES[np.minimum(points, 0xFFFF)]
    blank = (kind & _SPACE).astype(bool)
    edges = np.flatnonzero(np.diff(blank, prepend=False, append=False))
    start, end = edges[::2], edges[1::2]

    def within(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[end] - total[start]

    breaks = (kind & _BREAK).astype(bool)
    lines = end[(within(breaks) > 0) | (within(kind & _NEXT_LINE > 0) > 0)]
    single = breaks.copy()
    single[1:] &= ~((points[1:] == 0x0A) & (points[:-1] == 0x0D))
    paragraphs = end[(within(single) > 1) | (within(kind & _PARTING > 0) > 0)]
    before = np.maximum.accumulate(np.where(kind & _CLOSE > 0, -1, np.arange(len(kind))))
    first = start[start > 0]
    last = before[first - 1]
    sentences = [first[(last >= 0) & (kind[last] & _END > 0)]]
    full = kind & _FULL_END > 0
    if full.any():
        marks = np.flatnonzero(full & ~np.append(full[1:], False)) + 1
        stop = np.append(np.where(kind & _FULL_CLOSE > 0, len(kind), np.arange(len(kind))), len(kind))
        sentences.append(np.minimum.accumulate(stop[::-1])[::-1][marks])
    return paragraphs, lines, np.concatenate(sentences), blank


def _boundaries(text: str, starts: list[int], ids: list[tuple], cap: int, merger: PairMerger):
    """Candidate cuts as arrays (tokens before, characters before, kind number), ascending, from 0 to the end.

    Paragraph, line and sentence ends always; word ends, slice ends, and places inside a
    slice only where the better ones lie more than ``cap`` tokens apart.
    """
    p = np.array([*starts, len(text)], np.int64)
    k = np.array([0, *accumulate(map(len, ids))], np.int64)
    kind = np.full(len(p), -1, np.int8)
    paragraphs, lines, sentences, blank = natural_ends(text)
    for number, ends in ((2, sentences), (1, lines), (0, paragraphs)):
        # The last white space of a run may belong to the next slice: the cut is then before it.
        at = np.searchsorted(p, ends, "right") - 1
        kind[at] = number
    kind[0] = kind[-1] = 0
    # White space or an end of the text on either side.
    around = np.concatenate([[True], blank, [True]])
    word = around[p] | around[p + 1]

    def gaps(chosen: np.ndarray):
        t = k[chosen]
        for g in np.flatnonzero(np.diff(t) > cap):
            yield chosen[g], chosen[g + 1]

    chosen = np.flatnonzero(kind >= 0)
    for lo, hi in list(gaps(chosen)):
        part = kind[lo + 1 : hi]
        part[(part < 0) & word[lo + 1 : hi]] = 3
    chosen = np.flatnonzero(kind >= 0)
    for lo, hi in list(gaps(chosen)):
        kind[lo + 1 : hi] = np.where(kind[lo + 1 : hi] < 0, 4, kind[lo + 1 : hi])
    chosen = np.flatnonzero(kind >= 0)
    extra, inner = [], {}
    for lo, hi in list(gaps(chosen)):  # neighbours now: one slice
        a, b = _inside(text[p[lo] : p[hi]], ids[lo], merger)
        inner[int(lo)] = a + k[lo], b + p[lo]
        extra.append(inner[int(lo)])
    t, c = (np.concatenate([x[chosen], *[e[n] for e in extra]]) for n, x in enumerate((k, p)))
    kinds = np.concatenate([kind[chosen], np.full(len(t) - len(chosen), 5, np.int8)])
    order = np.argsort(t, kind="stable")
    return t[order], c[order], kinds[order], k, p, inner, word


def _inside(piece: str, ids: tuple, merger: PairMerger) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, characters) of the places in a slice where a token and a character both end."""
    lengths = merger.__dict__.setdefault("_lengths", {})
    if not lengths:
        lengths.update((v, len(b)) for b, v in merger.ranks.items())
    ends = np.cumsum([lengths[i] for i in ids])
    chars = np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in piece])
    _, a, b = np.intersect1d(ends, chars, return_indices=True)
    keep = a + 1 < len(ids)
    return a[keep] + 1, b[keep] + 1


def _restarts(t: np.ndarray, c: np.ndarray, k: np.ndarray, p: np.ndarray, inner: dict, word: np.ndarray, text: str, ids: list, overlap: int, merger: PairMerger) -> tuple[np.ndarray, np.ndarray]:
    """For each cut the place (tokens, characters) where the next piece begins: about ``overlap`` tokens before it."""
    if overlap <= 0:
        return t, c
    want = t - overlap

    def nearest(places: np.ndarray) -> np.ndarray:
        if len(places) < 2:
            return np.zeros(len(want), np.int64)
        at = np.clip(np.searchsorted(places, want), 1, len(places) - 1)
        return np.where(want - places[at - 1] <= places[at] - want, at - 1, at)

    words = np.flatnonzero(word)
    by_word, by_slice = words[nearest(k[words])], nearest(k)
    fits = [(np.abs(k[i] - want) <= _SLACK) & (k[i] < t) for i in (by_word, by_slice)]
    pick = np.where(fits[0], by_word, by_slice)
    early = want <= 0
    tokens, chars = np.where(early, 0, k[pick]), np.where(early, 0, p[pick])
    for n in np.flatnonzero(~(fits[0] | fits[1] | early)):
        # Within a long slice; no overlap where no token and character end together nearby.
        i = int(np.searchsorted(k, want[n], "right") - 1)
        if i not in inner:
            a, b = _inside(text[p[i] : p[i + 1]], ids[i], merger)
            inner[i] = a + k[i], b + p[i]
        a, b = inner[i]
        at = int(np.searchsorted(a, want[n]))
        near = [m for m in (at - 1, at) if 0 <= m < len(a) and a[m] < t[n] and abs(a[m] - want[n]) <= _SLACK]
        m = min(near, key=lambda m: abs(a[m] - want[n]), default=None)
        tokens[n], chars[n] = (t[n], c[n]) if m is None else (a[m], b[m])
    # Later cuts restart no earlier.
    top = np.maximum.accumulate(np.where(np.maximum.accumulate(tokens) == tokens, np.arange(len(tokens)), 0))
    return tokens[top], chars[top]


def _best_cuts(t: np.ndarray, s: np.ndarray, penalty: np.ndarray, limit: int, target: float, least: int) -> list[int] | None:
    """The cuts of least cost, each ``least`` tokens or more after the one before; null if there are none.

    Cuts within ``least`` tokens of each other can't follow one another, so such a run of
    cuts is solved at once, against all cuts before it.
    """
    cost, came = np.full(len(t), np.inf), np.full(len(t), -1, np.int64)
    ends, lows, highs = t.searchsorted(t + least, "left").tolist(), s.searchsorted(t - limit, "left").tolist(), t.searchsorted(t - least, "right").tolist()
    cost[0], at = 0.0, 1
    while at < len(t):
        end = max(at + 1, ends[at])
        lo, hi = lows[at], min(highs[end - 1], at)
        if lo < hi:
            size = t[at:end, None] - s[None, lo:hi]
            sums = cost[None, lo:hi] + ((size - target) / limit) ** 2
            sums[(size > limit) | (t[at:end, None] - t[None, lo:hi] < least)] = np.inf
            best = np.argmin(sums, axis=1)
            cost[at:end] = sums[np.arange(end - at), best] + penalty[at:end]
            came[at:end] = best + lo
        at = end
    if not np.isfinite(cost[-1]):
        return None
    path, j = [], len(t) - 1
    while j > 0:
        path.append(j)
        j = int(came[j])
    return path[::-1]


def split_text(text: str, merger: PairMerger, limit: int, overlap: int, slices: tuple[list[int], list[tuple]] | None = None) -> list[dict]:
    """Pieces of one text: piece, start, stop (characters), tokens, overlap (characters shared
    with the piece before), cut (kind of the cut at its end). One piece if it is within the limit.
    ``slices``: the text's slices, where a caller has them.
    """
    if not text:
        return []
    starts, ids = slices or next(encode_slices([text], merger))
    total = sum(map(len, ids))
    if total <= limit:
        return [{"piece": 1, "start": 0, "stop": len(text), "tokens": total, "overlap": 0, "cut": "end"}]
    cap = limit - overlap - _SLACK
    t, c, kinds, k, p, inner, word = _boundaries(text, starts, ids, cap, merger)
    s, back = _restarts(t, c, k, p, inner, word, text, ids, overlap, merger)
    cuts, dense = _Cuts(t, c, kinds, s, back), []
    banned: set[int] = set()
    while True:
        # Cuts that made a piece too long are out, and where none are left the text is measured in bytes.
        now = cuts.without(banned).measured(text, dense, overlap)
        path = _solve(now, limit, overlap)
        if path is None:
            dense.append(now.widest_gap(limit))
            continue
        out = _pieces(text, now, path, merger, dense, k, p)
        long = [x["stop"] for x in out if x["tokens"] > limit]
        if not long:
            return out
        banned.update(long)
        if len(text) in banned:  # the end can't be moved: cut finer before it
            banned.remove(len(text))
            dense.append((out[-1]["start"], len(text)))


@dataclass
class _Cuts:
    """Candidate cuts, ascending: tokens and characters before each, its kind, and where the next piece begins."""

    t: np.ndarray
    c: np.ndarray
    kinds: np.ndarray
    s: np.ndarray
    back: np.ndarray

    def _take(self, keep: np.ndarray) -> _Cuts:
        return _Cuts(self.t[keep], self.c[keep], self.kinds[keep], self.s[keep], self.back[keep])

    def without(self, banned: set[int]) -> _Cuts:
        return self._take(~np.isin(self.c, list(banned))) if banned else self

    def widest_gap(self, limit: int) -> tuple[int, int]:
        """The stretch between neighbours (characters) that no piece can span for sure, the widest first."""
        wide = np.diff(self.t)
        n = int(np.argmax(np.where(np.diff(self.c) > 1, wide, -1)))
        return int(self.c[n]), int(self.c[n + 1])

    def measured(self, text: str, dense: list[tuple[int, int]], overlap: int) -> _Cuts:
        """With every character of the dense stretches a candidate, and these stretches measured in bytes: a token has one or more."""
        out = self
        for lo, hi in sorted(dense):
            sizes = np.cumsum([len(x.encode("utf-8", "surrogatepass")) for x in text[lo:hi]])
            i, j = (int(np.searchsorted(out.c, x)) for x in (lo, hi))
            if i >= len(out.c) or out.c[i] != lo:
                i -= 1  # from the last candidate before it
                lo = int(out.c[i])
                sizes = np.cumsum([len(x.encode("utf-8", "surrogatepass")) for x in text[lo:hi]])
            before = np.concatenate([[0], sizes])
            at = np.arange(lo + 1, hi)
            start = np.searchsorted(before, before[1:-1] - overlap, "left")
            start = np.minimum(start, np.arange(1, hi - lo))
            base, extra = int(out.t[i]), int(sizes[-1] - (out.t[j] - out.t[i]))
            inside = (out.back[j:] > lo) & (out.back[j:] < hi)
            late = np.where(out.back[j:] >= hi, out.s[j:] + extra, out.s[j:])
            late = np.where(inside, base + before[np.clip(out.back[j:] - lo, 0, hi - lo)], late)
            t, c = np.concatenate([out.t[: i + 1], base + before[1:-1], out.t[j:] + extra]), np.concatenate([out.c[: i + 1], at, out.c[j:]])
            kinds = np.concatenate([out.kinds[: i + 1], np.full(len(at), 5, np.int8), out.kinds[j:]])
            s, back = np.concatenate([out.s[: i + 1], base + before[start], late]), np.concatenate([out.back[: i + 1], lo + start, out.back[j:]])
            top = np.maximum.accumulate(np.where(np.maximum.accumulate(back) == back, np.arange(len(back)), 0))
            out = _Cuts(t, c, kinds, s[top], back[top])
        return out


def _solve(cuts: _Cuts, limit: int, overlap: int) -> list[int] | None:
    penalty = _COSTS[cuts.kinds]
    penalty[-1] = 0.0
    total = int(cuts.t[-1])
    count = max(2, -(-(total - overlap) // (limit - overlap)))
    target = (total + (count - 1) * overlap) / count
    return _best_cuts(cuts.t, cuts.s, penalty, limit, target, limit // 8) or _best_cuts(cuts.t, cuts.s, penalty, limit, target, 1)


def _pieces(text: str, cuts: _Cuts, path: list[int], merger: PairMerger, dense: list, k: np.ndarray, p: np.ndarray) -> list[dict]:
    """The pieces between the cuts; ``k`` and ``p``: tokens and characters before each slice of the text."""
    out, before, stop_before = [], 0, 0
    for n, j in enumerate(path):
        start, stop = (0 if n == 0 else int(cuts.back[before])), int(cuts.c[j])
        out.append({"piece": n + 1, "start": start, "stop": stop, "tokens": int(cuts.t[j] - (cuts.s[before] if n else 0)), "overlap": stop_before - start, "cut": "end" if stop == len(text) else _KINDS[cuts.kinds[j]]})
        before, stop_before = j, stop
    # White space at a piece's end can merge otherwise than before more text: count it again from the slice before it
    # on, and pieces measured in bytes as a whole.
    again = []
    for x, j in zip(out, path):
        start, stop = x["start"], x["stop"]
        if any(start < hi and stop > lo for lo, hi in dense):
            again.append((x, start, 0))
        elif stop < len(text) and text[stop - 1].isspace():
            end = stop - 1
            while end > start and text[end - 1].isspace():
                end -= 1
            i = int(p.searchsorted(max(end - 1, 0), "right")) - 1
            again.append((x, int(p[i]), x["tokens"] - int(cuts.t[j] - k[i])) if p[i] > start and not dense else (x, start, 0))
    if again:
        for (x, _, before), (_, parts) in zip(again, encode_slices([text[at : x["stop"]] for x, at, _ in again], merger)):
            x["tokens"] = before + sum(map(len, parts))
    return out


_PIECE = T.StructType([
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()),
    T.StructField("tokens", T.IntegerType()), T.StructField("overlap", T.IntegerType()), T.StructField("cut", T.StringType()), T.StructField("text", T.StringType()),
])


def split_oversized(df: DataFrame, id_column: str, text: str, path: str, limit: int = 1024, overlap: int = 64, keep_small: bool = False) -> DataFrame:
    """(id, piece, start, stop, tokens, overlap, cut, text): the pieces of each oversized text.

    Pieces have at most ``limit`` tokens when encoded by themselves; each but the first
    begins about ``overlap`` tokens (within 16, at a word's beginning where there is one)
    before the end of the piece before. Taken without their overlaps, a text's pieces are
    the text. With ``keep_small`` texts within the limit come out as one piece, else not at
    all. Null and empty texts give no rows; repeated rows are split each; only the id and
    the text are read.

    A narrow stage without exchange. Texts of at most ``limit`` bytes can't be oversized, as
    a token has a byte or more, and don't leave the JVM.
    """
    if overlap < 0 or limit < 2 * (overlap + _SLACK) + 2:
        raise ValueError("limit must exceed twice the overlap and its slack")
    ship(df.sparkSession)
    ship_file(df.sparkSession, path)

    @F.arrow_udf(T.ArrayType(_PIECE))
    def pieces(texts: pa.Array) -> pa.Array:
        merger, rows = load_merger(path), []
        for group in text_groups([t or "" for t in texts.to_pylist()]):
            for whole, slices in zip(group, encode_slices(group, merger)):
                found = split_text(whole, merger, limit, overlap, slices)
                if len(found) == 1 and not keep_small:
                    found = []
                for x in found:
                    x["text"] = whole[x["start"] : x["stop"]]
                rows.append(found)
        kind = pa.struct([("piece", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("tokens", pa.int32()), ("overlap", pa.int32()), ("cut", pa.string()), ("text", pa.string())])
        return pa.array(rows, pa.list_(kind))

    picked = df.select(F.col(id_column).alias("_id"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    if not keep_small:
        picked = picked.where(F.octet_length("_text") > limit)
    return picked.select(F.col("_id").alias(id_column), F.explode(pieces("_text")).alias("_p")).select(id_column, "_p.*")
