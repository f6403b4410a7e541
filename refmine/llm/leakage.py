"""Held-out passages in a corpus, found by latent semantic retrieval.

Passages of the corpus (stretches of words that the items use, in windows) and word windows
of the items are TF-IDF vectors over the items' vocabulary. A randomised SVD, whose passes
over the passages are distributed, gives a latent space in which cosines are compared;
longest common runs, longest common subsequences and an answer check judge the candidates.

The latent search loses nothing that it looks for: what a projection cuts off a vector is
known exactly, so for each pair the least latent cosine that a passage holding the window
could have is known too (Cauchy-Schwarz on the two residuals), and that is the pair's
threshold. Pairs come from an inverted index: a passage that holds a window but for a share
``loss`` of its weight has one of the rarest words that together weigh more than that.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from refmine.session import materialize, ship

_WORD = re.compile(r"[^\W_]+")
#: Words of a passage window; windows start every half of it, so each run of up to half + 1 words lies in one.
_WINDOW = 24
#: Pairs of passages and windows that are looked at at once.
_PAIRS = 500_000
#: Share of a window's weight that is indexed beyond what a passage may lack.
_MORE = 0.15


def words_of(text: str) -> list[str]:
    """Runs of letters and digits, in lower case."""
    if "İ" in text:  # its lower case is two characters, the second no letter
        return [w.lower() for w in _WORD.findall(text)]
    return _WORD.findall(text.lower())


@dataclass
class Postings:
    """An inverted index: windows and their words' squared weights by word; of each window the whole squared weight and what isn't indexed of it."""

    starts: np.ndarray
    windows: np.ndarray
    weights: np.ndarray
    total: np.ndarray
    rest: np.ndarray


class ItemIndex:
    """The items of one block: vocabulary, words, windows of ``gram`` words (or the whole shorter item) at every ``stride``-th word and the last, answers.

    Words lie in one array; a window is a place in it, so a word takes some 50 bytes in all.
    """

    def __init__(self, items: list[tuple], gram: int, stride: int = 1):
        self.ids, parts, self.answers, self.vocab = [], [], [], {}
        for item, text, labels in items:
            words = words_of(text or "")
            if not words:
                continue
            self.ids.append(item)
            parts.append(np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words], np.int32))
            answers = [[self.vocab.setdefault(w, len(self.vocab)) for w in words_of(x)] for x in labels or [] if x]
            self.answers.append([np.array(a, np.int32) for a in answers if a])
        self.gram = gram
        self.length = np.array([len(w) for w in parts], np.int64)
        self.start = np.cumsum(self.length) - self.length
        size = np.minimum(self.length, gram)
        self.shortest = int(size.min(initial=gram))
        last = self.length - size
        count = -(-last // stride) + 1
        self.owner = np.repeat(np.arange(len(parts), dtype=np.int32), count)
        self.place = self.start[self.owner] + np.minimum(ragged(np.zeros(len(parts), np.int64), count) * stride, last[self.owner])
        # The word beyond the vocabulary fills windows of shorter items.
        self.flat = np.concatenate([*parts, np.full(gram, len(self.vocab), np.int32)])

    def words(self, i: int) -> np.ndarray:
        return self.flat[self.start[i] : self.start[i] + self.length[i]]

    def windows(self, which: np.ndarray) -> np.ndarray:
        """The different words of windows, one row each, filled up with the word beyond the vocabulary."""
        at = self.place[which, None] + np.arange(self.gram)
        owner = self.owner[which]
        rows = np.where(at < (self.start[owner] + self.length[owner])[:, None], self.flat[np.minimum(at, len(self.flat) - 1)], len(self.vocab))
        rows.sort(axis=1)
        rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = len(self.vocab)
        return rows

    def postings(self, weight: np.ndarray, loss: float) -> Postings:
        """Under each word the windows of which it is one of the heaviest words.

        These are so many that together they weigh more than the share ``loss`` of the
        window's squared weight, by some more, so that a passage must have several of them.
        """
        squared = np.append(weight.astype(np.float64) ** 2, 0.0)
        words, windows, weights, total, rest = [], [], [], np.zeros(len(self.owner)), np.zeros(len(self.owner))
        for lo in range(0, len(self.owner), 100_000):
            which = np.arange(lo, min(lo + 100_000, len(self.owner)))
            rows = self.windows(which)
            w = squared[rows]
            order = np.argsort(-w, axis=1, kind="stable")
            rows, w = np.take_along_axis(rows, order, 1), np.take_along_axis(w, order, 1)
            total[which] = w.sum(axis=1)
            keep = (np.cumsum(w, axis=1) - w <= (loss + _MORE) * total[which, None] + 1e-9) & (w > 0)
            rest[which] = (w * ~keep).sum(axis=1)
            words.append(rows[keep])
            weights.append(w[keep])
            windows.append(np.repeat(which, keep.sum(axis=1)))
        words, windows, weights = (np.concatenate([np.zeros(0, t), *x]) for x, t in ((words, np.int32), (windows, np.int64), (weights, float)))
        order = np.argsort(words, kind="stable")
        return Postings(np.searchsorted(words[order], np.arange(len(weight) + 2)), windows[order].astype(np.int32), weights[order].astype(np.float32), total.astype(np.float32), rest.astype(np.float32))

    def signature(self) -> set[str]:
        """For each window its word that is rarest among the items: whoever holds a window whole has it."""
        times = np.append(np.bincount(self.flat, minlength=len(self.vocab) + 1)[: len(self.vocab)], np.iinfo(np.int64).max)
        chosen = [np.zeros(0, np.int32)]
        for lo in range(0, len(self.owner), 100_000):
            rows = self.windows(np.arange(lo, min(lo + 100_000, len(self.owner))))
            chosen.append(np.take_along_axis(rows, np.argmin(times[rows], axis=1)[:, None], 1).ravel())
        names = list(self.vocab)
        return {names[w] for w in np.unique(np.concatenate(chosen))}


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of several runs, one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def numbers_of(words: list[str], vocab: dict[str, int]) -> np.ndarray:
    """The words' numbers, -1 for foreign ones."""
    return np.fromiter((vocab.get(w, -1) for w in words), np.int32, len(words))


def stretches(found: np.ndarray, least: int, gap: int) -> Iterator[np.ndarray]:
    """Maximal stretches with at least ``least`` words of the vocabulary and at most ``gap`` others (-1) in a row."""
    at = np.flatnonzero(found >= 0)
    if len(at) < least:
        return
    cuts = np.flatnonzero(np.diff(at) > gap + 1) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(at)]):
        if hi - lo >= least:
            yield found[at[lo] : at[hi - 1] + 1]


def passage_windows(stretch: np.ndarray) -> Iterator[np.ndarray]:
    for start in range(0, max(1, len(stretch) - _WINDOW // 2), _WINDOW // 2):
        yield stretch[start : start + _WINDOW]


def longest_run(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest run of words that both have; -1 in ``a`` is no word."""
    order = np.argsort(b, kind="stable")
    low, high = np.searchsorted(b[order], a, "left"), np.searchsorted(b[order], a, "right")
    size = np.where(a >= 0, high - low, 0)
    if not size.sum():
        return 0
    i, j = np.repeat(np.arange(len(a)), size), order[ragged(low, size)]
    key = np.sort((i - j + len(b)) * (len(a) + 1) + i)  # by diagonal, then along it
    ends = np.flatnonzero(np.append(np.diff(key) != 1, True))
    return int(np.diff(np.concatenate([[-1], ends])).max())


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bit sets of the places in ``b``."""
    places: dict[int, int] = {}
    for j, y in enumerate(b):
        places[y] = places.get(y, 0) | 1 << j
    row, full = 0, (1 << len(b)) - 1
    for x in a:
        m = places.get(x, 0) if x >= 0 else 0
        u = row | m
        row = (u & ~(u - ((row << 1) | 1))) & full
    return row.bit_count()


def best_subsequence(found: np.ndarray, words: np.ndarray, share: float) -> int:
    """Longest common subsequence of an item and a stretch, over the stretch's parts of _WINDOW words at every word
    and, for longer items, also those of the item's length; 0 where none reaches ``share`` of _WINDOW words (or of
    the item's, if it is shorter, or of a longer part's).

    The words that are of the item at all are counted first; a subsequence can't be longer.
    """
    own = np.zeros(int(max(words.max(), found.max())) + 2, np.int32)  # the last is that of foreign words (-1)
    own[words] = 1
    count = np.zeros(len(found) + 1, np.int64)
    np.cumsum(own[found], out=count[1:])
    b, best = words.tolist(), 0
    for wide, least in {(_WINDOW, min(_WINDOW, len(b))), (max(_WINDOW, len(b)), len(b))}:
        least, size = int(np.ceil(share * least - 1e-9)), min(wide, len(found))
        held = count[size:] - count[: len(count) - size]
        # A part whose count isn't above that of the part before it by a fresh word can't do better than both.
        for at in np.flatnonzero(held >= max(least, best + 1)):
            if held[at] > best:
                n = common_subsequence(found[at : at + size].tolist(), b)
                if n >= least:
                    best = max(best, n)
    return best


class _Latent:
    """What a worker needs to search: index, basis, postings, thresholds."""

    def __init__(self, index: ItemIndex, idf: np.ndarray, basis: np.ndarray, loss: float, share: float | None):
        self.index, self.loss, self.share = index, loss, share
        self.weight, self.basis = np.append(idf, np.float32(0)), np.vstack([basis, np.zeros((1, basis.shape[1]), basis.dtype)])
        self.post = index.postings(idf, loss)

    def _vectors(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Projections of sets of words (one row each, filled up) and what these cut off."""
        w = self.weight[rows]
        projected = np.einsum("ij,ijk->ik", w, self.basis[rows])
        own = np.einsum("ij,ij->i", projected, projected)
        return projected, np.sqrt(np.maximum(np.einsum("ij,ij->i", w, w) - own, 0.0)) + 1e-3

    def _held(self, passages: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """For pairs: the squared weight of the window's words that the passage has."""
        out = np.zeros(len(windows))
        for at in range(0, len(windows), 20_000):
            words = self.index.windows(windows[at : at + 20_000])
            there = (words[:, :, None] == passages[at : at + 20_000, None, :]).any(axis=2)
            out[at : at + 20_000] = (self.weight[words].astype(np.float64) ** 2 * there).sum(axis=1)
        return out

    def candidates(self, windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(passage window, item, cosine, share of the item's window held) of the pairs that can be, best by item."""
        foreign = len(self.weight) - 1
        rows = np.full((len(windows), _WINDOW), foreign, np.int32)
        for k, w in enumerate(windows):
            rows[k, : len(w)] = w
        rows[rows < 0] = foreign
        rows.sort(axis=1)
        rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = foreign
        post, windows_in_all = self.post, len(self.post.total)
        size = post.starts[rows + 1] - post.starts[rows]  # the word beyond has none
        out = [], [], [], []
        sofar, lo = np.cumsum(size.sum(axis=1)), 0
        while lo < len(windows):
            hi = max(lo + 1, int(np.searchsorted(sofar, (sofar[lo - 1] if lo else 0) + _PAIRS, "right")))
            part = size[lo:hi]
            at = ragged(post.starts[rows[lo:hi]].ravel(), part.ravel())
            key = np.repeat(np.arange(hi - lo), part.sum(axis=1)) * windows_in_all + post.windows[at]
            order = np.argsort(key, kind="stable")
            key = key[order]
            heads = np.flatnonzero(np.diff(key, prepend=-1))
            lo, first = hi, lo
            if not len(heads):
                continue
            shared, key = np.add.reduceat(post.weights[at][order], heads), key[heads]
            w = key % windows_in_all
            # The passage may have all that isn't indexed, and no more.
            can = shared + post.rest[w] >= (1.0 - self.loss - 1e-4) * post.total[w]
            p, w = key[can] // windows_in_all, w[can]
            if not len(p):
                continue
            ps, p = np.unique(p, return_inverse=True)
            ws, w = np.unique(w, return_inverse=True)
            (a, cut), (b, cut_b) = self._vectors(rows[first:hi][ps]), self._vectors(self.index.windows(ws))
            square = post.total[ws][w]
            dots = np.einsum("ij,ij->i", a[p], b[w])
            hit = dots >= (1.0 - self.loss) * square - cut[p] * cut_b[w] - 1e-3 * square
            p, w, dots, square = p[hit], w[hit], dots[hit], square[hit]
            held = self._held(rows[first:hi][ps][p], ws[w]) / square
            hit = held >= 1.0 - self.loss - 1e-4
            p, w = p[hit], w[hit]
            cosine = dots[hit] / np.maximum(np.linalg.norm(a, axis=1)[p] * np.linalg.norm(b, axis=1)[w], 1e-6)
            for x, y in zip(out, (ps[p] + first, self.index.owner[ws][w], cosine, held[hit])):
                x.append(y)
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        return tuple(np.concatenate([n, *x]) for n, x in zip(none, out))

    def judge(self, found: list[np.ndarray]) -> list[tuple]:
        """(stretch, item number, run, lcs, cosine, held, answer) of the candidates of each stretch."""
        windows = [(k, w) for k, f in enumerate(found) for w in passage_windows(f)]
        owner = np.array([k for k, _ in windows], np.int64)
        p, item, cosine, held = self.candidates([w for _, w in windows])
        best: dict[tuple[int, int], tuple[float, float]] = {}
        for k, i, c, h in zip(owner[p].tolist(), item.tolist(), cosine.tolist(), held.tolist()):
            old = best.get((k, i), (-1.0, -1.0))
            best[k, i] = max(c, old[0]), max(h, old[1])
        out = []
        for (k, i), (c, h) in best.items():
            a, b = found[k], self.index.words(i)
            run, lcs = longest_run(a, b), None if self.share is None else best_subsequence(a, b, self.share)
            if lcs == 0 and run < min(self.index.gram, len(b)):
                continue
            answer = any(longest_run(a, x) == len(x) for x in self.index.answers[i])
            out.append((k, i, run, lcs, c, h, answer))
        return out


def _add_products(total: np.ndarray, seen: np.ndarray, words: np.ndarray, owner: np.ndarray, weight: np.ndarray, g: np.ndarray) -> None:
    """Add A'AG of some rows to ``total`` and mark their words: ``words`` of the rows ``owner``, each counted once a row."""
    key = np.unique(owner * len(weight) + words)
    if not len(key):
        return
    owner, words = key // len(weight), key % len(weight)
    a = weight[words]
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    share = np.add.reduceat(g[words] * a[:, None], heads, axis=0)
    order = np.argsort(words, kind="stable")
    firsts = np.flatnonzero(np.diff(words[order], prepend=-1))
    rows = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(words))))[order]
    which = words[order][firsts]
    total[which] += np.add.reduceat(share[rows] * a[order, None], firsts, axis=0)
    seen[which] = True


def _basis(passages: DataFrame, index: ItemIndex, idf: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Leading right singular vectors of the TF-IDF passages, by a randomised range finder.

    One distributed pass forms (A'A)G for a random G, A being the corpus passages with
    windows of the items below them; each task adds up its rows' share and gives one vector a word
    it saw. The driver holds vocabulary x rank numbers: bounded by the block of items.
    """
    size = len(idf)
    k = min(rank + 16, size)
    noise = np.random.default_rng(seed).standard_normal((size, k)).astype(np.float32)
    shared = passages.sparkSession.sparkContext.broadcast((idf, noise))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, g = shared.value
        total = np.zeros((len(weight), g.shape[1]), np.float32)
        seen = np.zeros(len(weight), bool)
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.column(0).slice(at, 2048)
                words, owner = np.asarray(part.flatten()), np.asarray(part.value_parent_indices()).astype(np.int64)
                _add_products(total, seen, words[words >= 0], owner[words >= 0], weight, g)
        rows = np.flatnonzero(seen)
        parts = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * g.shape[1], pa.int32()), pa.array(total[rows].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), parts], ["word", "part"])

    parts = passages.select("stretch").mapInArrow(sketch, "word int, part array<float>")
    sums = parts.groupBy("word").agg(F.array(*[F.sum(F.col("part")[j]) for j in range(k)]).alias("row"))
    total = np.zeros((size, k), np.float32)
    for r in sums.toLocalIterator():
        total[r["word"]] = r["row"]
    # The items' windows side by side: each word about once.
    which = np.flatnonzero((index.place - index.start[index.owner]) % index.gram == 0)
    for lo in range(0, len(which), 4096):
        rows = index.windows(which[lo : lo + 4096])
        inside = rows < size
        _add_products(total, np.zeros(size, bool), rows[inside], np.nonzero(inside)[0], idf, noise)
    # A'A is about total (G' total)^-1 total': its eigenvectors from the sketch alone.
    middle = (noise.T @ total).astype(np.float64)
    middle = (middle + middle.T) / 2
    shift = 1e-8 * max(float(np.trace(middle)) / k, 1e-12)
    values, vectors = np.linalg.eigh(middle + shift * np.eye(k))
    half = total @ (vectors / np.sqrt(np.maximum(values, shift))).astype(np.float32)
    left, _, _ = np.linalg.svd(half, full_matrices=False)
    return left[:, : min(rank, k)].astype(np.float32)


def leaked_items(docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str, labels: str | None = None, gram: int = 12, rank: int = 192, share: float | None = 0.6, loss: float = 0.5, gap: int = 12, block_words: int = 4_000_000, seed: int = 7) -> DataFrame:
    """(doc_id, item_id, words, run, lcs, cosine, held, answer): which documents hold passages of which items.

    One row a document and item with a candidate passage. ``words``: the item's words.
    ``run``: most consecutive words of the item in a passage; with ``share`` None every run
    of ``gram`` words is found for sure; a run is measured whole, however long. ``lcs``: longest
    common subsequence of the item and a part of the passage (see best_subsequence).
    ``cosine``: best latent cosine of a window of the passage and one of the item; ``held``:
    the largest share of a candidate window's weight that lies in the passage.
    ``answer``: some label of the item stands in a passage. A document holds the item,
    exactly, where run >= least(gram, words); a smaller run with a large lcs is a paraphrase.

    ``share`` None looks for exact runs only. Else candidates are passages that may lack the
    share ``loss`` of the weight of a window of ``gram`` words of the item (one at every
    ``gram`` / 4-th word), with up to ``gap`` foreign words in a row, and those are kept that
    hold a run of ``gram`` words or a subsequence of ``share`` of 24 words (of the item's, if
    it is shorter); their recall is measured in the tests.

    Document frequencies and the SVD take in all documents. The corpus is passed once for
    each ``block_words`` words of items (25 MB of text; a single longer item makes its own
    block), and only its passages twice more. A block's vocabulary, index and basis go to
    the workers: some 50 bytes a word of items and 4 x rank a word of its vocabulary, so
    their size is bounded whatever the items. Null and empty texts, and items without words,
    give nothing; repeated rows give one; an empty table on either side gives an empty
    result. ``gram`` is at most 13: a longer run needn't lie in one passage window.
    """
    if gram > _WINDOW // 2 + 1:
        raise ValueError(f"gram must be at most {_WINDOW // 2 + 1}")
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    own = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text"), (F.col(labels) if labels else F.lit(None).cast("array<string>")).alias("labels")).where(F.col("text").isNotNull())
    kinds = (("doc", source.schema["doc"].dataType), ("item", own.schema["item"].dataType), ("words", T.IntegerType()), ("run", T.IntegerType()), ("lcs", T.IntegerType()), ("cosine", T.DoubleType()), ("held", T.DoubleType()), ("answer", T.BooleanType()))
    kind = T.StructType([T.StructField(n, t) for n, t in kinds])
    result: DataFrame | None = None
    for block in _blocks(own, block_words):
        index = ItemIndex(block, gram, 1 if share is None else max(1, gram // 4))
        if index.ids:
            found = _search_block(source, index, rank, 0.0 if share is None else loss, 0 if share is None else gap, seed, share, kind)
            result = found if result is None else result.unionByName(found)
    if result is None:
        result = spark.createDataFrame([], kind)
    best = result.groupBy("doc", "item").agg(*[F.max(c).alias(c) for c in kind.names[2:]])
    return best.select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), *kind.names[2:])


def _blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple]]:
    """Items streamed to the driver block by block; it never holds more than one block."""
    block, words = [], 0
    for r in items.dropDuplicates(["item", "text"]).toLocalIterator():
        n = len(r["text"]) // 6 + 1
        if block and words + n > block_words:
            yield block
            block, words = [], 0
        block.append((r["item"], r["text"], r["labels"]))
        words += n
    if block:
        yield block


def _search_block(source: DataFrame, index: ItemIndex, rank: int, loss: float, gap: int, seed: int, share: float | None, result: T.StructType) -> DataFrame:
    spark = source.sparkSession
    # Exact runs have a word of the signature; otherwise a passage has half the words of a window.
    exact = share is None
    shared = spark.sparkContext.broadcast((index.vocab, index.signature() if exact else None, index.shortest if exact else -(-index.shortest // 2), gap))

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stretches, and at the end the task's document frequencies (doc null, counts: word, count, ...)."""
        vocab, signature, least, gap = shared.value
        counts, documents, kind = np.zeros(len(vocab), np.int64), 0, None
        known = vocab.keys()
        for b in batches:
            kind = b.column(0).type
            ids, found = [], []
            for k, body in enumerate(b.column(1).to_pylist()):
                words = words_of(body)
                documents += 1
                different = set(words)
                held = known & different
                if not held:
                    continue
                counts[[vocab[w] for w in held]] += 1
                if signature is not None and signature.isdisjoint(held):
                    continue
                numbers = numbers_of(words, vocab)
                for s in stretches(numbers, least, gap):
                    ids.append(k)
                    found.append(s)
            if ids:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int64())), pa.array(found, pa.list_(pa.int32())), pa.nulls(len(ids), pa.list_(pa.int64()))], ["doc", "stretch", "counts"])
        if kind is not None:
            held = np.flatnonzero(counts)
            flat = np.column_stack([np.concatenate([[-1], held]), np.concatenate([[documents], counts[held]])]).ravel().tolist()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.list_(pa.int32())), pa.array([flat], pa.list_(pa.int64()))], ["doc", "stretch", "counts"])

    kind = T.StructType([result["doc"], T.StructField("stretch", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.LongType()))])
    both = materialize(source.mapInArrow(passages, kind), "leak-passages")
    # The files are few and small for what a passage costs: spread them.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    found = both.where("stretch IS NOT NULL").select("doc", "stretch").repartition(tasks, F.xxhash64("doc", "stretch"))
    pairs = both.where("counts IS NOT NULL").select(F.explode(F.sequence(F.lit(0), F.size("counts") - 2, F.lit(2))).alias("i"), "counts")
    sums = pairs.select(F.col("counts")[F.col("i")].alias("word"), F.col("counts")[F.col("i") + 1].alias("n")).groupBy("word").agg(F.sum("n").alias("n"))
    frequency, documents = np.zeros(len(index.vocab)), 0
    for r in sums.toLocalIterator():  # one row a word of the block at most
        if r["word"] < 0:
            documents = r["n"]
        else:
            frequency[r["word"]] = r["n"]
    idf = (np.log((documents + 1) / (frequency + 1)) + 1).astype(np.float32)
    item_arrow = to_arrow_type(result["item"].dataType)
    latent = spark.sparkContext.broadcast(_Latent(index, idf, _basis(found, index, idf, rank, seed), loss, share))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = latent.value
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = [np.array(s, np.int32) for s in b.column(1).slice(at, 512).to_pylist()]
                rows = tool.judge(part)
                if not rows:
                    continue
                place, item, *rest = zip(*rows)
                ids = pa.array([tool.index.ids[i] for i in item], item_arrow)
                words = pa.array(tool.index.length[list(item)].astype(np.int32))
                columns = [pa.array(c, t) for c, t in zip(rest, (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.array(place) + at)), ids, words, *columns], result.names)

    return found.mapInArrow(search, result)
