"""How often each distinct term occurs, and in how many records, by burst tries.

Each worker counts into a burst trie: leaf containers are small tables of suffixes, and a
container that fills up bursts into a node with a container for each next character, so
prefixes get as deep as their terms are many. The workers' subtrees are then routed by
prefixes that adapt to the terms at hand: as many as there are tasks, each as short as
keeps its neighbours apart. A task gets the matching subtrees of all workers in the order
of their prefixes and merges them as tries, one after the other.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from refmine.functions.text import collapse_ws
from refmine.session import materialize, ship

#: Suffixes that a container holds before it bursts, and terms that a worker holds before it hands them on.
CONTAINER, HELD = 64, 300_000


class BurstTrie:
    """Counters [occurrences, records] by term."""

    __slots__ = ("root", "size")

    def __init__(self):
        # A node is [own counter or None, container of suffixes or None, children by character or None].
        self.root, self.size = [None, {}, None], 0

    def add(self, term: str, occurrences: int, records: int) -> None:
        self._add(self.root, term, occurrences, records)

    def _add(self, node: list, term: str, occurrences: int, records: int) -> None:
        depth = 0
        while node[2] is not None:
            if depth == len(term):
                if node[0] is None:
                    node[0] = [0, 0]
                    self.size += 1
                node[0][0] += occurrences
                node[0][1] += records
                return
            child = node[2].get(term[depth])
            if child is None:
                child = node[2][term[depth]] = [None, {}, None]
            node, depth = child, depth + 1
        suffix = term[depth:]
        counter = node[1].get(suffix)
        if counter is None:
            node[1][suffix] = [occurrences, records]
            self.size += 1
            if len(node[1]) > CONTAINER:
                self._burst(node)
            return
        counter[0] += occurrences
        counter[1] += records

    def merge(self, prefix: str, suffixes: list[str], occurrences: list[int], records: list[int]) -> None:
        """Take in a container that another trie has under a prefix: into the container in its place, or down the node there."""
        node, depth = self.root, 0
        while node[2] is not None and depth < len(prefix):
            child = node[2].get(prefix[depth])
            if child is None:
                child = node[2][prefix[depth]] = [None, {}, None]
            node, depth = child, depth + 1
        if node[2] is not None:
            for s, o, r in zip(suffixes, occurrences, records):
                self._add(node, s, o, r)
            return
        own, rest = node[1], prefix[depth:]
        for s, o, r in zip(suffixes, occurrences, records):
            counter = own.get(rest + s)
            if counter is None:
                own[rest + s] = [o, r]
                self.size += 1
            else:
                counter[0] += o
                counter[1] += r
        while len(node[1]) > CONTAINER:
            self._burst(node)
            if len(node[2]) > 1 or not (below := next(iter(node[2].values()), None)):
                return
            node = below

    @staticmethod
    def _burst(node: list) -> None:
        children: dict[str, list] = {}
        for suffix, counter in node[1].items():
            if suffix:
                children.setdefault(suffix[0], [None, {}, None])[1][suffix[1:]] = counter
            else:
                node[0] = counter
        node[1], node[2] = None, children

    def leaves(self) -> Iterator[tuple[str, list[str], list[list[int]]]]:
        """(prefix, suffixes, counters) of every container, and of nodes that are terms themselves."""
        todo = [("", self.root)]
        while todo:
            prefix, node = todo.pop()
            if node[0] is not None:
                yield prefix, [""], [node[0]]
            if node[1]:
                yield prefix, list(node[1]), list(node[1].values())
            for c, child in (node[2] or {}).items():
                todo.append((prefix + c, child))


_LEAF = "field int, prefix string, suffixes array<string>, occurrences array<bigint>, records array<bigint>"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of term lists to trie leaves; the records that hold any term of a field have a null prefix."""
    tries: dict[int, BurstTrie] = {}
    holding: dict[int, int] = {}
    for b in batches:
        for field, terms in enumerate(b.columns):
            trie = tries.setdefault(field, BurstTrie())
            for row in terms.to_pylist():
                if not row:
                    continue
                holding[field] = holding.get(field, 0) + 1
                if len(row) == 1:
                    trie.add(row[0], 1, 1)
                    continue
                times: dict[str, int] = {}
                for t in row:
                    times[t] = times.get(t, 0) + 1
                for t, n in times.items():
                    trie.add(t, n, 1)
            if trie.size >= HELD:
                yield from _leaf_batches(field, tries.pop(field))
    for field, trie in tries.items():
        yield from _leaf_batches(field, trie)
    for field, n in holding.items():
        yield _leaf_batch([(field, None, [None], [[0, n]])])


def _leaf_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int32()),
            pa.array([r[1] for r in rows], pa.string()),
            pa.array([r[2] for r in rows], pa.list_(pa.string())),
            pa.array([[c[0] for c in r[3]] for r in rows], pa.list_(pa.int64())),
            pa.array([[c[1] for c in r[3]] for r in rows], pa.list_(pa.int64())),
        ],
        ["field", "prefix", "suffixes", "occurrences", "records"],
    )


def _leaf_batches(field: int, trie: BurstTrie) -> Iterator[pa.RecordBatch]:
    rows = []
    for prefix, suffixes, counters in trie.leaves():
        rows.append((field, prefix, suffixes, counters))
        if len(rows) == 2000:
            yield _leaf_batch(rows)
            rows = []
    if rows:
        yield _leaf_batch(rows)


def _bounds(leaves: DataFrame, ranges: int) -> list[tuple[int, str]]:
    """At most ranges - 1 prefixes (field, prefix) that part the terms evenly; from 64 leaves a range, weighted by their terms."""
    first = F.concat("prefix", F.array_min("suffixes"))
    n = F.size("suffixes")
    # The largest keys log(u) / n of uniform u are a sample in which a leaf counts as often as it has terms.
    u = (F.pmod(F.xxhash64("field", "prefix", "suffixes"), F.lit(1 << 31)) + 0.5) / (1 << 31)
    sample = leaves.select("field", first.alias("term"), (F.log(u) / n).alias("k")).orderBy(F.desc("k")).limit(64 * ranges).select("field", "term").collect()
    terms = sorted((r["field"], r["term"]) for r in sample)
    bounds = set()
    for i in range(1, ranges):
        at = i * len(terms) // ranges
        if 0 < at < len(terms) and terms[at] != terms[at - 1]:
            (f, before), (g, term) = terms[at - 1], terms[at]
            same = 0
            while f == g and same < min(len(before), len(term)) and before[same] == term[same]:
                same += 1
            bounds.add((g, term[: same + 1] if f == g else ""))
    return sorted(bounds)


def _routed(bounds: list[tuple[int, str]]):
    """Leaves with the number of their range; a leaf that reaches over a bound is parted there."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for field, prefix, *columns in zip(*(c.to_pylist() for c in b.columns)):
                entries = sorted(zip(*columns))
                lo = bisect_right(bounds, (field, prefix + entries[0][0]))
                if lo == bisect_right(bounds, (field, prefix + entries[-1][0])):
                    rows.append((lo, field, prefix, *zip(*entries)))
                    continue
                parts: dict[int, list] = {}
                for e in entries:
                    parts.setdefault(bisect_right(bounds, (field, prefix + e[0])), []).append(e)
                rows += [(part, field, prefix, *zip(*es)) for part, es in parts.items()]
            if rows:
                columns = list(zip(*rows))
                lists = [pa.array([list(x) for x in c], pa.list_(t)) for c, t in zip(columns[3:], (pa.string(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()), *lists], ["part", "field", "prefix", "suffixes", "occurrences", "records"])

    return route


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves in the order of field and prefix to counted terms; no more is held than the subtree that leaves still fall in."""
    trie, field, root = BurstTrie(), None, ""
    for b in batches:
        for f, prefix, suffixes, occurrences, records in zip(*(b.column(i).to_pylist() for i in range(1, 6))):
            if f != field or not prefix.startswith(root):
                yield from _term_batches(field, root, trie)
                trie, field, root = BurstTrie(), f, prefix
            trie.merge(prefix[len(root) :], suffixes, occurrences, records)
    yield from _term_batches(field, root, trie)


def _term_batches(field: int | None, root: str, trie: BurstTrie) -> Iterator[pa.RecordBatch]:
    terms, occurrences, records = [], [], []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([field] * len(terms), pa.int32()), pa.array(terms, pa.string()), pa.array(occurrences, pa.int64()), pa.array(records, pa.int64())], ["field", "term", "occurrences", "records"])

    for prefix, suffixes, counters in trie.leaves():
        terms += [root + prefix + s for s in suffixes]
        occurrences += [c[0] for c in counters]
        records += [c[1] for c in counters]
        if len(terms) >= 10_000:
            yield batch()
            terms, occurrences, records = [], [], []
    if terms:
        yield batch()


def term_frequencies(df: DataFrame, fields: Sequence[str], rare_below: int = 3, common_above: float = 0.1) -> DataFrame:
    """(field_name, term, occurrences, records, holding, mark) for each distinct term of each list field.

    A term is an item in lower case, trimmed, inner white space one blank; null and blank
    items are none, null and empty lists hold none. ``records`` counts the rows that hold the
    term, repeated rows each; ``holding`` those that hold any term of the field. ``mark`` is
    'rare' below ``rare_below`` records, else 'common' above ``common_above`` of the holding
    rows, else null. An empty table gives no rows; other columns are not read.

    Rows aren't exploded before counting. A term of a third of all rows is one counter a
    worker. Only distinct terms are moved, once, as subtrees. The driver holds the bounds of
    the ranges, one a shuffle partition, and the sample they come from.
    """
    ship(df.sparkSession)
    lists = df.select(*[F.filter(F.transform(F.col(f), lambda x: collapse_ws(F.lower(x))), lambda x: x != "").alias(f"_f{i}") for i, f in enumerate(fields)])
    # Written once: finding the ranges' bounds would otherwise run the counting twice.
    leaves = materialize(lists.mapInArrow(_count, _LEAF), "trie-leaves")
    subtrees = leaves.where("prefix IS NOT NULL")
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    routed = subtrees.mapInArrow(_routed(_bounds(subtrees, ranges)), "part int, " + _LEAF)
    merged = routed.repartitionById(ranges, F.col("part")).sortWithinPartitions("field", "prefix").mapInArrow(_merged, "field int, term string, occurrences bigint, records bigint")
    holding = leaves.where("prefix IS NULL").groupBy("field").agg(F.sum(F.col("records")[0]).alias("holding"))  # one row a field
    names = F.array(*[F.lit(f) for f in fields])
    marked = merged.join(F.broadcast(holding), "field")
    # Exact: a tenth is no binary fraction.
    bound = F.lit(str(common_above)).cast("decimal(10,8)") * F.col("holding").cast("decimal(20,0)")
    mark = F.when(F.col("records") < rare_below, "rare").when(F.col("records").cast("decimal(20,0)") > bound, "common")
    return marked.select(names[F.col("field")].alias("field_name"), "term", "occurrences", "records", "holding", mark.alias("mark"))
