"""Cells that pack several values: infer the delimiters of each source, split, keep positions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from refmine.functions.text import is_blank, trim_u
from refmine.operators.skew import hot_key_join
from refmine.session import materialize, ship

#: Candidate delimiters. A slash counts only with white space on both sides.
CANDIDATES = (",", ";", "|", "\n", "\t", "<br>", " / ", "、", "；", "，", "｜")
#: Quote marks and what closes them.
QUOTES = {'"': '"', "'": "'", "“": "”", "«": "»"}

_WS = r"[\s\x1c-\x1f\x85]"
_SUFFIX = rf"(?:{_WS}*\(\+\d+\))"
_LINK = re.compile(r"(?:[a-z][a-z0-9+.-]*://\S+|(?:doi:\s*)?10\.\d{4,9}/\S+)(?:\s*\(\+\d+\))?", re.I)
_TRIM = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def _delimiter_regex(delimiter: str) -> str:
    if delimiter == " / ":
        return rf"{_WS}+/(?={_WS}|$)"
    if delimiter == "<br>":
        return rf"{_WS}*<[bB][rR]{_WS}*/?>"
    if delimiter == "\n":
        return rf"{_WS}*[\r\n]"
    return _WS + "*" + re.escape(delimiter)


@lru_cache(maxsize=256)
def _scanners(delimiters: tuple[str, ...]) -> tuple[re.Pattern, dict[str, re.Pattern], re.Pattern]:
    """For a set of delimiters: one delimiter, a quoted value by its opening mark, an unquoted value."""
    some = "|".join(_delimiter_regex(d) for d in delimiters) or r"(?!)"
    one = "|".join(f"({_delimiter_regex(d)})" for d in delimiters) or r"((?!))"
    end = rf"(?={_WS}*(?:{some}|$))"
    quoted = {}
    for o, c in QUOTES.items():
        e = re.escape(c)
        # A mark inside is escaped, doubled, or an apostrophe within a word.
        quoted[o] = re.compile(rf"{_WS}*{re.escape(o)}((?:[^{e}\\]++|\\.|{e}{e}|(?<=\w){e}(?=\w))*){e}({_SUFFIX}?){end}", re.S)
    first = set(r"\<") | set(" \t\r\n\f\v/\x1c\x1d\x1e\x1f\x85\xa0") | {d.strip(" ")[:1] for d in delimiters}
    plain = "".join(re.escape(x) for x in first if x)
    unquoted = re.compile(rf"(?:[^{plain}\s]++|\\.|(?!{some}).)*+", re.S)
    return re.compile(one), quoted, unquoted


_ESCAPED = re.compile(r"\\([^\w\s])", re.S)


_BRACKET = re.compile(r"\\.|\"(?:[^\"\\]|\\.)*\"|[\[\]]", re.S)


def _brackets_match(body: str) -> bool:
    """Whether the first bracket is open until the last: not so in ``[A], [B]``. Quoted and escaped ones don't count."""
    depth = 0
    for m in _BRACKET.finditer(body):
        depth += {"[": 1, "]": -1}.get(m[0], 0)
        if depth <= 0 and m.end() < len(body):
            return False
    return True


def _scan(cell: str | None, delimiters: Iterable[str]) -> tuple[list[str], list[str]]:
    """The pieces of a cell, empty ones too, and the delimiters between them."""
    if cell is None:
        return [], []
    body = cell.strip(_TRIM)
    if not body or body.lower() == "nan":
        return [], []
    if body[0] == "[" and body[-1] == "]" and _brackets_match(body):
        body = body[1:-1].strip(_TRIM)
    some = tuple(sorted(delimiters))
    one, quoted, unquoted = _scanners(some)
    pieces, between, at, n = [], [], 0, len(body)
    while True:
        start = at
        while start < n and body[start].isspace():
            start += 1
        m = quoted[body[start]].match(body, at) if start < n and body[start] in quoted else None
        if m:
            mark = QUOTES[body[start]]
            value = _ESCAPED.sub(r"\1", m[1].replace(mark * 2, mark)).strip(_TRIM)
            if value and m[2]:
                value += " " + m[2].strip(_TRIM)
        else:
            m = unquoted.match(body, at)
            value = _ESCAPED.sub(r"\1", m[0].strip(_TRIM))
        pieces.append(value)
        d = one.match(body, m.end())
        if not d:
            return pieces, between
        between.append(some[d.lastindex - 1])
        at = d.end()


def split_cell(cell: str | None, delimiters: Iterable[str] = CANDIDATES) -> list[str]:
    """The values of one cell, in order, without empty ones.

    Null, blank and ``nan`` cells give none. Brackets around a whole list, enclosing quotes,
    escapes, and white space around a value go; a doubled quote in a quoted value is one
    quote; delimiters that are quoted or escaped, and quotes elsewhere, are text. A count
    suffix after a quoted value is kept with it.
    """
    return [p for p in _scan(cell, delimiters)[0] if p]


def _kind(value: str) -> str:
    if _LINK.fullmatch(value):
        return "link"
    if any(c.isalpha() for c in value) and value.count("(") == value.count(")") and value.count('"') % 2 == 0:
        return "name"
    return "odd"


def score_cell(cell: str | None, candidates: Sequence[str] = CANDIDATES) -> list[dict]:
    """For each candidate found outside quotes: the pieces on either side of it, how many of
    them are of a regular type, and how often it occurs.

    A piece is regular when it is of the type of most pieces of the cell (link or name), so
    a candidate that cuts links or names into fragments scores low.
    """
    return _scored(*_scan(cell, candidates))


def _scored(pieces: list[str], between: list[str]) -> list[dict]:
    if not between:
        return []
    kinds = [_kind(p) if p else None for p in pieces]
    usual = "link" if 2 * kinds.count("link") >= sum(k is not None for k in kinds) else "name"
    found: dict[str, list[int]] = {}
    for i, d in enumerate(between):
        sides = [k for k in kinds[i : i + 2] if k]
        s = found.setdefault(d, [0, 0, 0])
        s[0] += len(sides)
        s[1] += sum(k == usual for k in sides)
        s[2] += 1
    return [{"delimiter": d, "pieces": n, "regular": r, "times": t} for d, (n, r, t) in found.items()]


_SCORE = T.StructType([T.StructField("delimiter", T.StringType()), T.StructField("pieces", T.IntegerType()), T.StructField("regular", T.IntegerType()), T.StructField("times", T.IntegerType())])


@F.arrow_udf(T.StructType([T.StructField("values", T.ArrayType(T.StringType())), T.StructField("scores", T.ArrayType(_SCORE))]))
def _scanned(cells: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("delimiter", pa.string()), ("pieces", pa.int32()), ("regular", pa.int32()), ("times", pa.int32())]))
    found = [_scan(c, CANDIDATES) for c in cells.to_pylist()]
    return pa.StructArray.from_arrays([pa.array([[p for p in pieces if p] for pieces, _ in found], pa.list_(pa.string())), pa.array([_scored(*f) for f in found], kind)], ["values", "scores"])


@F.arrow_udf(T.ArrayType(T.StringType()))
def _split(cells: pa.Array, delimiters: pa.Array) -> pa.Array:
    return pa.array([split_cell(c, d or ()) for c, d in zip(cells.to_pylist(), delimiters.to_pylist())], pa.list_(pa.string()))


def scan_cells(cells: DataFrame) -> DataFrame:
    """Cells (_source, _field, _cell, ...) with _values and _scores: split at every candidate, and how each candidate did."""
    return cells.withColumn("_s", _scanned("_cell")).withColumns({"_values": F.col("_s.values"), "_scores": F.col("_s.scores")}).drop("_s")


def infer_delimiters(scanned: DataFrame, min_score: float = 0.5, prior_pieces: int = 16, allowance: float = 0.1) -> DataFrame:
    """Accepted delimiters of each source: (_source, _field, _delimiters ARRAY<STRING>).

    ``scanned`` comes from ``scan_cells``. A candidate's regularity in a source is the mean
    over its cells of the share of regular pieces: each cell counts once, as two pieces, so
    no long cell can reject a delimiter that the others use. It is smoothed with
    ``prior_pieces`` pieces of the field as a whole so that a source of few cells can be
    judged. Its consistency is near 1 where it occurs about as often in every cell, by the
    spread of the logarithms of its counts; a consistent candidate may fall short of
    ``min_score`` by up to ``allowance``, an inconsistent one needs no more than it. Scores are sums, so that a source that holds most rows
    leaves one row a task and candidate; they are written once and read by all later steps.
    """
    seen = scanned.select("_source", "_field", F.explode("_scores").alias("_s"))
    # Candidates with nothing but empty pieces around them tell nothing.
    n, reg = F.count_if(F.col("_s.pieces") > 0) * 2.0, F.sum(F.try_divide(F.col("_s.regular") * 2.0, F.col("_s.pieces")))
    spread = F.var_pop(F.log2(F.col("_s.times") + F.lit(1.0)))
    by_source = materialize(seen.groupBy("_source", "_field", F.col("_s.delimiter").alias("_d")).agg(n.alias("_n"), F.coalesce(reg, F.lit(0.0)).alias("_reg"), spread.alias("_spread")), "delimiter-scores")
    # One row a field and candidate at most: bounded by the fields and CANDIDATES.
    by_field = by_source.groupBy("_field", "_d").agg(F.try_divide(F.sum("_reg"), F.sum("_n")).alias("_usual"))
    score = (F.col("_reg") + prior_pieces * F.coalesce("_usual", F.lit(0.0))) / (F.col("_n") + prior_pieces)
    consistency = F.col("_n") / (F.col("_n") + prior_pieces) / (1 + F.col("_spread"))
    return (
        by_source.join(F.broadcast(by_field), ["_field", "_d"])
        .where(score >= min_score - allowance * consistency)
        .groupBy("_source", "_field")
        .agg(F.sort_array(F.collect_set("_d")).alias("_delimiters"))
    )


def split_packed(df: DataFrame, id_column: str, fields: Sequence[str], source: str | Column | None = None, min_score: float = 0.5) -> DataFrame:
    """One row a value: (id_column, field_name, pos, item), pos from 1 over the values kept.

    ``source`` tells whose hand wrote a cell (a file, say); null is a source of its own. A
    source without any accepted delimiter keeps each cell as one value. Null, blank and
    ``nan`` cells give no rows, nor does an empty table. Repeated rows and repeated values
    are kept. Only ``id_column``, the fields and the source are read.

    Cells are scanned once, for all candidates, and written. A cell whose every delimiter is
    accepted in its source is split by that already: fewer candidates would give the same.
    The others are scanned again.
    """
    ship(df.sparkSession)
    src = F.lit("") if source is None else F.coalesce((F.col(source) if isinstance(source, str) else source).cast("string"), F.lit(""))
    cells = df.select(
        F.col(id_column).alias("_id"),
        src.alias("_source"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("_field"), F.col(f).cast("string").alias("_cell")) for f in fields])).alias("_c"),
    ).select("_id", "_source", "_c._field", "_c._cell")
    cells = cells.where(F.col("_cell").isNotNull() & ~is_blank("_cell") & (F.lower(trim_u("_cell")) != "nan"))
    scanned = materialize(scan_cells(cells), "cells-scanned")
    marked = hot_key_join(scanned, infer_delimiters(scanned, min_score), ["_source", "_field"], "left")
    none = F.array().cast("array<string>")
    settled = F.size(F.array_except(F.transform("_scores", lambda x: x["delimiter"]), F.coalesce("_delimiters", none))) == 0
    values = F.coalesce(F.when(settled, F.col("_values")), _split(F.when(~settled, F.col("_cell")), F.col("_delimiters")))
    return marked.select(
        F.col("_id").alias(id_column), F.col("_field").alias("field_name"), F.posexplode(values).alias("_p", "item")
    ).select(id_column, "field_name", (F.col("_p") + 1).cast("int").alias("pos"), "item")
