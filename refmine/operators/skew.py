"""Joins and aggregates whose keys may be very uneven.

``eager_join_aggregate`` and ``top_item_states`` never move raw rows by a join key: each
input is reduced to one compact state a key before anything is joined.
``hot_key_join`` is for joins that must keep their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: A key is hot with more than 1/HOT_PARTS of the rows, so fewer than HOT_PARTS keys are hot.
HOT_PARTS = 512


def eager_join_aggregate(left: DataFrame, right: DataFrame, key: str, left_sums: Sequence[str] = (), right_sums: Sequence[str] = (), rollup: str | None = None) -> DataFrame:
    """``SELECT key, count(*) AS pairs, sum(...) FROM left JOIN right USING (key) GROUP BY key`` without the join's rows.

    Both inputs are aggregated by key first (with map-side partial aggregation, so that a
    hot key leaves one row a task); only these states are joined. The count of the join is
    the product of the counts, and a sum over one side is that side's sum times the other
    side's count. Counts and sums are DECIMAL(38,0), since products outgrow BIGINT.

    ``rollup``: a column of ``left`` that the key determines no further; the states of
    ``left`` are then kept by (key, rollup) and the result is by ``rollup`` alone.

    Null keys join nothing. Sums skip nulls; a side whose values are all null sums to null.
    Empty inputs give an empty result. Other columns, whatever their names, are not read.
    """
    wide = "decimal(38,0)"
    by = [key] + ([rollup] if rollup else [])

    def state(df: DataFrame, keys: list[str], sums: Sequence[str], side: str) -> DataFrame:
        picked = df.where(F.col(key).isNotNull()).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(s).alias(f"_{side}s{i}") for i, s in enumerate(sums)])
        return picked.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias(f"_{side}n"), *[F.sum(f"_{side}s{i}").alias(f"_{side}s{i}") for i in range(len(sums))])

    joined = state(left, by, left_sums, "l").join(state(right, [key], right_sums, "r"), "_k0")
    out: list[Column] = [(F.col("_ln").cast("decimal(19,0)") * F.col("_rn").cast("decimal(19,0)")).cast(wide).alias("pairs")]
    out += [(F.col(f"_ls{i}").cast("decimal(19,0)") * F.col("_rn").cast("decimal(19,0)")).cast(wide).alias(f"sum_{s}") for i, s in enumerate(left_sums)]
    out += [(F.col(f"_rs{i}").cast("decimal(19,0)") * F.col("_ln").cast("decimal(19,0)")).cast(wide).alias(f"sum_{s}") for i, s in enumerate(right_sums)]
    result = joined.select(F.col("_k1" if rollup else "_k0").alias(rollup or key), *out)
    if rollup:
        names = [c for c in result.columns if c != rollup]
        result = result.groupBy(rollup).agg(*[F.sum(c).cast(wide).alias(c) for c in names])
    return result


def top_item_states(entries: DataFrame, key: str, item: str) -> DataFrame:
    """One row a key: (key, entries, items, top_item, top_entries).

    ``top_item`` has the most entries; among equals it is the smallest. Entries with a null
    key or item don't count. Both are BIGINT.

    Two levels of aggregation: by (key, item), which spreads a hot key over its items and
    leaves a hot pair one row a task, then by key over at most one row a task and key. The
    ordering (count, then smallest item) is packed into one DECIMAL, so that both levels
    stay hash aggregates of fixed width.
    """
    # An item's rank among equals, always in 0 .. 2e19: the smaller the item the larger the rank.
    span, top = F.lit(str(2 * 10**19)).cast("decimal(20,0)"), F.lit(str(2**63 - 1)).cast("decimal(19,0)")
    pairs = (
        entries.select(F.col(key).cast("long").alias("_k"), F.col(item).cast("long").alias("_i"))
        .where(F.col("_k").isNotNull() & F.col("_i").isNotNull())
        .groupBy("_k", "_i")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    packed = (F.col("_n").cast("decimal(17,0)") * span + (top - F.col("_i").cast("decimal(19,0)"))).cast("decimal(38,0)")
    states = pairs.groupBy("_k").agg(F.sum("_n").alias("entries"), F.count(F.lit(1)).alias("items"), F.max(packed).alias("_top"))
    rank = F.pmod(F.col("_top"), span)
    return states.select(
        F.col("_k").alias(key),
        "entries",
        "items",
        (top - rank).cast("long").alias("top_item"),
        F.call_function("div", F.col("_top"), span).alias("top_entries"),
    )


def join_item_states(states: dict[str, DataFrame], key: str) -> DataFrame:
    """Full outer join of the states of several inputs, one row a key.

    Each input adds the columns ``<name>__entries``, ``__items``, ``__top_item`` and
    ``__top_entries``, null where it lacks the key. All states are already partitioned by
    the key, so the join adds no exchange.
    """
    joined: DataFrame | None = None
    for name, df in states.items():
        own = df.select(key, *[F.col(c).alias(f"{name}__{c}") for c in ("entries", "items", "top_item", "top_entries")])
        joined = own if joined is None else joined.join(own, key, "full_outer")
    if joined is None:
        raise ValueError("no inputs")
    return joined


def top_items(inputs: dict[str, DataFrame], key: str, item: str, name_column: str = "field_name") -> DataFrame:
    """Rows (name_column, key, top_item, top_entries, entries, items), one an input and key that it has."""
    joined = join_item_states({n: top_item_states(df, key, item) for n, df in inputs.items()}, key)
    per = [
        F.struct(F.lit(n).alias(name_column), *[F.col(f"{n}__{c}").alias(c) for c in ("top_item", "top_entries", "entries", "items")])
        for n in inputs
    ]
    rows = joined.select(key, F.explode(F.array(*per)).alias("_r")).select(f"_r.{name_column}", key, "_r.top_item", "_r.top_entries", "_r.entries", "_r.items")
    return rows.where(F.col("entries").isNotNull())


def hot_keys(df: DataFrame, keys: Sequence[str], parts: int = HOT_PARTS) -> DataFrame:
    """The keys with more than 1/parts of all rows: fewer than ``parts`` rows, whatever the input."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("_all"))
    return counts.where(F.col("_n") * parts > total.scalar()).select(*keys)


def hot_key_join(big: DataFrame, states: DataFrame, keys: Sequence[str], how: str = "inner", hot: DataFrame | None = None) -> DataFrame:
    """Join rows with a table that is unique in ``keys``, hot keys apart.

    Rows of hot keys stay where they are and meet a broadcast of their states: fewer than
    HOT_PARTS rows by construction. All other rows take the plain shuffle join, where no
    key has more than 1/HOT_PARTS of the rows. ``how``: inner or left. Null keys match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    keys = list(keys)
    # The mark is joined in too, so that the hot rows aren't shuffled.
    hot = F.broadcast((hot_keys(big, keys) if hot is None else hot).select(*keys).distinct().withColumn("_hot", F.lit(True)))
    marked = big.join(hot, keys, "left")
    hot_states = states.join(hot.select(*keys), keys, "left_semi")
    return (
        marked.where(F.col("_hot").isNotNull()).drop("_hot").join(F.broadcast(hot_states), keys, how)
        .unionByName(marked.where(F.col("_hot").isNull()).drop("_hot").join(states, keys, how))
    )
