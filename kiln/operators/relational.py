"""Relational operators that need more than one built-in call."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def take_sample(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Exact-size uniform sample without replacement (``takeSample``).

    ``orderBy(rand).limit(n)`` plans as TakeOrderedAndProject: a bounded
    per-partition heap, then one merge of n x partitions rows.
    """
    return df.withColumn("_r", F.rand(seed)).orderBy("_r").limit(n).drop("_r")


def key_sample(df: DataFrame, key: str, modulus: int, residue: int) -> DataFrame:
    """Deterministic systematic sample: rows whose key falls in one residue class."""
    return df.where(F.pmod(F.col(key), F.lit(modulus)) == residue)


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """All rows of one key (``lookup``); a pushed-down filter on the scan."""
    return df.where(F.col(key) == F.lit(value))


def subtract_keep_duplicates(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` with no equal row in ``b``; duplicates of ``a`` stay.

    Unlike EXCEPT (distinct) and EXCEPT ALL (multiset difference).  Equality
    is null-safe on every column.
    """
    ra = a.alias("_a")
    rb = b.alias("_b")
    conds = [F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")) for c in a.columns]
    return ra.join(rb, reduce(lambda x, y: x & y, conds), "left_anti")


def drop_duplicates_first(df: DataFrame, subset: list[str], order: list[str]) -> DataFrame:
    """One row per ``subset`` key: the one first in ``order``.

    ``min(struct(order..., rest...))`` is a plain aggregate with a map-side
    partial step, so a hot key costs one partial row per partition.
    """
    rest = [c for c in df.columns if c not in subset and c not in order]
    agg = df.groupBy(*subset).agg(F.min(F.struct(*order, *rest)).alias("_m"))
    return agg.select(*subset, *[F.col(f"_m.{c}").alias(c) for c in [*order, *rest]])


def band_self_join(df: DataFrame, key: str, id_col: str, val: str, width: float) -> DataFrame:
    """Pairs (id1 < id2) with the same ``key`` and ``|val1 - val2| <= width``.

    The value axis is cut into bands of ``width``; the right side is copied
    into its own and both neighbour bands, so the join is an equi join on
    (key, band) and no pair outside neighbouring bands is ever formed.
    """
    band = F.floor(F.col(val) / F.lit(width)).cast("long")
    left = df.select(F.col(key).alias("_k"), F.col(id_col).alias("k1"), F.col(val).alias("_v1"),
                     band.alias("_band"))
    right = df.select(F.col(key).alias("_k"), F.col(id_col).alias("k2"), F.col(val).alias("_v2"),
                      F.explode(F.array(band - 1, band, band + 1)).alias("_band"))
    j = left.join(right, ["_k", "_band"])
    return j.where((F.col("k1") < F.col("k2")) & (F.abs(F.col("_v1") - F.col("_v2")) <= F.lit(width))) \
            .select("k1", "k2")


def cogroup(inputs: list[tuple[DataFrame, dict[str, Column]]], keys: list[str]) -> DataFrame:
    """Any number of inputs grouped by ``keys`` side by side (``cogroup``,
    ``groupWith``): (keys, one column per aggregate of every input); NULL
    where an input lacks the key.  NULL is a key like any other.

    Each input is reduced to a row per key before the rows meet, so a hot key
    never travels as a list, and the rows of all inputs meet in one shuffle.
    Aggregates may be of any type; their names must differ."""
    names = [name for _, aggs in inputs for name in aggs]
    if len(set(names)) < len(names):
        raise ValueError("aggregates of a cogroup must have different names")
    parts = [df.groupBy(*keys).agg(*(c.alias(name) for name, c in aggs.items())).withColumn("_input", F.lit(i))
             for i, (df, aggs) in enumerate(inputs)]
    every = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    own = {name: i for i, (_, aggs) in enumerate(inputs) for name in aggs}
    # the one row of an input that has the key, whatever its value
    return every.groupBy(*keys).agg(*(F.max_by(name, F.when(F.col("_input") == own[name], 1)).alias(name) for name in names))


def cogroup_aggregate(a: DataFrame, b: DataFrame, key: str, val: str,
                      names_a: tuple[str, str], names_b: tuple[str, str], digits: int = 2) -> DataFrame:
    """Two inputs grouped by ``key`` side by side: counts (0 where an input
    lacks the key) and rounded sums of ``val``."""
    def aggs(names: tuple[str, str]) -> dict[str, Column]:
        return {names[0]: F.count(F.lit(1)), names[1]: F.round(F.sum(val), digits)}

    j = cogroup([(a, aggs(names_a)), (b, aggs(names_b))], [key])
    return j.select(key, F.coalesce(names_a[0], F.lit(0)).alias(names_a[0]), names_a[1],
                    F.coalesce(names_b[0], F.lit(0)).alias(names_b[0]), names_b[1])


def null_safe_all(cols_a: list[Column], cols_b: list[Column]) -> Column:
    return reduce(lambda x, y: x & y, [x.eqNullSafe(y) for x, y in zip(cols_a, cols_b)])
