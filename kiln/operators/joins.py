"""Join helpers: null-safe equality on named columns, and a broadcast behind
a check of the side's bytes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType

#: Most bytes of rows that are sent to every executor.
BROADCAST_BYTES = 64 << 20


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of the same names where NULL equals NULL; the
    keys are the left side's (left, inner, semi and anti joins)."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys))
    return left.join(other, same, how).drop(*(f"_r_{k}" for k in keys))


def full_join_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer equi-join on columns of the same names where NULL equals
    NULL; the keys come from whichever side has the row."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys))
    rest = [c for c in [*left.columns, *right.columns] if c not in keys]
    return left.join(other, same, "full").select(*(F.coalesce(k, f"_r_{k}").alias(k) for k in keys), *rest)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a table's values, counted over all its rows: the lengths of
    strings and binaries, 8 bytes an element for the rest, and 16 a value."""
    def width(name: str, kind) -> Column:
        if isinstance(kind, (StringType, BinaryType)):
            return F.octet_length(name)
        if isinstance(kind, (ArrayType, MapType)):
            return 8 * F.size(name)
        return F.lit(8)

    row = reduce(lambda a, b: a + b, (F.coalesce(width(f.name, f.dataType), F.lit(0)) + 16 for f in df.schema.fields))
    return df.agg(F.sum(row.cast("bigint"))).first()[0] or 0


def join_small(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
               limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Null-safe join that broadcasts ``small`` if its measured bytes are in
    the limit.  Beyond it both sides are shuffled on the keys (AQE splits
    skewed partitions).  ``small`` should be cheap to read twice: a written
    table or a small aggregate."""
    if measured_bytes(small) <= limit_bytes:
        small = F.broadcast(small)
    return join_on(big, small, keys, how)


def lookup(big: DataFrame, small: DataFrame, keys: list[str], rows_col: str, how: str = "inner",
           limit_bytes: int = BROADCAST_BYTES, hot_rows: int = 1_000_000) -> DataFrame:
    """Null-safe join of rows with one row per key, where ``rows_col`` of
    ``small`` (dropped) counts the rows of ``big`` that have the key.

    A small side in the limit is broadcast.  Beyond it, a key of more than
    ``hot_rows`` rows is dealt over copies of its row: there are at most
    total / hot_rows such keys, so that their list is joined as a small side.
    """
    bare = small.drop(rows_col)
    if measured_bytes(bare) <= limit_bytes:
        return join_on(big, F.broadcast(bare), keys, how)
    parts = F.ceil(F.col(rows_col) / F.lit(hot_rows))
    hot = small.where(F.col(rows_col) > hot_rows).select(*keys, parts.alias("_parts"))
    dealt = (join_on(big, F.broadcast(hot), keys, "left")
             .withColumn("_part", F.when(F.col("_parts").isNull(), 0)
                         .otherwise(F.pmod(F.monotonically_increasing_id(), F.col("_parts"))).cast("bigint"))
             .drop("_parts"))
    copies = small.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(parts, F.lit(1)) - 1))).drop(rows_col)
    return join_on(dealt, copies, [*keys, "_part"], how).drop("_part")
