"""Distributed matrices as tables, and their conversions.

* coordinate: (i, j, v), one row per entry;
* indexed rows: (i, entries), entries as an array of (j, v) by column, as
  long as the matrix has columns at most;
* blocks: (block_row, block_col, entries), entries as an array of (r, c, v)
  within the block, at most rows_per_block x cols_per_block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def from_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Coordinate form of one vector per row."""
    return df.select(F.col(id_col).cast("bigint").alias("i"), F.posexplode(F.col(vector_col).cast("array<double>")).alias("j", "v")) \
             .select("i", F.col("j").cast("bigint").alias("j"), "v")


def to_rows(coo: DataFrame) -> DataFrame:
    return coo.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "v"))).alias("entries"))


def rows_to_coordinate(rows: DataFrame) -> DataFrame:
    return rows.select("i", F.inline("entries"))


def to_blocks(coo: DataFrame, rows_per_block: int, cols_per_block: int) -> DataFrame:
    r, c = F.col("i") % rows_per_block, F.col("j") % cols_per_block
    placed = coo.select(F.floor(F.col("i") / rows_per_block).alias("block_row"), F.floor(F.col("j") / cols_per_block).alias("block_col"),
                        F.struct(r.alias("r"), c.alias("c"), F.col("v")).alias("entry"))
    return placed.groupBy("block_row", "block_col").agg(F.array_sort(F.collect_list("entry")).alias("entries"))


def blocks_to_coordinate(blocks: DataFrame, rows_per_block: int, cols_per_block: int) -> DataFrame:
    return blocks.select("block_row", "block_col", F.inline("entries")).select(
        (F.col("block_row") * rows_per_block + F.col("r")).alias("i"), (F.col("block_col") * cols_per_block + F.col("c")).alias("j"), "v")


def dimensions(coo: DataFrame) -> DataFrame:
    """(rows, cols, entries): one past the largest indices."""
    return coo.agg((F.max("i") + 1).alias("rows"), (F.max("j") + 1).alias("cols"), F.count(F.lit(1)).alias("entries"))
