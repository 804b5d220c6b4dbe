"""Distributed row index inside groups (zipWithIndex, contiguous folds).

``row_number() over (partition by g order by k)`` sends a whole group to one
task; with few groups (10 buckets) that is 10 tasks holding everything.  The
index is built the way ``zipWithIndex`` does it instead:

1. range-partition on (group, order) and sort inside partitions, so a hot
   group is spread over many partitions;
2. tag rows with (partition id, place in the partition);
3. count rows per (partition, group) -- at most partitions + groups rows;
4. prefix sums of those counts give each span's start; join them back.

The span table is written; it is broadcast if its bytes are in the limit of
``join_small``, else joined on (partition id, group), which no hot group
holds up: its rows are spread over partition ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.joins import join_small
from kiln.session import materialize, partitions_for

#: Bytes of input files for a partition of the sort.  Column files unpack to
#: ten times as many bytes of rows, and a partition should be sorted in memory.
PARTITION_BYTES = 32 << 20


def _place_in_partition():
    """0-based place of a row in its partition (below 2^33)."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def index_within_groups(df: DataFrame, group_cols: list[str], order_cols: list[str],
                        index_col: str = "idx", num_partitions: int | None = None,
                        size_col: str | None = None, keep_cols: list[str] | None = None) -> DataFrame:
    """0-based position of each row inside its group, in ``order_cols`` order
    (NULL first; rows with a NULL group form a group).

    ``order_cols`` must give a total order inside a group for the result to be
    repeatable (ties get arbitrary but distinct positions).  ``size_col``
    also attaches the group's row count, summed from the span table (no
    extra pass over the rows).  ``keep_cols`` limits the written columns
    (order columns are only needed for the sort).
    """
    n = num_partitions or partitions_for(df, PARTITION_BYTES)
    keys = [*group_cols, *order_cols]
    tagged = (df.repartitionByRange(n, *keys)
                .sortWithinPartitions(*keys)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", _place_in_partition()))
    if keep_cols is not None:
        tagged = tagged.select(*dict.fromkeys([*group_cols, *keep_cols, "_pid", "_mid"]))
    # Fix the ids once: later passes read the same rows with the same ids.
    tagged = materialize(tagged, compression="zstd")
    spans = tagged.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    w = Window.partitionBy(*group_cols).orderBy("_pid") if group_cols else Window.orderBy("_pid")
    spans = spans.withColumn("_before", F.sum("_cnt").over(w) - F.col("_cnt"))
    keep = ["_pid", *group_cols, "_first", "_before"]
    if size_col:
        whole = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
        spans = spans.withColumn(size_col, F.sum("_cnt").over(whole))
        keep.append(size_col)
    out = join_small(tagged, materialize(spans.select(*keep), "spans"), ["_pid", *group_cols])
    return (out.withColumn(index_col, F.col("_mid") - F.col("_first") + F.col("_before"))
               .drop("_pid", "_mid", "_first", "_before"))


def zip_with_index(df: DataFrame, order_cols: list[str], index_col: str = "idx") -> DataFrame:
    """Global contiguous index in a defined order (J9 zipWithIndex)."""
    return index_within_groups(df, [], order_cols, index_col=index_col)


def zip_with_unique_id(df: DataFrame, id_col: str = "uid") -> DataFrame:
    """Unique ids k, n+k, 2n+k ... per partition k (J9 zipWithUniqueId)."""
    n = df.rdd.getNumPartitions()
    w_local = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    return df.withColumn(id_col, w_local * F.lit(n) + F.spark_partition_id())
