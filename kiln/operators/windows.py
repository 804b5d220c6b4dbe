"""Window functions that stay spread out when one group is huge.

``Window.partitionBy(g)`` puts each group in one task.  With a group
holding a third of the rows that task does a third of the work.  These
operators split every group over many partitions instead:

* positions come from ``index_within_groups`` (range partitioning on
  (group, order) + per-span offsets);
* offsets (lag/lead) become equi-joins on (group, position) -- the key is
  unique per row, so nothing is hot;
* bounded row frames run in bands of positions, wide ones from running
  aggregates;
* ranks come from per-peer-group min/max positions (a partial aggregate);
* running (unbounded preceding) aggregates are a partition-local window
  plus the prefix of earlier spans of the same group;
* value-range frames aggregate per (group, order value) first and run in
  bands of values as wide as the frame;
* what is known per group or value is joined back with its hot keys dealt
  over copies (``lookup``).

NULL is a group, an order value and a peer like any other (first in order),
as in SQL windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from kiln.operators.indexing import index_within_groups
from kiln.operators.joins import join_on, join_small, lookup
from kiln.session import materialize, partitions_for

#: Widest frame (rows) that a window adds up row by row, and rows of a band of wider ones at least.
NARROW_FRAME, BAND_ROWS = 24, 8192

_AGG = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}
#: How partial aggregates of a group are merged.
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def with_position(df: DataFrame, group: list[str], order: list[str], col: str = "_pos") -> DataFrame:
    """0-based position inside the group (``row_number() - 1``)."""
    return index_within_groups(df, group, order, index_col=col)


def row_number(df: DataFrame, group: list[str], order: list[str], out: str = "row_number") -> DataFrame:
    return with_position(df, group, order).withColumn(out, F.col("_pos") + 1).drop("_pos")


def ranks(df: DataFrame, group: list[str], order: list[str], tiebreak: list[str], ntile: int | None = None) -> DataFrame:
    """row_number, rank, dense_rank, percent_rank, cume_dist (and ntile).

    ``order`` defines peers; ``tiebreak`` makes row_number / ntile unique.
    """
    pos = index_within_groups(df, group, [*order, *tiebreak], index_col="_pos", size_col="_n")
    peers = pos.groupBy(*group, *order).agg(F.min("_pos").alias("_pfirst"), F.max("_pos").alias("_plast"))
    # dense rank: position of the peer value among the group's distinct values
    dense = index_within_groups(peers, group, order, index_col="_dense")
    x = lookup(pos, dense.withColumn("_peers", F.col("_plast") - F.col("_pfirst") + 1), [*group, *order], "_peers")
    n = F.col("_n")
    rn = F.col("_pos") + 1
    rank = F.col("_pfirst") + 1
    x = x.select(*df.columns, rn.alias("row_number"), rank.alias("rank"),
                 (F.col("_dense") + 1).alias("dense_rank"),
                 F.when(n <= 1, F.lit(0.0)).otherwise((rank - 1) / (n - 1)).alias("percent_rank"),
                 ((F.col("_plast") + 1) / n).alias("cume_dist"),
                 *([_ntile(rn, n, ntile).alias("ntile")] if ntile else []))
    return x


def _ntile(rn: Column, n: Column, b: int) -> Column:
    # first (n mod b) tiles hold q + 1 rows, the rest q rows (q = n div b)
    q = F.floor(n / F.lit(b))
    rem = n - q * F.lit(b)
    big = rem * (q + 1)
    return F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1) \
            .otherwise(rem + F.floor((rn - 1 - big) / F.greatest(q, F.lit(1))) + 1).cast("int")


def shift(df: DataFrame, group: list[str], order: list[str], col: str, offset: int,
          default=None, out: str | None = None) -> DataFrame:
    """lag (offset > 0) / lead (offset < 0) of ``col``: a join on
    (group, position - offset).  The default stands where there is no such
    row; a NULL of the row found stays NULL."""
    out = out or (f"lag_{col}" if offset > 0 else f"lead_{col}")
    pos = with_position(df, group, order)
    src = pos.select(*group, (F.col("_pos") + F.lit(offset)).alias("_pos"), F.col(col).alias(out), F.lit(True).alias("_found"))
    j = join_on(pos, src, [*group, "_pos"], "left")
    if default is not None:
        j = j.withColumn(out, F.when(F.col("_found"), F.col(out)).otherwise(F.lit(default)))
    return j.drop("_pos", "_found")


def rows_frames(df: DataFrame, group: list[str], order: list[str], col: str, lo: int, hi: int,
                outs: dict[str, str]) -> DataFrame:
    """``fn(col) over (rows between lo and hi)`` for each ``{out: fn}``.

    Positions are cut into bands as wide as the frame.  A row goes to its own
    band and to the one or two that hold rows with a frame over it, whatever
    the width, and the window runs per (group, band): its rows are at most
    three frames, so no group is held by one task.  A window adds up each frame
    anew, so frames of more than ``NARROW_FRAME`` rows are put together from
    running aggregates."""
    if lo > hi:
        raise ValueError("a frame must not end before it begins")
    width, at = hi - lo + 1, F.col("_pos")
    exact_mean = isinstance(df.schema[col].dataType, DecimalType) and "avg" in outs.values()
    if width > NARROW_FRAME and not exact_mean:
        return _wide_frames(df, group, order, col, lo, hi, outs)
    bands = F.array_distinct(F.array(*(F.floor((at - d) / width) for d in (hi, lo, 0))))
    sent = with_position(df, group, order).withColumn("_own", F.floor(at / width)).withColumn("_band", F.explode(bands))
    w = Window.partitionBy(*group, "_band").orderBy("_pos").rangeBetween(lo, hi)
    return (sent.withColumns({out: _AGG[fn](col).over(w) for out, fn in outs.items()})
            .where("_band = _own").drop("_pos", "_own", "_band"))


def _wide_frames(df: DataFrame, group: list[str], order: list[str], col: str, lo: int, hi: int, outs: dict[str, str]) -> DataFrame:
    """``rows_frames`` in time that doesn't grow with the frame.

    Positions are cut into cells as wide as the frame, so that a frame is the
    end of a cell and the beginning of the next, or one whole cell: running
    aggregates from the left and from the right of the cells, looked up at
    the frame's two ends.  Bands are some cells; rows near their edges go to the
    neighbours too."""
    width, at = hi - lo + 1, F.col("_pos")
    band = width * -(-BAND_ROWS // width)
    needed = dict.fromkeys(f for fn in outs.values() for f in (("sum", "count") if fn == "avg" else (fn,)))
    bands = F.array_distinct(F.array(*(F.floor((at - d) / band) for d in (hi, lo, 0))))
    sent = (with_position(df, group, order).withColumn("_own", F.floor(at / band)).withColumn("_band", F.explode(bands))
            .repartition(*group, "_band").withColumn("_cell", F.floor(at / width)))
    cell = Window.partitionBy(*group, "_band", "_cell")
    left = cell.orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    right = cell.orderBy(F.desc("_pos")).rowsBetween(Window.unboundedPreceding, 0)
    x = sent.withColumns({f"_r_{f}": _AGG[f](col).over(right) for f in needed}).withColumns({f"_l_{f}": _AGG[f](col).over(left) for f in needed})
    # a band's positions have no gap, so that a position is as many rows away;
    # beyond the group's last row its last one ends the frame
    along = Window.partitionBy(*group, "_band").orderBy("_pos")
    all_rows = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = {f: F.struct(at.alias("at"), F.col(f"_l_{f}").alias("v")) for f in needed}
    x = x.withColumns({
        **{f"_a_{f}": _away(F.struct(at.alias("at"), F.col(f"_r_{f}").alias("v")), lo, along) for f in needed},
        **{f"_b_{f}": F.coalesce(_away(e, hi, along), F.last(e).over(all_rows) if hi > 0 else F.lit(None)) for f, e in ends.items()}})
    first_cell, last_cell = F.floor((at + lo) / width), F.floor((at + hi) / width)
    both = {}
    for f in needed:
        begin, end = F.col(f"_a_{f}"), F.col(f"_b_{f}")
        # from the frame's first row to the end of its cell, unless that is the end's cell as well
        head = F.when(first_cell < last_cell, begin["v"])
        tail = F.when(F.floor(end["at"] / width) == last_cell, end["v"])
        both[f] = _both(f, head, tail)
    both = {f: F.coalesce(c, F.lit(0).cast("bigint")) if f == "count" else c for f, c in both.items()}
    found = {out: F.when(both["count"] > 0, both["sum"].cast("double") / both["count"]) if fn == "avg" else both[fn] for out, fn in outs.items()}
    return x.where("_band = _own").select(*(F.col(c) for c in df.columns if c not in outs), *(c.alias(out) for out, c in found.items()))


def _away(value: Column, rows: int, along) -> Column:
    """The value so many rows further on."""
    return F.lead(value, rows).over(along) if rows >= 0 else F.lag(value, -rows).over(along)


def rows_frame(df: DataFrame, group: list[str], order: list[str], col: str, lo: int, hi: int,
               fn: str, out: str) -> DataFrame:
    return rows_frames(df, group, order, col, lo, hi, {out: fn})


def runnings(df: DataFrame, group: list[str], order: list[str], outs: dict[str, tuple[str, str]],
             num_partitions: int | None = None) -> DataFrame:
    """``fn(col) over (partition by group order by order rows unbounded
    preceding)`` for each ``{out: (col, fn)}``, fn in sum / count / min / max.

    Range partitioning splits a hot group; each partition runs a local
    window, and the prefix of earlier spans of the group is merged in.
    """
    n = num_partitions or partitions_for(df)
    keys = [*group, *order]
    t = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
           .withColumn("_pid", F.spark_partition_id()))
    t = materialize(t)
    frame = Window.partitionBy("_pid", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = (Window.partitionBy(*group) if group else Window.partitionBy()).orderBy("_pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    spans = t.groupBy("_pid", *group).agg(*(_AGG[fn](col).alias(f"_span_{out}") for out, (col, fn) in outs.items()))
    spans = spans.select("_pid", *group, *(_MERGE[fn](f"_span_{out}").over(before).alias(f"_before_{out}") for out, (_, fn) in outs.items()))
    j = join_small(t, materialize(spans, "spans"), ["_pid", *group])
    local = {out: _AGG[fn](col).over(frame) for out, (col, fn) in outs.items()}
    return (j.withColumns(local)
             .withColumns({out: _both(fn, F.col(f"_before_{out}"), F.col(out)) for out, (_, fn) in outs.items()})
             .drop("_pid", *(f"_before_{out}" for out in outs)))


def _both(fn: str, a: Column, b: Column) -> Column:
    """Merge two partial aggregates; NULL stands for no values."""
    if fn == "min":
        return F.least(a, b)
    if fn == "max":
        return F.greatest(a, b)
    zero = F.lit(0)
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, zero) + F.coalesce(b, zero))


def running(df: DataFrame, group: list[str], order: list[str], col: str, fn: str, out: str,
            num_partitions: int | None = None) -> DataFrame:
    return runnings(df, group, order, {out: (col, fn)}, num_partitions)


def range_frame(df: DataFrame, group: list[str], order_col: str, col: str, lo: int, hi: int,
                fn: str, out: str) -> DataFrame:
    """``fn(col) over (partition by group order by order_col range between
    lo and hi)`` for sum / count / min / max on an integer order column.

    Rows are first merged per (group, order value).  Values are cut into
    bands as wide as the frame, and each merged row is sent to the one or two
    bands that hold rows with a frame over it; the window then runs per
    (group, band), so a hot group is spread over its bands.  Rows with a NULL
    order value frame each other.
    """
    width = hi - lo + 1
    per_value = df.groupBy(*group, order_col).agg(_AGG[fn](col).alias("_v"), F.count(F.lit(1)).alias("_rows"))
    value = F.col(order_col)
    bands = F.array_distinct(F.array(*(F.floor((value - d) / width) for d in (hi, lo, 0))))
    sent = per_value.withColumn("_own", F.floor(value / width)).withColumn("_band", F.explode(bands))
    w = Window.partitionBy(*group, "_band").orderBy(order_col).rangeBetween(lo, hi)
    framed = (sent.withColumn(out, _MERGE[fn]("_v").over(w)).where(F.col("_band").eqNullSafe(F.col("_own")))
              .drop("_v", "_own", "_band"))
    if fn == "count":
        framed = framed.fillna(0, [out])
    return lookup(df, framed, [*group, order_col], "_rows")


def group_total(df: DataFrame, group: list[str], col: str, fn: str, out: str) -> DataFrame:
    """``fn(col) over (partition by group)`` (unbounded both sides): a
    partial aggregate joined back."""
    if not group:
        return df.withColumn(out, F.lit(df.agg(_AGG[fn](col)).first()[0]))
    return lookup(df, df.groupBy(*group).agg(_AGG[fn](col).alias(out), F.count(F.lit(1)).alias("_rows")), group, "_rows")
