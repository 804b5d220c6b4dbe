"""The n items with the largest inner products for each of given queries.

The queries are a stated set (some users, some words); they are held against
all items in blocks of ``BLOCK_BYTES``, each broadcast.  A task multiplies its
items with a block in slices and keeps the best n per query; queries whose
n-th best no item of a slice can reach (by the product of the lengths) skip
it.  What tasks send, at most n rows per query and task, is cut to n in two
levels.  Pairs are never listed: the result is queries x n rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

BLOCK_BYTES, SLICE_ROWS, PARTS = 16 << 20, 4096, 32


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(rows, -1)


def top_inner_products(queries: DataFrame, items: DataFrame, n: int, query_id: str, query_vec: str, item_id: str, item_vec: str,
                       cosine: bool = False, exclude_same_id: bool = False) -> DataFrame:
    """(query id, item id, score, rank from 1), ``n`` rows per query or as
    many as there are items.  Ties go to the smaller item id.  With
    ``cosine``, products of the vectors scaled to length 1 (a zero vector
    scores 0).  Rows with a NULL id or vector don't take part."""
    spark = items.sparkSession
    own = queries.select(F.col(query_id).alias("id"), F.col(query_vec).cast("array<double>").alias("x")).where("id is not null and x is not null")
    all_items = (items.select(F.col(item_id).alias("item"), F.col(item_vec).cast("array<double>").alias("x"))
                 .where("item is not null and x is not null"))
    id_type, item_type = own.schema["id"].dataType, all_items.schema["item"].dataType
    schema = f"id {id_type.simpleString()}, item {item_type.simpleString()}, score double"
    size = own.agg(F.sum(F.size("x") * 8 + 16)).first()[0] or 0
    blocks = -(-int(size) // BLOCK_BYTES)
    parts = []
    for k in range(blocks):
        rows = own.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).collect()
        if rows:
            q = np.array([r["x"] for r in rows], float)
            shared = spark.sparkContext.broadcast(([r["id"] for r in rows], _unit(q) if cosine else q))
            parts.append(all_items.mapInArrow(_best(shared, n, cosine, exclude_same_id, to_arrow_type(id_type), to_arrow_type(item_type)), schema))
    if not parts:
        return spark.createDataFrame([], f"`{query_id}` {id_type.simpleString()}, `{item_id}` {item_type.simpleString()}, score double, rank int")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    order = [F.desc("score"), F.asc("item")]
    for by in (["id", "part"], ["id"]):
        rows = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS))) if len(by) == 2 else found
        found = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n)
    return found.select(F.col("id").alias(query_id if query_id != item_id else f"query_{query_id}"), F.col("item").alias(item_id), "score", "rank")


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1.0)


def _best(shared, n: int, cosine: bool, exclude_same_id: bool, id_type: pa.DataType, item_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        length = np.linalg.norm(q, axis=1)
        best: list[list[tuple]] = [[] for _ in ids]           # (-score, item), ascending
        least = np.full(len(ids), -np.inf)                    # score from which an item is among the best
        for b in batches:
            for at in range(0, b.num_rows, SLICE_ROWS):
                s = b.slice(at, SLICE_ROWS)
                x = _matrix(s.column(1), s.num_rows)
                if cosine:
                    x = _unit(x)
                reach = length * np.linalg.norm(x, axis=1).max(initial=0.0)
                use = np.flatnonzero(reach * (1 + 1e-12) >= least)
                if not len(use):
                    continue
                scores = q[use] @ x.T
                items = np.array(s.column(0).to_pylist(), object)
                for k, row in zip(use.tolist(), scores):
                    some = np.flatnonzero(row >= least[k])
                    if len(some) > n + 1:                     # all that tie with the n-th (one may be the query itself)
                        cut = np.partition(row[some], len(some) - n - 1)[len(some) - n - 1]
                        some = some[row[some] >= cut]
                    new = [(-row[j], items[j]) for j in some.tolist() if not (exclude_same_id and items[j] == ids[k])]
                    if new:
                        best[k] = sorted(best[k] + new)[:n]
                        if len(best[k]) == n:
                            least[k] = -best[k][-1][0]
        out = [(i, item, -score) for i, rows in zip(ids, best) for score, item in rows]
        for at in range(0, len(out), 10_000):
            part = out[at:at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], id_type), pa.array([r[1] for r in part], item_type),
                                              pa.array([float(r[2]) for r in part], pa.float64())], ["id", "item", "score"])

    return run
