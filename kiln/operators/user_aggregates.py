"""Aggregation under user functions: typed accumulators, reduced in the tasks
that read the rows and merged in a tree.

An accumulator is a tuple or list in the order of its DDL (arrays and structs
allowed).  A task keeps one per key over all its rows and sends it when it
holds ``HELD_KEYS`` keys; so a hot key sends a few accumulators per task,
never its rows.  They are merged in ``depth`` shuffles: in each, those of a
key meet by the number of the task that sent them, modulo ``FAN_IN`` to the
power of the levels that are left; the last merge of a key sees at most
``FAN_IN`` accumulators if ``depth`` is 2 or more.  Merging goes over sorted
rows and holds one accumulator.

``comb`` must be associative and commutative, and the zero value neutral.
NULL is a key like any other, and values reach the functions as they are
(None for NULL).  A zero value is copied for every key, so functions may change
it in place.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

HELD_KEYS, FAN_IN = 1 << 17, 32
SEND_ROWS = 10_000


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def combine_by_key(df: DataFrame, keys: list[str], values: list[str], create: Callable[[tuple], tuple], seq: Callable[[tuple, tuple], tuple],
                   comb: Callable[[tuple, tuple], tuple], schema: str, depth: int = 2) -> DataFrame:
    """(keys, accumulator columns): per key the accumulator made by
    ``create`` from its first row and by ``seq`` from each further one within
    a task, merged by ``comb``."""
    if depth < 1:
        raise ValueError("depth must be 1 or more")
    rows = df.select(*keys, *values)
    typed = StructType([rows.schema[k] for k in keys] + StructType.fromDDL(schema).fields)
    arrow, n = to_arrow_schema(typed), len(keys)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}

        def send() -> Iterator[pa.RecordBatch]:
            out = [(*k, *acc) for k, acc in held.items()]
            held.clear()
            for at in range(0, len(out), SEND_ROWS):
                yield _batch(out[at:at + SEND_ROWS], arrow)

        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            for row in zip(*columns):
                key, value = row[:n], row[n:]
                held[key] = seq(held[key], value) if key in held else create(value)
            if len(held) >= HELD_KEYS:
                yield from send()
        yield from send()

    out = rows.mapInArrow(partial, typed).withColumn("_task", F.spark_partition_id())
    for level in range(depth - 1, -1, -1):
        out = _merge(out.withColumn("_task", F.pmod("_task", F.lit(FAN_IN ** level))), keys, typed, comb)
    return out.drop("_task")


def _merge(rows: DataFrame, keys: list[str], typed: StructType, comb: Callable) -> DataFrame:
    """One row per key and ``_task``."""
    n = len(keys)
    whole = StructType([*typed.fields, StructField("_task", IntegerType())])
    arrow = to_arrow_schema(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, acc, out = None, None, []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                key, value = (*row[:n], row[-1]), row[n:-1]
                if key == current:
                    acc = comb(acc, value)
                    continue
                if current is not None:
                    out.append((*current[:-1], *acc, current[-1]))
                    if len(out) == SEND_ROWS:
                        yield _batch(out, arrow)
                        out = []
                current, acc = key, value
        if current is not None:
            yield _batch([*out, (*current[:-1], *acc, current[-1])], arrow)

    by = [*keys, "_task"]
    return rows.select(*whole.names).repartition(*by).sortWithinPartitions(*by).mapInArrow(run, whole)


def aggregate_by_key(df: DataFrame, keys: list[str], values: list[str], zero: tuple, seq: Callable[[tuple, tuple], tuple],
                     comb: Callable[[tuple, tuple], tuple], schema: str, depth: int = 2) -> DataFrame:
    """``aggregateByKey``: from a copy of ``zero`` per key and task."""
    return combine_by_key(df, keys, values, lambda value: seq(copy.deepcopy(zero), value), seq, comb, schema, depth)


def fold_by_key(df: DataFrame, keys: list[str], values: list[str], zero: tuple, func: Callable[[tuple, tuple], tuple], depth: int = 2) -> DataFrame:
    """``foldByKey``: one function for rows and accumulators, which have the
    types of the value columns."""
    return aggregate_by_key(df, keys, values, zero, func, func, _ddl(df, values), depth)


def reduce_by_key(df: DataFrame, keys: list[str], values: list[str], func: Callable[[tuple, tuple], tuple], depth: int = 2) -> DataFrame:
    """``reduceByKey``: a key's first row is its first accumulator."""
    return combine_by_key(df, keys, values, lambda value: value, func, func, _ddl(df, values), depth)


def _ddl(df: DataFrame, values: list[str]) -> str:
    return ", ".join(f"`{v}` {df.schema[v].dataType.simpleString()}" for v in values)


def tree_aggregate(df: DataFrame, values: list[str], zero: tuple, seq: Callable[[tuple, tuple], tuple], comb: Callable[[tuple, tuple], tuple],
                   schema: str, depth: int = 2) -> DataFrame:
    """One row: the accumulator of all rows; the zero value of an empty table
    (``aggregate``, ``fold``, ``treeAggregate``)."""
    rows = _tree(df, values, lambda value: seq(copy.deepcopy(zero), value), seq, comb, schema, depth)
    none = df.sparkSession.createDataFrame([tuple(zero)], rows.schema)
    return _single(rows.unionByName(none), comb)


def tree_reduce(df: DataFrame, values: list[str], func: Callable[[tuple, tuple], tuple], depth: int = 2) -> DataFrame:
    """One row: all rows reduced (``reduce``, ``treeReduce``); an empty table
    is an error."""
    rows = _tree(df, values, lambda value: value, func, func, _ddl(df, values), depth)
    marked = rows.withColumn("_none", F.lit(False))
    none = df.sparkSession.createDataFrame([(*[None] * len(rows.columns), True)], marked.schema)
    typed, arrow = rows.schema, to_arrow_schema(rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc, seen = None, False
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                seen = True
                if not row[-1]:
                    acc = row[:-1] if acc is None else func(acc, row[:-1])
        if seen:
            if acc is None:
                raise ValueError("can't reduce an empty table")
            yield _batch([acc], arrow)

    return marked.unionByName(none).repartition(1).mapInArrow(run, typed)


def _tree(df: DataFrame, values: list[str], create: Callable, seq: Callable, comb: Callable, schema: str, depth: int) -> DataFrame:
    return combine_by_key(df.withColumn("_all", F.lit(0)), ["_all"], values, create, seq, comb, schema, depth).drop("_all")


def _single(rows: DataFrame, comb: Callable) -> DataFrame:
    """At most a few rows in one."""
    typed, arrow = rows.schema, to_arrow_schema(rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                acc = row if acc is None else comb(acc, row)
        if acc is not None:
            yield _batch([tuple(acc)], arrow)

    return rows.repartition(1).mapInArrow(run, typed)
