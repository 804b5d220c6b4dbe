"""Keyed streaming state under user functions, in a state store.

* ``reduce_by_key_and_window``: sliding windows kept up by a function and its
  inverse.  Per key the store holds one partial value per pane (a slide long)
  and the value of the current window; a slide adds the pane that has closed
  and takes off the one that has left, so a row is reduced once, however many
  windows it is in.
* ``update_state_by_key``: a user function of a key's new values and its old
  state, called for every key after every batch; ``None`` removes the key.
* ``group_by_key_and_window``: the rows of each window and key in long form,
  with their positions.

Rows are reduced (or, for the state function, optionally shrunk) in the task
that reads them, so a hot key sends a few partial values per task.  A NULL key
is a key like any other; keys are of types that text can hold.  Values and
states are tuples in the order of their DDL; user functions get and return such
tuples.  Give values that aren't NULL (coalesce them before).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, DataType, IntegerType, LongType, StructField, StructType

from kiln.operators.indexing import index_within_groups
from kiln.streaming.runner import run_append, run_batches

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
NO_ROWS = "spark.sql.streaming.noDataMicroBatches.enabled"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Keys that a task holds before it sends their partial values.
HELD_KEYS = 1 << 17


@contextmanager
def state_store(spark: SparkSession, without_rows: bool = True):
    """Streams started inside keep their state in the store that state of
    one's own needs.  ``without_rows``: whether batches without rows may run
    (they pass a moved watermark on; with timers of the clock they'd never end)."""
    names = (PROVIDER, NO_ROWS)
    old = [spark.conf.get(n) for n in names]
    for n, v in zip(names, (STORE, str(without_rows).lower())):
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in zip(names, old):
            spark.conf.set(n, v)


def _frame(rows: list[tuple], schema: StructType) -> pd.DataFrame:
    """Rows as a frame whose integers stay integers beside NULLs."""
    return pd.DataFrame({f.name: pd.Series([r[k] for r in rows], dtype=object) for k, f in enumerate(schema.fields)})


def _plain(x):
    """A key's value as a Python value; pandas gives NULL as NaN."""
    if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
        return None
    return x.item() if hasattr(x, "item") else x


def _as_text(key: str) -> Column:
    """A key as text that is never NULL: the store's frames turn whole numbers
    beside a NULL into fractions."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias(key)


def _from_text(key: str, kind: DataType) -> Column:
    return F.when(F.col(key) != "", F.expr(f"substring(`{key}`, 2)")).cast(kind).alias(key)


def _rows(pdfs: Iterator[pd.DataFrame], columns: list[int]) -> Iterator[tuple]:
    """Columns by place: the frames don't keep every name."""
    for pdf in pdfs:
        yield from zip(*(pdf.iloc[:, k].tolist() for k in columns))


class _PaneWindows(StatefulProcessor):
    """Panes by number in a map, and (end, panes held, value) of the window
    that was sent last."""

    def __init__(self, values: StructType, out: StructType, slide_ms: int, panes: int, reduce: Callable, inverse: Callable, keep: Callable | None):
        self.values, self.out, self.slide_ms, self.n_panes = values, out, slide_ms, panes
        self.reduce, self.inverse, self.keep = reduce, inverse, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane bigint", self.values)
        self.window = handle.getValueState(
            "window", StructType([StructField("end", LongType()), StructField("held", IntegerType()), *self.values.fields]))

    def handleInputRows(self, key, rows, timerValues):
        n = len(self.values)
        for pane, *value in _rows(rows, [-n - 2, *range(-n, 0)]):
            held = self.panes.getValue((pane,))
            if held is None:
                self.handle.registerTimer((pane + 1) * self.slide_ms)
            self.panes.updateValue((pane,), tuple(value) if held is None else tuple(self.reduce(tuple(held), tuple(value))))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        closed = timerValues.getCurrentWatermarkInMs() // self.slide_ms      # all panes before have all their rows
        panes = {k[0]: tuple(v) for k, v in self.panes.iterator()}
        state = self.window.get() if self.window.exists() else None
        end, held, value = (state[0], state[1], tuple(state[2:])) if state else (None, 0, None)
        sent = []
        while True:
            if held:
                end += 1
            else:                                            # from an empty window on to the next pane
                ahead = [p for p in panes if end is None or p >= end]
                if not ahead:
                    break
                end = min(ahead) + 1
            if end > closed:
                end -= 1
                break
            if end - 1 in panes:
                value = panes[end - 1] if not held else tuple(self.reduce(value, panes[end - 1]))
                held += 1
            gone = end - 1 - self.n_panes
            if gone in panes:
                held -= 1
                value = tuple(self.inverse(value, panes.pop(gone))) if held else None
                self.panes.removeKey((gone,))
            if held and (self.keep is None or self.keep(value)):
                sent.append((*map(_plain, key), (end - self.n_panes) * self.slide_ms, end * self.slide_ms, *value))
        if held:
            self.window.update((end, held, *value))
            self.handle.registerTimer((end + 1) * self.slide_ms)
        else:
            self.window.clear()
        return iter([_frame(sent, self.out)] if sent else ())


def reduce_by_key_and_window(stream: DataFrame, name: str, keys: list[str], time_col: str, values: list[str], slide_s: int, panes: int,
                             reduce: Callable[[tuple, tuple], tuple], inverse: Callable[[tuple, tuple], tuple],
                             keep: Callable[[tuple], bool] | None = None, delay: str = "0 seconds", checkpoint: str | None = None) -> DataFrame:
    """(keys, window_start_ms, window_end_ms, values) of every window of
    ``panes`` slides that holds rows, per key, in epoch milliseconds; one row
    per slide.  Without keys all rows are one window's.

    ``values``: columns that make a row's value.  ``reduce`` must be
    associative and commutative and ``inverse(reduce(a, b), b)`` must be
    ``a``.  ``keep``: windows whose value it refuses aren't sent (their panes
    stay).  Rows later than the watermark (``delay``) and rows without a time
    are dropped."""
    spark = stream.sparkSession
    slide_us = slide_s * 1_000_000
    grouped = keys or ["all_rows"]
    rows = stream if keys else stream.withColumn("all_rows", F.lit(0))
    kinds = {k: rows.schema[k].dataType for k in grouped}
    rows = rows.where(F.col(time_col).isNotNull()).select(
        *map(_as_text, grouped), F.floor(F.unix_micros(F.col(time_col)) / slide_us).cast("bigint").alias("pane_no"), F.col(time_col).alias("pane_time"), *values)
    schema = to_arrow_schema(rows.schema)
    n_keys = len(grouped) + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}

        def send() -> pa.RecordBatch:
            out = [(*k, t, *v) for k, (t, v) in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                key, time, value = row[:n_keys], row[n_keys], row[n_keys + 1:]
                if key in held:
                    last, old = held[key]
                    held[key] = max(last, time), tuple(reduce(old, value))
                else:
                    held[key] = time, value
            if len(held) >= HELD_KEYS:
                yield send()
        if held:
            yield send()

    types = {f.name: f for f in rows.schema.fields}
    value_type = StructType([types[v] for v in values])
    out = StructType([*(types[k] for k in grouped), StructField("window_start_ms", LongType()), StructField("window_end_ms", LongType()),
                      *value_type.fields])
    with state_store(spark):
        windows = (rows.mapInArrow(partial, rows.schema).withWatermark("pane_time", delay).groupBy(*grouped)
                   .transformWithStateInPandas(_PaneWindows(value_type, out, slide_s * 1000, panes, reduce, inverse, keep),
                                               out, "append", "EventTime"))
        sent = run_append(windows, name, checkpoint)
    return sent.select(*(_from_text(k, kinds[k]) for k in keys), *(c for c in sent.columns if c not in grouped))


class _KeyState(StatefulProcessor):
    """The state with the time of the batch in which the function was called
    last, in one value: every access asks the store anew.  A timer for the next
    batch calls the function for keys without rows."""

    def __init__(self, n_values: int, state: StructType, out: StructType, update: Callable):
        self.n_values, self.state_type, self.out, self.update = n_values, state, out, update

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", StructType([*self.state_type.fields, StructField("called_at", LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        return self._call(key, list(_rows(rows, [*range(-self.n_values, 0)])), self.held.get(), timerValues.getCurrentProcessingTimeInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, held = timerValues.getCurrentProcessingTimeInMs(), self.held.get()
        # called in this batch, or removed: a timer from before may be left
        if held is None or held[-1] == now:
            return iter(())
        return self._call(key, [], held, now)

    def _call(self, key: tuple, new: list[tuple], held: tuple | None, now: int) -> Iterator[pd.DataFrame]:
        old = None if held is None else tuple(held)[:-1]
        state = self.update(new, old)
        if state is None:
            if old is not None:
                self.held.clear()
            changed = old is not None
        else:
            state = tuple(state)
            changed = state != old
            self.held.update((*state, now))
            self.handle.registerTimer(now + 1)
        if not changed:
            return iter(())
        return iter([_frame([(*map(_plain, key), state is None, *(state or [None] * len(self.state_type.fields)))], self.out)])


def update_state_by_key(stream: DataFrame, name: str, key: str, values: list[str], state: str,
                        update: Callable[[list[tuple], tuple | None], tuple | None],
                        shrink: Callable[[list[tuple]], list[tuple]] | None = None) -> DataFrame:
    """(batch_id, key, removed, state columns): a row for every change of a
    key's state; ``latest_state`` has what holds at the end.

    After each batch ``update(new values, old state)`` is called for every key
    with rows in the batch or with state, the values in no given order and the
    old state None if there is none; it returns the new state, or None to
    remove the key.  Only states that change are sent.  ``shrink``
    reduces the values of a key within a task before they are shuffled (for
    example to the largest few); the function must give the same for shrunk
    values."""
    spark = stream.sparkSession
    kind = stream.schema[key].dataType
    rows = stream.select(_as_text(key), *values)
    if shrink is not None:
        schema = to_arrow_schema(rows.schema)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict = {}

            def send() -> pa.RecordBatch:
                out = [(k, *v) for k, vs in held.items() for v in vs]
                held.clear()
                return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

            for b in batches:
                new: dict = {}
                for k, *value in zip(*(c.to_pylist() for c in b.columns)):
                    new.setdefault(k, []).append(tuple(value))
                for k, vs in new.items():
                    held[k] = shrink(held.get(k, []) + vs)
                if len(held) >= HELD_KEYS:
                    yield send()
            if held:
                yield send()

        rows = rows.mapInArrow(partial, rows.schema)
    state_type = StructType.fromDDL(state)
    out = StructType([rows.schema[key], StructField("removed", BooleanType()), *state_type.fields])
    with state_store(spark, without_rows=False):
        changes = rows.groupBy(key).transformWithStateInPandas(_KeyState(len(values), state_type, out, update), out, "update", "ProcessingTime")
        sent = run_batches(changes, name, lambda batch, _: batch, mode="update")
    return sent.withColumn(key, _from_text(key, kind))


def latest_state(changes: DataFrame, key: str) -> DataFrame:
    """(key, state columns) of the keys that aren't removed after the last batch."""
    rest = [c for c in changes.columns if c not in (key, "batch_id")]
    last = changes.groupBy(key).agg(F.max_by(F.struct(*rest), "batch_id").alias("_last"))
    return last.where(~F.col("_last.removed")).select(key, *(F.col(f"_last.{c}").alias(c) for c in rest if c != "removed"))


def group_by_key_and_window(stream: DataFrame, name: str, keys: list[str], time_col: str, width: str, slide: str, order: list[str]) -> DataFrame:
    """(keys, window_start, window_end, pos, other columns): the rows of every
    window and key in long form, with their 0-based positions in ``order``
    (``groupByKeyAndWindow``).

    A row is in width / slide windows and comes out once for each; no list of
    a group is built.  Positions are given to the written rows by spans of a
    range partitioning, so a hot key or window stays spread.  Rows without a
    time are in no window."""
    window = F.window(F.col(time_col), width, slide)
    rows = stream.where(F.col(time_col).isNotNull()).select("*", window.alias("_window"))
    rows = rows.select(*stream.columns, F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"))
    return index_within_groups(run_append(rows, name), ["window_start", *keys], order, index_col="pos")
