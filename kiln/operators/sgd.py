"""Mini-batch gradient descent with proximal updaters, one Spark job a step.

If every row counts in every step (``fraction`` 1), the rows are packed once
into blocks of numbers, which the steps read.  Otherwise
every step takes the rows whose hash of (seed, step, row) lies below
``fraction``, averages their loss gradients and updates the weights on the
driver, which holds one number per feature.  A task folds its rows into one
gradient (numpy), and the gradients are summed position by position, so the
driver receives as many numbers as there are features whatever the tasks.
The sample of a step depends on the rows alone: a repeated task takes the same.

Step i has the rate ``step / sqrt(i)``.  Updaters: ``none``; ``l2`` shrinks the
weights by ``rate * reg`` before the step; ``l1`` takes ``rate * reg`` off their
size after it (soft threshold), so that weights become exactly 0.  An intercept
is one more weight with the constant 1, and is not regularised.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMS = "pos int, total double"

#: Rows of a block at most, and bytes of blocks a partition should have at most.
BLOCK_ROWS, PARTITION_BYTES = 1 << 14, 64 << 20


def _squared(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (margin - y) ** 2 / 2, margin - y


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.logaddexp(0, margin) - y * margin, 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y


def _hinge(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sign = 2 * y - 1
    inside = sign * margin < 1
    return np.where(inside, 1 - sign * margin, 0.0), np.where(inside, -sign, 0.0)


#: (loss, its derivative) by margin and label; labels of the last two are 0 or 1.
LOSSES = {"squared": _squared, "logistic": _logistic, "hinge": _hinge}


def shrink(weights: np.ndarray, gradient: np.ndarray, rate: float, updater: str, reg: float, free: np.ndarray) -> tuple[np.ndarray, float]:
    """(updated weights, penalty); ``free``: weights without regularisation."""
    if updater == "l2":
        new = weights * np.where(free, 1.0, 1 - rate * reg) - rate * gradient
        return new, 0.5 * reg * float((new[~free] ** 2).sum())
    new = weights - rate * gradient
    if updater == "l1":
        new = np.where(free, new, np.sign(new) * np.maximum(np.abs(new) - rate * reg, 0.0))
        return new, reg * float(np.abs(new[~free]).sum())
    return new, 0.0


@dataclass
class SgdModel:
    """``losses``: mean loss of each step's rows plus the penalty of the
    weights before it; ``history``: weights after every step, if kept."""
    weights: np.ndarray
    intercept: float
    losses: list[float]
    converged: bool
    history: list[np.ndarray] = field(default_factory=list)

    def margin(self, features: str) -> Column:
        """w . x + intercept of an array column, in the JVM."""
        w = F.array(*(F.lit(float(v)) for v in self.weights))
        products = F.zip_with(F.col(features).cast("array<double>"), w, lambda a, b: a * b)
        return F.aggregate(products, F.lit(self.intercept), lambda acc, v: acc + v)


def fit_sgd(df: DataFrame, features: str, label: str, loss: str = "squared", updater: str = "none", reg: float = 0.0, step: float = 1.0,
            iterations: int = 100, fraction: float = 1.0, initial: list[float] | None = None, intercept: bool = False,
            tolerance: float = 0.0, seed: int = 42, keep_history: bool = False) -> SgdModel:
    """Fit a linear model to an array column.  Rows without features or label
    don't count; a step whose sample is empty changes nothing.  Ends when the
    weights move by less than ``tolerance`` of their size (at least 1).
    ``initial`` may name the intercept as its last value."""
    if loss not in LOSSES:
        raise ValueError(f"unknown loss {loss!r}")
    if updater not in ("none", "l1", "l2"):
        raise ValueError(f"unknown updater {updater!r}")
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    rows = (df.select(F.col(features).cast("array<double>").alias("x"), F.col(label).cast("double").alias("y"))
            .where("x is not null and y is not null"))
    first = rows.select(F.size("x")).first()
    if first is None:
        raise ValueError("no row has features and a label")
    d = first[0] + intercept
    w = np.zeros(d)
    if initial is not None:
        if len(initial) not in (first[0], d):
            raise ValueError(f"expected {d} initial weights")
        w[:len(initial)] = initial
    free = np.zeros(d, bool)
    free[first[0]:] = True
    losses, history, converged, penalty = [], [], False, shrink(w, np.zeros(d), 0.0, updater, reg, free)[1]
    packed = fraction == 1 and iterations > 1
    if packed:
        rows = _packed(rows, first[0]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for i in range(1, iterations + 1):
            total, count, gradient = _gradient(rows, packed, w, loss, intercept, fraction, seed, i)
            if not count:
                continue
            losses.append(total / count + penalty)
            before = w
            w, penalty = shrink(w, gradient / count, step / np.sqrt(i), updater, reg, free)
            if keep_history:
                history.append(w)
            if np.linalg.norm(w - before) < tolerance * max(1.0, float(np.linalg.norm(w))):
                converged = True
                break
    finally:
        if packed:
            rows.unpersist()
    return SgdModel(w[:first[0]], float(w[-1]) if intercept else 0.0, losses, converged, history)


def _numbers(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of a batch of rows."""
    return np.asarray(b.column(0).flatten(), float).reshape(b.num_rows, -1), b.column(1).to_numpy(zero_copy_only=False)


def _packed(rows: DataFrame, width: int) -> DataFrame:
    """(block): the rows as blocks of doubles, rows x (features and label),
    dealt evenly over the tasks."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = _numbers(b)
                if x.shape[1] != width:
                    raise ValueError(f"expected rows of {width} features")
                whole = np.column_stack((x, y))
                yield pa.RecordBatch.from_arrays([pa.array([whole[s:s + BLOCK_ROWS].tobytes() for s in range(0, len(whole), BLOCK_ROWS)], pa.binary())], ["block"])

    sc = rows.sparkSession.sparkContext
    n_rows = rows.count()
    tasks = max(1, min(sc.defaultParallelism, -(-n_rows // BLOCK_ROWS)), -(-n_rows * 8 * (width + 1) // PARTITION_BYTES))
    return rows.mapInArrow(pack, "block binary").repartition(tasks)


def _gradient(rows: DataFrame, packed: bool, w: np.ndarray, loss: str, intercept: bool, fraction: float, seed: int, step: int) -> tuple[float, int, np.ndarray]:
    """(sum of losses, rows, sum of gradients) of a step's sample; ``packed``:
    whether the rows are blocks."""
    d, derive = len(w), LOSSES[loss]
    if fraction < 1:
        part = F.pmod(F.xxhash64(F.lit(seed), F.lit(step), "x", "y"), F.lit(1 << 53)) / F.lit(float(1 << 53))
        rows = rows.where(part < fraction)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for b in batches:
            if packed:
                for block in b.column(0):
                    whole = np.frombuffer(block.as_buffer()).reshape(-1, d - intercept + 1)
                    yield whole[:, :-1], whole[:, -1]
            elif b.num_rows:
                yield _numbers(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(d + 2)
        for x, y in parts(batches):
            if intercept:
                x = np.hstack([x, np.ones((len(x), 1))])
            values, slopes = derive(x @ w, y)
            sums += np.concatenate((x.T @ slopes, [values.sum(), len(x)]))
        if sums[-1]:
            yield pa.RecordBatch.from_arrays([pa.array(range(d + 2), pa.int32()), pa.array(sums)], ["pos", "total"])

    out = np.zeros(d + 2)
    for r in rows.mapInArrow(run, SUMS).groupBy("pos").agg(F.sum("total").alias("total")).collect():
        out[r["pos"]] = r["total"]
    return float(out[d]), int(out[d + 1]), out[:d]
