"""Seeded random columns (uniform, normal, log-normal, exponential,
Poisson, gamma) over a row id, so a recomputed task draws the same values.

Uniform/normal use Spark's ``rand``/``randn``; exponential and log-normal
are transforms of them; Poisson inverts a hash of the row id; gamma needs a
rejection sampler, which runs in a vectorised pandas UDF on such hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def uniform(seed: int) -> Column:
    return F.rand(seed)


def normal(seed: int) -> Column:
    return F.randn(seed)


def log_normal(mean: float, std: float, seed: int) -> Column:
    return F.exp(F.lit(mean) + F.lit(std) * F.randn(seed))


def exponential(mean: float, seed: int) -> Column:
    return -F.lit(mean) * F.log1p(-F.rand(seed))


def poisson(mean: float, seed: int, id_col: str) -> Column:
    """Counts by inversion of one uniform hash of (seed, id) per row: the
    same in every task and retry, whatever the batches."""
    steps = [math.exp(-mean)]
    while len(steps) < 20 or steps[-1] < 1 - 1e-15 and len(steps) < 20 * mean + 100:
        k = len(steps)
        steps.append(steps[-1] + math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1)))
    u = _hash_uniform(seed, F.col(id_col))
    return F.size(F.filter(F.array(*map(F.lit, steps)), lambda p: p < u)).cast("double")


def _hash_uniform(seed: int, *cols: Column) -> Column:
    return (F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 53)) + 0.5) / F.lit(float(1 << 53))


def _hash_normal(seed: int, *cols: Column) -> Column:
    """Box-Muller of two hashes."""
    return F.sqrt(-2 * F.log(_hash_uniform(seed, *cols))) * F.cos(2 * math.pi * _hash_uniform(seed + (1 << 32), *cols))


def gamma(shape: float, scale: float, seed: int, id_col: str) -> Column:
    """Marsaglia-Tsang sampling of a batch of ids at a time; each round draws
    from hashes of (seed, id, round), so a row's value depends on its id alone."""
    d = (shape if shape >= 1 else shape + 1) - 1 / 3
    c = 1 / math.sqrt(9 * d)

    @F.pandas_udf(DoubleType())
    def draw(ids: pd.Series) -> pd.Series:
        key = ids.to_numpy().astype(np.int64).view(np.uint64)

        def uniform(round_: int, part: int, keys: np.ndarray) -> np.ndarray:
            h = keys + np.uint64((0x9E3779B97F4A7C15 * (1 + seed * 4096 + round_ * 4 + part)) % (1 << 64))
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
            return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53) + 2.0 ** -54

        out, left, round_ = np.zeros(len(key)), np.arange(len(key)), 0
        while len(left):
            k = key[left]
            z = np.sqrt(-2 * np.log(uniform(round_, 0, k))) * np.cos(2 * np.pi * uniform(round_, 1, k))
            v = np.maximum(1 + c * z, 0) ** 3
            with np.errstate(divide="ignore"):
                good = (v > 0) & (np.log(uniform(round_, 2, k)) < z * z / 2 + d - d * v + d * np.log(v))
            out[left[good]] = d * v[good]
            left, round_ = left[~good], round_ + 1
        if shape < 1:
            out *= uniform(round_ + 1000, 3, key) ** (1 / shape)
        return pd.Series(out * scale)

    return draw(F.col(id_col))


def normal_vector(size: int, seed: int, id_col: str) -> Column:
    """``size`` standard normal values, drawn from the row's id."""
    return F.array(*(_hash_normal(seed * 1_000_003 + i, F.col(id_col)) for i in range(size)))


def vector(draw: Callable[[int], Column], size: int, seed: int) -> Column:
    """``size`` independent values of one row: ``draw`` makes a column from a
    seed, and each element has a seed of its own."""
    return F.array(*(draw(seed * 1_000_003 + i) for i in range(size)))


def uniform_vector(size: int, seed: int, id_col: str) -> Column:
    """Uniform in (0, 1); like all vectors here, drawn from the row's id."""
    return vector(lambda s: _hash_uniform(s, F.col(id_col)), size, seed)


def log_normal_vector(mean: float, std: float, size: int, seed: int, id_col: str) -> Column:
    return vector(lambda s: F.exp(F.lit(float(mean)) + F.lit(float(std)) * _hash_normal(s, F.col(id_col))), size, seed)


def exponential_vector(mean: float, size: int, seed: int, id_col: str) -> Column:
    return vector(lambda s: -F.lit(float(mean)) * F.log(_hash_uniform(s, F.col(id_col))), size, seed)


def poisson_vector(mean: float, size: int, seed: int, id_col: str) -> Column:
    return vector(lambda s: poisson(mean, s, id_col), size, seed)


def gamma_vector(shape: float, scale: float, size: int, seed: int, id_col: str) -> Column:
    return vector(lambda s: gamma(shape, scale, s, id_col), size, seed)


def linear_data(ids: DataFrame, weights: list[float], intercept: float, eps: float, seed: int, id_col: str = "id") -> DataFrame:
    """(id, x, y): y = weights . x + intercept + eps * noise, x uniform in
    [-1, 1) per element, all drawn from the row's id."""
    x = F.array(*(2 * _hash_uniform(seed * 1_000_003 + i, F.col(id_col)) - 1 for i in range(len(weights))))
    dot = sum((F.get("x", F.lit(i)) * float(w) for i, w in enumerate(weights)), F.lit(float(intercept)))
    return ids.withColumn("x", x).withColumn("y", dot + eps * _hash_normal(seed * 1_000_003 + len(weights), F.col(id_col)))
