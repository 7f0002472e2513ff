"""Statistics that Spark has no function for, vectorised in Arrow batches or on small aggregates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _gamma_p(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma: a series below a + 1, a continued fraction above."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    out = np.zeros(a.shape)
    from math import lgamma

    log_front = a * np.log(np.maximum(x, 1e-300)) - x - np.vectorize(lgamma)(np.maximum(a, 1e-300))
    low = (x < a + 1) & (x > 0)
    if low.any():
        al, xl = a[low], x[low]
        term = total = 1 / al
        for n in range(1, 2000):
            term = term * xl / (al + n)
            total = total + term
            if (term < total * 1e-16).all():
                break
        out[low] = total * np.exp(log_front[low])
    high = x >= a + 1
    if high.any():
        ah, xh = a[high], x[high]
        b = xh + 1 - ah
        c = np.full(ah.shape, 1e300)
        d = 1 / b
        f = d.copy()
        for i in range(1, 2000):
            an = -i * (i - ah)
            b = b + 2
            d = 1 / np.where(np.abs(an * d + b) < 1e-300, 1e-300, an * d + b)
            c = np.where(np.abs(b + an / c) < 1e-300, 1e-300, b + an / c)
            f = f * c * d
            if (np.abs(c * d - 1) < 1e-15).all():
                break
        out[high] = 1 - np.exp(log_front[high]) * f
    return out


def gamma_quantile(p: float, a: np.ndarray) -> np.ndarray:
    """Where the gamma distribution with shape a reaches p, by bisection; 0 where a is 0."""
    a = np.asarray(a, float)
    lo, hi = np.zeros(a.shape), a + 10 * np.sqrt(a + 1) + 20
    safe = np.maximum(a, 1e-12)
    for _ in range(80):
        mid = (lo + hi) / 2
        below = _gamma_p(safe, mid) < p
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
    return np.where(a > 0, (lo + hi) / 2, 0.0)


def poisson_interval(df: DataFrame, count: str, level: float = 0.95) -> DataFrame:
    """Exact interval of a Poisson mean: half the chi-square quantiles at 2c and 2c + 2. Counts may be fractions; NULL stays NULL."""
    tail = (1 - level) / 2

    @F.pandas_udf("low double, high double")
    def interval(c: pd.Series) -> pd.DataFrame:
        known = c.fillna(0.0).to_numpy(float)
        out = pd.DataFrame({"low": gamma_quantile(tail, known), "high": gamma_quantile(1 - tail, known + 1)})
        out[c.isna().to_numpy()] = None
        return out

    return df.withColumn("_i", interval(F.col(count).cast("double"))).select("*", F.col("_i.low").alias("low"), F.col("_i.high").alias("high")).drop("_i")


def multiplicity(cluster: Column, round_: Column) -> Column:
    """How often a cluster is drawn in a round: Poisson(1) from a hash, so rounds are repeatable and no rows move."""
    u = (F.pmod(F.xxhash64(cluster, round_), F.lit(1 << 30)) + 0.5) / (1 << 30)
    steps, total, p = F.lit(0), 0.0, np.exp(-1.0)
    for k in range(8):
        total += p
        steps = steps + F.when(u > total, 1).otherwise(0)
        p /= k + 1
    return steps


def cluster_bootstrap(df: DataFrame, cluster: str, value: str, weight: str, rounds: int = 200) -> DataFrame:
    """95 % interval of a weighted mean over resampled clusters. A cluster's Poisson(1) multiplicity in a round comes from a hash, so rounds are repeatable and no rows move."""
    sums = df.groupBy(cluster).agg(F.sum(F.col(value) * F.col(weight)).alias("vw"), F.sum(weight).alias("w"))
    draws = sums.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds)))).withColumn("m", multiplicity(F.col(cluster), F.col("round")))
    means = draws.groupBy("round").agg(F.try_divide(F.sum(F.col("vw") * F.col("m")), F.sum(F.col("w") * F.col("m"))).alias("mean"))
    return means.agg(F.avg("mean").alias("mean"), F.percentile("mean", 0.025).alias("low"), F.percentile("mean", 0.975).alias("high"))
