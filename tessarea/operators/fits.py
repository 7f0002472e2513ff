"""Fits from moment matrices: rows are read by tasks and become one small matrix a group, whatever their number; solvers then see matrices alone.

A task's matrices merge in rounds of up to ``FAN`` tasks a group, so no task and not the driver gets one from every task."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessarea.operators.rel import once
from tessarea.session import Scratch

FAN, HELD = 32, 64 << 20  # matrices a merge; bytes of matrices held by a task


def moments(df: DataFrame, columns: Sequence[str], group: str | None = None, build: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """group (a string, NULLs as one group; '' without one) and ``m``, the rows' matrix X'X as an array, X the columns after a constant 1.

    ``build`` makes X from the columns' values instead. Rows with a NULL or NaN in any column take no part."""
    made = build or (lambda x: np.hstack([np.ones((len(x), 1)), x]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, sums = TaskContext.get().partitionId(), {}

        def give() -> Iterator[pa.RecordBatch]:
            for name, m in sums.items():
                yield pa.record_batch([pa.array([name], pa.string()), pa.array([part], pa.int32()), pa.array([m.ravel()], pa.list_(pa.float64()))], names=["group", "part", "m"])
            sums.clear()

        for batch in batches:
            names = np.asarray(batch.column(0).to_pylist(), object)
            x = np.stack([np.asarray(batch.column(i + 1).to_pandas(), float) for i in range(len(columns))], 1) if columns else np.empty((len(names), 0))
            known = ~np.isnan(x).any(1)
            names, x = names[known], x[known]
            if not len(x):
                continue
            codes, known_names = pd.factorize(names)
            for code, name in enumerate(known_names):
                full = made(x[codes == code])
                sums[name] = sums[name] + full.T @ full if name in sums else full.T @ full
                if len(sums) * full.shape[1] ** 2 * 8 > HELD:
                    yield from give()
        yield from give()

    name = F.coalesce(F.col(group).cast("string"), F.lit("\0")) if group else F.lit("")
    partial = df.select(name.alias("group"), *[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)]).mapInArrow(run, "group string, part int, m array<double>")
    return _merged(partial)


def _merged(partial: DataFrame) -> DataFrame:
    scratch = Scratch(partial.sparkSession, "moments")
    table = scratch.keep(partial, "partial")
    parts = (table.agg(F.max("part")).first()[0] or 0) + 1

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"group": rows["group"].iloc[:1], "part": rows["near"].iloc[:1], "m": [np.sum(np.stack(rows["m"].tolist()), axis=0)]})

    while True:
        parts = math.ceil(parts / FAN)
        table = table.withColumn("near", F.floor(F.col("part") / FAN).cast("int")).groupBy("group", "near").applyInPandas(add, "group string, part int, m array<double>")
        if parts == 1:
            return scratch.keep(table.select("group", "m"), "moments")


def matrix(row_m: Sequence[float] | None, n: int) -> np.ndarray:
    return np.zeros((n, n)) if row_m is None else np.asarray(row_m, float).reshape(n, n)


def non_negative(g: np.ndarray, b: np.ndarray, free: Sequence[int] = (), start: Sequence[int] = ()) -> np.ndarray:
    """The x with x >= 0 (but for ``free``) that makes x'gx / 2 - b'x smallest: an active set that grows by the steepest term and
    shrinks where a term would turn negative. ``start`` are terms tried first. Terms are scaled, so ``g`` may mix magnitudes."""
    n = len(b)
    scale = np.sqrt(np.where(np.diag(g) > 0, np.diag(g), 1.0))
    g, b = g / np.outer(scale, scale), b / scale
    bound = np.ones(n, bool)
    bound[list(free)] = False
    inside = ~bound
    inside[list(start)] = True
    x, tolerance = np.zeros(n), 1e-10 * max(1.0, float(np.abs(b).max(initial=0)))

    def solved() -> np.ndarray:
        z, at = np.zeros(n), np.flatnonzero(inside)
        if len(at):
            part = g[np.ix_(at, at)]
            try:
                c = np.linalg.cholesky(part + 1e-13 * np.eye(len(at)))
                z[at] = np.linalg.solve(c.T, np.linalg.solve(c, b[at]))
            except np.linalg.LinAlgError:
                z[at] = np.linalg.lstsq(part, b[at], rcond=None)[0]
        return z

    while (low := inside & bound & (solved() <= 0)).any():  # what a start of another fit has too much
        inside &= ~low
    x = solved()
    for _ in range(10 * n + 10):
        slope = np.where(~inside, b - g @ x, -np.inf)
        j = int(slope.argmax()) if n else 0
        if not n or slope[j] <= tolerance:
            break
        inside[j] = True
        z = solved()
        if z[j] <= 0:  # rounding: it can't grow
            inside[j] = False
            break
        while (bad := inside & bound & (z <= 0)).any():
            step = float((x[bad] / (x[bad] - z[bad])).min())
            x = x + step * (z - x)
            inside &= ~(bound & (x <= 1e-14))
            x[~inside] = 0
            z = solved()
        x = z
    return np.where(bound, np.maximum(x, 0), x) / scale


def nnls(df: DataFrame, terms: Sequence[str], target: str) -> np.ndarray:
    """Least squares with coefficients of 0 or more, without a constant, for any number of terms: one pass, one matrix."""
    n = len(terms) + 1
    row = moments(df, [*terms, target], build=lambda x: x).first()
    m = matrix(row["m"] if row else None, n)
    return non_negative(m[:-1, :-1], m[:-1, -1])


def nnls_without_each(df: DataFrame, group: str, terms: Sequence[str], target: str) -> DataFrame:
    """term, p25, median, p75 of the coefficients fitted without each group in turn. A group is one matrix; its fit is that of the total
    less the group's, begun from the terms of the fit of all."""
    n = len(terms) + 1
    sums = moments(df, [*terms, target], group, build=lambda x: x)
    whole = _merged(sums.select(F.lit("").alias("group"), F.pmod(F.xxhash64("group"), F.lit(FAN * FAN)).cast("int").alias("part"), "m")).first()
    total = matrix(whole["m"] if whole else None, n)
    first = np.flatnonzero(non_negative(total[:-1, :-1], total[:-1, -1]) > 0).tolist()

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            left = [total - matrix(m, n) for m in rows["m"]]
            found = [non_negative(m[:-1, :-1], m[:-1, -1], start=first) for m in left]
            yield pd.DataFrame({"term": [t for _ in found for t in terms], "v": np.concatenate([np.empty(0), *found])})

    long = sums.mapInPandas(fit, "term string, v double")
    return long.groupBy("term").agg(*[F.percentile("v", q).alias(c) for q, c in ((0.25, "p25"), (0.5, "median"), (0.75, "p75"))])


def ridge_of(m: np.ndarray, penalty: float) -> np.ndarray:
    """(constant, coefficients, -1) of ridge regression on standardised features, from the moments of 1, features, target; so v'Mv is a sum of squared errors."""
    n = m[0, 0]
    mean = m[0, 1:] / n
    c = m[1:, 1:] / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(c)[:-1], 0))
    safe = np.where(sd > 1e-12, sd, 1.0)
    z = c[:-1, :-1] / np.outer(safe, safe) + penalty * np.eye(len(sd))
    k = np.where(sd > 1e-12, np.linalg.lstsq(z, c[:-1, -1] / safe, rcond=None)[0] / safe, 0.0)
    return np.concatenate([[mean[-1] - k @ mean[:-1]], k, [-1.0]])


def leave_pairs_out(df: DataFrame, group: str, features: Sequence[str], target: str, penalties: Sequence[float]) -> DataFrame:
    """first, second, penalty, group, error: for every pair of groups and every penalty the mean squared error on each of the two by a ridge fit that
    has seen neither. Rows are read once; a pair is a row of two small matrices, and its fit starts from the total less both.

    NULL features count as their mean over all rows; rows without a target take no part."""
    n = len(features) + 2
    means = df.agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(features)]).first()
    filled = df.select(group, F.col(target).cast("double").alias("_y"), *[F.coalesce(F.col(c).cast("double"), F.lit(means[i])).alias(f"_x{i}") for i, c in enumerate(features)])
    sums = moments(filled, [*[f"_x{i}" for i in range(len(features))], "_y"], group)
    whole = _merged(sums.select(F.lit("").alias("group"), F.pmod(F.xxhash64("group"), F.lit(FAN * FAN)).cast("int").alias("part"), "m")).first()
    total = matrix(whole["m"] if whole else None, n)
    from tessarea.operators.distributed import positions

    placed = Scratch(df.sparkSession, "pairs").keep(positions(sums, ["group"], "i"), "groups")
    count = placed.count()
    partner = placed.filter(F.col("i") < count - 1).select("group", "m", F.explode(F.sequence(F.col("i") + 1, F.lit(count - 1).cast("long"))).alias("j"))
    pairs = partner.join(placed.select(F.col("i").alias("j"), F.col("group").alias("other"), F.col("m").alias("m2")), "j").select("group", "other", "m", "m2")

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for a, b, ma, mb in zip(rows["group"], rows["other"], rows["m"], rows["m2"], strict=True):
                ga, gb = matrix(ma, n), matrix(mb, n)
                for penalty in penalties:
                    v = ridge_of(total - ga - gb, penalty) if count > 2 else np.concatenate([np.zeros(n - 1), [-1.0]])
                    out += [(a, b, penalty, name, float(v @ g @ v) / g[0, 0]) for name, g in ((a, ga), (b, gb))]
            yield pd.DataFrame(out, columns=["first", "second", "penalty", "group", "error"])

    return pairs.mapInPandas(fit, "first string, second string, penalty double, group string, error double")


def integrated_splines(x: np.ndarray, knots: Sequence[float], degree: int = 3) -> np.ndarray:
    """Columns that rise from 0 to 1 over the knots, each a tail of the B-splines of a degree; any sum of them with weights of 0 or more is monotone."""
    k = np.asarray(knots, float)
    t = np.concatenate([[k[0]] * degree, k, [k[-1]] * degree])
    x = np.clip(np.asarray(x, float), k[0], k[-1])
    last = np.searchsorted(k, k[-1], "left") - 1 + degree  # the right end belongs to the last piece that has a width
    at = np.minimum(np.searchsorted(t, x, "right") - 1, last)
    b = (at[:, None] == np.arange(len(t) - 1)[None, :]).astype(float)
    for d in range(1, degree + 1):
        left, right = t[d:-1] - t[: -d - 1], t[d + 1 :] - t[1:-d]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(left > 0, (x[:, None] - t[: -d - 1]) / left, 0.0)
            down = np.where(right > 0, (t[d + 1 :] - x[:, None]) / right, 0.0)
        b = up * b[:, :-1] + down * b[:, 1:]
    return b[:, ::-1].cumsum(1)[:, ::-1][:, 1:]


@dataclass
class MonotoneSplines:
    """An additive fit, monotone in each feature by its form: link(mean) = constant + sums of integrated splines with weights of 0 or more."""

    features: dict[str, bool]
    knots: dict[str, list[float]]
    middle: dict[str, float]
    family: str
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def basis(self, x: np.ndarray) -> np.ndarray:
        """1 and the splines of each feature's column of x; missing values count as the feature's median, falling features turn over."""
        out = [np.ones((len(x), 1))]
        for i, (name, rising) in enumerate(self.features.items()):
            if name in self.knots:
                part = integrated_splines(np.where(np.isnan(x[:, i]), self.middle[name], x[:, i]), self.knots[name])
                out.append(part if rising else -part)
        return np.hstack(out)

    def smooth(self) -> np.ndarray:
        """Penalty: squared differences of neighbouring weights of each feature."""
        size = len(self.weights)
        p, at = np.zeros((size, size)), 1
        for name in self.features:
            if name in self.knots:
                k = len(self.knots[name]) + 1
                d = np.diff(np.eye(k), axis=0)
                p[at : at + k, at : at + k] = d.T @ d
                at += k
        return p

    def predicted(self, df: DataFrame, name: str = "fitted", exposure: Column | None = None) -> DataFrame:
        """Adds the mean. The plan holds the weights, a few for each feature, and nothing of the rows."""
        this = self

        @F.pandas_udf("double")
        def mean(*columns: pd.Series) -> pd.Series:
            x = np.stack([c.to_numpy(float, na_value=np.nan) for c in columns], 1)
            eta = this.basis(x) @ this.weights
            return pd.Series(np.exp(eta) if this.family == "poisson" else eta)

        made = mean(*[F.col(c).cast("double") for c in self.features])
        return df.withColumn(name, made * exposure if exposure is not None else made)


def monotone_splines(df: DataFrame, features: dict[str, bool], target: str, family: str = "gaussian", exposure: str | None = None, pieces: int = 8, penalty: float = 1e-4, rounds: int = 30) -> MonotoneSplines:
    """``features`` says of each whether the fit rises with it. Knots lie at quantiles. Family ``poisson`` fits counts with a logarithmic link and an exposure.

    Each round is one pass over the rows that gives one matrix (a few dozen columns), which the driver solves with weights of 0 or more."""
    if family not in ("gaussian", "poisson"):
        raise ValueError(f"no family {family}")
    names = list(features)
    rows = once(df.filter(F.col(target).isNotNull()).select(*[F.col(c).cast("double").alias(c) for c in names], F.col(target).cast("double").alias("_y"), (F.col(exposure).cast("double") if exposure else F.lit(1.0)).alias("_e")).filter("_e > 0"), "splines")
    cuts = rows.approxQuantile(names, [i / pieces for i in range(pieces + 1)], 1e-4)
    model = MonotoneSplines(features, {}, {}, family)
    for name, q in zip(names, cuts, strict=True):
        if len(set(q)) > 1:
            model.knots[name], model.middle[name] = sorted(set(q)), q[len(q) // 2]
    size = 1 + sum(len(k) + 1 for k in model.knots.values())
    start = rows.agg(F.sum("_y").alias("y"), F.sum("_e").alias("e")).first()
    mean = (start["y"] or 0.0) / (start["e"] or 1.0)
    model.weights = np.zeros(size)
    model.weights[0] = math.log(max(mean, 1e-12)) if family == "poisson" else mean
    smooth = model.smooth()
    at = list(range(1, size))
    for _ in range(rounds if family == "poisson" else 1):
        weights = model.weights

        def build(x: np.ndarray, weights: np.ndarray = weights) -> np.ndarray:
            b, y, e = model.basis(x[:, :-2]), x[:, -2], x[:, -1]
            if family == "gaussian":
                w, z = e, y
            else:
                eta = np.clip(b @ weights, -30, 30)
                mu = e * np.exp(eta)
                w, z = mu, eta + (y - mu) / mu
            return np.hstack([b, z[:, None]]) * np.sqrt(w)[:, None]

        filled = rows.select(*[F.coalesce(F.col(c), F.lit(model.middle.get(c, 0.0))).alias(c) for c in names], "_y", "_e")
        row = moments(filled, [*names, "_y", "_e"], build=build).first()
        if row is None:
            break
        m = matrix(row["m"], size + 1)
        g = m[:-1, :-1] + penalty * m[0, 0] * smooth + 1e-10 * m[0, 0] * np.eye(size)
        model.weights = non_negative(g, m[:-1, -1], free=[0], start=[i for i in at if weights[i] > 0])
        if np.abs(model.weights - weights).max() < 1e-8 * (1 + np.abs(weights).max()):
            break
    return model
