"""Fits from moment matrices against refits, optimality conditions and known curves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessarea.operators import fits


def frame(spark, x, y, group=None):
    n = x.shape[1]
    rows = [(None if group is None else group[i], *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, ", ".join(["g string", *[f"x{i} double" for i in range(n)], "y double"]))


@pytest.mark.parametrize("n", [5, 40, 200])
def test_non_negative_fits_are_optimal(n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(3 * n, n)) * 10.0 ** rng.integers(-3, 4, n)
    y = x @ (rng.normal(size=n) / np.abs(x).mean(0)) + rng.normal(size=3 * n)
    g, b = x.T @ x, x.T @ y
    k = fits.non_negative(g, b)
    slope = (b - g @ k) / np.sqrt(np.diag(g))
    assert (k >= 0).all() and slope.max() <= 1e-6 * np.abs(b / np.sqrt(np.diag(g))).max() and abs(slope[k > 0]).max() <= 1e-6 * np.abs(slope).max()
    assert fits.non_negative(g, b, start=range(n)) == pytest.approx(k, rel=1e-6, abs=1e-9)
    free = fits.non_negative(g, b, free=range(n))
    assert free == pytest.approx(np.linalg.solve(g, b), rel=1e-5)


def test_two_hundred_terms_in_one_pass(spark):
    rng = np.random.default_rng(1)
    x = rng.random((600, 200))
    k = np.where(rng.random(200) < 0.3, rng.random(200), 0.0)
    found = fits.nnls(frame(spark, x, x @ k), [f"x{i}" for i in range(200)], "y")
    assert found == pytest.approx(k, abs=1e-6)


def test_moments_merge_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(fits, "FAN", 2)
    monkeypatch.setattr(fits, "HELD", 1)
    rng = np.random.default_rng(2)
    x, y, g = rng.random((100, 2)), rng.random(100), [None if i % 5 == 0 else f"g{i % 3}" for i in range(100)]
    df = frame(spark, x, y, g).unionByName(spark.createDataFrame([("g1", None, 1.0, 2.0), ("g1", float("nan"), 1.0, 2.0)], "g string, x0 double, x1 double, y double")).repartition(7)
    got = {r.group: fits.matrix(r.m, 4) for r in fits.moments(df, ["x0", "x1", "y"], "g").collect()}
    full = np.hstack([np.ones((100, 1)), x, y[:, None]])
    for name in {"\0", "g0", "g1", "g2"}:
        mine = full[[(v or "\0") == name for v in g]]
        assert got[name] == pytest.approx(mine.T @ mine)
    assert set(got) == {"\0", "g0", "g1", "g2"}


def test_pairs_left_out_equal_refits(spark):
    rng = np.random.default_rng(3)
    x, g = rng.normal(size=(120, 3)), [f"g{i % 6}" for i in range(120)]
    x[:, 2] = 4.0
    y = x @ [2.0, -1.0, 0.0] + 3 + rng.normal(0, 0.3, 120) + np.array([int(v[1]) for v in g]) * 0.1
    got = {(r["first"], r["second"], r.penalty, r.group): r.error for r in fits.leave_pairs_out(frame(spark, x, y, g), "g", ["x0", "x1", "x2"], "y", [0.0, 0.5]).collect()}
    names, g = sorted(set(g)), np.array(g)
    assert len(got) == 15 * 2 * 2
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            seen = (g != a) & (g != b)
            mean, sd = x[seen].mean(0), np.where(x[seen].std(0) > 1e-12, x[seen].std(0), 1)
            z = (x - mean) / sd
            for penalty in (0.0, 0.5):
                k = np.linalg.lstsq(z[seen].T @ z[seen] / seen.sum() + penalty * np.eye(3), z[seen].T @ (y[seen] - y[seen].mean()) / seen.sum(), rcond=None)[0]
                for name in (a, b):
                    error = ((y - y[seen].mean() - z @ k)[g == name] ** 2).mean()
                    assert got[a, b, penalty, name] == pytest.approx(error, rel=1e-6)


def test_few_groups(spark):
    df = frame(spark, np.ones((4, 1)), np.array([1.0, 2.0, 3.0, 5.0]), ["a", "a", "b", "b"])
    assert {r.error for r in fits.leave_pairs_out(df, "g", ["x0"], "y", [0.0]).collect()} == {2.5, 17.0}
    assert fits.leave_pairs_out(df.filter("g = 'a'"), "g", ["x0"], "y", [0.0]).count() == 0
    assert fits.leave_pairs_out(df.limit(0), "g", ["x0"], "y", [0.0]).count() == 0
    assert fits.nnls(df.limit(0), ["x0"], "y").tolist() == [0.0]


def test_splines_rise_from_zero_to_one():
    x = np.linspace(-1, 6, 400)
    b = fits.integrated_splines(x, [0, 1, 1.5, 3, 5])
    assert b.shape == (400, 6) and (np.diff(b, axis=0) >= -1e-12).all()
    assert np.allclose(b[x <= 0], 0) and np.allclose(b[x >= 5], 1)


def test_a_known_rising_curve_is_found(spark):
    rng = np.random.default_rng(4)
    x, z = rng.uniform(0, 10, 3000), rng.uniform(0, 1, 3000)
    mean = 2 / (1 + np.exp(-(x - 5))) - 1.5 * z**2
    y = mean + rng.normal(0, 0.1, 3000)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(d)) for a, b, c, d in zip(x, z, y, mean, strict=True)] + [(None, 0.5, 1.0, None)], "x double, z double, y double, mean double")
    model = fits.monotone_splines(df, {"x": True, "z": False}, "y")
    rows = model.predicted(df).collect()
    assert np.sqrt(np.mean([(r.fitted - r["mean"]) ** 2 for r in rows if r["mean"] is not None])) < 0.03
    at = np.linspace(0, 10, 300)
    curve = model.basis(np.stack([at, np.full(300, 0.5)], 1)) @ model.weights
    assert (np.diff(curve) >= -1e-9).all() and all(r.fitted is not None for r in rows)
    fall = fits.monotone_splines(df, {"x": False, "z": True}, "y")  # against the data: flat, not falling the wrong way
    assert (np.diff(fall.basis(np.stack([at, np.full(300, 0.5)], 1)) @ fall.weights) <= 1e-9).all()


def test_counts_with_an_exposure(spark):
    rng = np.random.default_rng(5)
    x, e = rng.uniform(0, 3, 4000), rng.uniform(1, 20, 4000)
    rate = np.exp(-1 + 0.8 * np.sqrt(x))
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x, e, rng.poisson(rate * e), strict=True)], "x double, e double, y double")
    model = fits.monotone_splines(df, {"x": True}, "y", "poisson", "e")
    at = np.linspace(0.05, 2.95, 100)
    found = np.exp(model.basis(at[:, None]) @ model.weights)
    assert np.abs(found / np.exp(-1 + 0.8 * np.sqrt(at)) - 1).max() < 0.08
    sums = model.predicted(df, exposure=F.col("e")).agg(F.sum("y").alias("y"), F.sum("fitted").alias("f")).first()
    assert sums.f == pytest.approx(sums.y, rel=1e-3)


def test_the_plan_does_not_grow_with_the_rows(spark):
    sizes = []
    for n in (200, 20_000):
        df = spark.range(n).select((F.rand(1) * 10).alias("x"), F.rand(2).alias("y"))
        model = fits.monotone_splines(df, {"x": True}, "y")
        sizes.append((len(model.weights), len(model.predicted(df)._jdf.queryExecution().optimizedPlan().toString())))
    assert sizes[0][0] == sizes[1][0] and abs(sizes[0][1] - sizes[1][1]) < 50
    constant = fits.monotone_splines(spark.range(9).select(F.lit(1.0).alias("x"), F.col("id").cast("double").alias("y")), {"x": True}, "y")
    assert constant.weights.tolist() == pytest.approx([4.0])


def test_held_out_makes_its_frame_once(spark):
    from pyspark.sql import functions as F

    from tessarea.operators import ml

    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        made.add(1)
        return float(x % 7)

    df = spark.range(300).select("id", seen("id").alias("a"), (F.col("id") * 2.0).alias("y"))
    assert ml.held_out(df, ml.ridge(["a"], "y"), "id", 2).count() == 300
    assert made.value == 300
