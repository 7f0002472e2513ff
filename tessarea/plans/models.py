"""Queries that SQL can't express; their tests use brute force or known values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea.operators import fits, ml, stats
from tessarea.plans.publish import PARTS, parts, units
from tessarea.plans.registry import Tables, query, r


@query()
def poisson_exact_interval(t: Tables) -> DataFrame:
    """Exact interval of each unit's count (K3)."""
    x = stats.poisson_interval(units(t).select("cust", F.col("y").cast("double").alias("y")), "y")
    return x.select("cust", "y", r("low", 4).alias("low"), r("high", 4).alias("high"))


@query()
def cluster_bootstrap_interval(t: Tables) -> DataFrame:
    """Interval of the mean count over resampled nations."""
    return stats.cluster_bootstrap(units(t), "nation", "y", "pop")


@query()
def nnls_calibration(t: Tables) -> DataFrame:
    """Non-negative coefficients of a few terms."""
    p = parts(t).select(F.col("size").cast("double").alias("a"), F.col("price").alias("b"), (-F.col("price")).alias("c"), "q")
    k = fits.nnls(p, ["a", "b", "c"], "q")
    return t.spark.createDataFrame([(n, float(round(v, 9))) for n, v in zip("abc", k, strict=True)], "term string, coefficient double")


@query()
def boosted_held_out(t: Tables) -> DataFrame:
    """Held-out fit of boosted trees: 500 rounds of depth 5 at a rate of 0.03, leaves of 20 rows."""
    p = parts(t).select("part", F.col("size").cast("double").alias("size"), "price", F.col("k").cast("double").alias("k"), "q")
    return ml.fit_report(ml.held_out_boosted(p, ["size", "price", "k"], "q", "part"), "q")


@query()
def ridge_held_out(t: Tables) -> DataFrame:
    """Held-out fit of ridge regression (M2)."""
    p = parts(t).select("part", F.col("size").cast("double").alias("size"), "price", F.col("k").cast("double").alias("k"), "q")
    return ml.fit_report(ml.held_out(p, ml.ridge(["size", "price", "k"], "q"), "part", 3), "q")


def model_frame(t: Tables) -> DataFrame:
    p = parts(t).select("part", "brand", F.col("size").cast("double").alias("size"), "price", F.col("k").cast("double").alias("k"), "q")
    return p.withColumn("noise", F.pmod(F.xxhash64("part"), F.lit(1000)) / 1000.0)


@query()
def monotone_fit(t: Tables) -> DataFrame:
    """An additive spline fit that rises with each feature (M3)."""
    model = fits.monotone_splines(model_frame(t), {"k": True, "size": True}, "q")
    return ml.fit_report(model.predicted(model_frame(t)), "q", "fitted")


@query()
def monotone_counts(t: Tables) -> DataFrame:
    """Counts with an exposure by a monotone fit with a logarithmic link: means and fits by tenth of the exposure (M3)."""
    p = model_frame(t).withColumn("lines", F.col("k"))
    model = fits.monotone_splines(p, {"size": True, "price": False}, "lines", "poisson", "size")
    fitted = model.predicted(p, exposure=F.col("size")).withColumn("tenth", F.ceil(F.col("size") / 5).cast("int"))
    return fitted.groupBy("tenth").agg(F.sum("lines").alias("lines"), r(F.sum("fitted"), 4).alias("fitted"))


@query()
def weighted_residual_model(t: Tables) -> DataFrame:
    """What a model leaves, with one-hot parents and weights (M4, M5)."""
    p = model_frame(t).withColumns({"model": F.col("k") * 20.0, "weight": F.greatest("k", F.lit(1.0))}).withColumn("target", ml.residual_target("q", "model"))
    brands = ["Brand#1", "Brand#2", "Brand#3"]
    p = ml.one_hot(p, "brand", brands).withColumnsRenamed({f"brand_{b}": f"brand_{i}" for i, b in enumerate(brands)})
    return ml.fit_report(ml.held_out(p, ml.boosted(["size", "price", "brand_0", "brand_1", "brand_2"], "target", "weight"), "part"), "target")


@query()
def leave_pairs_out_errors(t: Tables) -> DataFrame:
    """Errors on each of all pairs of brands from ridge fits without them, at several penalties (M8, M9)."""
    return fits.leave_pairs_out(model_frame(t), "brand", ["size", "price", "k"], "q", [0.0, 0.1, 1.0])


@query()
def permutation_importance(t: Tables) -> DataFrame:
    """How much worse the model is without what a block of features tells, with intervals over brands and a verdict."""
    blocks = {"k": ["k"], "shape": ["size", "price"], "noise": ["noise"]}
    losses = ml.permutation_losses(model_frame(t), ml.ridge(["size", "price", "k", "noise"], "q"), "part", "brand", blocks, "q")
    return ml.importance(losses)


def tilt_losses(t: Tables) -> DataFrame:
    g = t.part.groupBy(F.col("p_brand").alias("unit")).agg(F.avg("p_retailprice").alias("a"), F.avg("p_size").alias("b"))
    losses = g.select("unit", "a", "b", F.explode(F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 1.0)])).alias("tau"))
    return losses.withColumn("loss", F.abs(F.col("tau") - F.col("b") / 50) + 0.01 * (F.col("a") % 7))


@query("""WITH g AS (SELECT p_brand AS unit, unnest([0.0, 0.25, 0.5, 1.0])::DOUBLE AS tau, avg(p_retailprice) AS a, avg(p_size) AS b FROM part GROUP BY p_brand), l AS (SELECT tau, unit, abs(tau - b / 50) + 0.01 * (a % 7) AS loss FROM g),
m AS (SELECT tau, avg(loss) AS mean, stddev_samp(loss) / sqrt(count(*)) AS se FROM l GROUP BY tau), b AS (SELECT mean + se AS cut FROM m ORDER BY mean, se, tau LIMIT 1), f AS (SELECT min(tau) AS first FROM m CROSS JOIN b WHERE mean <= cut)
SELECT tau, round(mean, 6) AS mean, round(se, 6) AS se, tau = first AS chosen FROM m CROSS JOIN f""")
def one_standard_error(t: Tables) -> DataFrame:
    """The smallest tilt within a standard error of the best."""
    return ml.one_se(tilt_losses(t), "tau", "unit", "loss").select("tau", r("mean").alias("mean"), r("se").alias("se"), "chosen")


@query()
def choice_stability(t: Tables) -> DataFrame:
    """How often a tilt is chosen over resampled units."""
    return ml.one_se_stability(tilt_losses(t), "tau", "unit", "loss")


@query(f"SELECT 'k' AS a, 'q' AS b, round(corr(k, q), 6) AS r FROM {PARTS}")
def correlated_features(t: Tables) -> DataFrame:
    """The most correlated pair."""
    found = ml.correlated_pairs(model_frame(t), ["k", "q", "size", "noise"], 0.5, 1)
    return t.spark.createDataFrame([(a, b, float(round(c, 6))) for a, b, c in found], "a string, b string, r double")


@query()
def fold_safe_calibration(t: Tables) -> DataFrame:
    """Non-negative coefficients without each parent in turn, and their quartiles."""
    p = parts(t).select("brand", F.col("size").cast("double").alias("a"), F.col("k").cast("double").alias("b"), "q")
    return fits.nnls_without_each(p, "brand", ["a", "b"], "q")
