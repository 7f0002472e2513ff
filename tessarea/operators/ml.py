"""Models on DataFrames by pyspark.ml: fold splits by key, a boosted tree and ridge pipeline, and held-out diagnostics."""

from __future__ import annotations

import math
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, Imputer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessarea.session import Scratch


def folds(df: DataFrame, key: str, k: int) -> DataFrame:
    """A fold by a hash of the key, so all rows of a key share one."""
    return df.withColumn("fold", F.pmod(F.xxhash64(key), F.lit(k)).cast("int"))


def _pipeline(features: list[str], model) -> Pipeline:
    filled = [f"{f}__filled" for f in features]
    return Pipeline(stages=[Imputer(strategy="median", inputCols=features, outputCols=filled), VectorAssembler(inputCols=filled, outputCol="__raw"), StandardScaler(inputCol="__raw", outputCol="__features", withMean=True), model])


def boosted(features: list[str], target: str, weight: str | None = None, depth: int = 5, rounds: int = 20, step: float = 0.1, seed: int = 7) -> Pipeline:
    model = GBTRegressor(featuresCol="__features", labelCol=target, maxDepth=depth, maxIter=rounds, stepSize=step, minInstancesPerNode=20, seed=seed)
    return _pipeline(features, model.setWeightCol(weight) if weight else model)


def ridge(features: list[str], target: str, weight: str | None = None, penalty: float = 1.0, mix: float = 0.0) -> Pipeline:
    model = LinearRegression(featuresCol="__features", labelCol=target, regParam=penalty, elasticNetParam=mix)
    return _pipeline(features, model.setWeightCol(weight) if weight else model)


def held_out(df: DataFrame, pipeline: Pipeline, key: str, k: int = 3) -> DataFrame:
    """Predictions for each row from a model that has not seen its fold. One fit a fold; the rows stay distributed."""
    # Written once: every pass of every fit would make the frame anew.
    split, out = Scratch(df.sparkSession, "held").keep(folds(df, key, k), "split"), None
    for i in range(k):
        part = pipeline.fit(split.filter(F.col("fold") != i)).transform(split.filter(F.col("fold") == i))
        part = part.drop(*[c for c in part.columns if c.startswith("__") or c.endswith("__filled")])
        out = part if out is None else out.unionByName(part)
    return out


def held_out_boosted(df: DataFrame, features: list[str], target: str, key: str, k: int = 3, depth: int = 5, rounds: int = 500, rate: float = 0.03, leaf: int = 20, bins: int = 255, seed: int = 7) -> DataFrame:
    """Predictions for each row from boosted trees over histograms that have not seen its fold; the folds are fitted side by side.

    Features are dealt into at most ``bins`` by quantiles of a fold's training rows, NULLs by their median. Rows of equal bins go the same way in
    every tree, so their count and mean stand for them: passes read cells, not rows, of which there are at most as many as distinct values of all
    features together. ``rate`` is the part of the residual that a round takes; every leaf has at least ``leaf`` training rows."""
    scratch = Scratch(df.sparkSession, "boosted")
    split = scratch.keep(folds(df, key, k), "split")
    filled, binned = [f"{f}__filled" for f in features], [f"__{f}" for f in features]

    def fold(i: int) -> DataFrame:
        train, test = split.filter(F.col("fold") != i), split.filter(F.col("fold") == i)
        imputer = Imputer(strategy="median", inputCols=features, outputCols=filled).fit(train)
        # The largest value is a bound too, so that a rare one of two values has a bin.
        bounds = imputer.transform(train).approxQuantile(filled, [j / (bins - 1) for j in range(1, bins)], 0.1 / bins)
        splits = [[-math.inf, *sorted(set(found)), math.inf] for found in bounds]
        dealer = PipelineModel([imputer, Bucketizer(splitsArray=splits, inputCols=filled, outputCols=binned)])
        # A sum has no label of a category, which the Bucketizer gives and trees would split out of order.
        ordered = [(F.col(b) + 0.0).alias(b) for b in binned]
        cells = scratch.keep(dealer.transform(train.filter(F.col(target).isNotNull())).groupBy(*ordered).agg(F.count("*").cast("double").alias("__n"), F.avg(target).alias("__mean")), f"cells-{i}")
        # Leaves are held to rows by their share of all rows, as a cell counts as one instance; half a row allows for rounding.
        share = min((leaf - 0.5) / (cells.agg(F.sum("__n")).first()[0] or 1), 0.4999)
        # Splits are sought in all cells if there are no more than the square of maxBins. MLlib's trees fit twice the residual, so its step is half the rate.
        model = GBTRegressor(featuresCol="__features", labelCol="__mean", weightCol="__n", predictionCol="prediction", maxDepth=depth, maxIter=rounds, stepSize=rate / 2, maxBins=8 * bins, minWeightFractionPerNode=share, seed=seed)
        fitted = Pipeline(stages=[VectorAssembler(inputCols=binned, outputCol="__features"), model]).fit(cells)
        rows = dealer.transform(test)
        said = scratch.keep(fitted.transform(rows.select(*binned).distinct()).select(*binned, "prediction"), f"said-{i}")
        return rows.join(said, binned).select(*split.columns, "prediction")

    with ThreadPool(k) as pool:
        parts = pool.map(inheritable_thread_target(df.sparkSession)(fold), range(k))
    return reduce(DataFrame.unionByName, parts)


def fit_report(df: DataFrame, target: str, prediction: str = "prediction") -> DataFrame:
    """R2, RMSE and mean residual in one pass."""
    e = F.col(target) - F.col(prediction)
    return df.agg((1 - F.sum(e * e) / (F.var_pop(target) * F.count("*"))).alias("r2"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"), F.count("*").alias("n"))


def correlated_pairs(df: DataFrame, columns: list[str], least: float, k: int) -> list[tuple[str, str, float]]:
    """The k feature pairs with the highest absolute correlation; one aggregate for all pairs."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]).first()
    found = [(a, b, row[f"c{i}"]) for i, (a, b) in enumerate(pairs) if row[f"c{i}"] is not None and abs(row[f"c{i}"]) >= least]
    return sorted(found, key=lambda x: (-abs(x[2]), x[0], x[1]))[:k]


def one_hot(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """A 0 or 1 column for each of a fixed list of values."""
    return df.withColumns({f"{column}_{v}": F.coalesce((F.col(column) == v).cast("double"), F.lit(0.0)) for v in values})


def residual_target(truth: str, model: str, floor: float = 0.5, most: float = 12.0):
    """log(truth / model), both raised by ``floor`` and clipped."""
    from tessarea.functions import clip

    return clip(F.log((F.col(truth) + floor) / (F.col(model) + floor)), -most, most)


def permuted(df: DataFrame, key: str, block: list[str], seed: int = 7) -> DataFrame:
    """The block's columns of one key put on another: keys in the order of a hash take the next key's values, so all rows of a key share one.

    Places come from range-partitioned ranks, not from one task."""
    from tessarea.operators.distributed import positions

    keys = df.select(key, *block).dropDuplicates([key]).withColumn("_h", F.xxhash64(F.lit(seed), key))
    placed = positions(keys, ["_h", key], "_at")
    n = placed.agg(F.max("_at").alias("_n"))
    moved = placed.select(F.col("_at").alias("_to"), *[F.col(c).alias(f"_{c}") for c in block])
    pairs = placed.select(key, "_at").crossJoin(F.broadcast(n)).withColumn("_to", F.when(F.col("_at") == F.col("_n"), F.lit(0).cast("long")).otherwise(F.col("_at") + 1)).join(moved, "_to")
    return df.join(pairs.select(key, *[f"_{c}" for c in block]), key).select(*[F.col(f"_{c}").alias(c) if c in block else F.col(c) for c in df.columns])


def permutation_losses(df: DataFrame, pipeline: Pipeline, key: str, cluster: str, blocks: dict[str, list[str]], target: str, seed: int = 7) -> DataFrame:
    """block, cluster, rise, n: by how much the squared errors on a cluster's held-out rows rise in sum when a block of features is permuted.

    One fit on the rows of half the keys; each held-out row keeps its own error, and a block costs one more prediction."""
    split = folds(df, key, 2)
    model = pipeline.fit(split.filter("fold = 0"))
    bare = lambda p: p.drop(*[c for c in p.columns if c.startswith("__") or c.endswith("__filled") or c == "prediction"])
    squared = F.pow(F.col(target) - F.col("prediction"), 2)
    test = Scratch(df.sparkSession, "importance").keep(bare(model.transform(split.filter("fold = 1").drop("fold")).withColumn("_own", squared)), "held-out")
    out = None
    for name, block in blocks.items():
        part = model.transform(permuted(test, key, block, seed)).groupBy(F.coalesce(F.col(cluster).cast("string"), F.lit("")).alias("cluster"))
        part = part.agg(F.sum(squared - F.col("_own")).alias("rise"), F.count("*").alias("n")).select(F.lit(name).alias("block"), "cluster", "rise", "n")
        out = part if out is None else out.unionByName(part)
    return out


def importance(losses: DataFrame, rounds: int = 500, level: float = 0.95) -> DataFrame:
    """block, rise, low, high, keep: the mean rise by row with its interval over resampled clusters; a block is kept if all of the interval is above 0.

    All rounds of all blocks are one aggregate of the table of clusters."""
    from tessarea.operators.stats import multiplicity

    table = Scratch(losses.sparkSession, "importance").keep(losses, "losses")
    drawn = table.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds)))).withColumn("m", multiplicity(F.col("cluster"), F.col("round")))
    means = drawn.groupBy("block", "round").agg(F.try_divide(F.sum(F.col("rise") * F.col("m")), F.sum(F.col("n") * F.col("m"))).alias("mean"))
    tail = (1 - level) / 2
    spans = means.groupBy("block").agg(F.percentile("mean", tail).alias("low"), F.percentile("mean", 1 - tail).alias("high"))
    own = table.groupBy("block").agg((F.sum("rise") / F.sum("n")).alias("rise"))
    return own.join(spans, "block").select("block", "rise", "low", "high", (F.col("low") > 0).alias("keep"))


def one_se(losses: DataFrame, option: str, unit: str, loss: str) -> DataFrame:
    """option, mean, se, chosen: the smallest option whose mean loss is within one standard error (over units) of the best."""
    means = losses.groupBy(option, unit).agg(F.avg(loss).alias("_l")).groupBy(option).agg(F.avg("_l").alias("mean"), (F.stddev_samp("_l") / F.sqrt(F.count("*"))).alias("se"))
    best = means.agg(F.min(F.struct("mean", "se", option)).alias("b"))
    limit = means.crossJoin(F.broadcast(best)).withColumn("_in", F.col("mean") <= F.col("b.mean") + F.coalesce("b.se", F.lit(0.0)))
    first = limit.filter("_in").agg(F.min(option).alias("_first"))
    return limit.crossJoin(F.broadcast(first)).select(option, "mean", "se", (F.col(option) == F.col("_first")).alias("chosen"))


def one_se_stability(losses: DataFrame, option: str, unit: str, loss: str, rounds: int = 500) -> DataFrame:
    """option, chosen_share, best_share, rounds: in how many rounds over resampled units an option is the one-standard-error choice, or the best.

    Units are drawn by hashed multiplicities; all rounds of all options are one aggregate of the mean losses by option and unit, and no draw moves rows."""
    from tessarea.operators.stats import multiplicity

    means = Scratch(losses.sparkSession, "stability").keep(losses.groupBy(F.col(option).alias("option"), F.col(unit).alias("unit")).agg(F.avg(loss).alias("l")), "means")
    m, x = F.col("m"), F.col("l")
    drawn = means.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds)))).withColumn("m", multiplicity(F.col("unit"), F.col("round")))
    sums = drawn.groupBy("round", "option").agg(F.sum(m).alias("n"), (F.sum(m * x) / F.sum(m)).alias("mean"), F.sum(m * x * x).alias("s2")).filter("n > 1")
    spread = F.sqrt(F.greatest(F.lit(0.0), (F.col("s2") - F.col("n") * F.col("mean") * F.col("mean")) / (F.col("n") - 1)) / F.col("n"))
    sums = sums.withColumn("se", spread)
    best = sums.groupBy("round").agg(F.min(F.struct("mean", "se", "option")).alias("b"))
    tried = sums.join(best, "round")
    near = tried.filter(F.col("mean") <= F.col("b.mean") + F.col("b.se"))
    chosen = near.groupBy("round").agg(F.min("option").alias("option"), F.min("b.option").alias("best"))
    n = chosen.agg(F.count("*").alias("rounds"))  # one row
    counts = chosen.select(F.explode(F.array(F.struct("option", F.lit(1).alias("c"), F.lit(0).alias("b")), F.struct(F.col("best").alias("option"), F.lit(0).alias("c"), F.lit(1).alias("b")))).alias("x")).groupBy("x.option").agg(F.sum("x.c").alias("c"), F.sum("x.b").alias("b"))
    every = means.select("option").distinct().join(counts, "option", "left").crossJoin(F.broadcast(n))
    share = lambda c: F.try_divide(F.coalesce(F.col(c), F.lit(0)), F.col("rounds"))
    return every.select(F.col("option").alias(option), share("c").alias("chosen_share"), share("b").alias("best_share"), "rounds")
