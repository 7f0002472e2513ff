"""The kits on frames made by hand: nulls, ties, fail-closed pairs, known values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessarea.functions import bounded_ratio, case_first, case_last, clip, finite, haversine_km, ratio, round_half_even, try_num, zfill
from tessarea.operators import expect, fits, geo, ml, rel, rules, stats


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    return spark.createDataFrame([tuple(v for _, v in values.values()) or (1,)], schema).select(column.alias("v")).first()["v"]


def test_scalars(spark):
    assert one(spark, ratio("a", "b"), a=("double", 1.0), b=("double", 0.0)) is None
    assert one(spark, clip("a", 0.0, 1.0), a=("double", None)) is None
    assert one(spark, bounded_ratio("a", "b"), a=("double", 5.0), b=("double", 2.0)) == 1.0
    assert one(spark, bounded_ratio("a", "b"), a=("double", 5.0), b=("double", -2.0)) is None
    assert one(spark, zfill("a", 3), a=("string", "12345")) == "12345"
    assert one(spark, zfill("a", 3), a=("string", "7")) == "007"
    assert one(spark, try_num("a"), a=("string", "x1")) is None
    assert one(spark, finite("a"), a=("double", math.inf)) is None
    assert [one(spark, round_half_even("a"), a=("double", x)) for x in (0.5, 1.5, 2.5)] == [0, 2, 2]
    assert one(spark, haversine_km("a", "b", "c", "d"), a=("double", 0.0), b=("double", 0.0), c=("double", 0.0), d=("double", 1.0)) == pytest.approx(111.195, abs=0.01)


def test_ladders_differ_in_who_wins(spark):
    rungs = [(F.col("a") > 0, "first"), (F.col("a") > 5, "second")]
    assert one(spark, case_first(rungs), a=("int", 9)) == "first"
    assert one(spark, case_last(rungs), a=("int", 9)) == "second"
    assert one(spark, case_last(rungs, "none"), a=("int", None)) == "none"


def test_shares_and_plug(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 0.0), ("c", "x", 1.0), ("c", "y", 1.0), ("c", "z", 1.0)], "g string, k string, v double")
    s = rel.share_of_group(df, ["g"], "v", "s")
    assert {(r.g, r.k): r.s for r in s.collect()}[("b", "x")] == 0.0
    plugged = rel.plug_residual(s.filter("g <> 'b'"), ["g"], "s", [F.desc("v"), F.asc("k")])
    expect.sums_to(plugged, ["g"], "s", 1.0, 1e-12)


def test_lookup_chain_labels(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    table = spark.createDataFrame([(1, 0.5)], "k int, v double")
    none = spark.createDataFrame([(None,)], "v double")
    got = {r.k: (r.q, r.q_source) for r in rel.lookup_chain(df, [(table, ["k"], "v", "state"), (none, [], "v", "national")], "q", 1.0).collect()}
    assert got == {1: (0.5, "state"), 2: (1.0, "default")}


def test_dominant_label_tie(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 2.0), (2, "c", 1.0)], "k int, l string, w double")
    assert {r.k: r.l for r in rel.dominant_label(df, ["k"], "l", "w").collect()} == {1: "a", 2: "c"}


def test_frame_diff(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None), (3, 5.0), (5, 1.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.1), (2, None), (4, 1.0), (5, None)], "k int, v double")
    assert {r.k: r.kind for r in rel.frame_diff(a, b, ["k"], "v", 0.05).collect()} == {1: "differs", 3: "left_only", 4: "right_only", 5: "differs"}


def test_expectations_fail_closed(spark):
    df = spark.createDataFrame([(1, "a", 0.4), (1, "b", 0.6), (2, "a", None)], "k int, l string, w double")
    expect.unique(df, ["k", "l"])
    for broken in (
        lambda: expect.unique(df, ["k"]),
        lambda: expect.functional(df, "k", "l"),
        lambda: expect.all_hold(df, known=F.col("w") >= 0),
        lambda: expect.sums_to(df.filter("l = 'a'"), ["k"], "w"),
        lambda: expect.reconciles(df, df.filter("l = 'a'"), ["k"], "w", 0.1),
        lambda: expect.ratchet(112, 100),
    ):
        with pytest.raises(expect.ExpectationError):
            broken()
    expect.ratchet(90, 100)


def test_totals_that_differ_by_rounding_alone_reconcile(spark):
    tenths = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, F.lit(1)).alias("k"), (F.col("id") * 1000.1 + 0.07).alias("v"))
    other = tenths.groupBy("k", F.pmod(F.xxhash64("v"), F.lit(7_000))).agg(F.sum("v").alias("v")).orderBy(F.desc("v"))
    expect.reconciles(tenths, other, ["k"], "v", 1e-6)
    for gone in (tenths.filter("v > 0.1"), other.unionByName(other.limit(1), allowMissingColumns=True).select("k", "v")):
        with pytest.raises(expect.ExpectationError):
            expect.reconciles(tenths, gone.withColumn("v", F.col("v") + F.when(F.col("v") < 1e9, 0.5).otherwise(0)), ["k"], "v", 1e-6)


def test_rules(spark):
    column = rules.first_match([{"label": "x", "all": [{"field": "a", "regex": "^q"}], "none": [{"field": "b", "ge": 5}]}], "rest")
    assert one(spark, column, a=("string", "qq"), b=("int", None)) == "x"
    assert one(spark, column, a=("string", "qq"), b=("int", 6)) == "rest"
    with pytest.raises(ValueError):
        rules.condition({"field": "a", "like": "x"})


def test_within_km_equals_all_pairs(spark):
    left = spark.createDataFrame([(i, 40 + i * 0.003, -70 + (i * 7 % 11) * 0.02) for i in range(60)], "id int, lat double, lon double")
    right = left.select(F.col("id").alias("id2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    fast = {(r.id, r.id2) for r in geo.within_km(left, right, 4.0).collect()}
    slow = {(r.id, r.id2) for r in left.crossJoin(right).filter(haversine_km("lat", "lon", "lat2", "lon2") <= 4.0).collect()}
    assert fast == slow and len(fast) >= 60


def test_point_in_ring(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 4), (2, 1), (0, 4))])
    inside = geo.point_in_ring(F.col("a"), F.col("b"), ring)
    assert one(spark, inside, a=("double", 3.5), b=("double", 1.0)) is True
    assert one(spark, inside, a=("double", 2.0), b=("double", 2.0)) is False


def test_poisson_interval_known_values(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "c double")
    got = {r.c: (r.low, r.high) for r in stats.poisson_interval(df, "c").collect()}
    assert got[0.0][0] == 0 and got[0.0][1] == pytest.approx(3.6889, abs=1e-4)
    assert got[1.0] == pytest.approx((0.02532, 5.57164), abs=1e-4)
    assert got[10.0] == pytest.approx((4.79539, 18.39036), abs=1e-4)
    assert got[None][0] is None or math.isnan(got[None][0])


def test_nnls_finds_the_corner(spark):
    df = spark.createDataFrame([(1.0, 0.0, 2.0), (0.0, 1.0, -1.0), (1.0, 1.0, 1.0)], "a double, b double, y double")
    k = fits.nnls(df, ["a", "b"], "y")
    assert k[1] == 0 and k[0] == pytest.approx(1.5)


def test_correlated_pairs(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), (F.col("id") % 7).cast("double").alias("c"))
    assert [x[:2] for x in ml.correlated_pairs(df, ["a", "b", "c"], 0.9, 5)] == [("a", "b")]


def test_stream_gives_the_batch_result(spark, tmp_path):
    from tessarea.streaming.events import first_seen, read_events, run_once, sessions, windowed_counts

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(read_events(spark, str(tmp_path / "in"), events.schema), "1 day", "60 days")
    run_once(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    done = spark.read.parquet(str(tmp_path / "out"))
    batch = windowed_counts(events, "1 day")
    assert done.exceptAll(batch).count() == 0  # windows that the watermark has closed are final
    assert sessions(events, "1 hour").agg(F.sum("n")).first()[0] == events.count()
    twice = first_seen(read_events(spark, str(tmp_path / "in"), events.schema), "60 days", ["event_id"])
    run_once(twice, str(tmp_path / "seen"), str(tmp_path / "state2")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "seen")).count() == events.count()


def test_token_pairs_are_all_found(spark):
    """Whatever the ids and however common a token; rows with equal ids are pairs of their own, a null id or list has none."""
    names = [(i, ["the"] + [w for k, w in enumerate(["oak", "elm", "ash", "yew"]) if i % (k + 2) == 0]) for i in range(60)]
    names += [(7, ["oak"]), (None, ["the"]), (90, None), (91, []), (92, ["lone"])]
    df = spark.createDataFrame(names, "id int, ws array<string>")
    want = sorted((a, b, len({*x} & {*y})) for a, x in names for b, y in names if a is not None and b is not None and x and y and a < b and {*x} & {*y})
    for most in (7, 1_000):
        assert sorted(map(tuple, rel.token_pairs(df, "id", "ws", most).collect())) == want


def test_token_overlap_has_all_pairs(spark, tmp_path):
    from tessarea import plans

    spark.createDataFrame([(1, "North Elm"), (2, "elm south"), (11, "oak"), (13, "Elm oak oak")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert sorted(map(tuple, plans.QUERIES["token_overlap"](spark, str(tmp_path)).collect())) == [(1, 2, 1), (1, 13, 1), (2, 13, 1), (11, 13, 1)]


def test_boosted_query_fits_the_whole_model(spark, monkeypatch):
    from tessarea import plans

    fits = []
    monkeypatch.setattr(ml, "held_out", lambda df, pipeline, key, k=3: fits.append((pipeline.getStages()[-1], k)) or df.withColumn("prediction", F.lit(0.0)))
    plans.QUERIES["boosted_held_out"](spark, "/root/testdata/sf0.001")
    (model, k), whole = fits[0], ml.boosted(["x"], "q").getStages()[-1]
    assert (model.getMaxDepth(), model.getMaxIter(), k) == (whole.getMaxDepth(), whole.getMaxIter(), 3) == (5, 20, 3)


def test_boosted_query_runs_all_rounds(spark, monkeypatch):
    """The model of the blueprint: 500 rounds of depth 5 at a rate of 0.03 and leaves of 20 rows, in each of three folds."""
    from tessarea import plans

    made, real = [], ml.GBTRegressor
    monkeypatch.setattr(ml, "GBTRegressor", lambda **given: made.append(given) or real(**given | {"maxIter": 2}))
    row = plans.QUERIES["boosted_held_out"](spark, "/root/testdata/sf0.001").first()
    assert row.n == 200
    assert [(m["maxIter"], m["maxDepth"], 2 * m["stepSize"]) for m in made] == 3 * [(500, 5, 0.03)]


def test_boosting_by_histograms_is_boosting_by_rows(spark):
    """Few values, so every one has a bin: the predictions are those of plain boosting over rows, whose first tree counts whole."""
    rng, rate, leaf = random.Random(5), 0.3, 20
    rows = [(i, float(a := rng.randrange(6)), float(b := rng.random() < 0.1), a * a * (1 + 2 * b) + rng.random()) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    got = {r.id: (r.fold, r.prediction) for r in ml.held_out_boosted(df, ["a", "b"], "y", "id", 2, 2, 4, rate, leaf).collect()}

    def grow(mine, residual, depth):
        mean = sum(residual[r[0]] for r in mine) / len(mine)
        best = (1e-9, None, None)
        for f in (1, 2) if depth else ():
            for bound in sorted({r[f] for r in mine})[1:]:
                low, high = [r for r in mine if r[f] < bound], [r for r in mine if r[f] >= bound]
                if min(len(low), len(high)) >= leaf:
                    gain = sum(len(side) * (sum(residual[r[0]] for r in side) / len(side) - mean) ** 2 for side in (low, high))
                    best = max(best, (gain, f, bound), key=lambda x: x[0])
        if best[1] is None:
            return lambda r: mean
        _, f, bound = best
        low, high = grow([r for r in mine if r[f] < bound], residual, depth - 1), grow([r for r in mine if r[f] >= bound], residual, depth - 1)
        return lambda r: low(r) if r[f] < bound else high(r)

    for fold in (0, 1):
        train, said = [r for r in rows if got[r[0]][0] != fold], {r[0]: 0.0 for r in rows}
        for i in range(4):
            tree = grow(train, {r[0]: r[3] - said[r[0]] for r in train}, 2)
            said = {r[0]: said[r[0]] + (rate if i else 1) * tree(r) for r in rows}
        for r in rows:
            if got[r[0]][0] == fold:
                assert got[r[0]][1] == pytest.approx(said[r[0]], abs=1e-6)


def test_totals_do_not_double_the_work(spark):
    """Chained totals over joins read each table as often as one does."""
    df = spark.range(200).selectExpr("id", "id % 7 AS g", "id * 1.0D AS v").join(spark.range(7).selectExpr("id AS g", "id * 2 AS z"), "g")
    out = df
    for i in range(4):
        out = rel.share_of_group(out, ["g"], "v", f"s{i}")
    plan = out._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() <= 2
    assert out.agg({"s3": "sum"}).first()[0] == pytest.approx(7)
    shares = rel.basis_shares(df.withColumn("none", F.lit(0.0)), ["g"], ["none", "v"], "share", 0.02)
    assert shares._jdf.queryExecution().optimizedPlan().collectLeaves().size() <= 4
    rows = shares.collect()
    for g in range(7):
        mine = [(r.v, r.share) for r in rows if r.g == g]
        first = [v / sum(x for x, _ in mine) for v, _ in mine]
        kept = [s if s >= 0.02 else 0.0 for s in first]
        assert [s for _, s in mine] == pytest.approx([s / sum(kept) for s in kept])
