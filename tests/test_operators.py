"""Operators on small frames: plain versions of their definitions, NULLs, and jobs that must stop."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessarea.functions import haversine_km, rates, text
from tessarea.operators import allocation, controls, distributed, entities, expect, fits, geo, ledgers, ml, rel, stats
from tessarea.operators.expect import ExpectationError


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(3)
    rows = [(i, None if i % 11 == 0 else "abc"[i % 3], None if i % 13 == 0 else float(rng.randrange(20))) for i in range(300)]
    return rows, spark.createDataFrame(rows, "id int, g string, x double")


def test_running_sums_and_places(numbers):
    rows, df = numbers
    got = {r.id: (r.before, r.at) for r in distributed.positions(distributed.running(df, ["x", "id"], ["g"], before=F.col("id")), ["x", "id"], "at", ["g"]).collect()}
    for g in (None, "a", "b", "c"):
        total = 0
        for at, (i, _, _) in enumerate(sorted((r for r in rows if r[1] == g), key=lambda r: (r[2] is not None, r[2], r[0]))):
            assert got[i] == (total, at)
            total += i


def test_quantiles_buckets_and_ranks(numbers):
    rows, df = numbers
    shares = (0.0, 0.1, 0.5, 0.95, 1.0)
    got = {r.g: list(r)[1:] for r in distributed.quantiles(df, ["g"], "x", shares, ["a", "b", "c", "d", "e"]).collect()}
    for g in (None, "a", "b", "c"):
        want = np.quantile([r[2] for r in rows if r[1] == g and r[2] is not None], shares)
        assert got[g] == pytest.approx(want.tolist())
    for n in (1, 7, 400):
        b = [r.b for r in distributed.buckets(df, ["id"], n, "b").orderBy("id").collect()]
        assert b == [k + 1 for k, part in enumerate(np.array_split(np.arange(300), n)) for _ in part]
    known = [r for r in rows if r[2] is not None and r[1] == "a"]
    rank = {r.id: r.k for r in distributed.average_ranks(df.filter("g = 'a' AND x IS NOT NULL"), "x", "k").collect()}
    for i, _, x in known:
        assert rank[i] == sum(y < x for _, _, y in known) + (sum(y == x for _, _, y in known) + 1) / 2


def test_totals_of_null_groups(numbers):
    rows, df = numbers
    got = {r.id: r.s for r in rel.with_totals(df, ["g"], s=F.count("*")).collect()}
    assert all(got[i] == sum(r[1] == g for r in rows) for i, g, _ in rows)


def test_within_km_at_poles_and_the_date_line(spark):
    rng = random.Random(5)
    spots = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)]
    spots += [(rng.uniform(89, 90), rng.uniform(-180, 180)) for _ in range(40)] + [(rng.uniform(-1, 1), rng.choice([-1, 1]) * rng.uniform(179, 180)) for _ in range(60)] + [(90.0, 0.0), (-90.0, 5.0), (60.0, 180.0), (60.0, -180.0)]
    left = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spots)], "id int, lat double, lon double")
    right = left.toDF("id2", "lat2", "lon2")
    for km in (40.0, 900.0):
        fast = sorted((r.id, r.id2) for r in geo.within_km(left, right, km).collect())
        slow = sorted((r.id, r.id2) for r in left.crossJoin(right).filter(haversine_km("lat", "lon", "lat2", "lon2") <= km).collect())
        assert fast == slow


def ring(*corners):
    return [{"x": float(a), "y": float(b)} for a, b in corners]


def test_clipped_areas_and_lengths(spark):
    window, kind = ring((0, 0), (4, 0), (4, 4), (0, 4)), "array<struct<x: double, y: double>>"
    shapes = {1: (ring((1, 1), (2, 1), (2, 2), (1, 2)), 1.0), 2: (ring((-2, 2), (2, -2), (6, 2), (2, 6)), 16.0), 3: (ring((3, 3), (6, 3), (6, 6), (3, 6)), 1.0), 4: (ring((9, 9), (10, 9), (10, 10)), 0.0), 5: (ring((-1, -1), (5, -1), (5, 5), (-1, 5)), 16.0), 6: (ring((0, 0), (8, 0), (0, 8)), 16.0)}
    df = spark.createDataFrame([(i, s, window) for i, (s, _) in shapes.items()], f"id int, ring {kind}, ring2 {kind}")
    got = {r.id: r.a for r in df.select("id", geo.area(geo.clip_ring(F.col("ring"), F.col("ring2"))).alias("a")).collect()}
    assert got == pytest.approx({i: a for i, (_, a) in shapes.items()})
    lines = {(-1, 2, 5, 2): 4.0, (1, 1, 2, 2): math.sqrt(2), (5, 5, 9, 9): 0.0, (-2, 2, 2, -2): 0.0, (2, -1, 2, 3): 3.0, (3, 5, 5, 3): 0.0, (0, 2, 4, 6): math.sqrt(8)}
    df = spark.createDataFrame([(*map(float, x), window) for x in lines], f"a double, b double, c double, d double, ring2 {kind}")
    got = {(r.a, r.b, r.c, r.d): r.n for r in df.select("a", "b", "c", "d", geo.clipped_length(*map(F.col, "abcd"), F.col("ring2")).alias("n")).collect()}
    assert got == pytest.approx({tuple(map(float, k)): v for k, v in lines.items()})


def test_ranges_and_texts(spark):
    df = spark.createDataFrame([([3, 1, 2, 7, 9, 8, 1],), ([],), (None,), ([5],)], "n array<int>")
    assert [r[0] for r in df.select(text.ranges("n")).collect()] == ["1-3,7-9", "", None, "5"]
    one = spark.createDataFrame([("St. Regis Mohawk Tribal Police", "Tribune City", None)], "a string, b string, c string")
    row = one.select(text.has_word("a", ["tribal"]).alias("a"), text.has_word("b", ["trib"]).alias("b"), text.has_word("c", ["x"]).alias("c"), text.month_number(F.lit(" SEP ")).alias("m"), text.extract("b", r"(\d+)").alias("d")).first()
    assert tuple(row) == (True, False, None, 9, None)


def test_rate_bands_and_guards(spark):
    df = spark.createDataFrame([(5000.0, 1.0), (500.0, 1.0), (50.0, 1.0), (10.0, 0.0)], "p double, a double")
    assert [r[0] for r in df.select(rates.band(rates.density("p", "a"), [(1000, "urban"), (100, "suburban")], "rural")).collect()] == ["urban", "suburban", "rural", "rural"]


def test_carve_out_and_remainder(spark):
    df = spark.createDataFrame([(100.0, 60.0, 30.0), (100.0, 130.0, 5.0), (100.0, -4.0, 200.0)], "t double, r double, i double")
    assert [tuple(r) for r in df.select(*[x.alias(n) for n, x in allocation.carve_out("t", "r", "i").items()]).collect()] == [(60.0, 30.0, 10.0), (100.0, 0.0, 0.0), (0.0, 100.0, 0.0)]
    g = spark.createDataFrame([("k", "a", 2.0), ("k", "b", 6.0), ("k", "rest", 2.0)], "k string, n string, e double").withColumn("t", F.lit(50.0))
    parts = lambda rare: {r.n: r.part for r in allocation.split_remainder(g, ["k"], "t", "e", F.col("n") != "rest", F.lit(rare)).collect()}
    assert parts(False) == {"a": 10.0, "b": 30.0, "rest": 10.0} and parts(True) == {"a": 0.0, "b": 37.5, "rest": 12.5}
    with pytest.raises(ExpectationError):
        allocation.split_remainder(g.filter("n <> 'rest'"), ["k"], "t", "e", F.col("n") != "rest", F.lit(False))


def test_displacement_takes_the_largest_cover(spark):
    s = spark.createDataFrame([("s", 1, 0.5), ("s", 2, 0.5), ("t", 3, 1.0)], "state string, bg int, share double")
    c = spark.createDataFrame([(1, 0.4, "x"), (1, 0.6, "y"), (2, 1.0, "y")], "bg int, cover double, who string")
    got = {(r.state, r.bg): r.share for r in allocation.displace(s, c, ["state"], "bg", "share", "cover").collect()}
    assert got == pytest.approx({("s", 1): 1.0, ("t", 3): 1.0})
    carved = {(r.state, r.bg): r.share for r in allocation.displace(s, c, ["state"], "bg", "share", "cover", F.col("who") == "y").collect()}
    assert carved == pytest.approx({("s", 1): 0.375, ("s", 2): 0.625, ("t", 3): 1.0})
    with pytest.raises(ExpectationError):
        allocation.displace(s, spark.createDataFrame([(3, 1.0, "x")], c.schema), ["state"], "bg", "share", "cover")


def test_basis_ladder_floors_slivers(spark):
    s = spark.createDataFrame([("b", 1, 1000.0), ("b", 2, 16.0), ("c", 3, 1000.0), ("c", 4, 30.0), ("d", 5, 0.0), ("d", 6, 0.0)], "bg string, j int, pop double").withColumn("none", F.lit(0.0))
    got = {r.j: r.share for r in rel.basis_shares(s, ["bg"], ["none", "pop"], "share", 0.02).collect()}
    assert got == pytest.approx({1: 1.0, 2: 0.0, 3: 1000 / 1030, 4: 30 / 1030, 5: 0.5, 6: 0.5})


def test_jobs_that_must_stop(spark):
    a = spark.createDataFrame([(1, "x", 2.0), (2, "y", 3.0)], "k int, v string, n double")
    other = a.withColumn("v", F.lit("z"))
    stops = [
        lambda: expect.vocabulary(a, ["k"], "v", ["x", "y"]), lambda: expect.referential(a, a.filter("k = 1"), ["k"]), lambda: expect.exclusive(a.unionByName(other), ["k"], "v"),
        lambda: expect.within_residual(a.withColumn("left", F.lit(2.5)), ["k"], "n", "left"), lambda: expect.count_is(a, F.col("n") > 2, 2),
        lambda: ledgers.combine(a, other, "k", "v"), lambda: ledgers.override(a, a.unionByName(a), ["k"], ["v"]), lambda: ledgers.rekey(a, a.unionByName(a), "k", "k", "n"),
        lambda: ledgers.no_fill_where_reported(a, F.col("n") > 2, F.col("k") > 1, F.lit(False)), lambda: controls.land_on_controls(a.filter("k = 1"), a.withColumn("m", F.lit(1.0)), ["k"], "n", "m", "v"),
        lambda: controls.by_policy(["a", "b"], {"a": "shared"}, ["shared"]), lambda: controls.relabel(a, spark.createDataFrame([("11", "21"), ("12", "31")], "o string, w string"), "v", "o", "w", 1),
        lambda: allocation.targets_hold(a.withColumn("d", F.lit(2.5)), ["k"], "n", "d"), lambda: allocation.footprint_shares(a.withColumn("w", F.lit(1.0)), ["k"], "v", "n", "w"),
        lambda: allocation.overlap_lanes(a.select(F.lit("c").alias("kind"), F.col("v").alias("place"), "n"), a.filter("k = 1"), {"c": ("v", F.lit(True))}, "n", "k", "n"),
        lambda: entities.gate(a, a, a.filter("k = 1"), ["k"]), lambda: entities.decide(a, a.unionByName(a), ["k"], {}, {}), lambda: entities.passes(a, [a.unionByName(a)], "k", "v"),
    ]
    for stop in stops:
        with pytest.raises(ExpectationError):
            stop()
    expect.vocabulary(a.unionByName(a.withColumn("v", F.when(F.col("v") == "x", "y").otherwise("x"))), ["k"], "v", ["x", "y"])
    expect.referential(a, a, ["k"])
    expect.exclusive(a, ["k"], "v")


def test_mass_neutral_merges_and_masters(spark):
    m = spark.createDataFrame([("a", "f"), ("a", "f"), ("b", "f"), ("b", "g"), ("c", "f"), ("c", None)], "c string, f string")
    assert {r.c: r.applies for r in ledgers.mass_neutral(m, "c", "f").collect()} == {"a": True, "b": False, "c": False}
    one = spark.createDataFrame([(1, 2020, None, "p"), (1, 2021, "n1", None)], "k int, y int, name string, t string")
    two = spark.createDataFrame([(1, 2019, "late", "q"), (2, 2019, None, "q")], one.schema)
    assert {r.k: (r.name, r.t) for r in entities.master([one, two], "k", "y", ["name", "t"]).collect()} == {1: ("n1", "p"), 2: (None, "q")}


def test_features_are_screened(spark):
    df = spark.range(200).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("a_again"), F.lit(1.0).alias("one"), F.lit(None).cast("double").alias("none"), F.when(F.col("id") < 1, 1.0).otherwise(0.0).alias("rare"))
    names = controls.useful_features(df, ["a", "a_again", "one", "none", "rare"], least_nonzero=0.01)
    assert names == ["a", "a_again"] and controls.distinct_columns(df, names, "id") == ["a"]


def test_permuted_blocks_stay_whole(spark):
    df = spark.range(60).select((F.col("id") % 20).alias("k"), "id", (F.col("id") % 20 * 2.0).alias("u"), (F.col("id") % 20 * 3.0).alias("v"))
    rows = ml.permuted(df, "k", ["u", "v"]).collect()
    assert len(rows) == 60 and all(r.v == 1.5 * r.u for r in rows) and len({(r.k, r.u) for r in rows}) == 20
    assert sorted({r.u for r in rows}) == [2.0 * i for i in range(20)] and not any(r.u == 2.0 * r.k for r in rows)


def test_importance_and_held_out_reports(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=400), rng.normal(size=400)
    df = spark.createDataFrame([(i, float(p), float(q), float(3 * p + rng.normal(0, 0.2))) for i, (p, q) in enumerate(zip(a, b, strict=True))], "id int, a double, b double, y double")
    losses = ml.permutation_losses(df.withColumn("g", F.col("id") % 12), ml.ridge(["a", "b"], "y", penalty=0.01), "id", "g", {"a": ["a"], "b": ["b"]}, "y")
    found = {r.block: r for r in ml.importance(losses, 200).collect()}
    assert found["a"].rise > 5 and abs(found["b"].rise) < 0.5
    assert found["a"].keep and found["a"].low < found["a"].rise < found["a"].high and not found["b"].keep
    assert found == {r.block: r for r in ml.importance(losses, 200).collect()}  # repeatable
    for model in (ml.ridge(["a", "b"], "y", penalty=0.01), ml.boosted(["a", "b"], "y")):
        report = ml.fit_report(ml.held_out(df, model, "id"), "y").first()
        assert report.r2 > 0.85 and report.n == 400


def test_least_squares_without_each_group(spark):
    rng = np.random.default_rng(5)
    x = rng.random((90, 2))
    y = x @ [2.0, 0.5] + rng.normal(0, 0.01, 90)
    df = spark.createDataFrame([(i % 3, float(p), float(q), float(v)) for i, ((p, q), v) in enumerate(zip(x, y, strict=True))], "g int, a double, b double, y double")
    got = {r.term: r.median for r in fits.nnls_without_each(df, "g", ["a", "b"], "y").collect()}
    refits = [np.linalg.lstsq(x[np.arange(90) % 3 != g], y[np.arange(90) % 3 != g], rcond=None)[0] for g in range(3)]
    assert [got["a"], got["b"]] == pytest.approx(np.median(refits, axis=0).tolist(), abs=1e-9)


def test_second_computation_of_intervals_and_coefficients(spark):
    """Poisson bounds by summing the distribution; non-negative coefficients by projected gradient."""
    for c in (0, 1, 4, 17):
        low, high = (float(stats.gamma_quantile(p, np.array([k]))[0]) for p, k in ((0.025, c), (0.975, c + 1)))
        tail = lambda m, ks: sum(math.exp(-m + k * math.log(m) - math.lgamma(k + 1)) for k in ks)
        assert tail(high, range(c + 1)) == pytest.approx(0.025, abs=1e-6)
        assert c == 0 or 1 - tail(low, range(c)) == pytest.approx(0.025, abs=1e-6)
    rng = np.random.default_rng(6)
    x = rng.random((80, 3))
    y = x @ [1.5, -1.0, 0.3]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, y double")
    k, step = np.zeros(3), 1 / np.linalg.norm(x.T @ x, 2)
    for _ in range(20_000):
        k = np.maximum(0, k - step * (x.T @ (x @ k - y)))
    assert fits.nnls(df, ["a", "b", "c"], "y") == pytest.approx(k, abs=1e-6)


MASS = [("a", 2020, 5.0), ("a", 2021, 1.0), ("b", 2020, 2.0), ("c", 2021, 4.0), ("d", 2020, 7.0)]
PLACES = [("a", "x"), ("b", "x"), ("c", "y"), ("d", "x"), ("d", "y")]


def ruled(spark, rulings):
    return ledgers.adjudicate(
        spark.createDataFrame(MASS, "e string, yr int, v double"), spark.createDataFrame(PLACES, "e string, p string"), spark.createDataFrame(rulings, "case_id int, old string, new string, verdict string"), "e", ["yr"], ["v"], "p"
    )


def test_rulings_move_mass_where_it_stays_in_its_places(spark):
    rows, cases = ruled(spark, [(1, "b", "a", "merge"), (2, "c", "a", "merge"), (3, "d", "a", "keep")])
    assert {(r.e, r.yr): (r.v, r.merged) for r in rows.collect()} == {("a", 2020): (7.0, 1), ("a", 2021): (1.0, 0), ("c", 2021): (4.0, 0), ("d", 2020): (7.0, 0)}
    assert {r.case_id: (r.status, r.v) for r in cases.collect()} == {1: ("applied", 2.0), 2: ("set aside", 0.0), 3: ("kept", 0.0)}


@pytest.mark.parametrize("rulings", [[(1, "b", "a", "perhaps")], [(1, "b", "a", "merge"), (2, "b", "d", "keep")], [(1, "b", "a", "merge"), (2, "a", "d", "merge")], [(1, "a", "a", "merge")]])
def test_rulings_that_can_not_stand_stop_the_job(spark, rulings):
    with pytest.raises(expect.ExpectationError):
        ruled(spark, rulings)


def test_directives_over_reported_months(spark):
    df = spark.createDataFrame([("a", 12, True), ("b", 12, True), ("c", 2, False), ("d", 12, True)], "e string, months int, usable boolean")
    registry = lambda rows: spark.createDataFrame(rows, "e string, directive string, believable_months int")
    got = {r.e: (r.months, r.usable) for r in ledgers.believable(df, registry([("a", "reads_missing", None), ("b", "partial_year", 5), ("c", "partial_year", 5)]), ["e"], "months", "usable").collect()}
    assert got == {"a": (0, False), "b": (5, False), "c": (2, False), "d": (12, True)}
    for bad in ([("a", "maybe", None)], [("a", "partial_year", None)], [("a", "partial_year", 12)], [("a", "reads_missing", None)] * 2):
        with pytest.raises(expect.ExpectationError):
            ledgers.believable(df, registry(bad), ["e"], "months", "usable")


def test_likeness_of_names():
    from tessarea.functions.text import likeness

    con = __import__("duckdb").connect()
    for a, b in [("martha", "marhta"), ("dwayne", "duane"), ("dixon", "dicksonx"), ("abc", "xyz"), ("a", "a"), ("ab", "ba"), ("", "a"), ("jellyfish", "smellyfish")]:
        assert likeness(a, b) == pytest.approx(con.sql(f"SELECT jaro_winkler_similarity('{a}', '{b}') AS s").df()["s"][0], abs=1e-12)


def test_common_aliases_show_a_few_keys(spark):
    df = spark.range(50).select("id", F.lit("same").alias("a"), F.when(F.col("id") == 3, "own").alias("b"))
    got = {r.alias: (r.n, r["first"]) for r in entities.alias_summary(df, "id", ["a", "b"], 3).collect()}
    assert got == {"same": (50, "0|1|10"), "own": (1, "3")}


def test_stability_of_a_choice(spark):
    """A clear winner is chosen always, a tie within the error goes to the smaller option; rounds repeat."""
    rng = np.random.default_rng(7)
    rows = [(o, f"u{u}", float(rng.normal(m, 0.3))) for o, m in ((0.0, 5.0), (0.5, 1.0), (1.0, 0.99)) for u in range(30)]
    df = spark.createDataFrame(rows, "tau double, unit string, loss double")
    got = {r.tau: r for r in ml.one_se_stability(df, "tau", "unit", "loss", 300).collect()}
    assert got[0.0].chosen_share == 0 and got[0.5].chosen_share > 0.5 and got[0.5].chosen_share + got[1.0].chosen_share == pytest.approx(1)
    assert sum(r.best_share for r in got.values()) == pytest.approx(1) and got[0.0].rounds == 300
    assert got == {r.tau: r for r in ml.one_se_stability(df, "tau", "unit", "loss", 300).collect()}
    from tessarea.operators.stats import multiplicity

    m = {(r.unit, r.round): r.m for r in df.select("unit").distinct().crossJoin(spark.range(1, 301).withColumnRenamed("id", "round").select(F.col("round").cast("int"))).withColumn("m", multiplicity(F.col("unit"), F.col("round"))).collect()}
    won = 0
    for k in range(1, 301):
        w = np.array([m[f"u{u}", k] for u in range(30)])
        found = []
        for o in (0.0, 0.5, 1.0):
            x = np.array([v for p, _, v in rows if p == o])
            n, mean = w.sum(), (w * x).sum() / w.sum()
            found.append((mean, ((w * (x - mean) ** 2).sum() / (n - 1) / n) ** 0.5, o))
        mean, se, _ = min(found)
        won += min(o for v, _, o in found if v <= mean + se) == 0.5
    assert got[0.5].chosen_share == pytest.approx(won / 300)


def test_nearest_match_equals_all_pairs(spark):
    rng = random.Random(3)
    value = lambda: rng.choice([None, *[round(rng.uniform(-999, 9999), 2) for _ in range(30)], 100.0, 1100.0, 2100.0])
    rows = [(i, rng.randrange(4), value()) for i in range(150)]
    others = [(i % 40, rng.randrange(5) // 2 + 1, value()) for i in range(70)]
    gap = lambda a, b: F.floor(F.abs(a - b) / 1000).cast("int")
    far = float("inf")
    plain = {}
    for i, block, v in rows:
        near = [(far if v is None or w is None else abs(v - w) // 1000, e) for e, b, w in others if b == block]
        if near:
            best = {e for g, e in near if g == min(near)[0]}
            plain[i] = min(best) if len(best) == 1 else None
    a, b = spark.createDataFrame(rows, "r long, b int, v double"), spark.createDataFrame(others, "e long, b int, w double")
    assert {x.r: x.e for x in entities.nearest_match(a, b, ["b"], "r", "e", "v", "w", gap).collect()} == plain


def test_blocks_resolve_as_their_pairs_do(spark):
    rng = random.Random(5)
    rows = spark.createDataFrame([(i, rng.randrange(12)) for i in range(60)], "r long, b int")
    others = spark.createDataFrame([(rng.randrange(30), rng.randrange(10), rng.random() < 0.4, rng.random() < 0.3) for _ in range(25)], "e long, b int, a boolean, p boolean")
    flags = ("r", "e", F.col("a"), F.col("p"))
    blocks = entities.resolution_by_block(rows, others, ["b"], *flags)
    assert sorted(blocks.collect()) == sorted(entities.resolution(rows.join(others, "b"), *flags).collect())
    assert blocks.select("status").distinct().count() > 1


def test_names_with_many_bearers_meet_rows_once(spark, monkeypatch):
    aliases = spark.range(500).select(F.lit(1).alias("scope"), F.lit("x").alias("name"), F.col("id").alias("entity"), F.lit(0).alias("priority"))
    made = {}
    plain = type(aliases).join
    monkeypatch.setattr(type(aliases), "join", lambda self, other, *rest, **more: made.update({len(made): plain(self, other, *rest, **more)}) or made[len(made) - 1])
    rows = spark.range(20).select(F.col("id").alias("row"))
    candidates = rows.select("row", F.lit(1).alias("scope"), F.lit("x").alias("name"), F.lit(0).alias("tier"))
    assert entities.tiered_match(rows, "row", candidates, aliases, ["scope"]).filter("entity IS NULL").count() == 20
    assert max(df.count() for df in made.values()) == 20


def test_succession_meets_equal_footprints_once(spark, monkeypatch):
    rng = random.Random(8)
    kinds = [sorted(rng.sample(range(8), rng.randrange(1, 5))) for _ in range(20)]
    held = {i: kinds[rng.randrange(20)] for i in range(400)}
    last = {i: 1990 if rng.random() < 0.5 else 2001 for i in held}
    plain = {}
    for i in held:
        found = [j for j in held if last[j] == 2001 and set(held[i]) <= set(held[j])]
        if last[i] == 1990 and found and i != 7:
            plain[i] = min(found)
    rows = [(i, u) for i in held for u in held[i]] + [(7, None)]
    last[7] = 1990
    made, join = [], type(spark.range(1)).join
    monkeypatch.setattr(type(spark.range(1)), "join", lambda self, *rest, **more: made.append(join(self, *rest, **more)) or made[-1])
    out = ledgers.succession(spark.createDataFrame(list(last.items()), "e long, last int"), spark.createDataFrame(rows, "e long, u int"), "e", "u", 2001)
    plain = {i: min(j for j in held if last[j] == 2001 and set(held[i]) <= set(held[j])) for i in plain if any(last[j] == 2001 and set(held[i]) <= set(held[j]) for j in held)}
    assert {r.dead: r.live for r in out.collect()} == plain
    assert max(df.count() for df in made) <= len(rows)


@pytest.mark.parametrize("names", [str, int])
def test_succession_makes_no_row_of_a_pair(spark, monkeypatch, names):
    """All footprints differ and share a unit: the smallest cover comes from blocks of them, common and rare units alike."""
    rng = random.Random(9)
    held = {i: {0, *rng.sample(range(1, 9), 3 if i % 2 else 5), *([100 + i % 30] if i % 3 == 0 else []), *([200 + i] if i > 12 else [])} for i in range(400)}
    for i in range(1, 400, 2):  # odd ones are silent
        held[i] -= {200 + i} if i % 5 else set()
    live = [j for j in held if j % 2 == 0]
    plain = {i: min(found) for i in held if i % 2 and (found := [j for j in live if held[i] <= held[j]])}
    assert 20 < len(plain) < 180
    rows = [(i, names(u)) for i in held for u in held[i]]
    made, join = [], type(spark.range(1)).join
    monkeypatch.setattr(type(spark.range(1)), "join", lambda self, *rest, **more: made.append(join(self, *rest, **more)) or made[-1])
    footprint = spark.createDataFrame(rows, ["e", "u"])
    last = spark.createDataFrame([(i, 1990 if i % 2 else 2001) for i in held], "e long, last int")
    for more in ({}, {"block": 64}):
        assert {r.dead: r.live for r in ledgers.succession(last, footprint, "e", "u", 2001, **more).collect()} == plain
        assert max(df.count() for df in made) <= len(rows)


def test_succession_without_live_or_silent_ones(spark):
    footprint = spark.createDataFrame([(1, 5), (2, 5), (2, None), (3, None)], "e long, u int")
    for years in ((1990, 1990, 1990), (2001, 2001, 2001), (1990, 1990, 2001)):
        assert ledgers.succession(spark.createDataFrame([(i + 1, y) for i, y in enumerate(years)], "e long, last int"), footprint, "e", "u", 2001).collect() == []
