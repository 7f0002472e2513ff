"""Trained operators by held-out accuracy, gradients and recall; empty tables; the pipeline's stages."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessarea.llm import anisotropic_search as ann
from tessarea.llm import language_id, weak_quality
from tessarea.llm import queries as Q

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.identify(docs, language_id.fit(docs)).join(docs.select("doc_id", "lang", "text"), "doc_id").filter("held_out AND lang IS NOT NULL AND lang_pred <> 'und' AND length(text) >= 100")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 50 and right >= 0.9 * n


def test_language_defined_cases(docs):
    got = language_id.identify(docs, language_id.fit(docs)).collect()
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in range(3)] == ["und"] * 3 and by[0].score == 0 and by[None].held_out
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}


def test_signs_that_are_no_letters(spark):
    df = spark.createDataFrame([(1, "½ ② Ⅷ"), (2, "12 _ ٣"), (3, "日")], "doc_id long, text string")
    net = language_id.Network.new(["a", "b"])
    assert [r.lang_pred == "und" for r in sorted(language_id.identify(df, net).collect())] == [True, True, False]


def test_segments_lie_all_over_a_text():
    text = b"".join(i.to_bytes(4, "big") for i in range(12_500))
    places = []
    for k in range(400):
        for x in language_id.drawn(text, k * 0x9E3779B97F4A7C15 & 2**63 - 1):
            assert len(x) == language_id.TRAIN
            places.append(text.index(x))
    assert np.histogram(places, 8, (0, len(text)))[0].min() > 40
    assert language_id.drawn(b"short", 9) == [b"short"] and language_id.drawn(b"", 9) == [b""]


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    net = language_id.Network.new(["a", "b", "c"], hidden=3)
    for p in net.parameters():
        p += rng.standard_normal(p.shape).astype(np.float32) * 0.2
    block, target, weight = rng.integers(97, 101, (4, 6)).astype(np.uint8), np.array([0, 1, 2, 1]), np.ones(4)
    _, grads = language_id.gradients(net, block, target, weight)
    for p, g in zip(net.parameters(), grads, strict=True):
        at = np.unravel_index(int(np.abs(g).argmax()), g.shape)
        old = p[at]
        losses = []
        for step in (0.01, -0.01):
            p[at] = old + step
            losses.append(language_id.gradients(net, block, target, weight)[0])
        p[at] = old
        assert (losses[0] - losses[1]) / 0.02 == pytest.approx(g[at], rel=0.05, abs=1e-4)


def test_quality_against_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality IS NOT NULL").select("doc_id", "quality").distinct()
    got = weak_quality.score(docs, weak_quality.fit(docs)).join(labels, "doc_id")
    kept = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert kept.get((0, False), 0) >= 0.9 * (kept.get((0, True), 0) + kept.get((0, False), 0)) > 0
    assert kept.get((1, True), 0) >= 0.95 * (kept.get((1, True), 0) + kept.get((1, False), 0))  # no label was used in fitting


def test_expectation_maximisation_recovers_accuracies():
    rng = np.random.default_rng(0)
    n, k = 20_000, len(weak_quality.LABELLERS)
    good = rng.random(n) < 0.8
    rates = np.linspace(0.75, 0.95, k)
    right = rng.random((n, k)) < rates
    votes = np.where(right == good[:, None], 2, 1)
    votes[rng.random((n, k)) < 0.2] = 0
    patterns, counts = np.unique(votes @ 3 ** np.arange(k), return_counts=True)
    _, accuracy = weak_quality.expectation_maximisation(patterns, counts)
    assert np.abs(accuracy - rates).max() < 0.03


def brute(x, ids, q, k):
    """Copies of one vector must score alike, so norms and products are summed one way for all."""
    out = []
    for c, v in zip(ids, x, strict=True):
        if c != q[0]:
            out.append((-float((v * q[1]).sum() / (np.linalg.norm(v) * np.linalg.norm(q[1]))), c))
    return sorted(out)[:k]


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((1500, 17))
    x[100:130] = x[50]  # copies of a query
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(2000, None), (2001, [0.0] * 17), (2050, [None, *[1.0] * 16]), (2003, [float("nan"), *[1.0] * 16]), (2004, [float("inf"), *[1.0] * 16]), (None, [1.0] * 17)]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumns({"raw": F.lit(1), "codes": F.lit(1), "cell": F.lit(1), "h": F.lit(1)})
    index, words = ann.build(table)
    got = ann.search(index, words, F.col("vec_id") % 50 == 0).collect()
    found: dict = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == set(range(0, 1500, 50))
    hits = 0
    for q, near in found.items():
        want = brute(x, range(1500), (q, x[q]), 5)
        hits += len({c for _, c in want} & {c for c, _ in near})
        for c, s in near:
            assert s == pytest.approx(float(x[c] @ x[q] / (np.linalg.norm(x[c]) * np.linalg.norm(x[q]))), abs=1e-12)
        assert near == sorted(near, key=lambda p: (-p[1], p[0]))
    assert hits >= 0.9 * 5 * len(found)
    assert [c for c, _ in found[50]] == [100, 101, 102, 103, 104]  # ties to the smaller ids
    assert ann.search(*ann.build(table.filter("vec_id < 3")), F.col("vec_id") % 50 == 0).count() == 2
    assert ann.search(*ann.build(table.limit(0)), F.col("vec_id") % 50 == 0).count() == 0


def test_vectors_of_other_lengths_take_no_part(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(6 if i % 10 else 9).tolist()) for i in range(1, 60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(*ann.build(table), F.col("vec_id") % 7 == 0).collect()
    assert {r.query_id for r in got} == {i for i in range(7, 60, 7) if i % 10} and all(r.vec_id % 10 for r in got)


def test_recall_on_full_cells(spark):
    """Independent vectors, several full cells: the 96 that are ranked first are about 1 % of a cell."""
    rng = np.random.default_rng(12)
    x = rng.standard_normal((3 * ann.CELL, 24))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found: dict = {}
    for r in ann.search(*ann.build(table), F.col("vec_id") % 500 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    length = np.linalg.norm(x, axis=1)
    for q in range(0, len(x), 500):
        cosine = x @ x[q] / (length * length[q])
        cosine[q] = -2
        assert found[q] == set(np.argsort(-cosine)[:5].tolist())


def test_recall_on_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    local = [(r.vec_id, np.array(r.embedding, float)) for r in table.collect() if r.embedding is not None and all(v is not None and np.isfinite(v) for v in r.embedding) and any(r.embedding)]
    ids, x = [i for i, _ in local], np.stack([v for _, v in local])
    index, words = ann.build(table)
    found: dict = {}
    for r in ann.search(index, words, F.col("vec_id") % 50 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    want = {q: {c for _, c in brute(x, ids, (q, v), 5)} for q, v in local if q % 50 == 0}
    assert sum(len(found[q] & want[q]) for q in want) >= 0.9 * sum(map(len, want.values()))


@pytest.mark.parametrize("name", [n for n in Q.queries() if n != "op5_nearest_neighbours"])
def test_queries_on_an_empty_table(spark, tmp_path, nothing, name):
    nothing.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert Q.queries()[name](spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("case", ["full", "empty"])
def test_stages_keep_the_columns(spark, tmp_path, docs, nothing, case):
    docs = docs if case == "full" else nothing
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert kept.columns == docs.columns
            assert kept.count() <= docs.count()
        docs = kept
    assert case == "full" or docs.count() == 0


def test_pipeline_on_the_table(spark):
    """Clean labelled documents stay but for near copies; every piece lies in a sequence without gaps."""
    packed = corpus_pipeline.run(spark, SF)
    gaps = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).filter("n <> end OR end > 2048")
    assert gaps.count() == 0 and packed.count() > 0


def test_nearest_neighbours_among_near_copies(spark):
    """Full cells in which a third of the vectors differ by little: most share a few codes, yet all true neighbours are found."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((2 * ann.CELL, 32))
    hot = np.arange(0, len(x), 3)
    x[hot] = x[0] + rng.normal(0, 1e-3, (len(hot), 32))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found: dict = {}
    for r in ann.search(*ann.build(table), F.col("vec_id") % 500 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    length = np.linalg.norm(x, axis=1)
    for q in range(0, len(x), 500):
        cosine = x @ x[q] / (length * length[q])
        cosine[q] = -2
        assert found[q] == set(np.argsort(-cosine)[:5].tolist())


def test_repeated_rows_teach_once(spark, monkeypatch):
    """100,000 equal rows beside few others: the fitting task gets one of them, and the other language is learned."""
    english = [f"the cat sat on the mat number {i} and then went on to the other house" for i in range(60)]
    german = [f"der hund lief durch den wald nummer {i} und kam dann wieder nach hause" for i in range(60)]
    rows = [(i, t, lang) for i, (t, lang) in enumerate([*((t, "en") for t in english), *((t, "de") for t in german)])]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    again = spark.range(100_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(english[1]).alias("text"), F.lit("en").alias("lang"))
    got = {}
    seen = type(table).groupBy

    def counted(self, *keys):
        if keys == ("one",):
            got["rows"] = self.count()
        return seen(self, *keys)

    monkeypatch.setattr(type(table), "groupBy", counted)
    net = language_id.fit(table.unionByName(again), sample=200)
    assert net.langs == ["de", "en"] and got["rows"] <= 2 * 120


def test_every_language_is_learned(spark):
    rows = [(i, f"wort{i % 90} rede sprache {i}", f"l{i % 90}") for i in range(900)]
    net = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=30)
    assert len(net.langs) == 90


def test_repeated_ids_and_extreme_vectors(spark):
    rng = np.random.default_rng(21)
    x = rng.standard_normal((120, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(0, x[0].tolist()), (0, x[7].tolist()), (200, (x[50] * 1e200).tolist()), (201, (x[50] * 1e-200).tolist()), (202, (x[50] * 1e308 / np.abs(x[50]).max()).tolist()), (203, (x[50] * 5e-324 / np.abs(x[50]).max()).tolist())]
    rows += [(50, x[9].tolist())] * 3
    found: dict = {}
    for r in ann.search(*ann.build(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), F.col("vec_id") % 50 == 0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(len(v) for v in found.values()) == [5, 5, 15, 20]  # 100 and 200 once, 0 three times, 50 four times
    assert all(np.isfinite(s) and abs(s) <= 1 + 1e-12 for v in found.values() for *_, s in v)
    assert {i for _, i, s in found[200] if s > 1 - 1e-9} >= {50, 201, 202}
    own = [(i, s) for rank, i, s in found[0] if rank == 1]
    assert sum(i == 0 and s > 1 - 1e-12 for i, s in own) == 2 and any(i == 7 for i, _ in own)
    assert sum(i == 9 and s > 1 - 1e-12 for _, i, s in found[50]) == 3 and sum(i == 50 and s > 1 - 1e-12 for _, i, s in found[50]) == 6
