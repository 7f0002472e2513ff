"""Readers and sinks on small local files."""

import hashlib
import json

import pytest

from tessarea import sources
from tessarea.operators.expect import ExpectationError


def test_strings_keep_zeros_and_other_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ori,name,n\n007,Ávila,1\n010,,2\n", encoding="latin-1")
    got = sources.read_strings(spark, str(tmp_path / "a.csv"), ["ori", "name"]).collect()
    assert [tuple(r) for r in got] == [("007", "Ávila"), ("010", None)]
    (tmp_path / "b.tsv").write_text("ori\tname\n007\tÁvila\n", encoding="utf-8")
    assert [tuple(r) for r in sources.read_strings(spark, str(tmp_path / "b.tsv"), separator="\t").collect()] == [("007", "Ávila")]


def test_hive_scan_prunes(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 5 AS part", "id / 10.0 AS x").write.partitionBy("part").parquet(str(tmp_path / "p"))
    df = sources.hive_scan(spark, str(tmp_path / "p"), "part = 3 AND x BETWEEN 2 AND 5", ["id"])
    assert sorted(r.id for r in df.collect()) == [i for i in range(20, 51) if i % 5 == 3]
    assert all("part=3" in r.filename for r in df.collect()) and "PartitionFilters: [isnotnull(part" in df._jdf.queryExecution().toString()


def test_report_with_preamble(spark, tmp_path):
    (tmp_path / "r.csv").write_text('State report\nprinted 2024,,\n\nOffense,2020,2021\nMurder,5,"1,206"\nArson,-,7\n,,\n')
    got = {tuple(r) for r in sources.read_report(spark, str(tmp_path / "r.csv")).collect()}
    assert got == {("Murder", 2020, 5.0), ("Murder", 2021, 1206.0), ("Arson", 2020, None), ("Arson", 2021, 7.0)}


def test_header_is_sniffed(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Table 8\nof a state\nAgency,Murder,Robbery,Arson\nA,1,2,3\nB,4,5,6\n")
    got = sources.sniffed_table(spark, str(tmp_path / "s.csv"), ["murder", "robbery", "arson"], 2).collect()
    assert [r.asDict() for r in got] == [{"Agency": "A", "Murder": "1", "Robbery": "2", "Arson": "3"}, {"Agency": "B", "Murder": "4", "Robbery": "5", "Arson": "6"}]
    with pytest.raises(ExpectationError):
        sources.sniffed_table(spark, str(tmp_path / "s.csv"), ["nothing"], 1)


def test_features(spark, tmp_path):
    ring = [[0, 0], [2, 0], [2, 1], [0, 0]]
    (tmp_path / "f.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"properties": {"id": 7}, "geometry": {"type": "Polygon", "coordinates": [ring]}}, {"properties": {"id": 8}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}))
    got = {r.id: r.ring for r in sources.read_features(spark, str(tmp_path / "f.json"), "id: long").collect()}
    assert [list(p) for p in got[7]] == [[float(a), float(b)] for a, b in ring] and got[8] is None


@pytest.mark.parametrize("total", [None, "25"])
def test_paged_records_and_features(spark, tmp_path, total):
    for at in range(0, 40, 10):
        rows = [{"id": i, "name": f"n{i}", "when": 1_700_000_000_000 + i} for i in range(at, min(at + 10, 25))]
        (tmp_path / f"r{at}.json").write_text(json.dumps(rows))
        (tmp_path / f"f{at}.json").write_text(json.dumps({"features": [{"attributes": r} for r in rows], "exceededTransferLimit": at < 20}))
    more = {"limit": "10", "together": "2"} | ({"total": total} if total else {})
    for kind, letter in (("socrata", "r"), ("arcgis", "f")):
        df = sources.read_portal(spark, {"portal_type": kind, "url": f"file://{tmp_path}/{letter}{{offset}}.json", **more}, "id long, name string, when long")
        assert sorted(tuple(r) for r in df.collect()) == [(i, f"n{i}", 1_700_000_000_000 + i) for i in range(25)]
    with pytest.raises(ValueError, match="portal_type"):
        sources.read_portal(spark, {"portal_type": "ftp"}, "id long")


def test_pages_are_planned_by_a_count(spark, tmp_path):
    for at in range(0, 30, 10):
        (tmp_path / f"r{at}.json").write_text(json.dumps([{"id": i} for i in range(at, min(at + 10, 25))]))
    for body in ({"count": 25}, [{"count": "25"}], [{"count_1": "25"}]):
        (tmp_path / "n.json").write_text(json.dumps(body))
        df = sources.read_portal(spark, {"portal_type": "socrata", "url": f"file://{tmp_path}/r{{offset}}.json", "count": f"file://{tmp_path}/n.json", "limit": "10", "together": "1"}, "id long")
        assert df.rdd.getNumPartitions() == 3 and sorted(r.id for r in df.collect()) == list(range(25))
    with pytest.raises(Exception, match="r90|No such file|urlopen"):
        sources.read_portal(spark, {"portal_type": "socrata", "url": f"file://{tmp_path}/r{{offset}}.json", "total": "100", "limit": "10", "tries": "2", "wait": "0.01"}, "id long").count()


def test_csv_portal_folds_in_one_pass(spark, tmp_path):
    (tmp_path / "c.csv").write_text("home,work,n\n01,01,3\n01,02,4\n02,02,5\n")
    df = sources.read_portal(spark, {"portal_type": "csv", "url": str(tmp_path / "c.csv")}, "home string, work string, n long")
    assert {r.home: r["sum(n)"] for r in df.groupBy("home").sum("n").collect()} == {"01": 7, "02": 5}


def test_coverage_manifest_and_freshness(spark, tmp_path):
    df = spark.createDataFrame([(2020, 1)] * 3 + [(2021, 1)], "year int, n int")
    assert sources.require_coverage(df, "year", [2020, 2021, 2022], 2) == [2020]
    with pytest.raises(ExpectationError):
        sources.require_coverage(df, "year", [2022], 1)
    (tmp_path / "x.bin").write_bytes(b"abc")
    row = sources.input_manifest(spark, [str(tmp_path / "x.bin")]).first()
    assert (row.bytes, row.sha256) == (3, hashlib.sha256(b"abc").hexdigest())
    assert not sources.is_fresh(spark, str(tmp_path / "built"), [str(tmp_path / "x.bin")])
    (tmp_path / "built").write_text("")
    assert sources.is_fresh(spark, str(tmp_path / "built"), [str(tmp_path / "x.bin")])
    with pytest.raises(FileNotFoundError):
        sources.is_fresh(spark, str(tmp_path / "built"), [str(tmp_path / "lacking")])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b"), (2, None)], "id int, name string").orderBy("id")
    assert sources.markdown_table(df) == "| id | name |\n|---|---|\n| 1 | a\\|b |\n| 2 |  |"
    with pytest.raises(ValueError):
        sources.markdown_table(df, 1)
    for kind in ("csv", "json"):
        sources.write_report(df, str(tmp_path / kind), kind)
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == spark.read.json(str(tmp_path / "json")).count() == 2
    with pytest.raises(ValueError):
        sources.write_report(df, str(tmp_path / "x"), "xls")
