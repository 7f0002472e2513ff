"""Every query with SQL gives the rows that DuckDB gives, at the smallest scale; the others have rows."""

import duckdb
import pandas as pd
import pytest

from tessarea import plans

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(p: pd.DataFrame) -> pd.DataFrame:
    p = p[sorted(p.columns)].copy()
    for c in p.columns:
        kind = str(p[c].dtype)
        if kind.startswith("datetime"):
            p[c] = p[c].astype(str)
        elif kind in ("object", "str"):
            p[c] = p[c].map(lambda v: None if v is None or v != v else float(v) if type(v).__name__ == "Decimal" else str(v))
        elif kind.startswith(("int", "Int", "float")):
            p[c] = p[c].astype(float)
    return p.sort_values(list(p.columns), na_position="first").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_matches_sql(spark, duck, name):
    ours, theirs = plain(plans.QUERIES[name](spark, FOLDER).toPandas()), plain(duck.sql(plans.SQL[name]).df())
    assert list(ours.columns) == list(theirs.columns)
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, rtol=1e-9, atol=2e-6)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_rows_without_sql(spark, name):
    assert plans.QUERIES[name](spark, FOLDER).count() > 0


def test_entry_imports_and_names_agree():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "lane_top1_selection" in entry.queries()


def test_equal_orders_rank_by_key_however_files_lie(spark, tmp_path):
    """Three amounts whose sum depends on the order of additions: the smaller customer comes first."""
    rows = [(1, 0, 0.1), (2, 0, 0.2), (3, 0, 0.3), (6, 1, 0.3), (5, 1, 0.2), (4, 1, 0.1)]
    pd.DataFrame([(k, c, v, pd.Timestamp("1999-05-01")) for k, c, v in rows], columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]).to_parquet(tmp_path / "orders.parquet", coerce_timestamps="us")
    got = {r.cust: (r.place, r.amount) for r in plans.QUERIES["nulls_last_sort"](spark, str(tmp_path)).collect()}
    assert got == {0: (1, 0.1 + 0.2 + 0.3), 1: (2, 0.1 + 0.2 + 0.3)}


def test_rows_without_keys_come_last_among_equals(spark, tmp_path):
    """A NULL customer or year stands behind the others that have its amount, as in SQL."""
    day = pd.Timestamp("1999-05-01")
    rows = [(1, None, 5.0, day), (2, 4, 5.0, None), (3, 4, 5.0, day), (4, 2, 5.0, day), (5, None, 5.0, None), (6, 9, None, day), (7, None, None, day)]
    orders = pd.DataFrame(rows, columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]).astype({"o_custkey": "Int64"})
    orders.to_parquet(tmp_path / "orders.parquet", coerce_timestamps="us")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet'")
    ours, theirs = plain(plans.QUERIES["nulls_last_sort"](spark, str(tmp_path)).toPandas()), plain(con.sql(plans.SQL["nulls_last_sort"]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False)


def test_equal_sizes_tie_among_many_boxes(spark):
    """Sizes of boxes that differ by rounding alone go to the smaller zone; the smallest tables have too few to tell."""
    folder = FOLDER.replace("sf0.001", "sf0.1")
    con = duckdb.connect()
    for name in ("part", "supplier"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    ours, theirs = plain(plans.QUERIES["smallest_polygon"](spark, folder).toPandas()), plain(con.sql(plans.SQL["smallest_polygon"]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False)


def test_lines_with_one_key_count_each(spark, duck, tmp_path):
    """A key that stands twice is two lines, as in SQL; equal places are summed before they meet the zones."""
    parts = duck.sql("SELECT * FROM part UNION ALL SELECT * REPLACE (p_name || 'x' AS p_name) FROM part WHERE p_partkey < 90").df()
    parts.to_parquet(tmp_path / "part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
    for name in ("nation", "supplier"):
        duck.sql(f"SELECT * FROM {name}").df().to_parquet(tmp_path / f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    for name in ("clipped_lines", "pixel_sums", "points_in_shapes"):
        ours, theirs = plain(plans.QUERIES[name](spark, str(tmp_path)).toPandas()), plain(con.sql(plans.SQL[name]).df())
        pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, rtol=1e-9, atol=2e-6)
