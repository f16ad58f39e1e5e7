"""Every registered query with SQL gives the rows of its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from skeinworks.plans import queries as plans

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sql():
    if not DATA.exists():
        pytest.skip("no driver tables here")
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query(spark, sql, name):
    df, want = plans.queries()[name](spark, str(DATA)), sql.sql(plans.oracle_sql()[name])
    names = sorted(want.columns)
    assert sorted(df.columns) == names
    mine = sorted(tuple(map(str, r)) for r in df.select(*names).collect())
    assert mine == sorted(tuple(map(str, r)) for r in want.project(", ".join(f'"{n}"' for n in names)).fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert {*plans.queries()} <= {*__spark_entry__.queries()}


def test_results_come_from_every_card(spark, tmp_path):
    lines = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string"
    rows = [(k, 10 * j + 1, j, 3 - j, 4.0 + j, 9.5, flag) for k in (None, *range(1, 12)) for j, flag in enumerate("RAN")]
    spark.createDataFrame(rows, lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted(tuple(map(str, r)) for r in plans.queries()["card_results"](spark, str(tmp_path)).collect())
    assert {r[0] for r in got} == {"None", *map(str, range(1, 12))} and len(got) == 24
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    assert got == sorted(tuple(map(str, r)) for r in con.sql(plans.oracle_sql()["card_results"]).fetchall())
