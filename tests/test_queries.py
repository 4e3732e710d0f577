"""Every query with an oracle gives the oracle's rows; those without one give rows."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# Their own tests hold these against brute force.
SLOW = ("op", "pipeline")
NAMES = [n for n in entry.queries() if not n.startswith(SLOW) or n in entry.oracle_sql()]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float | decimal.Decimal):
        return repr(round(float(v), 9) + 0.0)
    return str(v)


@pytest.mark.parametrize("name", NAMES)
def test_rows_match_the_oracle(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    sql = entry.oracle_sql()[name].strip()
    want = duck.sql(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({sql})").fetchall()
    assert got == sorted(tuple(map(plain, r)) for r in want)
    assert columns == sorted(duck.sql(sql).columns)


def test_every_query_has_sql_or_is_tested_apart():
    missing = {n for n in entry.queries() if n not in entry.oracle_sql()}
    assert all(n.startswith(SLOW) for n in missing), missing


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_no_product_in_spatial_joins(spark, sf_dir):
    for name in ("J02_best_match", "F01_scope_reason"):
        plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


