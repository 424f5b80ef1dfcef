"""Driver contract and the DuckDB oracle over the smallest tables."""

import datetime as dt
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001, SF01
from sluice.plans import catalog, oracle

TABLES = "documents pages events conversations labels benchmark".split()


def test_entry_runs_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and {r["pipeline_name"] for r in rows} <= {"invoice_pipeline", "contract_pipeline",
                                                           "unclassified_pipeline"}


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


def test_flagship_label_counts_at_sf001(spark):
    from pyspark.sql import functions as F

    from sluice.plans import catalog

    df = catalog.rule_first_match(spark, SF01).groupBy("doc_type").agg(F.count(F.lit(1)).alias("n"))
    assert {r["doc_type"]: r["n"] for r in df.collect()} == {"invoice": 68, "contract": 202, "plain": 198,
                                                            None: 532}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle_at_sf0001(spark, duck, name):
    from sluice.plans.oracle import ORACLE_DIR

    sdf = entry.queries()[name](spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(entry.oracle_sql()[name].replace(ORACLE_DIR, SF001))  # file twins read the folder
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, sdf.columns) == _digest(drows, dcols)
    spark.catalog.clearCache()
