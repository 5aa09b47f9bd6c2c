"""Every registered job against its independent DuckDB SQL on sf0.001 (the
same check the driver runs at sf0.01), plus the driver entry points."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import rows_of  # noqa: E402

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from martlake.sources.tables import TABLES, table_path
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    yield con
    con.close()


def test_every_survey_key_registered():
    assert len(QUERIES) >= 51
    assert set(ORACLE) <= set(QUERIES)
    assert set(E.REGISTRY) <= set(ORACLE)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    rel = duck.execute(ORACLE[key])
    dcols, drows = [d[0] for d in rel.description], rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(scols, srows) == rows_of(dcols, drows)


def test_entry(spark):
    out = E.entry(spark)
    assert out.columns == ["ProductID", "QuantitySold", "QuantityFluctuation", "LastUpdated"]
    assert out.count() > 0
