"""Every registered query equals its DuckDB SQL (rows, columns, values)."""

import pytest
from conftest import SF001
from oracle_check import digest

from __spark_entry__ import oracle_sql, queries
from trafficlens.plans.queries import QUERIES

DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "DATE": "date", "BOOLEAN": "boolean"}

QS = queries()
SQL = {k: v for k, v in oracle_sql().items() if k in QUERIES}


def test_every_traffic_query_has_sql():
    assert set(SQL) == set(QUERIES) <= set(QS)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, duck001, name):
    df = QS[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck001.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(dcols, drows)[0]
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    types = duck001.sql(SQL[name]).types
    duck_types = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(dcols, types)}
    assert spark_types == duck_types


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["name", "raw_contribution_pct", "calibrated_contribution_pct",
                          "bot_inflation_pct", "roi", "insight"]
    assert df.count() == 4
