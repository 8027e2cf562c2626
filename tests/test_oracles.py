"""Every query with an SQL twin against DuckDB on the smallest tables."""

import duckdb
import pytest

import check_oracles
from lotledger.catalogue import ORACLES
from lotledger.plans.vehicle_tables import TABLES


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, sf_dir, name):
    verdict, detail, _ = check_oracles.compare(spark, con, name, sf_dir)
    assert verdict == "ok", detail
