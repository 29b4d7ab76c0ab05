"""Donors that lack their id, against the SQL."""

import os

import duckdb
import pytest

from granary.plans.catalog import QUERIES
from test_catalog import FOLDER, TABLES, same


@pytest.mark.parametrize("name", ["donor_pool", "donors_by_group"])
def test_a_donor_without_an_id_is_in_the_pool(spark, tmp_path, name):
    connection = duckdb.connect()
    for table in TABLES:
        rows = f"SELECT * FROM '{FOLDER}/{table}.parquet'"
        if table == "customer":
            rows = f"SELECT * REPLACE (CASE WHEN c_custkey % 3 > 0 THEN c_custkey END AS c_custkey) FROM '{FOLDER}/customer.parquet'"
        connection.execute(f"COPY ({rows}) TO '{os.path.join(tmp_path, table)}.parquet' (FORMAT parquet)")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(tmp_path, table)}.parquet'")
    assert same(connection, QUERIES[name](spark, str(tmp_path)), name)
