"""Donations whose lineitems lack their line number, and so have no id, against the SQL."""

import os

import duckdb
import pytest

from granary.plans.catalog import QUERIES
from test_catalog import FOLDER, TABLES, same

NAMES = ["daily_summary", "camp_performance", "contribution", "daily_trend", "donor_pool", "donor_roster"]


@pytest.fixture(scope="module")
def planted(tmp_path_factory):
    """The test tables, where two in five parts' lineitems have no line number."""
    folder = tmp_path_factory.mktemp("planted")
    connection = duckdb.connect()
    for table in TABLES:
        rows = f"SELECT * FROM '{FOLDER}/{table}.parquet'"
        if table == "lineitem":
            rows = f"SELECT * REPLACE (CASE WHEN l_partkey % 5 > 1 THEN l_linenumber END AS l_linenumber) FROM '{FOLDER}/lineitem.parquet'"
        connection.execute(f"COPY ({rows}) TO '{os.path.join(folder, table)}.parquet' (FORMAT parquet)")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(folder, table)}.parquet'")
    return str(folder), connection


@pytest.mark.parametrize("name", NAMES)
def test_a_donation_without_an_id_counts_with_its_units(spark, planted, name):
    folder, duck = planted
    assert same(duck, QUERIES[name](spark, folder), name)
