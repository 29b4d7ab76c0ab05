"""Donations whose lineitems have quantities that are not whole, against the SQL."""

import os

import duckdb
import pytest

from granary.plans.catalog import QUERIES
from test_catalog import FOLDER, TABLES, same

NAMES = ["clean_donations", "daily_summary", "camp_performance", "contribution", "daily_trend", "donor_pool", "donor_roster"]


@pytest.fixture(scope="module")
def planted(tmp_path_factory):
    """The test tables, where five in seven lineitems have a part of a unit more or less, some below zero."""
    folder = tmp_path_factory.mktemp("planted")
    connection = duckdb.connect()
    for table in TABLES:
        rows = f"SELECT * FROM '{FOLDER}/{table}.parquet'"
        if table == "lineitem":
            rows = f"""SELECT * REPLACE (l_quantity + CASE l_orderkey % 7 WHEN 1 THEN 0.7 WHEN 2 THEN 0.5 WHEN 3 THEN 0.2 WHEN 4 THEN -60.5
                WHEN 5 THEN -60.3 ELSE 0 END AS l_quantity) FROM '{FOLDER}/lineitem.parquet'"""
        connection.execute(f"COPY ({rows}) TO '{os.path.join(folder, table)}.parquet' (FORMAT parquet)")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(folder, table)}.parquet'")
    return str(folder), connection


@pytest.mark.parametrize("name", NAMES)
def test_part_of_a_unit_counts_as_the_nearest_whole(spark, planted, name):
    folder, duck = planted
    assert same(duck, QUERIES[name](spark, folder), name)
