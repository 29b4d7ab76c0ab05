"""Donations whose lineitems have copies without a bank, against the SQL."""

import os

import duckdb
import pytest

from granary.plans.catalog import QUERIES
from granary.plans.oracles import ORACLES
from test_catalog import FOLDER, TABLES, same

# Queries that read the deduplicated donations.
NAMES = [
    "dedup", "banks_by_units", "camp_performance", "clean_donations", "contribution", "daily_summary", "daily_trend",
    "day_range", "distribution", "donor_pool", "donor_roster", "donors_by_group",
]


@pytest.fixture(scope="module")
def planted(tmp_path_factory):
    """The test tables, where a third of the lineitems have a copy of the same day whose part has no bank."""
    folder = tmp_path_factory.mktemp("planted")
    connection = duckdb.connect()
    for table in TABLES:
        rows = f"SELECT * FROM '{FOLDER}/{table}.parquet'"
        if table == "lineitem":
            # Part 8 of each 41 has no bank; the copy also tells other units and another status.
            rows += f""" UNION ALL SELECT * REPLACE (l_partkey - l_partkey % 41 + 8 AS l_partkey, l_quantity + 1 AS l_quantity,
                CASE l_returnflag WHEN 'N' THEN 'A' ELSE 'N' END AS l_returnflag) FROM '{FOLDER}/lineitem.parquet' WHERE l_orderkey % 3 = 0"""
        connection.execute(f"COPY ({rows}) TO '{os.path.join(folder, table)}.parquet' (FORMAT parquet)")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(folder, table)}.parquet'")
    return str(folder), connection


@pytest.mark.parametrize("name", NAMES)
def test_a_copy_without_its_bank_is_not_the_one_that_counts(spark, planted, name):
    folder, duck = planted
    assert set(NAMES) <= set(ORACLES)
    assert same(duck, QUERIES[name](spark, folder), name)
