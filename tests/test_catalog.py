"""Every catalog query against its SQL counterpart, and what its plan may not contain."""

import datetime as dt
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_point
from granary.plans.catalog import QUERIES
from granary.plans.oracles import ORACLES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return f"d{value}"
    return repr(float(value)) if isinstance(value, (int, float)) and not isinstance(value, bool) else repr(value)


def table(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in data)


def same(duck, df, name):
    result = duck.execute(ORACLES[name])
    expected = table([c[0] for c in result.description], result.fetchall())
    return table(df.columns, df.collect()) == expected


def check_plan(df):
    """No pairing of everything with everything, no Python rows, no unconditional broadcast."""
    execution = df._jdf.queryExecution()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas|MapInArrow", execution.executedPlan().toString())
    assert "strategy=broadcast" not in execution.analyzed().toString()


def test_catalog_and_sql_cover_each_other():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    assert same(duck, df, name)
    check_plan(df)


LARGE_JOINS = ["enrich", "bank_performance", "donor_roster", "transfers_valid", "event_admission", "transfer_candidates",
               "center_rank", "orphans", "city_stock_b", "layer_metrics"]


@pytest.mark.parametrize("name", LARGE_JOINS)
def test_same_rows_when_nothing_fits_a_broadcast_and_every_partition_is_skewed(spark, duck, conf, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    assert same(duck, QUERIES[name](spark, FOLDER), name)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0 and df.columns[:3] == ["blood_bank_id", "blood_group", "component_type"]


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["demand"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert read and all("l_extendedprice" not in r and "l_tax" not in r for r in read)


def test_watch_list_filter_runs_before_the_place_join(spark):
    plan = QUERIES["zero_stock"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    below_join = plan[plan.index("Join LeftOuter"):]
    assert re.search(r"Filter .*available_units#\d+ = 0", below_join)


def test_ledger_is_shuffled_once_for_the_whole_state(spark):
    execution = QUERIES["stock_state"](spark, FOLDER)._jdf.queryExecution()
    optimized = execution.optimizedPlan().toString()
    assert len(re.findall(r"^\W*Aggregate \[.*blood_bank_id", optimized, re.M)) == 1 and "Join" not in optimized


def test_surplus_matching_limits_rows_before_its_shuffle(spark):
    plan = QUERIES["transfer_candidates"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# Query, column and the values that must occur in it: a wrong rule would change a result.
OCCUR = [
    ("stock_availability_a", "availability_status", {"CRITICAL", "LOW", "MODERATE", "GOOD"}),
    ("shortage_a", "shortage_level", {"CRITICAL", "LOW", "MODERATE", "GOOD"}),
    ("group_summary_b", "availability_status", {"OUT_OF_STOCK", "CRITICAL", "LOW", "AVAILABLE"}),
    ("run_totals", "availability_status", {"OUT_OF_STOCK", "CRITICAL", "LOW", "AVAILABLE"}),
    ("enrich", "donor_exists", {True, False}), ("enrich", "blood_bank_exists", {True, False}),
    ("enrich", "inventory_record_exists", {True, False}), ("enrich", "camp_exists", {True, None}),
    ("enrich", "donor_id", {None}), ("enrich", "blood_bank_id", {None}),
    ("inventory_quality", "blood_bank_exists", {True, False}),
    ("reconcile", "reconciliation_status", {"MATCH", "MISMATCH", "NOT_PUBLISHED", "NOT_IN_LEDGER"}),
    ("stream_admission", "reject_reason", {
        None, "Duplicate donation_id", "Unknown donor_id", "Unknown blood_bank_id", "Unknown camp_id", "blood_group mismatch",
        "Invalid units_donated", "Invalid donation_status", "Missing event_time", "Missing donation_date"}),
    ("standardise_codes", "note", {"Unknown", "line 1", "line 7"}),
]


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name, column, values", OCCUR)
def test_every_case_occurs(folder, name, column, values):
    connection = duckdb.connect()
    for table_ in TABLES:
        connection.execute(f"CREATE VIEW {table_} AS SELECT * FROM '/root/testdata/{folder}/{table_}.parquet'")
    if name == "stream_admission" and folder == "sf0.001":
        values = {"Missing event_time", "Unknown donor_id", "Unknown camp_id"}  # ten banks: few events get further
    found = {r[0] for r in connection.execute(f"SELECT DISTINCT {column} FROM ({ORACLES[name]})").fetchall()}
    assert values <= found


def test_alerts_and_faults_occur(duck):
    assert duck.execute(ORACLES["shortage_alerts"]).fetchall()
    for name in ("inventory_consistency", "stock_precheck"):
        row = duck.execute(f"SELECT * FROM ({ORACLES[name]})").fetchall()
        assert any(v for r in row for v in r if isinstance(v, int))
