import json
import shutil
from functools import partial

import pytest
from pyspark.sql import functions as F

from helpers import by, rows
from granary.operators import checks
from granary.plans.layers import Lake, run_all, run_bronze, run_checks, run_ledger, together
from granary.sources import files, schemas

CSV = {
    "donors": """donor_id,full_name,gender,age,blood_group,city,state,registration_date,last_donation_date,eligibility_status
D1,Ann,Female,30,o neg,Pune,MH,2022-01-01,2026-01-05,Eligible
D2,Ben,Male,40,A+,Agra,UP,2022-01-01,,Eligible
D3,Cy,,50,AB NEG,,MH,2022-01-01,,
""",
    "blood_banks": """blood_bank_id,blood_bank_name,city,state,address,latitude,longitude,storage_capacity,operating_status
B1,One,Pune,MH,"1 Road
Pune, MH",18.5,73.8,100,Active
B2,Two,Agra,UP,"2 ""Old"" Road",27.1,78.0,50,Active
""",
    "blood_inventory": """inventory_id,blood_bank_id,blood_group,available_units,reserved_units,last_updated,inventory_status
I1,B1,O-,12,0,2026-08-01 10:00:00,GOOD
I2,B2,O-,0,0,2026-08-01 10:00:00,CRITICAL
I3,B1,AB-,3,0,2026-08-01 10:00:00,LOW
I4,B1,A-,7,0,2026-08-01 10:00:00,NORMAL
I5,B1,B-,7,0,2026-08-01 10:00:00,NORMAL
I6,B1,A+,seven,0,2026-08-01 10:00:00,NORMAL
""",
    "donation_camps": """camp_id,camp_name,organizer,city,state,camp_date,location,expected_donors
C1,Camp,Org,Pune,MH,2026-01-01,"Field, Pune",10
C2,Idle,,Agra,UP,2026-01-01,,10
""",
    "donations": """donation_id,donor_id,blood_bank_id,camp_id,donation_date,blood_group,units_donated,donation_status
X1,D1,B1,C1,2026-01-05,o neg,2,complete
X1,D1,B1,C1,2026-01-05,o neg,2,complete
X2,D2,B1,,2026-02-05,A+,1,Completed
X3,D2,B2,,2026-02-05,A+,1,Canceled
X4,D3,B2,C1,2026-03-05,AB-,4,success
""",
}
LEDGER = """transaction_id,blood_bank_id,blood_group,component_type,transaction_type,units,transaction_timestamp,source_donation_id,source_transfer_id,destination_bank_id,status,issue_id
T1,B1,O-,RBC,DONATION,9,2026-08-10 10:00:00,X1,,,POSTED,
T2,B1,O-,RBC,ISSUE,2,2026-08-11 10:00:00,,,,POSTED,I1
T3,B1,O-,RBC,TRANSFER_OUT,3,2026-08-12 10:00:00,,F1,B2,POSTED,
T4,B2,O-,RBC,TRANSFER_IN,3,2026-08-12 10:00:00,,F1,,POSTED,
T5,B1,AB-,RBC,DONATION,4,2026-08-01 10:00:00,X4,,,POSTED,
T6,B1,AB-,RBC,EXPIRY,1,2026-08-12 10:00:00,,,,POSTED,
T7,B1,A-,RBC,DONATION,4,2026-08-01 10:00:00,,,,POSTED,
T8,B1,A-,RBC,ADJUSTMENT,-1,2026-08-12 10:00:00,,,,POSTED,
T9,B1,B-,RBC,DONATION,4,2026-08-01 10:00:00,,,,POSTED,
"""
TRANSFERS = """transfer_id,source_bank_id,destination_bank_id,blood_group,component_type,units,transfer_date,status
F1,B1,B2,O-,RBC,3,2026-08-12,COMPLETED
F2,B1,B1,O-,RBC,3,2026-08-12,COMPLETED
"""


@pytest.fixture
def lake(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, content in CSV.items():
        (raw / f"{name}.csv").write_text(content)
    (raw / "inventory_transactions.csv").write_text(LEDGER)
    (raw / "blood_transfers.csv").write_text(TRANSFERS)
    landing = tmp_path / "streaming" / "landing"
    landing.mkdir(parents=True)
    event = dict(donation_id="L1", donor_id="D1", blood_bank_id="B1", camp_id=None, donation_date="2026-08-12", blood_group="O-",
                 units_donated=1, donation_status="Completed", event_time="2026-08-12T20:28:14", source="live", event_type="blood_donation")
    (landing / "e1.json").write_text(json.dumps(event, indent=2))
    return Lake(str(tmp_path))


def test_all_layers(spark, lake, policy):
    overall = by(run_all(spark, lake, policy), "section")
    gold = lambda name: spark.read.parquet(lake.gold(name))
    bronze = spark.read.parquet(lake.bronze("blood_banks"))
    assert bronze.count() == 2 and "\n" in by(bronze, "blood_bank_id")["B1"]["address"]
    metrics = spark.read.parquet(lake.silver("data_quality")).collect()[0].asDict()
    assert (metrics["historical_donations"], metrics["streaming_donations"], metrics["combined_donations"], metrics["duplicates_removed"]) == (5, 1, 6, 1)
    assert rows(gold("daily_donation_summary"), "total_units_donated") == [(1,), (1,), (2,), (4,)]
    assert rows(gold("blood_group_distribution")) == [("A+", 1, 1, 12.5), ("AB-", 1, 4, 50.0), ("O-", 2, 3, 37.5)]
    assert rows(gold("rare_donor_summary")) == [("AB-", 1, 1, 1, 4), ("O-", 1, 1, 2, 3)]
    assert rows(gold("gold_blood_shortage_report"), "blood_group", "shortage_level") == [
        ("A-", "MODERATE"), ("AB-", "LOW"), ("B-", "MODERATE"), ("O-", "GOOD")]
    state = by(gold("gold_inventory_state"), "blood_bank_id", "blood_group")
    assert {k: r["available_units"] for k, r in state.items()} == {
        ("B1", "O-"): 4, ("B2", "O-"): 3, ("B1", "AB-"): 3, ("B1", "A-"): 3, ("B1", "B-"): 4}
    assert {k: r["is_valid"] for k, r in by(gold("gold_transfer_history"), "transfer_id").items()} == {"F1": True, "F2": False}
    failed = {s: r["failed_checks"] for s, r in overall.items() if r["status"] == "FAIL" and s != "OVERALL"}
    # Raw rules see the raw text: "seven" is no number, one city is blank, two groups are spelled out.
    assert failed == {"missing_values": "blood_inventory.available_units, donors.city", "donors": "invalid_group",
                      "allowed_values": "donations.blood_group, donors.blood_group"}
    ingest = spark.read.schema(checks.SHAPE).json(f"{lake.root}/validation/ingest")
    assert {r["status"] for r in ingest.collect()} == {"PASS"} and ingest.count() == 5
    # A small report is one file.
    import glob
    assert len(glob.glob(f"{lake.gold('blood_shortage_report')}/part-*.parquet")) == 1


def test_missing_tables_are_reported_or_raised(spark, lake, policy, tmp_path):
    run_bronze(spark, lake)
    early = by(checks.overall(run_checks(spark, lake, policy)), "section")
    assert {early[s]["status"] for s in ("bronze", "foreign_keys")} == {"PASS"}
    assert {early[s]["status"] for s in ("duplicates", "clean_layer", "streaming")} == {"SKIPPED"}
    # Raw movements exist, so absent ledger tables are a fault, as are absent silver and gold tables.
    assert {early[s]["status"] for s in ("silver", "gold", "ledger", "OVERALL")} == {"FAIL"}
    with pytest.raises(files.MissingTable):
        files.read_table(spark, lake.silver("donors"), "donors")
    with pytest.raises(files.MissingColumns):
        files.read_table(spark, lake.bronze("donors"), "donors", ["donor_id", "shoe_size"])
    absent = checks.table_present(spark, "gold", "x", lake.gold("x"), ["a"]).collect()[0]
    assert (absent["status"], absent["detail"]) == ("FAIL", "not found or unreadable")
    lacking = checks.table_present(spark, "bronze", "donors", lake.bronze("donors"), ["a"]).collect()[0]
    assert lacking["detail"] == "missing columns: a"
    listed = files.read_optional_csv(spark, str(tmp_path / "none.csv"), schemas.TRANSFERS)
    assert listed.count() == 0 and listed.columns[0] == "transfer_id"


@pytest.mark.parametrize("status, code", [("FAIL", 1), ("PASS", 0)])
def test_command_line_prints_sections_and_fails_on_failure(spark, conf, capsys, monkeypatch, status, code):
    from granary import __main__ as command
    from granary.tuning import settings

    for key in settings(1, 8):
        conf(key, spark.conf.get(key))
    called = []

    def stub(session, lake, policy, with_stream):
        called.append((lake.root, policy.as_of.isoformat(), with_stream))
        return checks.overall(session.createDataFrame([("gold", "daily", status, 1, None)], checks.SHAPE))

    monkeypatch.setattr(command, "run_all", stub)
    assert command.main(["/lake", "--as-of", "2026-08-15", "--input-gb", "0.001", "--no-stream"]) == code
    assert called == [("/lake", "2026-08-15", False)]
    assert [line.split()[:2] for line in capsys.readouterr().out.splitlines()] == [["OVERALL", status], ["gold", status]]


def test_shuffle_width_follows_the_data():
    from granary.tuning import GIB, settings

    assert settings(GIB, 8)["spark.sql.shuffle.partitions"] == "16"
    assert int(settings(100 * 1024 * GIB, 8000)["spark.sql.shuffle.partitions"]) == 204800


def test_a_report_replaces_the_old_one_and_a_torn_swap_is_mended(spark, tmp_path):
    from granary.sources import files

    path = str(tmp_path / "gold")
    files.write_report(spark.range(3), path)
    files.write_report(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and {p.name for p in tmp_path.iterdir()} == {"gold"}
    # The driver died after the old table had made room.
    (tmp_path / "gold").rename(tmp_path / "gold.old")
    failing = spark.range(2).selectExpr("raise_error('broken') as id")
    try:
        files.write_report(failing, path)
    except Exception:
        pass
    else:
        raise AssertionError("the write should have failed")
    assert spark.read.parquet(path).count() == 5
    files.write_report(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7


def test_an_ordered_table_skips_files_by_their_bounds(spark, conf, tmp_path):
    """Rows lie in few files by day, one day that holds most rows in several of them; a filter reaches the scan."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    path = str(tmp_path / "gifts")
    day = "date_add(date'2026-01-01', if(id % 10 < 9, 40, cast(id % 100 as int)))"
    gifts = spark.range(8000).selectExpr(f"{day} as day", "id as key")
    files.write_table(gifts, path, ["day", "key"])
    spans = spark.read.parquet(path).groupBy("_metadata.file_path").agg({"day": "min", "key": "count"}).collect()
    assert 2 <= len(spans) <= 4 and max(r["count(key)"] for r in spans) < 4000
    assert len({r["min(day)"] for r in spans}) < len(spans) or len(spans) < 3  # the large day goes on in another file
    one_day = spark.read.parquet(path).where("day = date'2026-01-10'")
    assert "PushedFilters: [IsNotNull(day), EqualTo(day," in one_day._jdf.queryExecution().executedPlan().toString()
    assert one_day.count() == gifts.where("day = date'2026-01-10'").count() > 0


def test_the_ledger_is_parsed_once_and_read_from_its_stored_copy(spark, lake, policy):
    run_ledger(spark, lake, policy)
    stored = spark.read.parquet(lake.bronze("inventory_transactions"))
    text = files.read_ledger(spark, lake.raw("inventory_transactions"))
    assert rows(stored.select(*text.columns)) == rows(text) and set(schemas.LINEAGE) <= set(stored.columns)
    # The checks pass on the stored copy, and on the text where a lake has no such copy.
    ledger_rules = ("ledger", "reconciliation", "stock_state", "transfer_legs", "transfers")
    by_copy = run_checks(spark, lake, policy).where(F.col("section").isin(*ledger_rules))
    seen = rows(by_copy, "section", "check_name", "status", "value")
    shutil.rmtree(lake.bronze("inventory_transactions"))
    by_text = run_checks(spark, lake, policy).where(F.col("section").isin(*ledger_rules))
    assert seen and rows(by_text, "section", "check_name", "status", "value") == seen


def test_independent_jobs_give_results_in_order_and_a_failure_stops_none(spark):
    done = []

    def job(number):
        done.append(spark.range(number).count())
        if number == 2:
            raise ValueError("job 2")
        return number

    assert together(spark, *[partial(job, n) for n in (5, 1, 7, 3, 4, 6)]) == [5, 1, 7, 3, 4, 6]
    done.clear()
    with pytest.raises(ValueError, match="job 2"):
        together(spark, *[partial(job, n) for n in (2, 1, 3, 4, 5, 6)])
    assert sorted(done) == [1, 2, 3, 4, 5, 6]
