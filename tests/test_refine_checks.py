import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import by, rows
from granary.operators import checks, keyed, refine
from granary.operators.admission import judge
from granary.sources import schemas

NOW = dt.datetime(2026, 8, 15, 9)
DAY = dt.date(2026, 8, 1)


def donors_raw(spark):
    return spark.createDataFrame(
        [("D1", "Ann", " F ", 17, "o neg", None, "MH", DAY, DAY - dt.timedelta(days=1), "Eligible"),
         ("D1", "Ann", " F ", 17, "o neg", None, "MH", DAY, DAY - dt.timedelta(days=1), "Eligible"),
         ("D2", "Ben", "", 18, "A positive", " Pune ", "MH", DAY, None, " "),
         ("D3", None, "M", 65, "ABPOS", "Agra", "UP", DAY, DAY, "Retired"), ("D4", "Di", "F", None, None, "Agra", "UP", None, DAY, None)],
        schemas.RAW_TABLES["donors"])


def test_donors_are_cleaned_and_flagged(spark, policy):
    got = by(refine.donors(donors_raw(spark), policy), "donor_id")
    assert len(got) == 4
    pick = lambda i, *c: tuple(got[i][k] for k in c)
    assert pick("D1", "gender", "city", "blood_group", "is_valid_age", "overall_data_quality_status") == ("F", "Unknown", "O-", False, "REVIEW")
    assert pick("D2", "gender", "city", "eligibility_status", "overall_data_quality_status") == ("Unknown", "Pune", "Unknown", "VALID")
    assert pick("D3", "is_valid_blood_group", "is_valid_age") == (False, True)
    assert pick("D4", "is_valid_blood_group", "is_valid_age", "overall_data_quality_status") == (None, False, "REVIEW")


def test_banks_inventory_and_camps(spark, policy):
    banks = refine.banks(spark.createDataFrame(
        [("B1", "One", "Pune", "MH", "x", 90.0, -180.0, 1, "Active"), ("B2", "Two", "Pune", "MH", "x", 90.1, 0.0, 0, "Active"),
         ("B3", "Three", "Pune", "MH", "x", None, 0.0, None, "Active")], schemas.RAW_TABLES["blood_banks"]), policy)
    got = by(banks, "blood_bank_id")
    assert [got[b]["overall_data_quality_status"] for b in ("B1", "B2", "B3")] == ["VALID", "REVIEW", "REVIEW"]
    assert (got["B3"]["is_valid_coordinates"], got["B3"]["is_valid_capacity"]) == (None, False)
    inventory = by(refine.inventory(spark.createDataFrame(
        [("I1", "B1", "b neg", 0, 0, NOW, "LOW"), ("I2", "ZZ", "O-", 1, 0, NOW, "LOW"), ("I3", None, "O-", -1, 0, NOW, "LOW"),
         ("I4", "B1", "O-", None, 0, NOW, "LOW")], schemas.RAW_TABLES["blood_inventory"]), banks, policy), "inventory_id")
    assert {i: (r["is_valid_units"], r["blood_bank_exists"], r["overall_data_quality_status"]) for i, r in inventory.items()} == {
        "I1": (True, True, "VALID"), "I2": (True, False, "REVIEW"), "I3": (False, False, "REVIEW"), "I4": (False, True, "REVIEW")}
    assert inventory["I1"]["is_rare_blood"] is True
    camps = by(refine.camps(spark.createDataFrame(
        [("C1", "Camp", " ", None, "MH", DAY, "x", 10), ("C2", "Camp", "Org", "Pune", "MH", None, "x", 10)],
        schemas.RAW_TABLES["donation_camps"])), "camp_id")
    assert (camps["C1"]["organizer"], camps["C1"]["city"], camps["C2"]["overall_data_quality_status"]) == ("Unknown", "Unknown", "REVIEW")


def raw_donations(spark):
    return spark.createDataFrame(
        [("X1", "D1", "B1", None, DAY, "o neg", 1, "complete"), ("X1", "D1", "B1", None, DAY, "o neg", 1, "complete"),
         ("X2", "D9", "B1", "C1", DAY, "A+", 5, "Canceled"), ("X3", "D2", "B9", "C9", dt.date(2026, 8, 16), "A+", 6, "on hold"),
         ("X4", "D2", None, "C1", None, None, None, None)],
        schemas.RAW_TABLES["donations"],
    ).withColumns({"_ingested_at": F.lit(NOW), "_source_file": F.lit("donations.csv"), "_ingestion_date": F.lit(NOW.date())})


def live_donations(spark):
    return spark.createDataFrame(
        [("X2", "D1", "B1", None, DAY, "O-", 2, "Completed", NOW, "live", "blood_donation"),
         ("L1", "D1", "B1", None, DAY, "O-", 2, "Completed", NOW, "live", "blood_donation")], schemas.DONATION_EVENT,
    ).withColumns({"_ingested_at": F.lit(NOW - dt.timedelta(days=1)), "_source_file": F.lit("f.json"), "_ingestion_date": F.lit(NOW.date())})


def cleaned(spark, policy):
    parts = refine.combine(refine.donations(raw_donations(spark), policy), refine.donations(live_donations(spark), policy, batch=False))
    return parts, refine.with_quality(refine.dedupe_donations(parts), policy)


def test_batch_and_live_meet_in_one_shape(spark, policy):
    parts, clean = cleaned(spark, policy)
    assert parts.columns == list(refine.DONATION_SHAPE) and parts.count() == 7
    got = by(clean, "donation_id")
    assert got["X2"]["source"] == "live"  # ingested earlier
    assert (got["X1"]["source"], got["X1"]["event_time"], got["X1"]["event_type"]) == ("historical_batch", None, "blood_donation")
    flags = ("is_valid_blood_group", "is_valid_donation_quantity", "is_valid_donation_date", "is_valid_donation_status", "overall_data_quality_status")
    assert tuple(got["X1"][f] for f in flags) == (True, True, True, True, "VALID")
    assert tuple(got["X3"][f] for f in flags) == (True, False, False, False, "REVIEW")
    assert tuple(got["X4"][f] for f in flags) == (None, False, False, None, "REVIEW")


def test_status_column_of_older_sources(spark, policy):
    old = raw_donations(spark).withColumnRenamed("donation_status", "status")
    assert rows(refine.donations(old, policy)) == rows(refine.donations(raw_donations(spark), policy))
    assert refine.combine(old, None) is old


def dims(spark, policy):
    donors = refine.donors(donors_raw(spark), policy)
    banks = spark.createDataFrame([("B1", None, "Pune", "MH", 1.0, 1.0, 5)],
                                  "blood_bank_id string, blood_bank_name string, city string, state string, latitude double, longitude double, storage_capacity int")
    camps = spark.createDataFrame([("C1", "Camp", "Pune", "Org", DAY)], "camp_id string, camp_name string, city string, organizer string, camp_date date")
    stock = spark.createDataFrame([("B1", "O-", 7, NOW)], "blood_bank_id string, blood_group string, available_units int, last_updated timestamp")
    return donors, banks, camps, stock


def test_enrichment_flags(spark, policy):
    _, clean = cleaned(spark, policy)
    enriched = refine.enrich(clean, *dims(spark, policy))
    got = by(enriched, "donation_id")
    flags = ("donor_exists", "blood_bank_exists", "inventory_record_exists", "camp_exists", "blood_group_match")
    assert {i: tuple(r[f] for f in flags) for i, r in got.items()} == {
        "X1": (True, True, True, None, True), "X2": (True, True, True, None, True), "L1": (True, True, True, None, True),
        "X3": (True, False, False, False, True), "X4": (True, False, False, True, None)}
    older = by(refine.enrich(clean, *dims(spark, policy), attribute_flags=True), "donation_id")
    assert older["X1"]["blood_bank_exists"] is False  # the matched bank has no name
    assert {r["status"] for r in checks.enrichment(clean, enriched).collect()} == {"PASS"}


def test_the_heaviest_attributes_travel_last_and_keyed_rows_carry_no_hash(spark, policy, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    _, clean = cleaned(spark, policy)
    wide = refine.enrich(clean, *dims(spark, policy))
    assert wide.columns[:len(clean.columns)] == clean.columns and wide.columns[len(clean.columns)] == "donor_name"
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    joined = [key for line in plan.splitlines() if "Join LeftOuter" in line for key in ("camp_id", "blood_group", "donor_id") if f"({key}#" in line]
    assert joined == ["donor_id", "blood_group", "camp_id"]  # from the last to the first; the bank has no name of its own here
    slots = keyed.attach(clean, dims(spark, policy)[0], {"donor_id": "donor_id"}, {}, "donation_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "_fact_slot" in slots[slots.index("Join"):].splitlines()[0] and " & 0)" in slots


def test_layer_metrics_by_key_equal_those_of_enriched_rows_and_send_no_row_to_a_dimension(spark, policy):
    clean = refine.with_quality(refine.donations(raw_donations(spark), policy), policy)
    odd = clean.limit(1).withColumns({"donor_id": F.lit(None).cast("string"), "blood_bank_id": F.lit("nowhere"), "blood_group": F.lit(None).cast("string")})
    clean = clean.unionByName(odd).unionByName(odd.withColumn("blood_bank_id", F.lit(None).cast("string")))
    donors, banks, camps, stock = dims(spark, policy)
    for facts in (clean, clean.limit(0)):
        by_key = refine.layer_metrics_by_key(raw_donations(spark), live_donations(spark), facts, donors, banks, stock)
        enriched = refine.layer_metrics(raw_donations(spark), live_donations(spark), refine.enrich(facts, donors, banks, camps, stock))
        assert by_key.dtypes == enriched.dtypes and by_key.collect() == enriched.collect()
    assert "Join" not in by_key._jdf.queryExecution().optimizedPlan().toString().replace("JoinedRow", "")


def test_layer_metrics(spark, policy):
    parts, clean = cleaned(spark, policy)
    row = refine.layer_metrics(raw_donations(spark), live_donations(spark), refine.enrich(clean, *dims(spark, policy))).collect()[0]
    assert tuple(row) == (5, 2, 7, 2, 3, 2, 3, 0, 2, 2)
    alone = refine.layer_metrics(raw_donations(spark), None, refine.enrich(clean, *dims(spark, policy))).collect()[0]
    assert alone["streaming_donations"] == 0


def test_admission_reasons(spark, policy):
    base = dict(donation_id="E", donor_id="D2", blood_bank_id="B1", camp_id=None, donation_date=DAY, blood_group="A+", units_donated=1,
                donation_status="Completed", event_time=NOW, source="live", event_type="blood_donation")
    cases = {
        "ok": ({}, None), "ok-camp": ({"camp_id": "C1"}, None), "X1": ({}, "Duplicate donation_id"),
        "donor": ({"donor_id": "D9"}, "Unknown donor_id"), "nobody": ({"donor_id": None}, "Unknown donor_id"),
        "bank": ({"blood_bank_id": "B9"}, "Unknown blood_bank_id"), "camp": ({"camp_id": "C9"}, "Unknown camp_id"),
        "group": ({"blood_group": "O-"}, "blood_group mismatch"), "units": ({"units_donated": 0}, "Invalid units_donated"),
        "no-units": ({"units_donated": None}, "Invalid units_donated"), "status": ({"donation_status": "Done"}, "Invalid donation_status"),
        "time": ({"event_time": None}, "Missing event_time"), "date": ({"donation_date": None}, "Missing donation_date"),
        "two": ({"camp_id": "C9", "units_donated": -1}, "Unknown camp_id"),
    }
    events = spark.createDataFrame([tuple((base | change | {"donation_id": i}).values()) for i, (change, _) in cases.items()], schemas.DONATION_EVENT)
    donors, banks, camps, _ = dims(spark, policy)
    judged = judge(events, donors, banks, camps, raw_donations(spark), policy)
    assert judged.columns[:len(base)] == list(base)
    got = by(judged, "donation_id")
    assert {i: r["reject_reason"] for i, r in got.items()} == {i: reason for i, (_, reason) in cases.items()}
    assert all(r["admitted"] == (r["reject_reason"] is None) for r in got.values())
    assert {i: r["rejected_value"] for i, r in got.items()} == {
        "ok": None, "ok-camp": None, "X1": "X1", "donor": "D9", "nobody": None, "bank": "B9", "camp": "C9", "group": got["group"]["rejected_value"],
        "units": "0", "no-units": None, "status": "Done", "time": None, "date": None, "two": "C9"}
    assert got["group"]["rejected_value"].startswith("O- against ")


def test_first_acceptable_event_of_an_id_wins(spark, policy):
    def event(units, minutes, donation="E"):
        return (donation, "D2", "B1", None, DAY, "A+", units, "Completed", NOW + dt.timedelta(minutes=minutes), "live", "blood_donation")
    events = spark.createDataFrame(
        [event(0, 0), event(2, 1), event(3, 2), event(0, 3), event(9, 9, "F"), event(9, 9, "F"), event(9, 9, "F")], schemas.DONATION_EVENT)
    donors, banks, camps, _ = dims(spark, policy)
    judged = judge(events, donors, banks, camps, raw_donations(spark), policy)
    assert rows(judged, "donation_id", "units_donated", "event_time", "reject_reason") == [
        ("E", 0, NOW, "Invalid units_donated"), ("E", 0, NOW + dt.timedelta(minutes=3), "Duplicate donation_id"),
        ("E", 2, NOW + dt.timedelta(minutes=1), None), ("E", 3, NOW + dt.timedelta(minutes=2), "Duplicate donation_id"),
        ("F", 9, NOW + dt.timedelta(minutes=9), None), *[("F", 9, NOW + dt.timedelta(minutes=9), "Duplicate donation_id")] * 2]


def status(df):
    return {r["check_name"]: (r["status"], r["value"]) for r in df.collect()}


def test_single_frame_checks(spark, policy):
    df = spark.createDataFrame([("a", "O-", 0), ("a", None, -1), (None, "ZZ", 9), ("b", "A+", None)], "id string, blood_group string, units_donated int")
    assert status(checks.unique(df, ["id"], "id")) == {"id": ("FAIL", 1)}
    assert status(checks.complete(df, ["id", "nope"], "t")) == {"t.id": ("FAIL", 1), "t.nope": ("FAIL", None)}
    bad = checks.allowed(df, "blood_group", policy.groups, "groups").collect()[0]
    assert (bad["status"], bad["value"], bad["detail"]) == ("FAIL", 2, "NULL, ZZ")
    fine = checks.allowed(df.where("id = 'b'"), "blood_group", policy.groups, "groups").collect()[0]
    assert (fine["status"], fine["value"], fine["detail"]) == ("PASS", 0, None)
    assert status(checks.quantities(df, policy)) == {
        "null_units": ("FAIL", 1), "zero_units": ("FAIL", 1), "negative_units": ("FAIL", 1), "unusually_large_units": ("PASS", 1)}


def test_donor_rules(spark, policy):
    got = status(checks.donor_rules(refine.donors(donors_raw(spark), policy), policy))
    assert got == {"age_out_of_range": ("FAIL", 2), "unknown_eligibility": ("FAIL", 1), "invalid_group": ("FAIL", 2), "donated_before_registration": ("FAIL", 1)}


def test_foreign_keys_and_prechecks(spark, policy):
    donors, banks, camps, stock = dims(spark, policy)
    got = status(checks.foreign_keys(raw_donations(spark), donors, banks, camps, stock))
    assert got == {"donor": ("FAIL", 1), "bank": ("FAIL", 2), "camp": ("FAIL", 1), "inventory_bank": ("PASS", 0)}
    inv = spark.createDataFrame([("I1", "B1", "O-", -1, NOW), ("I1", "B1", "O-", 2, None), ("I2", None, "ZZ", None, NOW), ("I3", "B9", None, 1, NOW)],
                                "inventory_id string, blood_bank_id string, blood_group string, available_units int, last_updated timestamp")
    row = checks.stock_precheck(inv, banks, policy).collect()[0].asDict()
    assert row == {"total_records": 4, "invalid_blood_groups": 1, "negative_units": 1, "null_blood_bank_id": 1, "null_blood_group": 1,
                   "null_available_units": 1, "null_last_updated": 1, "non_numeric_units": 0, "missing_bank_matches": 2, "duplicate_logical_keys": 1}
    row = checks.publish_precheck(donors, banks, inv, raw_donations(spark), policy).collect()[0].asDict()
    assert (row["null_donation_date"], row["non_positive_units_donated"], row["invalid_donation_groups"], row["duplicate_donation_ids"],
            row["duplicate_inventory_ids"], row["duplicate_bank_ids"]) == (1, 1, 2, 1, 1, 0)
    assert status(checks.inventory_consistency(inv, banks)) == {"negative_units": ("FAIL", 1), "orphan_banks": ("FAIL", 2), "total_units": ("PASS", 2)}


def test_published_totals_and_distribution(spark, policy):
    done = spark.createDataFrame([("Completed", 5), ("Cancelled", 9)], "donation_status string, units_donated int")
    inv = spark.createDataFrame([("O-", 3), ("A-", 2)], "blood_group string, available_units int")
    shares = spark.createDataFrame([("O-", 5, 100.0)], "blood_group string, total_units_donated bigint, percentage_of_total double")
    summary = spark.createDataFrame([("O-", 3), ("B-", 1)], "blood_group string, total_available_units bigint")
    got = {k: v[0] for k, v in status(checks.published_totals(done, inv, shares, summary, policy)).items()}
    assert got == {"completed_units": "PASS", "stock O-": "PASS", "stock A-": "FAIL", "stock B-": "FAIL"}
    assert status(checks.distribution_rules(shares, summary, policy)) == {"share_off": ("PASS", 0), "absent_groups": ("FAIL", 2)}


def test_boundaries(spark, policy):
    good = checks.boundaries(spark, policy.strict, {0: "OUT_OF_STOCK", 4: "CRITICAL", 5: "LOW", 9: "LOW", 10: "AVAILABLE", 11: "AVAILABLE"})
    assert {r["status"] for r in good.collect()} == {"PASS"}
    assert checks.boundaries(spark, policy.stock_out, {5: "LOW"}).collect()[0]["status"] == "FAIL"


def test_overall_status(spark):
    data = [("a", "x", "PASS", 0, None), ("a", "y", "FAIL", 3, None), ("b", "z", "SKIPPED", None, None), ("c", "w", "PASS", 0, None), ("c", "v", "SKIPPED", None, None)]
    got = by(checks.overall(spark.createDataFrame(data, checks.SHAPE)), "section")
    assert {s: (r["status"], r["failures"], r["failed_checks"]) for s, r in got.items()} == {
        "a": ("FAIL", 1, "y"), "b": ("SKIPPED", 0, ""), "c": ("PASS", 0, ""), "OVERALL": ("FAIL", 1, "y")}
    only = checks.overall(spark.createDataFrame(data[2:3], checks.SHAPE))
    assert by(only, "section")["OVERALL"]["status"] == "SKIPPED"


def test_random_order_never_changes_the_clean_layer(spark, policy):
    _, clean = cleaned(spark, policy)
    parts = refine.combine(refine.donations(raw_donations(spark).repartition(5), policy), refine.donations(live_donations(spark).repartition(3), policy, batch=False))
    again = refine.with_quality(refine.dedupe_donations(parts), policy)
    assert rows(clean) == rows(again)
    assert rows(keyed.duplicates_removed(parts, ["donation_id"])) == [(2,)]
