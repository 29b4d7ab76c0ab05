import datetime as dt
import random
from collections import defaultdict

import pytest

from helpers import by, rows
from granary.operators import board, checks, ledger, transfers
from granary.sources import schemas

T = dt.datetime(2026, 8, 14, 12)
KEY = ("B1", "O-", "RBC")


def at(days=0, hours=0):
    return T - dt.timedelta(days=days, hours=hours)


def movements(spark, *items):
    """Items: (key, type, units, timestamp[, extra])."""
    data = []
    for n, item in enumerate(items):
        key, kind, units, when = item[:4]
        extra = item[4] if len(item) > 4 else {}
        data.append((f"T{n:03d}", *key, kind, units, when, extra.get("donation"), extra.get("transfer"),
                     extra.get("to"), "POSTED", extra.get("issue")))
    return spark.createDataFrame(data, schemas.LEDGER)


def test_balance_signs_rounding_and_conditionals(spark, policy):
    df = movements(
        spark, (KEY, "DONATION", 10.0, at(9)), (KEY, "TRANSFER_IN", 4.0, at(8)), (KEY, "ISSUE", 3.0, at(7)),
        (KEY, "TRANSFER_OUT", 2.0, at(6)), (KEY, "EXPIRY", 1.5, at(5)), (KEY, "ADJUSTMENT", -1.0, at(4)),
        (KEY, "MYSTERY", 1.0, at(3)), (KEY, None, 1.0, at(2)), (("B2", "O-", "RBC"), "ISSUE", 0.5, at(1)),
    )
    got = by(ledger.balances(df, policy), "blood_bank_id")
    assert got["B1"]["available_units"] == 5  # 4.5 rounds half up
    assert (got["B1"]["last_updated"], got["B1"]["last_donation_at"], got["B1"]["lifetime_expired_units"]) == (at(2), at(9), 1.5)
    assert (got["B2"]["available_units"], got["B2"]["last_donation_at"], got["B2"]["lifetime_expired_units"]) == (-1, None, 0.0)


@pytest.mark.parametrize("hours, days", [(0, 1), (23, 1), (24, 2), (47, 2), (48, 3)])
def test_demand_window_counts_elapsed_days(spark, hours, days):
    df = movements(spark, (KEY, "ISSUE", 1.0, at(hours=hours)), (KEY, "ISSUE", 1.0, T), (KEY, "DONATION", 1.0, at(900)))
    assert by(ledger.demand(df), "blood_bank_id")["B1"]["observation_window_days"] == days


def test_demand_rates_follow_the_rounded_daily_rate(spark):
    df = movements(spark, (KEY, "ISSUE", 1.0, at(2)), (KEY, "ISSUE", 1.0, T), (("B2", "A-", "RBC"), "ISSUE", 5.0, at(1)))
    got = by(ledger.demand(df), "blood_bank_id")
    assert tuple(got["B1"].values())[3:] == (2.0, 2, 3, 0.667, 4.67, 20.01)
    assert got["B2"]["average_daily_demand"] == 1.667


def test_no_issue_means_no_demand_rows_and_unknown_coverage(spark, policy):
    df = movements(spark, (KEY, "DONATION", 8.0, at(1)))
    assert ledger.demand(df).count() == 0
    line = by(ledger.stock_state(df, policy), "blood_bank_id")["B1"]
    assert (line["has_demand_data"], line["average_daily_demand"], line["average_weekly_demand"], line["coverage_days"],
            line["coverage_sub_score"]) == (False, 0.0, None, None, 50)


def test_rate_that_rounds_to_zero_reads_as_no_demand(spark, policy):
    df = movements(spark, (KEY, "ISSUE", 0.2, at(999)), (("B2", "A-", "RBC"), "ISSUE", 900.0, T))
    line = by(ledger.stock_state(df, policy), "blood_bank_id")["B1"]
    assert (line["average_daily_demand"], line["has_demand_data"], line["average_weekly_demand"]) == (0.0, False, 0.0)


def test_trend_window_edges(spark, policy):
    df = movements(
        spark, (("R", "O-", "RBC"), "DONATION", 5.0, at(30)), (("P", "O-", "RBC"), "DONATION", 5.0, at(60)),
        (("P", "O-", "RBC"), "DONATION", 5.0, at(30, 1)), (("N", "O-", "RBC"), "DONATION", 5.0, at(60, 1)),
        (("N", "O-", "RBC"), "ISSUE", 1.0, T),
    )
    got = by(ledger.key_measures(df, policy), "blood_bank_id")
    assert {b: (r["recent_donation_units"], r["prior_donation_units"]) for b, r in got.items()} == {
        "R": (5.0, 0.0), "P": (0.0, 10.0), "N": (0.0, 0.0)}


def test_full_state_of_one_line(spark, policy):
    df = movements(
        spark, (KEY, "DONATION", 10.0, at(45)), (KEY, "DONATION", 6.0, at(2)), (KEY, "ISSUE", 4.0, at(1)),
        (KEY, "ISSUE", 4.0, T), (KEY, "EXPIRY", 2.0, T),
    )
    line = by(ledger.stock_state(df, policy), "blood_bank_id")["B1"]
    assert line["available_units"] == 6 and line["expiry_status"] == "VALID"
    assert (line["average_daily_demand"], line["coverage_days"]) == (4.0, 1.5)
    # stock 60, coverage 70, expiry 0, trend 30 (6 of 10) -> 24 + 21 + 0 + 4.5
    assert (line["shortage_score"], line["priority_level"]) == (50, "LOW")
    assert line["recommended_action"] == policy.priority_actions["LOW"]
    assert ledger.stock_state(df, policy).columns == ledger.STATE_COLUMNS


def test_null_key_parts_form_their_own_line(spark, policy):
    df = movements(spark, ((None, "O-", "RBC"), "DONATION", 3.0, T), ((None, "O-", "RBC"), "ISSUE", 1.0, T), (KEY, "DONATION", 1.0, T))
    got = by(ledger.stock_state(df, policy), "blood_bank_id")
    assert (got[None]["available_units"], got[None]["has_demand_data"]) == (2, True)
    running = by(ledger.running_balance(df, policy), "transaction_id")
    assert running["T001"]["running_balance"] == 2.0


def test_reconciliation_sees_missing_extra_and_wrong_keys(spark, policy):
    df = movements(spark, (KEY, "DONATION", 3.0, T), (("B2", "O-", "RBC"), "DONATION", 2.0, T), (("B3", None, "RBC"), "ISSUE", 2.0, T))
    good = ledger.balances(df, policy)
    assert {r["reconciliation_status"] for r in ledger.reconcile(good, df, policy).collect()} == {"MATCH"}
    bad = good.where("blood_bank_id <> 'B2'").selectExpr(
        "blood_bank_id", "blood_group", "component_type", "IF(blood_bank_id = 'B1', 9L, available_units) AS available_units"
    ).unionByName(spark.createDataFrame([("B7", "O-", "RBC", 1)], "blood_bank_id string, blood_group string, component_type string, available_units bigint"))
    got = by(ledger.reconcile(bad, df, policy), "blood_bank_id")
    assert {b: r["reconciliation_status"] for b, r in got.items()} == {
        "B1": "MISMATCH", "B2": "NOT_PUBLISHED", "B3": "MATCH", "B7": "NOT_IN_LEDGER"}
    assert {r["check_name"]: r["status"] for r in checks.reconciled(bad, df, policy).collect()} == {
        "mismatched_keys": "FAIL", "keys_not_published": "FAIL", "keys_not_in_ledger": "FAIL", "negative_balances": "FAIL"}


def test_running_balance_matches_a_sequential_ledger(spark, policy):
    rng = random.Random(11)
    banks = ["HOT"] * 6 + ["B1", "B2"]
    items = [((rng.choice(banks), "O-", "RBC"), rng.choice(policy.movement_types), float(rng.randint(1, 9)),
              T - dt.timedelta(hours=rng.randint(0, 200))) for _ in range(600)]
    df = movements(spark, *items)
    expected, balance = {}, defaultdict(float)
    for n, (key, kind, units, when) in sorted(enumerate(items), key=lambda e: (e[1][3], f"T{e[0]:03d}")):
        balance[key] += units if kind in policy.inflow_types else -units
        expected[f"T{n:03d}"] = balance[key]
    got = by(ledger.running_balance(df, policy), "transaction_id")
    assert {t: r["running_balance"] for t, r in got.items()} == expected
    assert all(r["below_zero"] == (r["running_balance"] < 0) for r in got.values())


def test_snapshot_expiry_candidates_and_postings(spark, policy):
    df = movements(
        spark, (KEY, "ISSUE", 5.0, T), (("B2", "O-", "Platelets"), "DONATION", 5.0, at(5)),
        (("B3", "O-", "Platelets"), "DONATION", 5.0, at(3)), (("B4", "O-", "Other"), "DONATION", 5.0, at(999)),
    )
    snap = by(ledger.closing_snapshot(df, policy), "blood_bank_id")
    assert (snap["B1"]["available_units"], snap["B2"]["expiry_status"], snap["B3"]["expiry_status"]) == (0, "EXPIRED", "EXPIRING_SOON")
    assert rows(ledger.expiry_candidates(df, policy), "blood_bank_id", "expiry_date") == [("B2", dt.date(2026, 8, 14))]


def test_posting_donations_splits_components_stably(spark, policy):
    gifts = spark.createDataFrame(
        [(f"D{i}", "B1", "O-", 2, dt.date(2026, 1, 1), "Completed" if i % 2 else "Cancelled") for i in range(400)],
        "donation_id string, blood_bank_id string, blood_group string, units_donated int, donation_date date, donation_status string",
    )
    posted = ledger.post_donations(gifts, policy)
    counts = dict(rows(posted.groupBy("component_type").count()))
    assert counts["RBC"] == counts["Plasma"] == 200 and 70 < counts["Platelets"] < 130
    assert rows(posted) == rows(ledger.post_donations(gifts.repartition(7), policy))
    assert posted.select("transaction_id").distinct().count() == posted.count()


def test_issue_list_round_trip(spark):
    df = movements(spark, (KEY, "ISSUE", 2.0, T, {"issue": "I1"}), (KEY, "DONATION", 9.0, T))
    issues = ledger.issue_list(df)
    assert rows(issues) == [("I1", *KEY, 2.0, T.date())]
    from pyspark.sql import functions as F
    posted = ledger.post_issues(issues.withColumn("hospital_id", F.lit("H1"))).collect()[0]
    assert (posted["transaction_type"], posted["units"], posted["issue_id"], posted["hospital_id"]) == ("ISSUE", 2.0, "I1", "H1")


def test_transfer_validity_is_three_valued(spark):
    listed = spark.createDataFrame(
        [("ok", "B1", "B2", 1.0), ("zero", "B1", "B2", 0.0), ("self", "B1", "B1", 1.0), ("who", "B1", "ZZ", 1.0),
         ("null", "B1", "B2", None), ("nowhere", "B1", None, 1.0)],
        "transfer_id string, source_bank_id string, destination_bank_id string, units double")
    banks = spark.createDataFrame([("B1",), ("B2",), ("B2",)], "blood_bank_id string")
    flagged = transfers.checked(listed, banks)
    assert {k: r["is_valid"] for k, r in by(flagged, "transfer_id").items()} == {
        "ok": True, "zero": False, "self": False, "who": False, "null": None, "nowhere": None}
    assert rows(transfers.validity_counts(flagged)) == [(6, 1, 3, 2)]
    assert {r["status"] for r in checks.transfer_rules(flagged).collect()} == {"PASS"}


def test_legs_are_paired(spark):
    leg = lambda t: {"transfer": t}
    df = movements(
        spark, (KEY, "TRANSFER_OUT", 2.0, T, leg("good")), (("B2", "O-", "RBC"), "TRANSFER_IN", 2.0, T, leg("good")),
        (KEY, "TRANSFER_OUT", 2.0, T, leg("lost")), (KEY, "TRANSFER_IN", 2.0, T, leg("found")),
        (KEY, "TRANSFER_OUT", 2.0, T, leg("short")), (KEY, "TRANSFER_IN", 1.0, T, leg("short")),
        (KEY, "TRANSFER_OUT", 1.0, T, leg("twice")), (KEY, "TRANSFER_OUT", 1.0, T, leg("twice")), (KEY, "TRANSFER_IN", 2.0, T, leg("twice")),
    )
    got = by(transfers.paired_legs(df), "transfer_id")
    assert {k: r["pair_status"] for k, r in got.items()} == {
        "good": "PAIRED", "lost": "MISSING_IN", "found": "MISSING_OUT", "short": "UNEQUAL_UNITS", "twice": "REPEATED_LEG"}


def test_posted_transfers_pair_up(spark):
    listed = spark.createDataFrame([("t1", "B1", "B2", "O-", "RBC", 3.0, T.date(), "COMPLETED")], schemas.TRANSFERS)
    posted = transfers.post_transfers(listed)
    got = by(posted, "transaction_type")
    assert (got["TRANSFER_OUT"]["blood_bank_id"], got["TRANSFER_OUT"]["destination_bank_id"]) == ("B1", "B2")
    assert (got["TRANSFER_IN"]["blood_bank_id"], got["TRANSFER_IN"]["destination_bank_id"]) == ("B2", None)
    assert rows(transfers.paired_legs(posted), "pair_status") == [("PAIRED",)]


def test_helpers_match_brute_force(spark, policy):
    rng = random.Random(3)
    items = [((f"B{rng.randint(0, 30):02d}", rng.choice(["O-", "A-"]), rng.choice(["RBC", "Plasma"])),
              rng.choice(["DONATION", "ISSUE"]), float(rng.randint(1, 6)), T) for _ in range(250)]
    items.append((("LONE", "AB-", "RBC"), "DONATION", 50.0, T))
    balance = defaultdict(float)
    for key, kind, units, _ in items:
        balance[key] += units if kind == "DONATION" else -units
    expected = set()
    for (bank, group, kind), units in balance.items():
        others = sorted((u, b) for (b, g, c), u in balance.items() if (g, c) == (group, kind) and b != bank)
        if units >= policy.surplus_units and others:
            expected.add((bank, group, kind, units, len(others), others[0][1], others[0][0]))
    assert set(rows(transfers.helpers(movements(spark, *items), policy))) == expected


def test_board_over_state(spark, policy):
    df = movements(spark, (KEY, "DONATION", 3.0, at(90)), (KEY, "ISSUE", 3.0, T), (("B2", "A+", "Plasma"), "DONATION", 99.0, at(1)))
    state = ledger.stock_state(df, policy)
    assert rows(board.most_urgent(state)) == [("O-", "RBC", "B1", 0, 100)]
    assert rows(board.urgent_alerts(state), "blood_bank_id", "coverage_display", "priority_level") == [("B1", "0.0", "EMERGENCY")]
    head = board.state_headline(state).collect()[0].asDict()
    assert (head["total_units"], head["blood_banks"], head["component_types"], head["emergency_lines"], head["expired_lines"],
            head["median_coverage_days"]) == (99, 2, 2, 1, 1, 0.0)
    assert rows(board.top_demand(ledger.demand(df), policy), "inventory_line") == [("B1 · O- RBC",)]


def test_ledger_and_state_invariants(spark, policy):
    kinds = [(KEY, k, 2.0, at(1)) for k in policy.movement_types]
    good = movements(spark, *kinds, *[(("B1", g, "Plasma"), "DONATION", 1.0, T) for g in policy.watch_list])
    assert {r["status"] for r in checks.ledger_invariants(good, policy).collect()} == {"PASS"}
    state = ledger.stock_state(good, policy)
    assert {r["status"] for r in checks.state_invariants(state, policy).collect()} == {"PASS"}
    assert {r["status"] for r in checks.ledger_keys_covered(good, state).collect()} == {"PASS"}
    bad = movements(spark, (KEY, "GIFT", 1.0, T), (KEY, "ISSUE", 0.0, T), (("B1", "O-", "Serum"), None, None, T))
    got = {r["check_name"]: r["value"] for r in checks.ledger_invariants(bad, policy).collect()}
    assert got == {"movements": 3, "unknown_types": 2, "types_never_used": 5, "non_positive_units": 1, "unknown_components": 1}
    assert checks.ledger_keys_covered(bad, state).collect()[0]["value"] == 1


def test_stored_ledger_is_filtered_and_pruned_in_the_scan(spark, tmp_path):
    movements(spark, (KEY, "ISSUE", 1.0, T), (KEY, "DONATION", 1.0, T)).write.parquet(str(tmp_path / "ledger"))
    stored = spark.read.parquet(str(tmp_path / "ledger"))
    plan = ledger.demand(stored)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(transaction_type,ISSUE)" in plan
    assert "source_donation_id" not in plan and "destination_bank_id" not in plan
