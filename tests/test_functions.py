import datetime as dt
from functools import reduce

import pytest
from pyspark.sql import functions as F

from helpers import by, rows
from granary.functions import flags, scores, text
from granary.functions.bands import label, translate
from granary.operators.refine import group_code


def apply(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


UNITS = [-1, 0, 1, 2, 3, 4, 5, 6, 9, 10, 11, 20, 21, None]


@pytest.mark.parametrize("scale, expected", [
    ("four_tier", "C C C C L L L M M M G G G -"),
    ("stock_out", "C O C C C C C L L L A A A -"),
    ("strict", "C O C C C C L L L A A A A -"),
    ("record", "C C L L L L L N N N N N G -"),
])
def test_scales_at_every_boundary(spark, policy, scale, expected):
    got = apply(spark, UNITS, "int", lambda c: label(c, getattr(policy, scale)))
    assert ["-" if g is None else g[0] for g in got] == expected.split()


def test_unknown_label_has_no_translation(spark, policy):
    assert apply(spark, ["CRITICAL", "???", None], "string", lambda c: translate(c, policy.severity)) == [2, None, None]


@pytest.mark.parametrize("raw, code", [
    ("o neg", "O-"), (" O Negative ", "O-"), ("ab positive", "AB+"), ("ab+", "AB+"), ("ABPOS", "ABPOS"),
    ("A - NEG", "A--"), ("XYZ", "XYZ"), ("", ""), (None, None), ("ABPOSITIVE", "AB+"),
])
def test_group_codes(spark, policy, raw, code):
    assert apply(spark, [raw], "string", lambda c: group_code(c, policy)) == [code]


def test_status_vocabulary(spark, policy):
    raw = ["complete", "SUCCESS", " Canceled", "pending", "rejected", "on hold", None]
    got = apply(spark, raw, "string", lambda c: text.to_vocabulary(c, policy.status_words))
    assert got == ["Completed", "Completed", "Cancelled", "Pending", "Rejected", "On Hold", None]


def test_blank_text_is_unknown(spark):
    assert apply(spark, [" x ", "  ", "", None], "string", text.or_unknown) == ["x", "Unknown", "Unknown", "Unknown"]


def test_membership_of_null_is_unknown(spark, policy):
    assert apply(spark, ["O-", "ZZ", None], "string", lambda c: flags.one_of(c, policy.groups)) == [True, False, None]


def test_ranges_are_closed_and_null_is_false(spark, policy):
    got = apply(spark, [17, 18, 65, 66, None], "int", lambda c: flags.within(c, policy.age_range))
    assert got == [False, True, True, False, False]


def test_future_dates(spark, policy):
    days = [policy.as_of, policy.as_of + dt.timedelta(days=1), None]
    assert apply(spark, days, "date", lambda c: flags.not_after(c, policy.as_of)) == [True, False, False]


def test_coordinates(spark, policy):
    places = [(90.0, 180.0), (90.1, 0.0), (-90.0, -180.0), (None, 0.0), (None, 999.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "i int, a double, o double")
    flag = flags.on_the_globe(F.col("a"), F.col("o"), policy.latitude_range, policy.longitude_range)
    assert [r[0] for r in df.orderBy("i").select(flag).collect()] == [True, False, True, None, False]


def test_verdict_needs_every_flag(spark):
    df = spark.createDataFrame([(True, True), (True, None), (False, None)], "a boolean, b boolean")
    assert rows(df.select(flags.verdict(F.col("a"), F.col("b")))) == [("REVIEW",), ("REVIEW",), ("VALID",)]


def test_priority_of_a_tier(spark, policy):
    cases = [("CRITICAL", 0, 100), ("CRITICAL", 4, 96), ("GOOD", 25, 0), ("LOW", 25, 65), (None, 3, 0)]
    df = spark.createDataFrame(cases, "s string, n bigint, e int")
    assert rows(df.where(scores.tier_priority(F.col("s"), F.col("n"), policy) != F.col("e"))) == []


def test_every_unknown_movement_takes_stock_away(spark, policy):
    kinds = ["DONATION", "TRANSFER_IN", "ADJUSTMENT", "ISSUE", "TRANSFER_OUT", "EXPIRY", "MYSTERY", None]
    got = apply(spark, kinds, "string", lambda c: scores.signed_units(c, F.lit(2.0), policy))
    assert got == [2.0, 2.0, 2.0, -2.0, -2.0, -2.0, -2.0, -2.0]


@pytest.mark.parametrize("component, age, status", [
    ("RBC", 43, "EXPIRED"), ("RBC", 42, "EXPIRED"), ("RBC", 41, "EXPIRING_SOON"), ("RBC", 39, "EXPIRING_SOON"),
    ("RBC", 38, "VALID"), ("RBC", None, "VALID"), ("Whole", 9999, "VALID"), ("Platelets", 5, "EXPIRED"),
])
def test_freshness(spark, policy, component, age, status):
    last = None if age is None else dt.datetime.combine(policy.as_of - dt.timedelta(days=age), dt.time(23, 59))
    df = spark.createDataFrame([(component, last)], "c string, t timestamp")
    assert rows(df.select(scores.freshness(F.col("c"), F.col("t"), policy))) == [(status,)]


@pytest.mark.parametrize("units, points", [(-4, 90), (0, 100), (5, 90), (6, 60), (10, 60), (20, 30), (21, 10), (None, 10)])
def test_stock_points(spark, policy, units, points):
    assert apply(spark, [units], "int", lambda c: scores.stock_points(c, policy)) == [points]


@pytest.mark.parametrize("days, points", [(0.9, 100), (1.0, 70), (2.9, 70), (3.0, 35), (6.9, 35), (7.0, 10)])
def test_coverage_points(spark, policy, days, points):
    assert apply(spark, [days], "double", lambda c: scores.coverage_points(F.lit(True), c, policy)) == [points]
    assert apply(spark, [None], "double", lambda c: scores.coverage_points(F.lit(False), c, policy)) == [50]


def test_coverage_uses_the_demand_floor(spark, policy):
    df = spark.createDataFrame([(3, 0.05), (3, 0.2), (3, 0.0)], "u bigint, d double")
    got = df.select("d", scores.coverage_days(F.col("u"), F.col("d"), policy).alias("c"))
    assert {k: v["c"] for k, v in by(got, "d").items()} == {0.05: 30.0, 0.2: 15.0, 0.0: None}


@pytest.mark.parametrize("recent, prior, points", [
    (0.0, 0.0, 100), (0.0, 5.0, 100), (5.0, 0.0, 50), (49.0, 100.0, 70), (50.0, 100.0, 30), (99.0, 100.0, 30), (100.0, 100.0, 0),
])
def test_trend_points(spark, recent, prior, points):
    df = spark.createDataFrame([(recent, prior)], "r double, p double")
    assert rows(df.select(scores.trend_points(F.col("r"), F.col("p")))) == [(points,)]


def test_score_is_weighted_rounded_and_clipped(spark, policy):
    df = spark.createDataFrame([(100, 100, 100, 100), (90, 50, 60, 30), (0, 0, 0, 0)], "a int, b int, c int, d int")
    got = df.select(scores.shortage_score(F.col("a"), F.col("b"), F.col("c"), F.col("d"), policy))
    assert rows(got) == [(0,), (65,), (100,)]


@pytest.mark.parametrize("score, level", [
    (0, "HEALTHY"), (20, "HEALTHY"), (21, "MONITOR"), (40, "MONITOR"), (41, "LOW"), (60, "LOW"), (61, "CRITICAL"),
    (80, "CRITICAL"), (81, "EMERGENCY"), (100, "EMERGENCY"),
])
def test_priority_bands(spark, policy, score, level):
    assert apply(spark, [score], "int", lambda c: scores.priority_level(c, policy)) == [level]


def test_messages_and_labels(spark):
    df = spark.createDataFrame([("O-", 0, "OUT_OF_STOCK"), ("B-", 3, "CRITICAL"), ("A-", 8, "LOW"), ("A+", 99, "AVAILABLE")],
                               "g string, u int, s string")
    got = rows(df.select(text.shortage_message(F.col("g"), F.col("u"), F.col("s"))))
    assert got == [(None,), ("CRITICAL: B- has only 3 units available.",), ("LOW: A- has 8 units available.",),
                   ("OUT OF STOCK: O- currently has no available units.",)]
    assert apply(spark, ["September"], "string", lambda c: text.month_label(c, F.lit(2026))) == ["Sep 2026"]


def test_rules_are_tried_only_where_a_pattern_is_found(spark, policy):
    values = ["A+", " o pos ", "AB NEGATIVE", "b-", "POSNEG", "", None, "neg pos", "unknown\tgroup"]
    plain = apply(spark, values, "string", lambda c: reduce(lambda acc, rule: F.regexp_replace(acc, *rule), policy.code_rules, text.canonical(c)))
    assert apply(spark, values, "string", lambda c: text.rewrite(c, policy.code_rules)) == plain
    # A rule may find what an earlier one has written.
    assert apply(spark, ["x", "y", "z"], "string", lambda c: text.rewrite(c, [("X", "Y"), ("Y", "W")])) == ["W", "W", "Z"]
    assert apply(spark, [" a ", None], "string", lambda c: text.rewrite(c, ())) == ["A", None]
    guarded = spark.createDataFrame([("A+",)], "v string").select(text.rewrite(F.col("v"), policy.code_rules).alias("out"))
    assert "CASE WHEN" in guarded._jdf.queryExecution().analyzed().toString()
