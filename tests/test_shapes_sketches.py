import datetime as dt
import re
from collections import Counter

import pytest
from helpers import by, rows
from pyspark.sql import functions as F

from granary.operators import shapes, sketches, timeline


def test_totals_by_sets_tell_real_nulls_from_left_out_columns(spark):
    data = [("n", "x", 1), ("n", None, 2), (None, "x", 4), ("n", "x", 8), ("s", "y", None)]
    frame = spark.createDataFrame(data, "a string, b string, v long")
    found = shapes.totals_by_sets(frame, [["a", "b"], ["a"], []], {"v": "total"})
    assert rows(found, "grouping_id", "a", "b", "total") == sorted([
        (0, "n", "x", 9), (0, "n", None, 2), (0, None, "x", 4), (0, "s", "y", None), (1, "n", None, 11), (1, None, None, 4), (1, "s", None, None),
        (3, None, None, 15)], key=lambda t: [(v is not None, v) for v in t])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1
    # Rows fold before they are expanded.
    assert re.search(r"Expand[\s\S]*HashAggregate[\s\S]*Exchange[\s\S]*HashAggregate", plan)


COLUMNS = {"A+": "a_pos", "O-": "o_neg"}


def test_matrix_and_back(spark):
    data = [(1, "A+", 3), (1, "A+", 4), (1, "O-", None), (2, "O-", 0), (3, "??", 9), (None, "A+", 1)]
    frame = spark.createDataFrame(data, "bank int, g string, v long")
    matrix = shapes.wide(frame, ["bank"], "g", "v", COLUMNS)
    assert rows(matrix) == [(None, 1, None), (1, 7, None), (2, None, 0), (3, None, None)]
    assert rows(shapes.tall(matrix, ["bank"], "g", "v", COLUMNS)) == [(None, "A+", 1), (1, "A+", 7), (2, "O-", 0)]
    assert shapes.wide(frame.limit(0), ["bank"], "g", "v", COLUMNS).columns == ["bank", "a_pos", "o_neg"]


def test_differences_count_copies(spark):
    left = [("a", 1), ("a", 1), ("b", None), ("c", 3)]
    right = [("a", 1), ("b", None), ("b", None), ("b", None), ("d", 4)]
    frames = [spark.createDataFrame(x, "k string, v int") for x in (left, right)]
    assert rows(shapes.counted_difference(*frames)) == [("a", 1, 2, 1), ("b", None, 1, 3), ("c", 3, 1, 0), ("d", 4, 0, 1)]
    common = Counter({(r["k"], r["v"]): r["both_count"] for r in shapes.in_common(*frames).collect()})
    assert common == Counter(left) & Counter(right)
    assert Counter(tuple(r) for r in frames[0].intersectAll(frames[1]).collect()) == common
    assert shapes.counted_difference(frames[0], frames[0]).count() == 0


def day(n):
    return dt.date(2026, 1, 1) + dt.timedelta(days=n)


def test_runs_and_pauses_and_rolling_sums(spark):
    closings = spark.createDataFrame([("a", day(d), v) for d, v in enumerate([1, 0, 0, 5, 0, None, 0])] + [("b", day(3), 0)], "k string, day date, v int")
    found = timeline.runs(closings, ["k"], "day", F.col("v") <= 0)
    assert rows(found) == [("a", day(1), day(2), 2, day(3)), ("a", day(4), day(4), 1, day(5)), ("a", day(6), day(6), 1, None), ("b", day(3), day(3), 1, None)]
    given = spark.createDataFrame([("x", day(0)), ("x", day(0)), ("x", day(100)), ("x", day(120)), ("y", None), ("y", day(1))], "k string, d date")
    assert rows(timeline.pauses(given, ["k"], "d", 90)) == [("x", day(0), day(100), 100)]
    moved = spark.createDataFrame([("k", day(0), 1), ("k", day(0), 2), ("k", day(29), 4), ("k", day(30), 8), ("k", day(90), None), (None, day(1), 5)], "k string, d date, v long")
    assert rows(timeline.rolling(moved, ["k"], "d", "v", "total", 30)) == [
        (None, day(1), 5), ("k", day(0), 3), ("k", day(29), 7), ("k", day(30), 12), ("k", day(90), None)]


def test_daily_sketches_merge_to_any_period_and_take_late_days(spark):
    given = spark.range(30_000).selectExpr("id % 6000 as donor_id", "if(id % 2 = 0, 'A-', null) as blood_group",
                                           "date_add(date'2026-01-01', cast(id % 59 as int)) as donation_date", "cast(id % 101 as int) as units_donated")
    daily = sketches.daily_sketches(given)
    whole = by(sketches.estimates(sketches.merged(daily, F.col("blood_group"))), "blood_group")
    parts = [sketches.merged(daily.where(c), F.col("blood_group")) for c in ("donation_date < date'2026-01-20'", "donation_date >= date'2026-01-20'")]
    late = by(sketches.estimates(sketches.merged(parts[0].unionByName(parts[1]), F.col("blood_group"))), "blood_group")
    for group in ("A-", None):
        for found in (whole, late):
            assert found[group]["donors_by_hll"] == pytest.approx(3000, rel=sketches.COUNT_ERROR)
        assert whole[group]["donors_by_theta"] == 3000 and late[group]["donors_by_theta"] == 3000  # below its size the set sketch is exact
        assert whole[group]["values"] == late[group]["values"] == 15_000 and abs(whole[group]["median_units"] - 50) <= 2 and abs(late[group]["median_units"] - 50) <= 2
    report = sketches.monthly_report(given, daily).collect()
    assert len(report) == 4 and all(r["hll_near"] and r["theta_near"] and r["median_near"] and r["all_values_seen"] for r in report)


def test_returning_donors_by_intersection(spark):
    given = spark.createDataFrame([(1, "A-", day(0), 1), (1, "A-", day(40), 1), (2, "A-", day(41), 1), (3, None, day(3), 1), (3, None, day(33), 1), (4, "A-", None, 1),
                                   (1, "A-", day(100), 1)], "donor_id long, blood_group string, donation_date date, units_donated int")
    assert rows(sketches.returning_donors(sketches.daily_sketches(given))) == [(day(31), None, 1), (day(31), "A-", 1)]
