import datetime as dt
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from granary.operators import timeline


@pytest.mark.parametrize("segment_rows", [1, 8, 1 << 16])
def test_running_sum_equals_a_loop(spark, segment_rows):
    pick = random.Random(4)
    data = [(pick.choice(["a", "b", None]), pick.randrange(5), i, pick.choice([None, 1, -2, 5])) for i in range(300)]
    frame = spark.createDataFrame(data, "k string, day int, id int, v long").repartition(5)
    expected, so_far = [], {}
    for k, day, i, v in sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        so_far[k] = so_far.get(k, 0) + (v or 0)
        expected.append((k, i, so_far[k]))
    found = timeline.running_sum(frame, ["k"], ["day", "id"], "v", "total", segment_rows)
    assert rows(found, "k", "id", "total") == sorted(expected, key=lambda t: [(v is not None, v) for v in t])


def test_a_hot_key_and_day_is_spread_over_tasks(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "8")
    frame = spark.range(40_000).selectExpr("if(id % 10 = 0, id, -1) as k", "1 as day", "id", "1L as v")
    found = timeline.running_sum(frame, ["k"], ["day", "id"], "v", "total", segment_rows=64)
    assert found.where("k = -1").agg(F.max("total")).first()[0] == 36_000
    per_task = [r["n"] for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(per_task) == 8 and max(per_task) <= 2 * 40_000 / 8
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(k") <= 3


def day(n):
    return dt.date(2026, 1, 1) + dt.timedelta(days=n)


@pytest.mark.parametrize("segment_rows", [2, 1 << 16])
def test_as_of_equals_a_search(spark, segment_rows):
    pick = random.Random(9)
    states = [(pick.choice(["a", "b", "c", None]), pick.choice([None, *map(day, range(40))]), pick.randrange(100)) for _ in range(120)]
    facts = [(i, pick.choice(["a", "b", "d", None]), pick.choice([None, *map(day, range(-3, 45))])) for i in range(200)]
    found = timeline.as_of(spark.createDataFrame(facts, "id int, k string, at date"), spark.createDataFrame(states, "k string, since date, v int"),
                           ["k"], "at", "since", ["since", "v"], segment_rows)
    expected = []
    for i, k, at in facts:
        known = [(s, v) for key, s, v in states if k is not None and key == k and s is not None and at is not None and s <= at]
        expected.append((i, *max(known, default=(None, None))))
    assert rows(found, "id", "since", "v") == sorted(expected)


def test_as_of_without_states_or_facts(spark):
    facts, states = spark.createDataFrame([(1, "a", day(1))], "id int, k string, at date"), spark.createDataFrame([], "k string, since date, v int")
    assert rows(timeline.as_of(facts, states, ["k"], "at", "since", ["v"])) == [(1, "a", day(1), None)]
    assert rows(timeline.as_of(facts.limit(0), states, ["k"], "at", "since", ["v"])) == []


def test_as_of_has_no_join_and_a_hot_key_is_spread(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "8")
    states = spark.range(0, 8000, 7).selectExpr("'hot' as k", "id as since", "id as v")
    facts = spark.range(8000).selectExpr("'hot' as k", "id as at", "id")
    found = timeline.as_of(facts, states, ["k"], "at", "since", ["v"], segment_rows=64)
    assert found.where("v != id - id % 7").count() == 0 and found.count() == 8000
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    per_task = [r["n"] for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(per_task) <= 2 * 8000 / 8


def test_points_in_intervals_of_every_length(spark):
    pick = random.Random(2)
    spans = [(i, pick.choice(["a", "b", None]), s, s + pick.choice([0, 1, 5, 6, 40, 41, 365, 5000, -1])) for i in range(150) for s in [pick.randrange(-50, 900)]]
    spans += [(900, "a", None, 5), (901, "a", 5, None)]
    points = [(i, pick.choice(["a", "b", "c", None]), pick.choice([None, *range(-60, 1000)])) for i in range(200)] + [(0, "a", 3), (0, "a", 3)]
    met = timeline.within_intervals(spark.createDataFrame(points, "p int, k string, at int"), spark.createDataFrame(spans, "i int, k string, lo int, hi int"),
                                    ["k"], "at", "lo", "hi")
    expected = [(p, i) for p, k, at in points for i, key, lo, hi in spans if k is not None and k == key and None not in (at, lo, hi) and lo <= at <= hi]
    assert expected and rows(met, "p", "i") == sorted(expected)
    assert met.columns == ["p", "k", "at", "i", "lo", "hi"]


def test_intervals_join_by_equal_keys_also_when_one_cell_is_hot(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4KB")
    points = spark.range(5000).selectExpr("id as p", "'k' as k", "if(id % 10 = 0, id, 77) as at")
    spans = spark.createDataFrame([(1, "k", 70, 80), (2, "k", 0, 10_000), (3, "k", 78, 79)], "i int, k string, lo long, hi long")
    met = timeline.within_intervals(points, spans, ["k"], "at", "lo", "hi")
    assert {r["i"]: r["count"] for r in met.groupBy("i").count().collect()} == {1: 4502, 2: 5000}
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_intervals(spark):
    none = spark.createDataFrame([], "i int, k string, lo int, hi int")
    assert timeline.within_intervals(spark.createDataFrame([(1, "a", 3)], "p int, k string, at int"), none, ["k"], "at", "lo", "hi").count() == 0
