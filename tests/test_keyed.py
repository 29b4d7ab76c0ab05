import datetime as dt
import random
import statistics
from collections import Counter

from pyspark.sql import functions as F

from helpers import by, rows
from granary.operators import keyed
from granary.operators.rank import competition_rank, cuts_above, exact_median
from granary.sources.star import Star


def test_dedupe_is_by_preference_and_independent_of_order(spark):
    data = [(1, "b", 2), (1, "a", 9), (2, "z", 1), (2, "z", 1), (3, None, 5), (3, "a", 4)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "id int, source string, v int").repartition(4)
        assert rows(keyed.dedupe(df, ["id"], ["source"])) == [(1, "a", 9), (2, "z", 1), (3, None, 5)]
        assert rows(keyed.dedupe(df, ["id"], ["v"])) == [(1, "b", 2), (2, "z", 1), (3, "a", 4)]


def test_a_copy_that_names_its_bank_goes_before_one_that_does_not(spark, tmp_path):
    day = dt.datetime(1999, 12, 12)
    lines = [(1, 1, 9, 49, 38.0, "R", day), (1, 1, 7, 50, 36.0, "A", day), (1, 2, 9, 50, 3.0, "N", day), (1, 2, 9, 51, 4.0, "N", day)]
    names = "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    kept = Star(spark, str(tmp_path)).unique_lines()
    # Part 49 has no bank; part 51 has no camp, which is known of it.
    assert rows(kept, "l_linenumber", "blood_bank_id", "camp_id", "units_donated") == [(1, 7, 50, 36), (2, 9, None, 4)]


def test_rows_without_a_key_are_kept_apart(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 2), (7, 3), (7, 3)], "id int, v int")
    assert rows(keyed.dedupe(df, ["id"])) == [(None, 1), (None, 1), (None, 2), (7, 3)]
    assert rows(keyed.dedupe(df, ["id"], collapse_null_keys=True)) == [(None, 1), (7, 3)]


def test_dedupe_keeps_column_order_and_types(spark):
    df = spark.createDataFrame([("x", 1, dt.date(2020, 1, 1))], "v string, id int, d date")
    assert keyed.dedupe(df, ["id"]).dtypes == df.dtypes


def test_one_hot_key_needs_no_task_that_holds_all_its_copies(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") % 5).alias("v"))
    unique = keyed.dedupe(df, ["k"])
    assert unique.where("k = 0").collect() == [(0, 0)]
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_duplicate_keys_and_rows_removed(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 2), (None, 0)], "a int, b int")
    assert rows(keyed.duplicate_keys(df, ["a"])) == [(1, 3)]
    assert rows(keyed.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]
    assert rows(keyed.duplicates_removed(df, ["a"])) == [(2,)]
    assert rows(keyed.duplicates_removed(df.limit(0), ["a"])) == [(0,)]


def test_attach_keeps_every_row_and_tells_missing_from_null(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz"), (5, None)], "id int, k string")
    dim = spark.createDataFrame([("a", "Anna"), ("b", None)], "k string, name string")
    for spread in (None, "id"):
        got = by(keyed.attach(facts, dim, {"k": "k"}, {"name": "who"}, spread, "found"), "id")
        assert {i: (r["who"], r["found"]) for i, r in got.items()} == {
            1: ("Anna", True), 2: (None, True), 3: (None, False), 4: (None, False), 5: (None, False)}


def test_facts_without_a_key_spread_over_tasks(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    facts = spark.range(20_000).select("id", F.when(F.col("id") < 0, F.col("id")).alias("k"))
    dim = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    spread = keyed.attach(facts, dim, {"k": "k"}, {"name": "name"}, "id")
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 8_000
    together = keyed.attach(facts, dim, {"k": "k"}, {"name": "name"})
    assert together.groupBy(F.spark_partition_id()).count().count() == 1


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "p int")
    assert rows(keyed.orphan_keys(child, "k", parent, "p")) == [(None, 1), (9, 2)]
    assert rows(keyed.orphan_total(child, "k", parent, "p")) == [(3,)]
    assert rows(keyed.orphan_total(child, "k", parent, "p", allow_null=True)) == [(2,)]


def test_side_by_side_shows_both_one_sided_and_null_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("only-left", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 1), (None, 5), ("only-right", 7)], "k string, w int")
    got = by(keyed.side_by_side(left, right, ["k"], {"v": "w"}), "k")
    assert {k: (r["left_v"], r["right_v"], r["in_left"], r["in_right"]) for k, r in got.items()} == {
        "a": (1, 1, True, True), None: (2, 5, True, True), "only-left": (3, None, True, False),
        "only-right": (None, 7, False, True)}


def test_missing_keys_and_values(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, g string")
    b = spark.createDataFrame([(2, "x")], "k int, g string")
    assert rows(keyed.missing_keys(a, b, ["k", "g"])) == [(1, None)]
    assert rows(keyed.invalid_values(a, "g", ["y"])) == [(None, 2), ("x", 1)]
    assert rows(keyed.null_counts(a, ["k", "g"])) == [("g", 2, 3), ("k", 0, 3)]


def brute_rank(values):
    known = [v for v in values if v is not None]
    return [1 + (len(known) if v is None else sum(o > v for o in known)) for v in values]


def test_rank_matches_brute_force(spark):
    rng = random.Random(5)
    for values in ([5, 5, 3, 1, 1, 1, 0], [7], [0, 0, 0], [None, 4, None, 9], [rng.randint(-50, 50) for _ in range(400)],
                   [rng.randint(0, 10**12) for _ in range(300)] + [0] * 150):
        df = spark.createDataFrame(list(enumerate(values)), "id int, v bigint")
        for ranges in (3, 64) if len(values) > 100 else (3,):
            got = by(competition_rank(df, "v", "r", ranges), "id")
            assert [got[i]["r"] for i in range(len(values))] == brute_rank(values)
        known = sorted(v for v in values if v is not None)
        assert rows(exact_median(df, "v", 5)) == [(statistics.median(known),)]


def test_median_of_nothing_is_unknown(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert rows(exact_median(df, "v")) == [(None,)]


def test_rank_sorts_no_whole_frame_in_one_task(spark):
    df = spark.range(50_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 977).alias("v"))
    got = competition_rank(df, "v", "r")
    counts = Counter(v for v in ((i % 977) if i % 3 else 0 for i in range(50_000)))
    ahead, expected = 0, {}
    for v in sorted(counts, reverse=True):
        expected[v] = ahead + 1
        ahead += counts[v]
    assert dict(rows(got.select("v", "r").distinct())) == expected


def test_cuts_above_equal_a_linear_count(spark):
    rng = random.Random(9)
    cases = [(sorted(rng.randint(0, 30) for _ in range(n)), rng.randint(-3, 33)) for n in (0, 1, 2, 3, 7, 8, 9, 63, 64) for _ in range(12)]
    df = spark.createDataFrame([(c, float(v)) for c, v in cases], "cuts array<int>, v double")
    got = df.select("cuts", "v", cuts_above(F.col("cuts"), F.col("v"), 64).alias("above")).collect()
    assert [r["above"] for r in got] == [sum(c > r["v"] for c in r["cuts"]) for r in got]
