"""Banks and their stock lines, looked up in one join."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import rows
from granary.operators import keyed, refine

NOW = dt.datetime(2026, 8, 15, 9)


def frames(spark):
    banks = spark.createDataFrame(
        [("B1", "One"), ("B2", None), ("B2", "Two again"), ("B4", "no stock"), (None, "no id")], "bank string, name string")
    lines = spark.createDataFrame(
        [("B1", "O-", 7), ("B1", "A+", None), ("B2", "O-", 1), ("B2", "O-", 2), ("B3", "O-", 3), (None, "O-", 4), ("B1", None, 5), ("B4", None, 6)],
        "bank string, code string, units int")
    pairs = [(b, g) for b in ("B1", "B2", "B3", "B4", "B9", None) for g in ("O-", "A+", "ZZ", None)]
    facts = spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], "id int, bank string, code string")
    return facts, banks, lines


def test_one_join_gives_what_two_lookups_give(spark, conf):
    facts, banks, lines = frames(spark)
    for limit in ("-1", "10MB"):
        conf("spark.sql.autoBroadcastJoinThreshold", limit)
        two = keyed.attach(facts, banks, {"bank": "bank"}, {"name": "bank_name"}, "id", "_bank")
        two = keyed.attach(two, lines, {"bank": "bank", "code": "code"}, {"units": "bank_units"}, "id", "_line")
        one = keyed.attach_with_line(facts, banks, lines, ("bank", "bank"), ("code", "code"), {"name": "bank_name"}, {"units": "bank_units"}, "id", "_bank", "_line")
        columns = ["id", "bank", "code", "bank_name", "bank_units", "_bank", "_line"]
        assert rows(one, *columns) == rows(two, *columns) and one.count() > facts.count()
        assert rows(keyed.attach_with_line(facts, banks.limit(0), lines.limit(0), ("bank", "bank"), ("code", "code"), {"name": "bank_name"}, {"units": "bank_units"}, "id", "_bank", "_line")
                    .where("_bank or _line or bank_name is not null")) == []


def test_donations_travel_once_to_a_bank_and_its_stock(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    facts = spark.createDataFrame([("X", "D", "B", "C", "O-")], "donation_id string, donor_id string, blood_bank_id string, camp_id string, blood_group string")

    def dimension(key, view):
        return spark.createDataFrame([tuple("x" for _ in view)], ", ".join(f"`{c}` string" for c in view)).withColumn(key, F.lit("B"))

    stock = dimension("blood_bank_id", refine.STOCK_VIEW).withColumn("blood_group", F.lit("O-"))
    wide = refine.enrich(facts, dimension("donor_id", refine.DONOR_VIEW), dimension("blood_bank_id", refine.BANK_VIEW),
                         dimension("camp_id", refine.CAMP_VIEW), stock)
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 3  # camp, bank with its stock, donor
    assert [tuple(r) for r in wide.select("blood_bank_exists", "inventory_record_exists", "donor_exists").collect()] == [(True, True, False)]
