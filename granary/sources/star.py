"""Domain frames derived from a TPC-H-like star schema, over its whole tables.

| domain frame | derived from |
| --- | --- |
| donors, banks | customer, supplier with nation and region |
| camps | part |
| donations | lineitem with its order; the natural key really repeats |
| inventory | lineitem with its order, summed per (supplier, group) |
| ledger, transfers | lineitem |
| donation events | events |

No frame is broadcast by hint: customer, supplier and part grow with the data.

The star tables are free of faults, so some are derived on purpose, by key, in every size: donors and
banks that are unknown or NULL, a bank that stock knows and the bank table does not, groups with little
or no stock, events that share an id or lack a time or a date.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.bands import label, translate
from granary.operators.keyed import dedupe
from granary.policy import DEFAULT_POLICY, Policy

# Star codes and the domain words they stand for.
SEGMENT_GROUP = {"AUTOMOBILE": "O-", "BUILDING": "A+", "FURNITURE": "B-", "HOUSEHOLD": "O+", "MACHINERY": "AB-"}
PRIORITY_GROUP = {"1-URGENT": "O-", "2-HIGH": "AB-", "3-MEDIUM": "B-", "4-NOT SPECIFIED": "A-", "5-LOW": "O+"}
EVENT_GROUP = {"signup": "O-", "click": "AB-", "error": "B-", "purchase": "A+", "view": "O+"}
RETURN_STATUS = {"N": "Completed", "A": "Cancelled", "R": "Rejected"}
RETURN_COMPONENT = {"N": "RBC", "A": "Plasma", "R": "Platelets"}
LINE_GROUP = {"O": "O-", "F": "A+"}
LINE_MOVEMENT = {
    1: "DONATION", 2: "ISSUE", 3: "TRANSFER_IN", 4: "TRANSFER_OUT", 5: "DONATION", 6: "EXPIRY", 7: "ADJUSTMENT",
}
ELIGIBILITY = {0: "Eligible", 1: "Temporarily Ineligible", 2: "Inactive", 3: "Unknown", 4: "On Leave"}
SPELLING = {1: " pos ", 2: " Positive", 3: "+", 4: " NEG", 5: "negative", 6: " - ", 7: "POS"}
EPOCH = dt.date(1995, 1, 1)
# Added to a key, it names nothing.
NOWHERE = 1_000_000_000
# Groups that one bank alone holds, with these units; other watch-listed groups follow the sold quantities.
SCARCE = {"AB-": 4, "B-": 8, "A-": 0}
SCARCE_BANK, LOST_BANK = 1, 2

STAR_POLICY: Policy = replace(DEFAULT_POLICY, as_of=dt.date(2001, 11, 5))


class Star:
    """Lazily built domain frames of one data folder."""

    def __init__(self, spark: SparkSession, folder: str, policy: Policy = STAR_POLICY):
        self.spark, self.folder, self.policy = spark, folder.rstrip("/"), policy

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _placed(self, df: DataFrame, nation_key: str) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        return df.join(places, F.col(nation_key) == F.col("n_nationkey"), "left")

    def donors(self) -> DataFrame:
        worth = F.floor(F.abs("c_acctbal")).cast("int")
        registered = F.date_add(F.lit(EPOCH), (worth % 2000).cast("int"))
        return self._placed(self.table("customer"), "c_nationkey").select(
            F.col("c_custkey").alias("donor_id"), F.col("c_name").alias("full_name"),
            F.when(F.col("c_nationkey") < 20, F.lit("Female")).alias("gender"),
            (worth % 55 + 15).cast("int").alias("age"),
            translate(F.col("c_mktsegment"), SEGMENT_GROUP).alias("blood_group"),
            F.col("n_name").alias("city"), F.col("r_name").alias("state"),
            registered.alias("registration_date"),
            F.date_add(registered, (F.col("c_custkey") % 400 - 20).cast("int")).alias("last_donation_date"),
            translate((F.col("c_nationkey") % 5), ELIGIBILITY).alias("eligibility_status"),
        )

    def banks(self) -> DataFrame:
        return self._placed(self.table("supplier"), "s_nationkey").select(
            F.col("s_suppkey").alias("blood_bank_id"), F.col("s_name").alias("blood_bank_name"),
            F.col("n_name").alias("city"), F.col("r_name").alias("state"),
            (F.col("s_acctbal") / 100).alias("latitude"),
            (F.col("s_nationkey") * 15.0 - 180.0).alias("longitude"),
            F.floor("s_acctbal").cast("int").alias("storage_capacity"),
        )

    def camps(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("camp_id"), F.col("p_name").alias("camp_name"),
            F.col("p_brand").alias("organizer"), F.col("p_type").alias("city"),
            F.date_add(F.lit(EPOCH), F.col("p_size")).alias("camp_date"),
        )

    def donation_lines(self) -> DataFrame:
        """Donations before their order is known: keyed by (order, line), with the copies still in.

        A quantity that is not whole counts as the nearest whole number of units, the even one of two.
        """
        return self.table("lineitem").select(
            "l_orderkey", "l_linenumber", astray(F.col("l_suppkey"), F.col("l_partkey"), 41).alias("blood_bank_id"),
            F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey")).alias("camp_id"),
            F.to_date("l_shipdate").alias("donation_date"),
            F.rint("l_quantity").cast("int").alias("units_donated"),
            translate(F.col("l_returnflag"), RETURN_STATUS).alias("donation_status"),
        )

    def _with_order(self, lines: DataFrame) -> DataFrame:
        orders = self.table("orders").select(
            "o_orderkey", astray(F.col("o_custkey"), F.col("o_orderkey"), 50).alias("donor_id"),
            translate(F.col("o_orderpriority"), PRIORITY_GROUP).alias("blood_group"),
        )
        joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        return joined.select(
            donation_key().alias("donation_id"), "donor_id", "blood_bank_id", "camp_id", "donation_date",
            "blood_group", "units_donated", "donation_status",
        )

    def raw_donations(self) -> DataFrame:
        return self._with_order(self.donation_lines())

    def raw_donation_ids(self) -> DataFrame:
        return self.table("lineitem").select(donation_key().alias("donation_id"))

    def unique_lines(self) -> DataFrame:
        """Copies are removed before the order join: an order with very many copies collapses first.

        A copy that names its bank goes before one that does not, so that the bank keeps what it received. No camp is
        no gap: the donation was made at the bank.
        """
        order = ["donation_date", "blood_bank_id", "camp_id", "units_donated", "donation_status"]
        known = [c for c in order if c != "camp_id"]
        # The key is the table's own row key, so the rule for rows without a key is not needed.
        return dedupe(self.donation_lines(), ["l_orderkey", "l_linenumber"], order, collapse_null_keys=True, known_first=known)

    def donations(self) -> DataFrame:
        return self._with_order(self.unique_lines())

    def inventory(self) -> DataFrame:
        lines = self.table("lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_shipdate")
        orders = self.table("orders").select(
            "o_orderkey", translate(F.col("o_orderpriority"), PRIORITY_GROUP).alias("blood_group")
        )
        sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").groupBy("l_suppkey", "blood_group").agg(
            (F.sum("l_quantity").cast("bigint") % 17).cast("int").alias("_units"), F.max("l_shipdate").alias("last_updated"),
        )
        held = F.when(F.col("l_suppkey") == SCARCE_BANK, translate(F.col("blood_group"), SCARCE)).otherwise(F.lit(0))
        stock = sold.select(
            F.when(F.col("l_suppkey") == LOST_BANK, F.col("l_suppkey") + NOWHERE).otherwise(F.col("l_suppkey")).alias("blood_bank_id"),
            "blood_group", F.when(F.col("blood_group").isin(*SCARCE), held).otherwise(F.col("_units")).cast("int").alias("available_units"),
            "last_updated",
        )
        return stock.withColumns({
            "inventory_id": F.concat_ws("-", F.col("blood_bank_id").cast("string"), "blood_group"),
            "inventory_status": label(F.col("available_units"), self.policy.record),
        })

    def ledger(self) -> DataFrame:
        movement = translate(F.col("l_linenumber"), LINE_MOVEMENT)
        size = F.ceil(F.col("l_quantity") / 10)
        units = F.when(movement == "ADJUSTMENT", size - 3).otherwise(size).cast("double")
        moved = movement.isin("TRANSFER_IN", "TRANSFER_OUT")
        return self.table("lineitem").select(
            donation_key().alias("transaction_id"), F.col("l_suppkey").alias("blood_bank_id"),
            translate(F.col("l_linestatus"), LINE_GROUP).alias("blood_group"),
            translate(F.col("l_returnflag"), RETURN_COMPONENT).alias("component_type"),
            movement.alias("transaction_type"), units.alias("units"),
            F.col("l_shipdate").alias("transaction_timestamp"),
            F.when(moved, F.col("l_orderkey")).alias("source_transfer_id"),
            F.when(movement == "TRANSFER_OUT", F.col("l_partkey")).alias("destination_bank_id"),
            F.lit("POSTED").alias("status"),
            F.when(movement == "ISSUE", donation_key()).alias("issue_id"),
        )

    def transfers(self) -> DataFrame:
        return self.table("lineitem").select(
            donation_key().alias("transfer_id"), F.col("l_suppkey").alias("source_bank_id"),
            F.col("l_partkey").alias("destination_bank_id"),
            translate(F.col("l_linestatus"), LINE_GROUP).alias("blood_group"),
            translate(F.col("l_returnflag"), RETURN_COMPONENT).alias("component_type"),
            (F.col("l_quantity") - 2).alias("units"), F.to_date("l_shipdate").alias("transfer_date"),
            F.lit("COMPLETED").alias("status"),
        )

    def events(self) -> DataFrame:
        return as_donation_events(self.table("events"))

    def spelled_codes(self) -> DataFrame:
        """Every lineitem with a code and a status as people might type them."""
        letter = F.lower("l_returnflag")
        words = F.when(F.col("l_linestatus") == "O", F.lower(translate(F.col("l_returnflag"), RETURN_STATUS)))
        return self.table("lineitem").select(
            donation_key().alias("donation_id"),
            F.concat(F.lit(" "), letter, translate(F.col("l_linenumber"), SPELLING)).alias("raw_code"),
            F.coalesce(words, F.when(F.col("l_tax") > 0.01, F.lit("  SUCCESS ")), F.lit("on HOLD")).alias("raw_status"),
            F.when(F.col("l_discount") > 0.05, F.concat(F.lit(" line "), F.col("l_linenumber").cast("string"), F.lit(" ")))
            .when(F.col("l_discount") > 0.01, F.lit("  ")).alias("raw_note"),
        )


def astray(key: Column, by: Column, step: int) -> Column:
    """The key, but unknown for one in ``step`` of the numbers ``by``, and NULL for another; no number is neither."""
    return F.when(by % step == 7, key + NOWHERE).when(by % step == 8, F.lit(None)).otherwise(key)


def donation_key() -> Column:
    """Order and line number as one number; line numbers run from 1 to 7 in this schema."""
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def as_donation_events(events: DataFrame, *extra: Column) -> DataFrame:
    """The events table read as live donation events, batch or streaming."""
    amount = F.col("value")
    return events.select(
        (F.col("event_id") - F.when(F.col("event_id") % 3 == 1, 1).otherwise(0)).alias("donation_id"),
        astray(F.col("user_id"), F.col("event_id"), 90).alias("donor_id"),
        astray(F.get_json_object("props", "$.k").try_cast("bigint"), F.col("event_id"), 80).alias("blood_bank_id"),
        F.when(F.col("event_type") != "view", F.floor(amount * 10)).alias("camp_id"),
        F.when((amount > 0.5) & (F.col("event_id") % 4 != 2), F.to_date("ts")).alias("donation_date"),
        translate(F.col("event_type"), EVENT_GROUP).alias("blood_group"),
        (F.floor(amount / 20)).cast("int").alias("units_donated"),
        F.when(amount < 200, F.lit("Completed")).otherwise(F.lit("Deferred")).alias("donation_status"),
        F.when((amount > 0.25) & (F.col("event_id") % 7 != 3), F.col("ts")).alias("event_time"),
        F.lit("live").alias("source"), F.lit("blood_donation").alias("event_type"), *extra,
    )
