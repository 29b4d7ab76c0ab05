"""Deciding whether an incoming donation event may be stored, and why not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.keyed import attach, known
from granary.policy import Policy


def with_dimensions(events: DataFrame, donors: DataFrame, banks: DataFrame, camps: DataFrame, spread: str) -> DataFrame:
    """Adds what the rules ask: _donor, _bank and _camp (known or not) and _donor_group. ``spread`` as in ``attach``."""
    wide = attach(events, donors, {"donor_id": "donor_id"}, {"blood_group": "_donor_group"}, spread, "_donor")
    wide = attach(wide, banks, {"blood_bank_id": "blood_bank_id"}, {}, spread, "_bank")
    return attach(wide, camps, {"camp_id": "camp_id"}, {}, spread, "_camp")


def failing(policy: Policy) -> Column:
    """The first rule that an event ``with_dimensions`` breaks, NULL if none."""
    # Rules in order, each with its reason.
    rules = [
        (~F.col("_donor"), "Unknown donor_id"),
        (~F.col("_bank"), "Unknown blood_bank_id"),
        (F.col("camp_id").isNotNull() & ~F.col("_camp"), "Unknown camp_id"),
        (~F.col("blood_group").eqNullSafe(F.col("_donor_group")), "blood_group mismatch"),
        (F.coalesce(F.col("units_donated") <= 0, F.lit(True)), "Invalid units_donated"),
        (~F.coalesce(F.col("donation_status").isin(*policy.donation_statuses), F.lit(False)), "Invalid donation_status"),
        (F.col("event_time").isNull(), "Missing event_time"),
        (F.col("donation_date").isNull(), "Missing donation_date"),
    ]
    return F.coalesce(*[F.when(broken, F.lit(reason)) for broken, reason in rules])


def offending(reason: Column) -> Column:
    """The value of an event ``with_dimensions`` that its reason for rejection is about, as text; NULL if it is the lack of one."""
    group = F.concat_ws(" against ", F.coalesce("blood_group", F.lit("none")), F.coalesce("_donor_group", F.lit("none")))
    values = {
        "Duplicate donation_id": F.col("donation_id"), "Unknown donor_id": F.col("donor_id"), "Unknown blood_bank_id": F.col("blood_bank_id"),
        "Unknown camp_id": F.col("camp_id"), "blood_group mismatch": group, "Invalid units_donated": F.col("units_donated"),
        "Invalid donation_status": F.col("donation_status"),
    }
    return F.coalesce(*[F.when(reason == name, value.cast("string")) for name, value in values.items()])


def judge(events: DataFrame, donors: DataFrame, banks: DataFrame, camps: DataFrame, stored: DataFrame,
          policy: Policy) -> DataFrame:
    """Adds ``admitted``, ``reject_reason`` (the first rule that fails) and ``rejected_value`` (what failed it).

    An id is a duplicate when it is already stored or when an earlier event with the same id was
    admitted. ``donors``, ``banks`` and ``camps`` must be unique by their id. Identical events are
    judged once, with their number, and told apart only in the result: one of them can be admitted.
    No row is numbered, so a task that runs again decides the same.
    """
    spread = "_spread"
    distinct = events.groupBy(*events.columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn(spread, F.xxhash64(*events.columns))
    wide = with_dimensions(distinct, donors, banks, camps, spread)
    # Only the stored ids this batch repeats matter: the store is filtered by the batch, not shuffled whole.
    repeated_ids = stored.select("donation_id").join(events.select("donation_id"), "donation_id", "left_semi")
    wide = known(wide, "donation_id", repeated_ids, "donation_id", "_stored", spread)

    # The earliest event comes first, then the smallest by its other columns: no two distinct events tie.
    others = [c for c in events.columns if c != "event_time"]
    ruled = wide.withColumn("_failing", failing(policy)).withColumn("_order", F.struct("event_time", *others))
    passed = F.when(F.col("_failing").isNull() & ~F.col("_stored"), F.col("_order"))
    first = ruled.groupBy("donation_id").agg(F.min(passed).alias("_first"), F.count(F.lit(1)).alias("_n"))
    repeated = first.where(F.col("_first").isNotNull() & (F.col("_n") > 1))
    placed = attach(ruled, repeated, {"donation_id": "donation_id"}, {"_first": "_first"}, spread)
    duplicate = F.col("_stored") | F.coalesce(F.col("_order") > F.col("_first"), F.lit(False))
    reason = F.when(duplicate, F.lit("Duplicate donation_id")).otherwise(F.col("_failing"))
    copies = placed.select(*events.columns, "_donor_group", reason.alias("_reason"), F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"))
    later = F.col("_reason").isNull() & (F.col("_copy") > 1)
    named = copies.withColumn("reject_reason", F.when(later, "Duplicate donation_id").otherwise(F.col("_reason")))
    return named.select(*events.columns, "reject_reason", F.col("reject_reason").isNull().alias("admitted"),
                        offending(F.col("reject_reason")).alias("rejected_value"))
