"""Donation activity over time, by group, bank, camp and donor.

Input contract: ``donations(donation_id, donor_id, blood_bank_id, camp_id, donation_date,
blood_group, units_donated, donation_status)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.keyed import attach
from granary.operators.stock import per_bank_watch_stock
from granary.policy import Policy


def _tally(**names: str) -> list[Column]:
    """Requested measures as ``measure=output name`` pairs; a donation without an id counts with its units."""
    measures = {
        "donations": lambda: F.count(F.lit(1)),
        "units": lambda: F.sum("units_donated"),
        "donors": lambda: F.count_distinct("donor_id"),
        "banks": lambda: F.count_distinct("blood_bank_id"),
    }
    return [measures[measure]().alias(name) for measure, name in names.items()]


def counted(donations: DataFrame, policy: Policy) -> DataFrame:
    """Donations that became usable stock."""
    if not policy.count_only_completed:
        return donations
    return donations.where(F.col("donation_status") == policy.counted_status)


def counted_watched(donations: DataFrame, policy: Policy) -> DataFrame:
    """Watch-listed and completed, whatever the general counting switch says."""
    rare = F.col("is_rare_blood") if "is_rare_blood" in donations.columns else F.col("blood_group").isin(*policy.watch_list)
    return donations.where(rare & (F.col("donation_status") == policy.counted_status))


def contribution(donations: DataFrame, policy: Policy) -> DataFrame:
    return counted_watched(donations, policy).groupBy("blood_group").agg(
        *_tally(donations="total_donations", units="total_units_donated", donors="active_donors",
                banks="blood_banks_receiving_donations"),
    ).orderBy("blood_group")


def watch_trend(donations: DataFrame, policy: Policy) -> DataFrame:
    return counted_watched(donations, policy).groupBy(F.col("donation_date").alias("date"), "blood_group").agg(
        *_tally(units="units_donated", donations="donation_count"),
    ).orderBy("date", "blood_group")


def daily(donations: DataFrame, policy: Policy) -> DataFrame:
    return counted(donations, policy).groupBy("donation_date").agg(
        *_tally(donations="total_donations", units="total_units_donated", donors="unique_donors",
                banks="active_blood_banks"),
    ).orderBy("donation_date")


def monthly(donations: DataFrame, policy: Policy) -> DataFrame:
    """Grouped on the first day of the month; the calendar words are derived after the aggregate."""
    first = F.col("_first")
    return counted(donations, policy).groupBy(F.trunc("donation_date", "month").alias("_first")).agg(
        *_tally(donations="total_donations", units="total_units_donated", donors="unique_donors"),
    ).select(
        F.year(first).alias("year"), F.month(first).alias("month"), F.date_format(first, "MMMM").alias("month_name"),
        "total_donations", "total_units_donated", "unique_donors",
    ).orderBy("year", "month")


def share_of(part: Column, whole: Column) -> Column:
    """Percentage with two decimals; unknown when there is nothing to share."""
    return F.round(F.when(whole > 0, part / whole) * 100, 2)


def distribution(donations: DataFrame, policy: Policy) -> DataFrame:
    groups = counted(donations, policy).groupBy("blood_group").agg(
        *_tally(donations="total_donations", units="total_units_donated"),
    )
    everything = groups.agg(F.sum("total_units_donated")).scalar()
    return groups.withColumn(
        "percentage_of_total", share_of(F.col("total_units_donated"), everything)
    ).orderBy(F.desc("total_units_donated"), "blood_group")


def bank_performance(donations: DataFrame, banks: DataFrame, inventory: DataFrame, policy: Policy) -> DataFrame:
    """Every bank with what it received and the watch-listed stock it holds now."""
    received = counted(donations, policy).groupBy("blood_bank_id").agg(
        *_tally(donations="total_donations_received", units="total_units_received", donors="unique_donors"),
    )
    measures = {c: c for c in received.columns[1:]}
    stock = per_bank_watch_stock(inventory, policy)
    stocked = {c: c for c in stock.columns[1:]}
    base = banks.select("blood_bank_id", "blood_bank_name", "city", "state")
    key = {"blood_bank_id": "blood_bank_id"}
    return attach(attach(base, received, key, measures), stock, key, stocked).fillna(
        0, subset=[*measures, *stocked]
    ).orderBy(F.desc("total_donations_received"), "blood_bank_id")


def camp_performance(donations: DataFrame, camps: DataFrame, policy: Policy) -> DataFrame:
    """Every camp with what it collected; donations made at a bank have no camp."""
    at_camps = counted(donations, policy).where(F.col("camp_id").isNotNull())
    collected = at_camps.groupBy("camp_id").agg(
        *_tally(donations="total_donations", units="total_units_collected", donors="unique_donors"),
    )
    measures = {c: c for c in collected.columns[1:]}
    return attach(camps.select("camp_id", "camp_name", "city"), collected, {"camp_id": "camp_id"}, measures).fillna(
        0, subset=list(measures)
    ).orderBy(F.desc("total_donations"), "camp_id")


def donor_roster(donations: DataFrame, donors: DataFrame, policy: Policy) -> DataFrame:
    """Every registered donor, active or not; dates stay unknown for those who never gave."""
    given = counted(donations, policy).groupBy("donor_id").agg(
        *_tally(donations="total_donations", units="total_units_donated"),
        F.min("donation_date").alias("first_donation_date"), F.max("donation_date").alias("last_donation_date"),
    )
    people = donors.select("donor_id", F.col("full_name").alias("name"), "blood_group", "city")
    return attach(people, given, {"donor_id": "donor_id"}, {c: c for c in given.columns[1:]}).fillna(
        0, subset=["total_donations", "total_units_donated"]
    ).withColumn(
        "is_rare_blood_donor", F.col("blood_group").isin(*policy.watch_list)
    ).orderBy(F.desc("total_donations"), "donor_id")


def donor_pool(roster: DataFrame) -> DataFrame:
    """Watch-listed donors per group, by the donor's own group; donors without an id are one each."""
    gave = F.when(F.col("total_donations") > 0, F.col("donor_id"))
    return roster.where("is_rare_blood_donor").groupBy("blood_group").agg(
        (F.count_distinct("donor_id") + F.count_if(F.col("donor_id").isNull())).alias("total_donors"),
        F.count_distinct(gave).alias("active_donors"),
        F.sum("total_donations").alias("total_donations"), F.sum("total_units_donated").alias("total_units_donated"),
    ).orderBy("blood_group")
