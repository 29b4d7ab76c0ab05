"""Stock on hand: availability, shortage, location rollups and ranking.

Input contract: ``inventory(blood_bank_id, blood_group, available_units, last_updated)`` and
``banks(blood_bank_id, blood_bank_name, city, state, latitude, longitude, storage_capacity)``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.bands import label, translate
from granary.functions.scores import severity, tier_priority
from granary.functions.text import canonical
from granary.operators.keyed import attach
from granary.operators.rank import competition_rank
from granary.operators.shared_store import settle
from granary.policy import Policy

_PLACE = {"blood_bank_name": "blood_bank_name", "city": "city", "state": "state"}
_SITE = {**_PLACE, "latitude": "latitude", "longitude": "longitude", "storage_capacity": "storage_capacity"}


def tidy_groups(df: DataFrame, column: str = "blood_group") -> DataFrame:
    """Light pass over a group column that was standardised elsewhere."""
    return df.withColumn(column, canonical(F.col(column)))


def watched(df: DataFrame, policy: Policy, column: str = "blood_group") -> DataFrame:
    return df.where(F.col(column).isin(*policy.watch_list))


def located(inventory: DataFrame, banks: DataFrame, detailed: bool = False) -> DataFrame:
    """Stock lines with their bank's place; lines of an unknown bank stay."""
    return attach(inventory, banks, {"blood_bank_id": "blood_bank_id"}, _SITE if detailed else _PLACE)


def rollup(inventory: DataFrame, by: Sequence[str]) -> DataFrame:
    """Totals and exact bank counts per ``by`` in one scan.

    Lines are first folded to one row per (``by``, bank); bank counts are then plain conditional
    counts. That avoids the row expansion several distinct counts would need and lets a hot
    group be summed by many tasks.
    """
    units = F.col("available_units")
    per_bank = inventory.groupBy(*by, "blood_bank_id").agg(
        F.sum(units).alias("held"), F.min(units).alias("low"), F.max(units).alias("high"),
        F.bool_or(units > 0).alias("stocked"), F.bool_or(units == 0).alias("empty"),
    )
    named = F.col("blood_bank_id").isNotNull()
    return per_bank.groupBy(*by).agg(
        F.sum("held").alias("total_available_units"),
        F.min("low").alias("minimum_units"),
        F.max("high").alias("maximum_units"),
        F.count("blood_bank_id").alias("banks_seen"),
        F.count_if(named & F.col("stocked")).alias("banks_stocked"),
        F.count_if(named & F.col("empty")).alias("banks_empty"),
    )


# ---- four-tier scale -------------------------------------------------------------------------

def group_summary(inventory: DataFrame) -> DataFrame:
    """Every group: total, centers holding stock, average per such center, range over all lines."""
    centers = F.col("banks_stocked")
    return rollup(inventory, ["blood_group"]).select(
        "blood_group", "total_available_units", centers.alias("number_of_centers"),
        F.try_divide("total_available_units", centers).alias("average_units_per_center"),
        "minimum_units", "maximum_units",
    )


def tiered_availability(inventory: DataFrame, policy: Policy) -> DataFrame:
    """Watch-listed groups with a tier and an urgency priority."""
    tier = label(F.col("total_available_units"), policy.four_tier)
    return (
        group_summary(watched(inventory, policy))
        .withColumn("availability_status", tier)
        .withColumn("priority_score", tier_priority(F.col("availability_status"), F.col("number_of_centers"), policy))
    )


def tiered_centers(inventory: DataFrame, banks: DataFrame, policy: Policy) -> DataFrame:
    """Watch-listed stock line by line with a tier per center."""
    return located(watched(inventory, policy), banks).select(
        "blood_bank_id", "blood_bank_name", "city", "state", "blood_group", "available_units", "last_updated",
        label(F.col("available_units"), policy.four_tier).alias("availability_status"),
    ).orderBy("blood_group", F.desc("available_units"), "blood_bank_id")


def tiered_shortages(inventory: DataFrame, policy: Policy) -> DataFrame:
    """Watch-listed groups, scarcest first, with what to do about it."""
    return tiered_availability(inventory, policy).select(
        "blood_group", "total_available_units", "number_of_centers",
        F.col("availability_status").alias("shortage_level"),
        translate(F.col("availability_status"), policy.tier_actions).alias("recommended_action"),
    ).orderBy("total_available_units", "blood_group")


def empty_lines(inventory: DataFrame, banks: DataFrame, policy: Policy) -> DataFrame:
    """Watch-listed lines that are tracked but hold nothing."""
    nothing = watched(inventory, policy).where(F.col("available_units") == 0)
    return located(nothing, banks).select(
        "blood_bank_id", "blood_bank_name", "city", "state", "blood_group", "available_units",
        F.lit("NO STOCK").alias("status"),
    ).orderBy("blood_group", "city", "blood_bank_id")


def tiered_cities(inventory: DataFrame, banks: DataFrame, policy: Policy) -> DataFrame:
    lines = located(watched(inventory, policy), banks)
    return rollup(lines, ["city", "state", "blood_group"]).select(
        "city", "state", "blood_group", "total_available_units",
        F.col("banks_stocked").alias("number_of_centers"),
        label(F.col("total_available_units"), policy.four_tier).alias("status"),
    ).orderBy("blood_group", F.desc("total_available_units"), "city", "state")


def per_bank_watch_stock(inventory: DataFrame, policy: Policy) -> DataFrame:
    """Watch-listed units and distinct groups in stock per bank."""
    in_stock = F.when(F.col("available_units") > 0, F.col("blood_group"))
    return watched(inventory, policy).groupBy("blood_bank_id").agg(
        F.sum("available_units").alias("rare_blood_units"),
        F.count_distinct(in_stock).alias("rare_blood_types_available"),
    )


def center_ranking(inventory: DataFrame, banks: DataFrame, policy: Policy) -> DataFrame:
    """Banks ranked by watch-listed units. The ranking reads its input three times, so it is settled first."""
    held = settle(per_bank_watch_stock(inventory, policy))
    ranked = competition_rank(held, "rare_blood_units", "center_rank")
    return located(ranked, banks).select(
        "blood_bank_id", "blood_bank_name", "city", "state",
        "rare_blood_units", "rare_blood_types_available", "center_rank",
    ).orderBy("center_rank", "blood_bank_id")


# ---- stock-out scale -------------------------------------------------------------------------

def _stock_out(units: str, policy: Policy) -> Column:
    return label(F.col(units), policy.stock_out)


def availability_detail(inventory: DataFrame, banks: DataFrame, policy: Policy) -> DataFrame:
    """Watch-listed lines with capacity, coordinates and a stock-out label."""
    return located(watched(inventory, policy), banks, detailed=True).select(
        "blood_bank_id", "blood_bank_name", "city", "state", "blood_group", "available_units", "storage_capacity",
        _stock_out("available_units", policy).alias("availability_status"),
        "last_updated", "latitude", "longitude",
    ).orderBy("blood_group", F.desc("available_units"), "blood_bank_id")


def watch_summary(inventory: DataFrame, policy: Policy) -> DataFrame:
    """Watch-listed groups: banks tracked, stocked and empty, average over all banks, label."""
    average = F.round(F.try_divide("total_available_units", "banks_seen"), 2)
    return rollup(watched(inventory, policy), ["blood_group"]).select(
        "blood_group", "total_available_units",
        F.col("banks_seen").alias("number_of_blood_banks"),
        F.col("banks_stocked").alias("number_of_banks_with_stock"),
        F.col("banks_empty").alias("number_of_banks_out_of_stock"),
        average.alias("average_units_per_bank"),
        _stock_out("total_available_units", policy).alias("availability_status"),
    ).orderBy("blood_group")


def severity_report(inventory: DataFrame, policy: Policy) -> DataFrame:
    """Worst groups first on the stock-out scale."""
    return watch_summary(inventory, policy).select(
        "blood_group", "total_available_units", "number_of_blood_banks",
        F.col("number_of_banks_with_stock").alias("banks_with_stock"),
        F.col("availability_status").alias("shortage_status"),
        severity(F.col("availability_status"), policy).alias("severity_score"),
    ).orderBy(F.desc("severity_score"), "total_available_units", "blood_group")


def bank_stock(inventory: DataFrame, banks: DataFrame, policy: Policy, in_stock_only: bool = False) -> DataFrame:
    """Where a watch-listed group can be found."""
    lines = watched(inventory, policy)
    if in_stock_only:
        lines = lines.where(F.col("available_units") > 0)
    return located(lines, banks, detailed=True).select(
        "blood_bank_id", "blood_bank_name", "city", "state", "blood_group", "available_units",
        _stock_out("available_units", policy).alias("availability_status"),
        "latitude", "longitude", "last_updated",
    ).orderBy("blood_group", F.desc("available_units"), "blood_bank_id")


def cities(inventory: DataFrame, banks: DataFrame, policy: Policy) -> DataFrame:
    lines = located(watched(inventory, policy), banks)
    return rollup(lines, ["city", "state", "blood_group"]).select(
        "city", "state", "blood_group", "total_available_units",
        F.col("banks_seen").alias("number_of_blood_banks"),
        F.col("banks_stocked").alias("banks_with_stock"),
        _stock_out("total_available_units", policy).alias("availability_status"),
    ).orderBy("blood_group", F.desc("total_available_units"), "city", "state")


# ---- other rollups ---------------------------------------------------------------------------

def watch_list_coverage(inventory: DataFrame, banks: DataFrame, policy: Policy) -> DataFrame:
    """Every watch-listed group, held anywhere or not: units, centers and cities in stock, strict label."""
    lines = located(watched(inventory, policy), banks)
    # Folded bank by bank, then city by city, so no distinct count is needed; an unknown city is one city.
    by_bank = lines.groupBy("blood_group", "city", "blood_bank_id").agg(
        F.sum("available_units").alias("units"), F.bool_or(F.col("available_units") > 0).alias("stocked"),
    )
    by_city = by_bank.groupBy("blood_group", "city").agg(
        F.sum("units").alias("units"), F.bool_or("stocked").alias("stocked"),
        F.count_if(F.col("stocked") & F.col("blood_bank_id").isNotNull()).alias("centers"),
    )
    held = by_city.groupBy(F.col("blood_group").alias("_group")).agg(
        F.sum("units").alias("_units"), F.sum("centers").alias("_centers"), F.count_if("stocked").alias("_cities"),
    )
    groups = inventory.sparkSession.createDataFrame([(g,) for g in policy.watch_list], "blood_group string")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("bigint")
    return groups.join(held, F.col("blood_group") == F.col("_group"), "left").select(
        "blood_group", zero("_units").alias("total_units"), zero("_centers").alias("centers_available"),
        zero("_cities").alias("cities_available"),
        label(zero("_units"), policy.strict).alias("status"),
    )


def record_status_counts(inventory: DataFrame, policy: Policy) -> DataFrame:
    """Per watch-listed group: units, centers in stock, lines CRITICAL and LOW by their stored status."""
    status = F.col("inventory_status")
    return watched(inventory, policy).groupBy("blood_group").agg(
        F.sum("available_units").alias("total_units"),
        F.count_distinct(F.when(F.col("available_units") > 0, F.col("blood_bank_id"))).alias("centers_with_stock"),
        F.count_if(status == "CRITICAL").alias("critical_records"),
        F.count_if(status == "LOW").alias("low_records"),
    )


def totals_by(inventory: DataFrame, column: str) -> DataFrame:
    return inventory.groupBy(column).agg(F.sum("available_units").alias("total_available_units"))
