"""Lookup queries over the published tables: filters, headline figures, top lists and alerts."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import text
from granary.operators.keyed import latest_first
from granary.operators.ledger import KEY
from granary.operators.rank import exact_median
from granary.operators.stock import watched
from granary.policy import Policy


def narrowed(df: DataFrame, policy: Policy, watch_only: bool = False, **equal) -> DataFrame:
    """Conjunction of optional equality filters; ``None`` and ``"All"`` mean no filter.

    A filter on a column the frame does not have is skipped, so one selection serves frames of
    different grain.
    """
    wanted = [F.col(c) == v for c, v in equal.items() if v not in (None, "All") and c in df.columns]
    if watch_only and "blood_group" in df.columns:
        wanted.append(F.col("blood_group").isin(*policy.watch_list))
    return df.where(reduce(lambda a, b: a & b, wanted)) if wanted else df


def between_days(df: DataFrame, column: str, first: dt.date, last: dt.date) -> DataFrame:
    return df.where(F.col(column).between(F.lit(first), F.lit(last)))


def mappable(df: DataFrame) -> DataFrame:
    return df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & (F.col("available_units") > 0))


def city_totals(city_rows: DataFrame) -> DataFrame:
    return city_rows.groupBy("city").agg(F.sum("total_available_units").alias("total_available_units")).orderBy(
        F.desc("total_available_units"), "city"
    )


def headline(summary: DataFrame, bank_rows: DataFrame, pool: DataFrame, shares: DataFrame, daily: DataFrame,
             as_of: dt.date) -> DataFrame:
    """One row of key figures. Each input is aggregated to one row and read as a subquery."""
    def figure(df: DataFrame, value: Column) -> Column:
        return F.coalesce(df.agg(value.cast("bigint").alias("v")).scalar(), F.lit(0).cast("bigint"))

    today = daily.where(F.col("donation_date") == F.lit(as_of))
    return summary.agg(
        F.coalesce(F.sum("total_available_units"), F.lit(0)).alias("rare_units"),
        F.count_if(F.col("availability_status") == "CRITICAL").alias("critical_groups"),
        F.count_if(F.col("availability_status") == "OUT_OF_STOCK").alias("out_of_stock_groups"),
    ).select(
        "*",
        figure(bank_rows, F.count_distinct(F.when(F.col("available_units") > 0, F.col("blood_bank_id")))).alias("rare_banks"),
        figure(pool, F.sum("total_donors")).alias("rare_donors"),
        figure(shares, F.sum("total_donations")).alias("total_donations"),
        figure(shares, F.sum("total_units_donated")).alias("total_units"),
        figure(today, F.sum("total_donations")).alias("donations_on_day"),
    )


def donor_figures(roster: DataFrame) -> DataFrame:
    return roster.agg(
        F.count(F.lit(1)).alias("total_donors"), F.count_if("is_rare_blood_donor").alias("rare_donors"),
        F.count_if(F.col("total_donations") > 0).alias("active_donors"),
    )


def donors_by_group(roster: DataFrame) -> DataFrame:
    return roster.groupBy("blood_group").agg(
        F.count(F.lit(1)).alias("donor_count"), F.sum("total_units_donated").alias("total_units_donated"),
    ).orderBy(F.desc("donor_count"), "blood_group")


def state_headline(state: DataFrame) -> DataFrame:
    """Units, spread, urgent and ageing lines, and the exact median of known coverage.

    The median reads the state again: pass a stored table.
    """
    counts = {
        "emergency_lines": F.col("priority_level") == "EMERGENCY", "critical_lines": F.col("priority_level") == "CRITICAL",
        "expiring_soon_lines": F.col("expiry_status") == "EXPIRING_SOON", "expired_lines": F.col("expiry_status") == "EXPIRED",
    }
    # Folded to (bank, component), so that few rows are expanded for the two distinct counts.
    folded = state.groupBy("blood_bank_id", "component_type").agg(
        F.sum("available_units").alias("total_units"), *[F.count_if(c).alias(name) for name, c in counts.items()])
    figures = folded.agg(
        F.sum("total_units").alias("total_units"), F.count_distinct("blood_bank_id").alias("blood_banks"),
        F.count_distinct("component_type").alias("component_types"), *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts])
    return figures.select("*", exact_median(state, "coverage_days").scalar().alias("median_coverage_days"))


def counts_in_order(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """Rows per category in a fixed order, zero where a category does not occur; one grouped pass."""
    counted = df.agg(*[F.count_if(F.col(column) == c).alias(f"c{i}") for i, c in enumerate(order)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias(column), F.col(f"c{i}").alias("line_count"))
        for i, c in enumerate(order)
    ])
    return counted.select(F.inline(rows))


def most_urgent(state: DataFrame) -> DataFrame:
    """The single EMERGENCY line with the highest score."""
    columns = ["blood_group", "component_type", "blood_bank_id", "available_units", "shortage_score"]
    urgent = state.where(F.col("priority_level") == "EMERGENCY").select(*columns)
    return latest_first(urgent, [F.desc("shortage_score"), "available_units", *KEY], 1)


def top_centers(centers: DataFrame, n: int = 10) -> DataFrame:
    stocked = centers.where(F.col("available_units") > 0).select(
        "blood_group", "blood_bank_id", "blood_bank_name", "city", "available_units", "availability_status"
    )
    return latest_first(stocked, [F.desc("available_units"), F.col("blood_group"), F.col("blood_bank_id")], n)


def by_measure(df: DataFrame, measure: str, key: str) -> DataFrame:
    """A published table re-sorted for display."""
    return df.orderBy(F.desc(measure), F.col(key))


def top_by(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    return by_measure(df, measure, key).limit(n)


def top_for_group(rows: DataFrame, group: str, n: int = 15) -> DataFrame:
    return top_by(rows.where(F.col("blood_group") == group), "available_units", "blood_bank_id", n)


def odd_values(invalid: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Up to ``n`` distinct bad values, in order, from ``keyed.invalid_values``."""
    return latest_first(invalid, [F.asc_nulls_first(column)], n)


def top_demand(demand: DataFrame, policy: Policy, watch_only: bool = False, n: int = 10) -> DataFrame:
    rows = watched(demand, policy) if watch_only else demand
    line = F.concat_ws(" ", F.concat_ws(" · ", F.col("blood_bank_id").cast("string"), "blood_group"), "component_type")
    ordered = latest_first(rows, [F.desc("average_daily_demand"), F.desc("total_units_issued"), *KEY], n)
    return ordered.select(line.alias("inventory_line"), *KEY, "average_daily_demand")


def recent_transfers(flagged: DataFrame, n: int = 25) -> DataFrame:
    columns = ["transfer_id", "source_bank_id", "destination_bank_id", "blood_group", "component_type", "units",
               "transfer_date", "status"]
    order = [F.desc("transfer_date"), *[F.col(c) for c in columns if c != "transfer_date"]]
    return latest_first(flagged.where("is_valid").select(*columns), order, n)


def live_feed(events: DataFrame, policy: Policy, n: int = 25) -> DataFrame:
    """Latest events with the watch-list tag and the wall time of the event."""
    columns = ["donation_id", "blood_group", "blood_bank_id", "units_donated", "donation_status", "event_time"]
    recent = latest_first(events.select(*columns), [F.desc_nulls_last("event_time"), F.col("donation_id")], n)
    return recent.withColumns({
        "is_rare": F.col("blood_group").isin(*policy.watch_list),
        "event_clock": F.date_format("event_time", "HH:mm:ss"),
    })


def first_ingested(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Preview in order of arrival."""
    return latest_first(df, [F.asc("_ingested_at"), F.col(key)], n)


def urgent_alerts(state: DataFrame) -> DataFrame:
    """EMERGENCY and CRITICAL lines, worst first, with coverage as text."""
    coverage = F.coalesce(F.format_string("%.1f", "coverage_days"), F.lit("No demand data"))
    shown = F.when(F.col("coverage_days").isNull(), F.lit("No demand data")).otherwise(coverage)
    return state.where(F.col("priority_level").isin("EMERGENCY", "CRITICAL")).select(
        "blood_group", "component_type", "blood_bank_id", "available_units", shown.alias("coverage_display"),
        "shortage_score", "priority_level", "recommended_action",
    ).orderBy(F.desc("shortage_score"), *KEY)


def shortage_alerts(summary: DataFrame) -> DataFrame:
    message = text.shortage_message(F.col("blood_group"), F.col("total_available_units"), F.col("availability_status"))
    return summary.select("blood_group", message.alias("alert")).where(F.col("alert").isNotNull())


def monthly_labels(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "year", "month", text.month_label(F.col("month_name"), F.col("year")).alias("period"), "total_units_donated"
    )


def watch_state_totals(state: DataFrame, policy: Policy) -> DataFrame:
    """Watch-listed stock lines, and how many of them are urgent."""
    urgent = F.col("priority_level").isin("EMERGENCY", "CRITICAL")
    return watched(state, policy).agg(F.count(F.lit(1)).alias("watch_lines"), F.count_if(urgent).alias("urgent_watch_lines"))


def run_totals(summary: DataFrame, bank_rows: DataFrame) -> DataFrame:
    """Per watch-listed group: units, label and banks that hold it."""
    holding = bank_rows.where(F.col("available_units") > 0).groupBy(F.col("blood_group").alias("_group")).agg(
        F.count_distinct("blood_bank_id").alias("banks_holding")
    )
    return summary.join(holding, F.col("blood_group") == F.col("_group"), "left").select(
        "blood_group", "total_available_units", "availability_status",
        F.coalesce("banks_holding", F.lit(0)).alias("banks_holding"),
    )
