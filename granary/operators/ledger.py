"""Stock, demand and shortage derived from a signed movement ledger.

Input contract: ``ledger(transaction_id, blood_bank_id, blood_group, component_type,
transaction_type, units, transaction_timestamp, source_donation_id, source_transfer_id,
destination_bank_id, status, issue_id)``.

All per-key measures come from one grouped aggregate, so the ledger is shuffled once and a hot
key is combined on the map side. Ledger-wide bounds are scalar subqueries (one row by
construction), not driver round trips.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions import scores
from granary.functions.bands import translate
from granary.operators import timeline
from granary.operators.keyed import side_by_side
from granary.policy import Policy

KEY = ["blood_bank_id", "blood_group", "component_type"]
_TYPE = "transaction_type"
_AT = "transaction_timestamp"


def _of(movement: str, value: Column) -> Column:
    return F.when(F.col(_TYPE) == movement, value)


def _balance(policy: Policy) -> Column:
    signed = scores.signed_units(F.col(_TYPE), F.col("units"), policy)
    return F.round(F.sum(signed)).cast("bigint")


def _expired() -> Column:
    return F.sum(F.coalesce(_of("EXPIRY", F.col("units")), F.lit(0.0)))


def bounds(ledger: DataFrame) -> DataFrame:
    """One row: latest movement and the number of days the issues span (at least 1)."""
    issued_at = _of("ISSUE", F.col(_AT))
    elapsed = F.timestamp_diff("DAY", F.min(issued_at), F.max(issued_at)) + 1
    return ledger.agg(
        F.max(_AT).alias("latest"),
        F.greatest(elapsed, F.lit(1)).cast("int").alias("issue_days"),
    )


def _bound(ledger: DataFrame, name: str) -> Column:
    return bounds(ledger).select(name).scalar()


def balances(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Signed stock per key with its last movement, last donation and lifetime expired units."""
    return ledger.groupBy(*KEY).agg(
        _balance(policy).alias("available_units"),
        F.max(_AT).alias("last_updated"),
        F.max(_of("DONATION", F.col(_AT))).alias("last_donation_at"),
        _expired().alias("lifetime_expired_units"),
    )


def with_freshness(lines: DataFrame, policy: Policy) -> DataFrame:
    status = scores.freshness(F.col("component_type"), F.col("last_donation_at"), policy)
    return lines.withColumn("expiry_status", status)


def _rates(total: Column, days: Column) -> dict[str, Column]:
    """Daily rate at three decimals; weekly and monthly are multiples of the rounded daily rate."""
    daily = F.round(total / days, 3)
    return {
        "average_daily_demand": daily,
        "average_weekly_demand": F.round(daily * 7, 2),
        "average_monthly_demand": F.round(daily * 30, 2),
    }


def demand(ledger: DataFrame) -> DataFrame:
    """Issued units per key over one shared observation window; keys never issued are absent."""
    issued = ledger.where(F.col(_TYPE) == "ISSUE").groupBy(*KEY).agg(
        F.sum("units").alias("total_units_issued"), F.count("transaction_id").alias("issue_event_count"),
    )
    dated = issued.withColumn("observation_window_days", _bound(ledger, "issue_days"))
    return dated.withColumns(_rates(F.col("total_units_issued"), F.col("observation_window_days")))


def key_measures(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Everything the shortage model needs per key, from one pass over the ledger."""
    latest = _bound(ledger, "latest")
    step = F.make_interval(days=F.lit(policy.trend_days))
    recent_from, prior_from = latest - step, latest - step - step
    at, units = F.col(_AT), F.col("units")
    donated = lambda inside: F.coalesce(F.sum(_of("DONATION", F.when(inside, units))), F.lit(0.0))
    return ledger.groupBy(*KEY).agg(
        _balance(policy).alias("available_units"),
        F.max(_AT).alias("last_updated"),
        F.max(_of("DONATION", at)).alias("last_donation_at"),
        _expired().alias("lifetime_expired_units"),
        F.sum(_of("ISSUE", units)).alias("_issued"),
        donated(at >= recent_from).alias("recent_donation_units"),
        donated((at < recent_from) & (at >= prior_from)).alias("prior_donation_units"),
    )


def with_coverage(lines: DataFrame, ledger: DataFrame, policy: Policy) -> DataFrame:
    """Demand rates, whether any demand is known, and how many days the stock lasts."""
    rates = _rates(F.col("_issued"), _bound(ledger, "issue_days"))
    rated = lines.withColumns(rates).withColumn("average_daily_demand", F.coalesce("average_daily_demand", F.lit(0.0)))
    daily = F.col("average_daily_demand")
    return rated.withColumns({
        "has_demand_data": daily > 0,
        "coverage_days": scores.coverage_days(F.col("available_units"), daily, policy),
    }).drop("_issued")


def with_trend(lines: DataFrame) -> DataFrame:
    points = scores.trend_points(F.col("recent_donation_units"), F.col("prior_donation_units"))
    return lines.withColumn("donation_trend_sub_score", points)


def with_shortage(lines: DataFrame, policy: Policy) -> DataFrame:
    """Sub-scores, the weighted 0-100 score, its band and the action for that band."""
    scored = lines.withColumns({
        "inventory_level_sub_score": scores.stock_points(F.col("available_units"), policy),
        "coverage_sub_score": scores.coverage_points(F.col("has_demand_data"), F.col("coverage_days"), policy),
        "expiry_sub_score": scores.expiry_points(F.col("expiry_status"), policy),
    })
    total = scores.shortage_score(
        F.col("inventory_level_sub_score"), F.col("coverage_sub_score"),
        F.col("expiry_sub_score"), F.col("donation_trend_sub_score"), policy,
    )
    banded = scored.withColumn("shortage_score", total).withColumn(
        "priority_level", scores.priority_level(F.col("shortage_score"), policy)
    )
    return banded.withColumn("recommended_action", translate(F.col("priority_level"), policy.priority_actions))


# Published column order.
STATE_COLUMNS = [
    *KEY, "available_units", "expiry_status", "lifetime_expired_units", "has_demand_data",
    "average_daily_demand", "average_weekly_demand", "average_monthly_demand", "coverage_days",
    "inventory_level_sub_score", "coverage_sub_score", "expiry_sub_score", "donation_trend_sub_score",
    "shortage_score", "priority_level", "recommended_action", "last_updated",
]


def stock_state(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Current stock, freshness, demand, coverage, trend and shortage score per key."""
    return (
        key_measures(ledger, policy)
        .transform(with_freshness, policy)
        .transform(with_coverage, ledger, policy)
        .transform(with_trend)
        .transform(with_shortage, policy)
        .select(*STATE_COLUMNS)
    )


# ---- reconciliation --------------------------------------------------------------------------

def balances_by_type(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Balances recomputed another way: units per key and movement type first, signs applied after."""
    per_type = ledger.groupBy(*KEY, _TYPE).agg(F.sum("units").alias("moved"))
    inflow = F.col(_TYPE).isin(*policy.inflow_types)
    came_in = F.sum(F.when(inflow, F.col("moved")).otherwise(0.0))
    went_out = F.sum(F.when(F.coalesce(inflow, F.lit(False)), 0.0).otherwise(F.col("moved")))
    return per_type.groupBy(*KEY).agg(F.round(came_in - went_out).cast("bigint").alias("recomputed_units"))


def reconcile(published: DataFrame, ledger: DataFrame, policy: Policy) -> DataFrame:
    """Published units against recomputed units for every key on either side."""
    compared = side_by_side(published, balances_by_type(ledger, policy), KEY, {"available_units": "recomputed_units"})
    ours, theirs = F.col("left_available_units"), F.col("right_available_units")
    status = (
        F.when(~F.col("in_left"), "NOT_PUBLISHED").when(~F.col("in_right"), "NOT_IN_LEDGER")
        .when(ours.eqNullSafe(theirs), "MATCH").otherwise("MISMATCH")
    )
    return compared.select(
        *KEY, ours.alias("available_units"), theirs.alias("recomputed_units"), status.alias("reconciliation_status")
    )


# ---- derived postings and snapshots ----------------------------------------------------------

def closing_snapshot(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Stock per key floored at zero, its freshness and its last movement."""
    return balances(ledger, policy).transform(with_freshness, policy).select(
        *KEY, F.greatest(F.col("available_units"), F.lit(0)).alias("available_units"),
        "expiry_status", F.col("last_updated").alias("last_transaction_at"),
    )


def expiry_candidates(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Keys with stock whose oldest donation has outlived the component's shelf life."""
    oldest = ledger.groupBy(*KEY).agg(
        _balance(policy).alias("available_units"), F.to_date(F.min(_of("DONATION", F.col(_AT)))).alias("oldest_donation"),
    )
    ends = scores.shelf_end(F.col("component_type"), F.col("oldest_donation"), policy)
    return oldest.where(F.col("available_units") > 0).withColumn("expiry_date", ends).where(
        F.col("expiry_date") <= F.lit(policy.as_of)
    )


def post_donations(donations: DataFrame, policy: Policy) -> DataFrame:
    """Completed donations as DONATION postings, one per component they are split into.

    Platelets are drawn from about half of the donations, chosen by a stable digest of the
    donation id. Expects deduplicated donations, so nothing is posted twice.
    """
    digest = F.conv(F.substring(F.md5(F.col("donation_id").cast("string")), 1, 4), 16, 10).cast("int")
    split = [
        F.when((F.lit(c != "Platelets")) | (digest < 32768), F.lit(c)) for c in policy.components
    ]
    posted = donations.where(F.col("donation_status") == policy.counted_status).withColumn(
        "component_type", F.explode(F.array_compact(F.array(*split)))
    )
    return posted.select(
        F.concat_ws("-", F.lit("D"), F.col("donation_id").cast("string"), "component_type").alias("transaction_id"),
        *KEY, F.lit("DONATION").alias(_TYPE), F.col("units_donated").cast("double").alias("units"),
        F.col("donation_date").cast("timestamp_ntz").alias(_AT),
        F.col("donation_id").alias("source_donation_id"), F.lit("POSTED").alias("status"),
    )


def post_issues(issues: DataFrame) -> DataFrame:
    """Issue list ``(issue_id, KEY, units, issue_date, hospital_id)`` as ISSUE postings."""
    return issues.select(
        F.concat_ws("-", F.lit("I"), F.col("issue_id").cast("string")).alias("transaction_id"),
        *KEY, F.lit("ISSUE").alias(_TYPE), F.col("units").cast("double").alias("units"),
        F.col("issue_date").cast("timestamp_ntz").alias(_AT), F.lit("POSTED").alias("status"),
        "issue_id", "hospital_id",
    )


def issue_list(ledger: DataFrame) -> DataFrame:
    """ISSUE movements back as an issue list."""
    return ledger.where(F.col(_TYPE) == "ISSUE").select(
        "issue_id", *KEY, "units", F.to_date(_AT).alias("issue_date")
    )


def running_balance(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Balance after every movement of a key, flagged where it falls below zero.

    One key, even on one day, may hold most of the ledger: see ``timeline.running_sum``. Movements that agree in
    everything shown follow each other in any order.
    """
    signed = ledger.select(
        *KEY, F.col(_AT), F.col("transaction_id"), F.col(_TYPE), F.col("units"), scores.signed_units(F.col(_TYPE), F.col("units"), policy).alias("_signed"),
    )
    summed = timeline.running_sum(signed, KEY, [_AT, "transaction_id", _TYPE, "units"], "_signed", "running_balance")
    return summed.select(
        *KEY, _AT, "transaction_id", _TYPE, "units", "running_balance",
        (F.col("running_balance") < 0).alias("below_zero"),
    )


def closing_by_day(ledger: DataFrame, keys: Sequence[str], policy: Policy) -> DataFrame:
    """Balance at the end of every day on which a key moved. Movements fold to days before they are shuffled."""
    signed = scores.signed_units(F.col(_TYPE), F.col("units"), policy)
    moved = ledger.groupBy(*keys, F.to_date(_AT).alias("day")).agg(F.sum(signed).alias("_moved"))
    so_far = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return moved.select(*keys, "day", F.sum("_moved").over(so_far).alias("balance"))


def lots(ledger: DataFrame, policy: Policy) -> DataFrame:
    """Donated units as lots with the days (as numbers) on which they may be issued, the last one included."""
    day = F.unix_date(F.to_date(_AT))
    shelf = translate(F.col("component_type"), policy.shelf_days)
    return ledger.where(F.col(_TYPE) == "DONATION").select(
        *KEY, F.col("transaction_id").alias("lot_id"), F.col("units").alias("lot_units"), day.alias("fresh_from"), (day + shelf).alias("fresh_until"))


def lots_at_issue(ledger: DataFrame, policy: Policy) -> DataFrame:
    """For every issue the lots of its key that were fresh on its day: how many, how many units, the oldest."""
    issues = ledger.where(F.col(_TYPE) == "ISSUE").select(*KEY, "transaction_id", F.unix_date(F.to_date(_AT)).alias("_day"))
    met = timeline.within_intervals(issues, lots(ledger, policy), KEY, "_day", "fresh_from", "fresh_until")
    return met.groupBy("transaction_id", *KEY, "_day").agg(
        F.count(F.lit(1)).alias("fresh_lots"), F.sum("lot_units").alias("fresh_units"), F.min("fresh_from").alias("_oldest")).select(
        "transaction_id", *KEY, F.date_from_unix_date("_day").alias("issue_date"), "fresh_lots", "fresh_units", F.date_from_unix_date("_oldest").alias("oldest_lot"))
