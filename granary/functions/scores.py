"""Priority, severity, freshness, coverage and shortage scores as pure expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.bands import first_match, label, translate
from granary.policy import Policy


def tier_priority(status: Column, centers: Column, policy: Policy) -> Column:
    """Base points of the tier less one point per stocked center, capped, never below zero."""
    discount = F.least(centers, F.lit(policy.spread_discount_cap))
    return F.greatest(translate(status, policy.tier_priority) - discount, F.lit(0)).cast("int")


def signed_units(movement: Column, units: Column, policy: Policy) -> Column:
    """Inflows add; every other movement, known or not, subtracts."""
    inflow = F.coalesce(movement.isin(*policy.inflow_types), F.lit(False))
    return units * F.when(inflow, F.lit(1)).otherwise(F.lit(-1))


def freshness(component: Column, last_donation: Column, policy: Policy) -> Column:
    """EXPIRED / EXPIRING_SOON / VALID from the days left on the latest donation."""
    age = F.datediff(F.lit(policy.as_of), F.to_date(last_donation))
    days_left = translate(component, policy.shelf_days) - age
    return first_match(
        days_left, (("<=", 0, "EXPIRED"), ("<=", policy.expiring_soon_days, "EXPIRING_SOON")), "VALID"
    )


def coverage_days(units: Column, daily: Column, policy: Policy) -> Column:
    """Days the stock lasts; NULL when there is no recorded demand."""
    rate = F.greatest(daily, F.lit(policy.demand_floor))
    return F.when(daily > 0, F.round(units / rate, 1))


def stock_points(units: Column, policy: Policy) -> Column:
    return first_match(units, policy.stock_points, policy.calm_points)


def coverage_points(has_demand: Column, coverage: Column, policy: Policy) -> Column:
    scored = first_match(coverage, policy.coverage_points, policy.calm_points)
    return F.when(has_demand, scored).otherwise(F.lit(policy.unknown_demand_points))


def expiry_points(status: Column, policy: Policy) -> Column:
    return F.coalesce(translate(status, policy.expiry_points), F.lit(0))


def trend_points(recent: Column, prior: Column) -> Column:
    """Falling or absent inflow raises urgency; no earlier baseline is neutral."""
    ratio = F.try_divide(recent, prior)
    # Points per trend.
    return (
        F.when(recent == 0, F.lit(100))
        .when(prior == 0, F.lit(50))
        .when(ratio >= 1.0, F.lit(0))
        .when(ratio >= 0.5, F.lit(30))
        .otherwise(F.lit(70))
    )


def shortage_score(stock: Column, coverage: Column, expiry: Column, trend: Column, policy: Policy) -> Column:
    w = policy.weights
    total = (
        stock * F.lit(w["stock"]) + coverage * F.lit(w["coverage"])
        + expiry * F.lit(w["expiry"]) + trend * F.lit(w["trend"])
    )
    return F.greatest(F.lit(0), F.least(F.lit(100), F.round(total).cast("int")))


def priority_level(score: Column, policy: Policy) -> Column:
    return label(score, policy.priority_bands)


def shelf_end(component: Column, oldest: Column, policy: Policy) -> Column:
    return F.date_add(F.to_date(oldest), translate(component, policy.shelf_days))


def severity(status: Column, policy: Policy) -> Column:
    return translate(status, policy.severity)
