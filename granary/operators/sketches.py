"""Daily sketches that are merged for any period: distinct donors, donors of two periods, quantiles of units.

A sketch has a fixed size whatever it has seen, so a month is merged from its days without reading a donation
again, and days that arrive later are merged in. Errors are stated with the result: every report has the
exact figure beside the estimate's deviation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Registers of the distinct sketch, entries of the set sketch (powers of two), accuracy of the quantile sketch.
HLL_BITS, THETA_BITS, KLL_K = 14, 14, 400
# Deviations that the sizes above keep: relative for counts, in ranks for quantiles.
COUNT_ERROR, RANK_ERROR = 0.05, 0.02


def daily_sketches(donations: DataFrame) -> DataFrame:
    """(donation_date, blood_group, donors_hll, donors_theta, units_kll): one row per day and group."""
    return donations.where(F.col("donation_date").isNotNull()).groupBy("donation_date", "blood_group").agg(
        F.hll_sketch_agg("donor_id", F.lit(HLL_BITS)).alias("donors_hll"), F.theta_sketch_agg("donor_id", THETA_BITS).alias("donors_theta"),
        F.kll_sketch_agg_bigint(F.col("units_donated").cast("bigint"), KLL_K).alias("units_kll"))


def merged(sketches: DataFrame, *period: Column) -> DataFrame:
    """Sketches of longer periods from those of days; ``period`` are the grouping columns."""
    return sketches.groupBy(*period).agg(
        F.hll_union_agg("donors_hll").alias("donors_hll"), F.theta_union_agg("donors_theta", THETA_BITS).alias("donors_theta"),
        F.kll_merge_agg_bigint("units_kll", KLL_K).alias("units_kll"))


def estimates(sketches: DataFrame) -> DataFrame:
    """Sketches replaced by what they say: distinct donors twice, median and number of units' values."""
    kept = [c for c in sketches.columns if c not in ("donors_hll", "donors_theta", "units_kll")]
    return sketches.select(
        *kept, F.hll_sketch_estimate("donors_hll").alias("donors_by_hll"), F.theta_sketch_estimate("donors_theta").alias("donors_by_theta"),
        F.kll_sketch_get_quantile_bigint("units_kll", F.lit(0.5)).alias("median_units"), F.kll_sketch_get_n_bigint("units_kll").alias("values"))


def returning_donors(sketches: DataFrame) -> DataFrame:
    """(month, blood_group, returning): donors of a month who also gave in the month before, by intersecting sets."""
    month = F.trunc("donation_date", "month")
    own = merged(sketches, month.alias("month"), F.col("blood_group")).select("month", "blood_group", F.col("donors_theta").alias("_now"))
    before = own.select(F.add_months("month", 1).alias("_month"), F.col("blood_group").alias("_group"), F.col("_now").alias("_then"))
    met = own.join(before, (F.col("month") == F.col("_month")) & F.col("blood_group").eqNullSafe(F.col("_group")))
    return met.select("month", "blood_group", F.theta_sketch_estimate(F.theta_intersection("_now", "_then")).alias("returning"))


def near(estimate: Column, exact: Column) -> Column:
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), COUNT_ERROR * exact)


def monthly_report(donations: DataFrame, sketches: DataFrame) -> DataFrame:
    """Per month and group the exact figures, and whether those of merged daily sketches are within their error.

    Donors fold to one row per month, group and donor before they are counted; the median is close if at most
    half and RANK_ERROR of the values lie below it, and at least half less RANK_ERROR are not above it.
    """
    month = F.trunc("donation_date", "month").alias("month")
    dated = donations.where(F.col("donation_date").isNotNull())
    folded = dated.groupBy(month, "blood_group", "donor_id").agg(F.count("units_donated").alias("_n"))
    donors = folded.groupBy("month", "blood_group").agg(F.count("donor_id").alias("donors"), F.sum("_n").alias("donated_values"))
    named = {c: f"_{c}" for c in ("month", "blood_group")}
    same = (F.col("month") == F.col("_month")) & F.col("blood_group").eqNullSafe(F.col("_blood_group"))
    said = estimates(merged(sketches, month, F.col("blood_group"))).withColumnsRenamed(named)
    joined = donors.join(said, same).drop("_month", "_blood_group")
    values = dated.groupBy(month, "blood_group", "units_donated").agg(F.count("units_donated").alias("_n")).withColumnsRenamed(named)
    ranked = joined.join(values, same).groupBy(*joined.columns).agg(
        F.sum(F.when(F.col("units_donated") < F.col("median_units"), F.col("_n")).otherwise(0)).alias("_below"),
        F.sum(F.when(F.col("units_donated") <= F.col("median_units"), F.col("_n")).otherwise(0)).alias("_up_to"))
    half, slack = F.col("donated_values") * 0.5, F.col("donated_values") * RANK_ERROR + 1
    return ranked.select(
        "month", "blood_group", "donors", "donated_values", near(F.col("donors_by_hll"), F.col("donors")).alias("hll_near"),
        near(F.col("donors_by_theta"), F.col("donors")).alias("theta_near"), (F.col("values") == F.col("donated_values")).alias("all_values_seen"),
        ((F.col("_below") <= half + slack) & (F.col("_up_to") >= half - slack)).alias("median_near"))
