"""Data-quality and reconciliation checks. Every check returns rows, never raises on bad data.

Row shape: ``section, check_name, status (PASS / FAIL / SKIPPED), value, detail``. The counters of
one frame come from a single aggregate over it.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.bands import label
from granary.operators import keyed
from granary.operators.ledger import KEY, reconcile
from granary.operators.transfers import paired_legs
from granary.policy import Policy, Scale
from granary.sources import files, schemas

SHAPE = "section string, check_name string, status string, value bigint, detail string"

# How a counter turns into a status.
_RULES = {
    "zero": lambda v: F.coalesce(v == 0, F.lit(False)),
    "positive": lambda v: F.coalesce(v > 0, F.lit(False)),
    "report": lambda v: F.lit(True),
}


def _check(section: str, name: str, passed: Column, value: Column, detail: Column | None = None) -> Column:
    return F.struct(
        F.lit(section).alias("section"), F.lit(name).alias("check_name"),
        F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        value.cast("bigint").alias("value"),
        (F.lit(None).cast("string") if detail is None else detail).alias("detail"),
    )


def from_counters(section: str, counters: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One-row counters as check rows; ``rules`` says per counter what it must be."""
    rows = [_check(section, name, _RULES[rule](F.col(name)), F.col(name)) for name, rule in rules.items()]
    return counters.select(F.inline(F.array(*rows)))


def stated(spark: SparkSession, section: str, name: str, status: str, detail: str | None = None) -> DataFrame:
    """A check whose outcome is known without data, such as an absent table."""
    return spark.createDataFrame([(section, name, status, None, detail)], SHAPE)


def combined(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _count(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def _outside(column: str, allowed: Sequence) -> Column:
    """Not in the set; a NULL is not counted here."""
    return ~F.col(column).isin(*allowed)


def _beside(counters: DataFrame, **others: DataFrame) -> DataFrame:
    """Further one-value frames as columns of a one-row frame."""
    return counters.select("*", *[df.scalar().alias(name) for name, df in others.items()])


def _duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return keyed.duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("n"))


# ---- presence and ingest ---------------------------------------------------------------------

def table_present(spark: SparkSession, section: str, name: str, path: str, columns: Sequence[str],
                  not_null: Sequence[str] = ()) -> DataFrame:
    """Readable, with its columns, at least one row, and lineage filled in."""
    df = files.read_optional(spark, path)
    if df is None:
        return stated(spark, section, name, "FAIL", "not found or unreadable")
    absent = sorted((set(columns) | set(not_null)) - set(df.columns))
    if absent:
        return stated(spark, section, name, "FAIL", f"missing columns: {', '.join(absent)}")
    counters = df.agg(F.count(F.lit(1)).alias("rows"), *[_count(F.col(c).isNull(), f"null{c}") for c in not_null])
    named = counters.toDF(*[f"{name}.{c}" for c in counters.columns])
    rules = {c: ("positive" if c.endswith(".rows") else "zero") for c in named.columns}
    rows = [
        _check(section, c, _RULES[rule](F.col(f"`{c}`")), F.col(f"`{c}`")) for c, rule in rules.items()
    ]
    return named.select(F.inline(F.array(*rows)))


def ingest_round_trip(counts: DataFrame) -> DataFrame:
    """``files.ingest`` counts: something was stored, and as much as was read."""
    name = F.concat(F.col("table_name"), F.lit(".round_trip"))
    ok = (F.col("stored_rows") > 0) & (F.col("raw_rows") == F.col("stored_rows"))
    return counts.select(
        F.lit("ingest").alias("section"), name.alias("check_name"),
        F.when(ok, "PASS").otherwise("FAIL").alias("status"), F.col("stored_rows").alias("value"),
        F.concat(F.lit("raw rows: "), F.col("raw_rows").cast("string")).alias("detail"),
    )


# ---- single-frame rules ----------------------------------------------------------------------

def unique(df: DataFrame, keys: Sequence[str], name: str, section: str = "duplicates") -> DataFrame:
    return from_counters(section, _duplicate_keys(df, keys).toDF(name), {name: "zero"})


def complete(df: DataFrame, columns: Sequence[str], name: str, section: str = "missing_values") -> DataFrame:
    """NULL count per column; a column that does not exist fails."""
    here = [c for c in columns if c in df.columns]
    counters = df.agg(*[_count(F.col(c).isNull(), c) for c in here])
    rows = [_check(section, f"{name}.{c}", F.col(c) == 0, F.col(c)) for c in here]
    found = counters.select(F.inline(F.array(*rows))) if here else None
    absent = [stated(df.sparkSession, section, f"{name}.{c}", "FAIL", "column not found") for c in columns if c not in here]
    return combined(([found] if found is not None else []) + absent)


def allowed(df: DataFrame, column: str, values: Sequence, name: str, section: str = "allowed_values",
            samples: int = 10) -> DataFrame:
    """Rows outside the vocabulary or NULL, with up to ``samples`` of the offending values in order."""
    bad = keyed.invalid_values(df, column, values)
    shown = bad.select(F.coalesce(F.col(column).cast("string"), F.lit("NULL")).alias("v")).orderBy("v").limit(samples)
    sample = shown.agg(F.array_join(F.sort_array(F.collect_list("v")), ", ").alias("s"))
    total = bad.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n"))
    detail = F.nullif(sample.scalar(), F.lit(""))
    return total.select(F.inline(F.array(_check(section, name, F.col("n") == 0, F.col("n"), detail))))


def quantities(donations: DataFrame, policy: Policy) -> DataFrame:
    units = F.col("units_donated")
    counters = donations.agg(
        _count(units.isNull(), "null_units"), _count(units == 0, "zero_units"), _count(units < 0, "negative_units"),
        _count(units > policy.units_range[1], "unusually_large_units"),
    )
    return from_counters("quantities", counters, {
        "null_units": "zero", "zero_units": "zero", "negative_units": "zero", "unusually_large_units": "report",
    })


def donor_rules(donors: DataFrame, policy: Policy) -> DataFrame:
    counters = donors.agg(
        _count(~F.coalesce(F.col("age").between(*policy.age_range), F.lit(False)), "age_out_of_range"),
        _count(_outside("eligibility_status", policy.eligibility), "unknown_eligibility"),
        _count(~F.coalesce(F.col("blood_group").isin(*policy.groups), F.lit(False)), "invalid_group"),
        _count(F.col("last_donation_date") < F.col("registration_date"), "donated_before_registration"),
    )
    return from_counters("donors", counters, dict.fromkeys(counters.columns, "zero"))


def display_rows(bank_rows: DataFrame, policy: Policy) -> DataFrame:
    """The published bank table as it is: how much of it a display shows, and what no row may lack.

    Rows outside the watch list, below zero or without a bank, group or count are faults of the table,
    whether a display would filter them away or not; rows without stock are only reported.
    """
    units, listed = F.col("available_units"), F.coalesce(F.col("blood_group").isin(*policy.watch_list), F.lit(False))
    counters = bank_rows.agg(
        _count(listed & (units > 0), "displayed_rows"), _count(units == 0, "not_in_stock"),
        _count(F.coalesce(units < 0, F.lit(True)), "bad_units"), _count(~listed & F.col("blood_group").isNotNull(), "off_list"),
        _count(F.col("blood_bank_id").isNull(), "null_bank"), _count(F.col("blood_group").isNull(), "null_group"),
    )
    return from_counters("display", counters, {
        "displayed_rows": "report", "not_in_stock": "report", "bad_units": "zero", "off_list": "zero", "null_bank": "zero", "null_group": "zero",
    })


# ---- rules over several frames ---------------------------------------------------------------

def foreign_keys(donations: DataFrame, donors: DataFrame, banks: DataFrame, camps: DataFrame,
                 inventory: DataFrame) -> DataFrame:
    first = keyed.orphan_total(donations, "donor_id", donors, "donor_id").toDF("donor")
    counters = _beside(
        first,
        bank=keyed.orphan_total(donations, "blood_bank_id", banks, "blood_bank_id"),
        camp=keyed.orphan_total(donations, "camp_id", camps, "camp_id", allow_null=True),
        inventory_bank=keyed.orphan_total(inventory, "blood_bank_id", banks, "blood_bank_id"),
    )
    return from_counters("foreign_keys", counters, dict.fromkeys(counters.columns, "zero"))


def enrichment(donations: DataFrame, enriched: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Ids stay unique, enrichment neither loses nor multiplies rows, required columns exist."""
    absent = [c for c in required if c not in donations.columns]
    if absent:
        return stated(donations.sparkSession, "clean_layer", "required_columns", "FAIL", ", ".join(absent))
    counters = _beside(
        donations.agg(F.count(F.lit(1)).alias("donations")),
        enriched_rows=enriched.agg(F.count(F.lit(1)).alias("n")),
        duplicate_ids=_duplicate_keys(donations, ["donation_id"]),
    ).select("*", (F.col("enriched_rows") - F.col("donations")).alias("row_change"))
    return from_counters("clean_layer", counters, {
        "donations": "positive", "enriched_rows": "report", "duplicate_ids": "zero", "row_change": "zero",
    })


def inventory_consistency(inventory: DataFrame, banks: DataFrame) -> DataFrame:
    units = F.col("available_units")
    counters = _beside(
        inventory.agg(_count(units < 0, "negative_units"), F.coalesce(F.sum(units), F.lit(0)).alias("total_units")),
        orphan_banks=keyed.orphan_total(inventory, "blood_bank_id", banks, "blood_bank_id"),
    )
    return from_counters("inventory", counters, {"negative_units": "zero", "orphan_banks": "zero", "total_units": "report"})


def stock_precheck(inventory: DataFrame, banks: DataFrame, policy: Policy) -> DataFrame:
    """One row of counters on the stock lines an availability run is about to use."""
    units = F.col("available_units")
    counters = inventory.agg(
        F.count(F.lit(1)).alias("total_records"),
        _count(_outside("blood_group", policy.groups), "invalid_blood_groups"),
        _count(units < 0, "negative_units"),
        _count(F.col("blood_bank_id").isNull(), "null_blood_bank_id"),
        _count(F.col("blood_group").isNull(), "null_blood_group"),
        _count(units.isNull(), "null_available_units"),
        _count(F.col("last_updated").isNull(), "null_last_updated"),
        _count(units.isNotNull() & units.try_cast("int").isNull(), "non_numeric_units"),
    )
    return _beside(
        counters,
        missing_bank_matches=keyed.orphan_total(inventory, "blood_bank_id", banks, "blood_bank_id"),
        duplicate_logical_keys=_duplicate_keys(inventory, ["blood_bank_id", "blood_group"]),
    )


def publish_precheck(donors: DataFrame, banks: DataFrame, inventory: DataFrame, donations: DataFrame,
                     policy: Policy) -> DataFrame:
    """One row of counters on the frames the published tables are built from."""
    units, given = F.col("available_units"), F.col("units_donated")
    counters = inventory.agg(
        _count(F.col("blood_bank_id").isNull(), "null_bank_id"),
        _count(F.col("blood_group").isNull(), "null_group"),
        _count(units.isNull(), "null_units"), _count(units < 0, "negative_units"),
        _count(_outside("blood_group", policy.groups), "invalid_inventory_groups"),
    )
    gifts = donations.agg(F.struct(
        _count(F.col("donation_date").isNull(), "no_date"),
        _count(F.coalesce(given <= 0, F.lit(True)), "no_units"),
        _count(_outside("blood_group", policy.groups), "bad_group"),
    ).alias("g")).scalar()
    with_gifts = counters.select(
        "*", gifts.getField("no_date").alias("null_donation_date"),
        gifts.getField("no_units").alias("non_positive_units_donated"),
        gifts.getField("bad_group").alias("invalid_donation_groups"),
    )
    return _beside(
        with_gifts,
        duplicate_donation_ids=_duplicate_keys(donations, ["donation_id"]),
        duplicate_donor_ids=_duplicate_keys(donors, ["donor_id"]),
        duplicate_bank_ids=_duplicate_keys(banks, ["blood_bank_id"]),
        duplicate_inventory_ids=_duplicate_keys(inventory, ["inventory_id"]),
    )


def published_totals(donations: DataFrame, inventory: DataFrame, shares: DataFrame, summary: DataFrame,
                     policy: Policy) -> DataFrame:
    """Published tables against the clean layer: completed units, and stock per watch-listed group."""
    total = lambda df, c: df.agg(F.coalesce(F.sum(c), F.lit(0)).alias("total"))
    done = donations.where(F.col("donation_status") == policy.counted_status)
    units = keyed.side_by_side(
        total(done, "units_donated").select(F.lit("completed_units").alias("item"), "total"),
        total(shares, "total_units_donated").select(F.lit("completed_units").alias("item"), F.col("total").alias("published")),
        ["item"], {"total": "published"},
    )
    held = inventory.where(F.col("blood_group").isin(*policy.watch_list)).groupBy(
        F.concat(F.lit("stock "), F.col("blood_group")).alias("item")
    ).agg(F.coalesce(F.sum("available_units"), F.lit(0)).alias("total"))
    shown = summary.select(
        F.concat(F.lit("stock "), F.col("blood_group")).alias("item"), F.col("total_available_units").alias("published")
    )
    stock = keyed.side_by_side(held, shown, ["item"], {"total": "published"})
    return units.unionByName(stock).select(
        F.lit("published_totals").alias("section"), F.col("item").alias("check_name"),
        F.when(F.col("left_total").eqNullSafe(F.col("right_total")), "PASS").otherwise("FAIL").alias("status"),
        F.col("left_total").alias("value"),
        F.concat(F.lit("published: "), F.coalesce(F.col("right_total").cast("string"), F.lit("none"))).alias("detail"),
    )


def distribution_rules(shares: DataFrame, summary: DataFrame, policy: Policy) -> DataFrame:
    """Shares add up to about 100, and no watch-listed group is absent from the summary."""
    groups = summary.sparkSession.createDataFrame([(g,) for g in policy.watch_list], "blood_group string")
    absent = keyed.missing_keys(groups, summary, ["blood_group"]).agg(F.count(F.lit(1)).alias("n"))
    counters = _beside(
        shares.agg((~F.coalesce(F.sum("percentage_of_total").between(99, 101), F.lit(False))).cast("int").alias("share_off")),
        absent_groups=absent,
    )
    return from_counters("distribution", counters, {"share_off": "zero", "absent_groups": "zero"})


# ---- ledger ----------------------------------------------------------------------------------

def ledger_invariants(ledger: DataFrame, policy: Policy) -> DataFrame:
    kind = F.col("transaction_type")
    present = [
        (~F.coalesce(F.bool_or(kind == t), F.lit(False))).cast("int") for t in policy.movement_types
    ]
    counters = ledger.agg(
        F.count(F.lit(1)).alias("movements"),
        _count(~F.coalesce(kind.isin(*policy.movement_types), F.lit(False)), "unknown_types"),
        reduce(lambda a, b: a + b, present).alias("types_never_used"),
        _count((kind != "ADJUSTMENT") & ~F.coalesce(F.col("units") > 0, F.lit(False)), "non_positive_units"),
        _count(~F.coalesce(F.col("component_type").isin(*policy.components), F.lit(False)), "unknown_components"),
    )
    rules = dict.fromkeys(counters.columns, "zero") | {"movements": "positive"}
    return from_counters("ledger", counters, rules)


def transfer_legs(ledger: DataFrame) -> DataFrame:
    counters = paired_legs(ledger).agg(
        F.count(F.lit(1)).alias("transfers"),
        *[_count(F.col("pair_status") == s, s.lower()) for s in ("MISSING_IN", "MISSING_OUT", "REPEATED_LEG", "UNEQUAL_UNITS")],
    )
    rules = dict.fromkeys(counters.columns, "zero") | {"transfers": "report"}
    return from_counters("transfer_legs", counters, rules)


def transfer_rules(flagged: DataFrame) -> DataFrame:
    """Transfers accepted as valid obey the rules, and the flag agrees with them."""
    bad_units = ~F.coalesce(F.col("units") > 0, F.lit(False))
    same = F.col("source_bank_id") == F.col("destination_bank_id")
    counters = flagged.agg(
        _count(F.col("is_valid") & same, "valid_to_itself"), _count(F.col("is_valid") & bad_units, "valid_without_units"),
    )
    return from_counters("transfers", counters, dict.fromkeys(counters.columns, "zero"))


def ledger_keys_covered(ledger: DataFrame, state: DataFrame) -> DataFrame:
    lost = keyed.missing_keys(ledger, state, KEY).agg(F.count(F.lit(1)).alias("keys_without_state"))
    return from_counters("ledger", lost, {"keys_without_state": "zero"})


def reconciled(state: DataFrame, ledger: DataFrame, policy: Policy) -> DataFrame:
    status = F.col("reconciliation_status")
    counters = reconcile(state, ledger, policy).agg(
        _count(status == "MISMATCH", "mismatched_keys"), _count(status == "NOT_PUBLISHED", "keys_not_published"),
        _count(status == "NOT_IN_LEDGER", "keys_not_in_ledger"), _count(F.col("available_units") < 0, "negative_balances"),
    )
    return from_counters("reconciliation", counters, dict.fromkeys(counters.columns, "zero"))


def state_invariants(state: DataFrame, policy: Policy) -> DataFrame:
    """Scores in range, bands re-derived, coverage known exactly when demand is, vocabularies kept."""
    score = F.col("shortage_score")
    known_cover = F.col("coverage_days").isNotNull()
    groups = [
        (~F.coalesce(F.bool_or(F.col("blood_group") == g), F.lit(False))).cast("int") for g in policy.watch_list
    ]
    counters = state.agg(
        _count(~F.coalesce(score.between(0, 100), F.lit(False)), "score_out_of_range"),
        _count(~label(score, policy.priority_bands).eqNullSafe(F.col("priority_level")), "band_disagrees"),
        _count(known_cover != F.col("has_demand_data"), "coverage_without_demand"),
        _count(F.col("recommended_action").isNull(), "no_action"),
        _count(_outside("expiry_status", policy.expiry_order), "unknown_expiry"),
        _count(_outside("priority_level", policy.priority_order), "unknown_priority"),
        _count(F.col("average_daily_demand") < 0, "negative_demand"),
        _count(F.col("lifetime_expired_units") < 0, "negative_expired"),
        reduce(lambda a, b: a + b, groups).alias("watch_groups_absent"),
    )
    rules = dict.fromkeys(counters.columns, "zero")
    return from_counters("stock_state", counters, rules)


# ---- stream, scales, roll-up -----------------------------------------------------------------

def stream_output(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Sink readable with its columns, rows, unique ids and timestamps; checkpoint log present."""
    df = files.read_optional(spark, path)
    if df is None:
        return stated(spark, "streaming", "sink", "FAIL", "not found or unreadable")
    wanted = spark.createDataFrame([], schemas.DONATION_EVENT).columns + list(schemas.LINEAGE)
    absent = [c for c in wanted if c not in df.columns]
    if absent:
        return stated(spark, "streaming", "sink", "FAIL", f"missing columns: {', '.join(absent)}")
    counters = _beside(
        df.agg(F.count(F.lit(1)).alias("events"), _count(F.col("donation_id").isNull(), "null_ids"),
               _count(F.col("event_time").isNull(), "null_event_times")),
        duplicate_ids=_duplicate_keys(df, ["donation_id"]),
    )
    log = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        commits = log.load(f"{checkpoint}/commits").select("path").limit(1).count()
    except Exception:  # any unreadable checkpoint folder is reported, not raised
        commits = 0
    return from_counters("streaming", counters, {
        "events": "positive", "null_ids": "zero", "null_event_times": "zero", "duplicate_ids": "zero",
    }).unionByName(stated(spark, "streaming", "checkpoint", "PASS" if commits else "FAIL"))


def boundaries(spark: SparkSession, scale: Scale, expected: Mapping[int, str]) -> DataFrame:
    """A scale against the labels expected at its boundary values."""
    cases = spark.createDataFrame(list(expected.items()), "units int, expected string")
    got = label(F.col("units"), scale)
    return cases.select(
        F.lit("boundaries").alias("section"), F.concat(F.lit("units "), F.col("units").cast("string")).alias("check_name"),
        F.when(got == F.col("expected"), "PASS").otherwise("FAIL").alias("status"),
        F.col("units").cast("bigint").alias("value"), got.alias("detail"),
    )


def overall(checks: DataFrame) -> DataFrame:
    """Status per section and for the whole run: any FAIL fails, all SKIPPED is skipped."""
    failed, skipped = F.col("status") == "FAIL", F.col("status") == "SKIPPED"
    names = F.array_join(F.sort_array(F.collect_list(F.when(failed, F.col("check_name")))), ", ")
    return checks.rollup("section").agg(
        F.when(F.bool_or(failed), "FAIL").when(F.bool_and(skipped), "SKIPPED").otherwise("PASS").alias("status"),
        F.count(F.lit(1)).alias("checks"), F.count_if(failed).alias("failures"), names.alias("failed_checks"),
    ).withColumn("section", F.coalesce("section", F.lit("OVERALL")))
