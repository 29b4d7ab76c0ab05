"""From raw records to clean, flagged and enriched ones. Rows are flagged, never deleted."""

from __future__ import annotations

from typing import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import flags, text
from granary.operators.keyed import attach, attach_with_line, dedupe, known
from granary.policy import Policy

# The common shape of batch and live donations.
DONATION_SHAPE: Mapping[str, str] = {
    "donation_id": "string", "donor_id": "string", "blood_bank_id": "string", "camp_id": "string",
    "donation_date": "date", "blood_group": "string", "units_donated": "int", "donation_status": "string",
    "event_time": "timestamp", "source": "string", "event_type": "string",
    "_ingested_at": "timestamp", "_ingestion_date": "date", "_source_file": "string",
}
# What a batch record says about itself when it carries no event columns.
BATCH_DEFAULTS: Mapping[str, str] = {"source": "historical_batch", "event_type": "blood_donation"}
DEDUP_ORDER = ("_ingested_at", "source")


def group_code(column: str | Column, policy: Policy) -> Column:
    return text.rewrite(F.col(column) if isinstance(column, str) else column, policy.code_rules)


def donors(raw: DataFrame, policy: Policy) -> DataFrame:
    clean = dedupe(raw, ["donor_id"]).withColumns({
        "blood_group": group_code("blood_group", policy),
        "age": F.col("age").try_cast("int"),
        "gender": text.or_unknown(F.col("gender")),
        "city": text.or_unknown(F.col("city")),
        "eligibility_status": text.or_unknown(F.col("eligibility_status")),
        "registration_date": F.col("registration_date").try_cast("date"),
        "last_donation_date": F.col("last_donation_date").try_cast("date"),
    })
    flagged = clean.withColumns({
        "is_valid_blood_group": flags.one_of(F.col("blood_group"), policy.groups),
        "is_valid_age": flags.within(F.col("age"), policy.age_range),
    })
    return flagged.withColumn(
        "overall_data_quality_status", flags.verdict(F.col("is_valid_blood_group"), F.col("is_valid_age"))
    )


def banks(raw: DataFrame, policy: Policy) -> DataFrame:
    clean = dedupe(raw, ["blood_bank_id"]).withColumns({
        "storage_capacity": F.col("storage_capacity").try_cast("int"),
        "latitude": F.col("latitude").try_cast("double"),
        "longitude": F.col("longitude").try_cast("double"),
    })
    capacity = F.col("storage_capacity")
    flagged = clean.withColumns({
        "is_valid_id": F.col("blood_bank_id").isNotNull(),
        "is_valid_capacity": flags.present_and(capacity, capacity > 0),
        "is_valid_coordinates": flags.on_the_globe(
            F.col("latitude"), F.col("longitude"), policy.latitude_range, policy.longitude_range
        ),
    })
    return flagged.withColumn(
        "overall_data_quality_status",
        flags.verdict(F.col("is_valid_id"), F.col("is_valid_capacity"), F.col("is_valid_coordinates")),
    )


def inventory(raw: DataFrame, clean_banks: DataFrame, policy: Policy) -> DataFrame:
    clean = dedupe(raw, ["inventory_id"]).withColumns({
        "blood_group": group_code("blood_group", policy),
        "available_units": F.col("available_units").try_cast("int"),
        "reserved_units": F.col("reserved_units").try_cast("int"),
        "last_updated": F.col("last_updated").try_cast("timestamp"),
    })
    units = F.col("available_units")
    flagged = clean.withColumns({
        "is_valid_blood_group": flags.one_of(F.col("blood_group"), policy.groups),
        "is_rare_blood": flags.one_of(F.col("blood_group"), policy.watch_list),
        "is_valid_units": flags.present_and(units, units >= 0),
    })
    return known(flagged, "blood_bank_id", clean_banks, "blood_bank_id", "blood_bank_exists", "inventory_id").withColumn(
        "overall_data_quality_status",
        flags.verdict(F.col("is_valid_blood_group"), F.col("is_valid_units"), F.col("blood_bank_exists")),
    )


def camps(raw: DataFrame) -> DataFrame:
    return dedupe(raw, ["camp_id"]).withColumns({
        "camp_date": F.col("camp_date").try_cast("date"),
        "organizer": text.or_unknown(F.col("organizer")),
        "city": text.or_unknown(F.col("city")),
    }).withColumn(
        "overall_data_quality_status", flags.verdict(F.col("camp_id").isNotNull(), F.col("camp_date").isNotNull())
    )


def rename_if_present(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new) if old in df.columns and new not in df.columns else df


def align(df: DataFrame, shape: Mapping[str, str], defaults: Mapping[str, str] | None = None,
          cast: tuple[str, ...] = ()) -> DataFrame:
    """Ordered projection to a target shape: absent columns become typed NULLs or literal defaults."""
    defaults = defaults or {}

    def column(name: str, kind: str) -> Column:
        if name in df.columns:
            return F.col(name).try_cast(kind).alias(name) if name in cast else F.col(name)
        return F.lit(defaults.get(name)).cast(kind).alias(name)

    return df.select(*[column(name, kind) for name, kind in shape.items()])


def donations(raw: DataFrame, policy: Policy, batch: bool = True) -> DataFrame:
    """One source of donations, standardised and brought to the common shape."""
    named = rename_if_present(raw, "status", "donation_status")
    coded = named.withColumns({
        "blood_group": group_code("blood_group", policy),
        "donation_status": text.to_vocabulary(F.col("donation_status"), policy.status_words),
    })
    typed = ("units_donated", "donation_date", "event_time")
    return align(coded, DONATION_SHAPE, BATCH_DEFAULTS if batch else None, cast=typed)


def combine(batch: DataFrame, live: DataFrame | None) -> DataFrame:
    return batch if live is None else batch.unionByName(live, allowMissingColumns=True)


def dedupe_donations(df: DataFrame) -> DataFrame:
    return dedupe(df, ["donation_id"], [c for c in DEDUP_ORDER if c in df.columns])


def with_quality(df: DataFrame, policy: Policy) -> DataFrame:
    checks = {
        "is_valid_blood_group": flags.one_of(F.col("blood_group"), policy.groups),
        "is_valid_donation_quantity": flags.within(F.col("units_donated"), policy.units_range),
        "is_valid_donation_date": flags.not_after(F.col("donation_date"), policy.as_of),
        "is_valid_donation_status": flags.one_of(F.col("donation_status"), policy.donation_statuses),
    }
    flagged = df.withColumns({**checks, "is_rare_blood": flags.one_of(F.col("blood_group"), policy.watch_list)})
    return flagged.withColumn("overall_data_quality_status", flags.verdict(*[F.col(name) for name in checks]))


# Dimension columns an enriched donation carries, and their output names.
DONOR_VIEW = {
    "full_name": "donor_name", "age": "donor_age", "gender": "donor_gender", "city": "donor_city",
    "blood_group": "donor_blood_group", "eligibility_status": "donor_eligibility_status",
}
BANK_VIEW = {
    "blood_bank_name": "blood_bank_name", "city": "blood_bank_city", "state": "blood_bank_state",
    "latitude": "latitude", "longitude": "longitude", "storage_capacity": "storage_capacity",
}
CAMP_VIEW = {"camp_name": "camp_name", "city": "camp_city", "organizer": "organizer", "camp_date": "camp_date"}
STOCK_VIEW = {"available_units": "current_available_units", "last_updated": "inventory_last_updated"}


def enrich(facts: DataFrame, donor_dim: DataFrame, bank_dim: DataFrame, camp_dim: DataFrame, stock: DataFrame,
           attribute_flags: bool = False, between: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Donations with donor, bank, camp and current stock; no donation is lost or multiplied.

    ``between`` is given the rows after every lookup but the last and gives back the same rows, stored if need be.

    The exists flags say whether the dimension row was found. ``attribute_flags`` switches to the
    older reading, where a found row whose name (or unit count) is NULL counts as missing.
    """
    spread = "donation_id"
    # Attributes travel with all later lookups: those that weigh most, the donor's, come last.
    wide = between(attach(facts, camp_dim, {"camp_id": "camp_id"}, CAMP_VIEW, spread, "_camp"))
    # A stock line is its bank's: both are found where the bank's rows meet, and rows travel once less.
    wide = between(attach_with_line(
        wide, bank_dim, stock, ("blood_bank_id", "blood_bank_id"), ("blood_group", "blood_group"), BANK_VIEW, STOCK_VIEW, spread, "_bank", "_stock"
    ))
    wide = attach(wide, donor_dim, {"donor_id": "donor_id"}, DONOR_VIEW, spread, "_donor")
    views = [DONOR_VIEW, BANK_VIEW, CAMP_VIEW, STOCK_VIEW]
    wide = wide.select(*facts.columns, *[name for view in views for name in view.values()], "_donor", "_bank", "_camp", "_stock")
    names = {"_donor": "donor_name", "_bank": "blood_bank_name", "_camp": "camp_name", "_stock": "current_available_units"}
    seen = {k: F.col(n).isNotNull() if attribute_flags else F.col(k) for k, n in names.items()}
    # No camp referenced, or no donor found, is not a mismatch: those flags stay unknown.
    return wide.withColumns({
        "donor_exists": seen["_donor"],
        "blood_bank_exists": seen["_bank"],
        "inventory_record_exists": seen["_stock"],
        "camp_exists": F.when(F.col("camp_id").isNotNull(), seen["_camp"]),
        "blood_group_match": F.col("blood_group") == F.col("donor_blood_group"),
    }).drop(*names)


def layer_metrics(batch: DataFrame, live: DataFrame | None, enriched: DataFrame) -> DataFrame:
    """One row of row counts per stage. Enrichment keeps the row count of the clean layer, so one pass over
    the enriched rows gives both; the parts meet as one-row subqueries."""
    status = F.col("overall_data_quality_status")
    counted = enriched.agg(
        F.count(F.lit(1)).alias("_kept"),
        F.count_if(status == "VALID").alias("valid_donations"),
        F.count_if(status == "REVIEW").alias("records_requiring_review"),
        F.count_if("is_rare_blood").alias("rare_blood_donations"),
        F.count_if(~F.col("donor_exists")).alias("missing_donor_matches"),
        F.count_if(~F.col("blood_bank_exists")).alias("missing_blood_bank_matches"),
        F.count_if(~F.col("inventory_record_exists")).alias("missing_inventory_matches"),
    )
    return _with_arrivals(batch, live, counted)


def layer_metrics_by_key(batch: DataFrame, live: DataFrame | None, clean: DataFrame, donor_dim: DataFrame, bank_dim: DataFrame,
                         stock: DataFrame) -> DataFrame:
    """``layer_metrics`` of clean rows that nobody needs enriched: no row is sent to a dimension.

    Rows are counted per referenced key, stacked on the keys that exist and grouped once; what a key counts is
    missing if no dimension row shares it. A key with a NULL part is referenced and never exists.
    """
    donor, bank, group, nothing = F.col("donor_id"), F.col("blood_bank_id"), F.col("blood_group"), F.lit(None)
    types = {df.schema["donor_id"].dataType for df in (clean, donor_dim)} | {df.schema["blood_bank_id"].dataType for df in (clean, bank_dim, stock)}
    key_type = types.pop() if len(types) == 1 else "string"

    def part(kind: Column, key: Column = nothing, group: Column = nothing) -> Column:
        return F.struct(kind.alias("_kind"), key.cast(key_type).alias("_key"), group.cast("string").alias("_group"))

    asked = clean.select(F.inline(F.array(
        part(F.lit("donor"), donor), part(F.lit("bank"), bank), part(F.lit("stock"), bank, group),
        part(F.lit("kept")), part(F.col("overall_data_quality_status")), part(F.when(F.col("is_rare_blood"), F.lit("rare"))),
    )))
    there = [donor_dim.select(part(F.lit("donor"), donor).alias("_part")), bank_dim.select(part(F.lit("bank"), bank).alias("_part")),
             stock.where(group.isNotNull()).select(part(F.lit("stock"), bank, group).alias("_part"))]
    stacked = asked.select("*", F.lit(1).cast("bigint").alias("_n"), F.lit(False).alias("_exists"))
    for keys in there:
        stacked = stacked.unionByName(keys.select("_part.*").where(F.col("_key").isNotNull()).select("*", F.lit(0).cast("bigint").alias("_n"), F.lit(True).alias("_exists")))
    counts = stacked.groupBy("_kind", "_key", "_group").agg(F.sum("_n").alias("_n"), F.max("_exists").alias("_exists"))

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when((F.col("_kind") == kind) & ~F.col("_exists"), F.col("_n"))), F.lit(0))

    return _with_arrivals(batch, live, counts.agg(*[total(kind).alias(name) for kind, name in {
        "kept": "_kept", "VALID": "valid_donations", "REVIEW": "records_requiring_review", "rare": "rare_blood_donations",
        "donor": "missing_donor_matches", "bank": "missing_blood_bank_matches", "stock": "missing_inventory_matches",
    }.items()]))


def _with_arrivals(batch: DataFrame, live: DataFrame | None, counted: DataFrame) -> DataFrame:
    """Counts of the clean layer, with those of what arrived in front."""
    def rows(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    live_rows = F.lit(0).cast("bigint") if live is None else rows(live)
    sized = counted.select(rows(batch).alias("historical_donations"), live_rows.alias("streaming_donations"),
                           "*")
    combined = F.col("historical_donations") + F.col("streaming_donations")
    return sized.select(
        "historical_donations", "streaming_donations", combined.alias("combined_donations"),
        (combined - F.col("_kept")).alias("duplicates_removed"), *counted.columns[1:],
    )
