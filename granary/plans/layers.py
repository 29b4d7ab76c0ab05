"""The layered batch job: raw files -> bronze -> silver -> gold -> checks, one Parquet table each.

Every stage writes its tables and the next stage reads them back, so a lost executor costs at most
the stage it was working on and no stage recomputes an earlier one.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from typing import Any, Callable

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from granary.operators import activity, checks, ledger, refine, stock, transfers
from granary.operators.shared_store import shuffles_released
from granary.policy import DEFAULT_POLICY, Policy
from granary.sources import files, schemas
from granary.streaming import ingest


# Tables that are built at the same time.
AT_ONCE = 4


def together(spark: SparkSession, *jobs: Callable[[], Any]) -> list[Any]:
    """Results of independent jobs that run side by side, so that a small one or the last tasks of one leave no cores idle.

    Each job gets its turn, also when another fails; the first failure is raised in the end.
    """
    with ThreadPoolExecutor(AT_ONCE) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in begun]


@dataclass(frozen=True)
class Lake:
    """Folder layout below one root any Hadoop file system can hold."""

    root: str

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}.csv"

    def landing(self) -> str:
        return f"{self.root}/streaming/landing"

    def checkpoint(self) -> str:
        return f"{self.root}/checkpoints/bronze_streaming_donations"

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def passing(self, step: int) -> str:
        """Rows between two steps of one table."""
        return f"{self.root}/passing/enriched_donations_{step}"

    def report(self) -> str:
        return f"{self.root}/validation/checks"


def run_bronze(spark: SparkSession, lake: Lake) -> DataFrame:
    """Every raw table to Parquet with lineage; returns the round-trip counts."""
    return checks.combined(together(spark, *[
        partial(files.ingest, spark, name, lake.raw(name), lake.bronze(name)) for name in schemas.RAW_TABLES
    ]))


def run_stream(spark: SparkSession, lake: Lake, one_per_file: bool = True) -> None:
    """Drain the landing folder into the append-only stream table."""
    events = ingest.with_stream_lineage(ingest.event_stream(spark, lake.landing(), one_per_file=one_per_file))
    ingest.drain(ingest.append_sink(events, lake.bronze("streaming_donations"), lake.checkpoint(), "donation-ingest"))


def run_silver(spark: SparkSession, lake: Lake, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Clean, combine, dedup, flag and enrich; returns the one-row layer metrics."""
    def bronze(name: str) -> DataFrame:
        return files.read_table(spark, lake.bronze(name), name)

    def stored(name: str, df: DataFrame, *order: str, dealt: bool = True) -> DataFrame:
        files.write_table(df, lake.silver(name), order, dealt)
        return spark.read.parquet(lake.silver(name))

    batch = bronze("donations")
    live = files.read_optional(spark, lake.bronze("streaming_donations"))

    def clean() -> DataFrame:
        parts = refine.combine(
            refine.donations(batch, policy), None if live is None else refine.donations(live, policy, batch=False)
        )
        return stored("donations", refine.with_quality(refine.dedupe_donations(parts), policy), "donation_date", "donation_id")

    def places() -> tuple[DataFrame, DataFrame]:
        banks = stored("blood_banks", refine.banks(bronze("blood_banks"), policy))
        return banks, stored("blood_inventory", refine.inventory(bronze("blood_inventory"), banks, policy))

    donations, donors, (banks, inventory), camps = together(
        spark, clean, lambda: stored("donors", refine.donors(bronze("donors"), policy)), places,
        lambda: stored("donation_camps", refine.camps(bronze("donation_camps"))),
    )
    steps: list[str] = []

    def passed_on(rows: DataFrame) -> DataFrame:
        """Stored packed, so that the shuffles of a lookup are gone before the next lookup writes its own."""
        steps.append(lake.passing(len(steps)))
        files.write_table(rows, steps[-1])
        for done in steps[:-1]:
            files.drop_table(spark, done)
        return spark.read.parquet(steps[-1])

    # The widest rows of the job stay where the last lookup leaves them.
    wide = refine.enrich(donations, donors, banks, camps, inventory, between=passed_on)
    enriched = stored("enriched_donations", wide, "donation_date", "donation_id", dealt=False)
    files.drop_table(spark, steps[-1])
    return stored("data_quality", refine.layer_metrics(batch, live, enriched))


def run_gold(spark: SparkSession, lake: Lake, policy: Policy = DEFAULT_POLICY) -> list[str]:
    """Both families of published tables; returns their names."""
    def silver(name: str) -> DataFrame:
        return files.read_table(spark, lake.silver(name), name)

    inventory, banks, donors, camps = map(silver, ("blood_inventory", "blood_banks", "donors", "donation_camps"))
    inventory, donations = stock.tidy_groups(inventory), stock.tidy_groups(silver("donations"))
    # Published table names.
    tables: dict[str, Callable[[], DataFrame]] = {
        "gold_inventory_summary": lambda: stock.group_summary(inventory),
        "gold_rare_blood_availability": lambda: stock.tiered_availability(inventory, policy),
        "gold_rare_blood_centers": lambda: stock.tiered_centers(inventory, banks, policy),
        "gold_blood_shortage_report": lambda: stock.tiered_shortages(inventory, policy),
        "gold_zero_rare_inventory": lambda: stock.empty_lines(inventory, banks, policy),
        "gold_city_rare_blood_availability": lambda: stock.tiered_cities(inventory, banks, policy),
        "gold_rare_blood_center_ranking": lambda: stock.center_ranking(inventory, banks, policy),
        "gold_rare_blood_donation_summary": lambda: activity.contribution(donations, policy),
        "gold_rare_blood_daily_trend": lambda: activity.watch_trend(donations, policy),
        "daily_donation_summary": lambda: activity.daily(donations, policy),
        "monthly_donation_summary": lambda: activity.monthly(donations, policy),
        "blood_group_distribution": lambda: activity.distribution(donations, policy),
        "rare_blood_availability": lambda: stock.availability_detail(inventory, banks, policy),
        "rare_blood_summary": lambda: stock.watch_summary(inventory, policy),
        "blood_shortage_report": lambda: stock.severity_report(inventory, policy),
        "blood_bank_rare_stock": lambda: stock.bank_stock(inventory, banks, policy),
        "blood_bank_rare_stock_available": lambda: stock.bank_stock(inventory, banks, policy, in_stock_only=True),
        "city_blood_availability": lambda: stock.cities(inventory, banks, policy),
        "blood_bank_performance": lambda: activity.bank_performance(donations, banks, inventory, policy),
        "donation_camp_performance": lambda: activity.camp_performance(donations, camps, policy),
        "donor_summary": lambda: activity.donor_roster(donations, donors, policy),
    }

    def publish(name: str, build: Callable[[], DataFrame]) -> None:
        files.write_report(build(), lake.gold(name))

    together(spark, *[partial(publish, name, build) for name, build in tables.items()])
    publish("rare_donor_summary", lambda: activity.donor_pool(spark.read.parquet(lake.gold("donor_summary"))))
    return [*tables, "rare_donor_summary"]


def run_ledger(spark: SparkSession, lake: Lake, policy: Policy = DEFAULT_POLICY) -> None:
    """Stock state, demand and checked transfers from the movement ledger."""
    # The text is parsed once; these tables and the checks read the stored copy some ten times.
    name = "inventory_transactions"
    files.write_table(files.with_lineage(files.read_ledger(spark, lake.raw(name)), f"{name}.csv"), lake.bronze(name))
    movements = files.read_table(spark, lake.bronze(name), name)

    def known_transfers() -> None:
        files.write_report(ledger.stock_state(movements, policy), lake.gold("gold_inventory_state"))
        # The banks a transfer may name are the banks the ledger knows.
        state = spark.read.parquet(lake.gold("gold_inventory_state"))
        listed = files.read_optional_csv(spark, lake.raw("blood_transfers"), schemas.TRANSFERS)
        files.write_report(transfers.checked(listed, state), lake.gold("gold_transfer_history"))

    together(spark, known_transfers, lambda: files.write_report(ledger.demand(movements), lake.gold("gold_demand_analytics")))


def run_checks(spark: SparkSession, lake: Lake, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """All check rows of the run, stored as JSON and returned.

    Raw-data rules look at bronze, structural rules at silver and gold. A part whose tables are
    absent is reported as SKIPPED; silver tables must be there, and ledger tables when raw movements are.
    """
    parts: list[DataFrame] = []

    def bronze(name: str) -> DataFrame | None:
        return files.read_optional(spark, lake.bronze(name))

    def silver(name: str) -> DataFrame | None:
        return files.read_optional(spark, lake.silver(name))

    def gold(name: str) -> DataFrame | None:
        return files.read_optional(spark, lake.gold(name))

    def given(section: str, needed: list[DataFrame | None], build: Callable[..., list[DataFrame]]) -> None:
        if any(df is None for df in needed):
            parts.append(checks.stated(spark, section, "inputs", "SKIPPED", "tables not ready"))
        else:
            parts.extend(build(*needed))

    for name, schema in schemas.RAW_TABLES.items():
        columns = spark.createDataFrame([], schema).columns
        parts.append(checks.table_present(spark, "bronze", name, lake.bronze(name), columns, ["_ingested_at"]))
    for name, columns in schemas.REQUIRED.items():
        given("missing_values", [bronze(name)], lambda df: [checks.complete(df, columns, name)])
    for name in ("donors", "blood_inventory", "donations"):
        given("allowed_values", [bronze(name)],
              lambda df: [checks.allowed(df, "blood_group", policy.groups, f"{name}.blood_group")])
    given("quantities", [bronze("donations")], lambda df: [checks.quantities(df, policy)])
    given("donors", [bronze("donors")], lambda df: [checks.donor_rules(df, policy)])
    given("foreign_keys",
          [bronze(n) for n in ("donations", "donors", "blood_banks", "donation_camps", "blood_inventory")],
          lambda *frames: [checks.foreign_keys(*frames)])
    for name in (*schemas.KEYS, "enriched_donations"):
        found = silver(name) is not None
        parts.append(checks.stated(spark, "silver", name, "PASS" if found else "FAIL", None if found else "table not found"))
    for name, key in schemas.KEYS.items():
        given("duplicates", [silver(name)], lambda df: [checks.unique(df, [key], key)])
    required = ["blood_group", "donation_date", "units_donated", "donation_status", "is_rare_blood"]
    given("clean_layer", [silver("donations"), silver("enriched_donations")],
          lambda clean, wide: [checks.enrichment(clean, wide, required)])
    given("inventory", [silver("blood_inventory"), silver("blood_banks")],
          lambda lines, banks: [checks.inventory_consistency(lines, banks)])
    # Labels expected at the bounds of the strict scale.
    parts.append(checks.boundaries(spark, policy.strict, {
        0: "OUT_OF_STOCK", 4: "CRITICAL", 5: "LOW", 9: "LOW", 10: "AVAILABLE", 11: "AVAILABLE",
    }))
    for name, columns in schemas.PUBLISHED.items():
        parts.append(checks.table_present(spark, "gold", name, lake.gold(name), columns))
    given("published_totals",
          [silver("donations"), silver("blood_inventory"), gold("blood_group_distribution"), gold("rare_blood_summary")],
          lambda gifts, lines, shares, summary: [
              checks.published_totals(gifts, lines, shares, summary, policy),
              checks.distribution_rules(shares, summary, policy),
          ])
    given("display", [gold("blood_bank_rare_stock")], lambda df: [checks.display_rows(df, policy)])
    given("streaming", [bronze("streaming_donations")],
          lambda _: [checks.stream_output(spark, lake.bronze("streaming_donations"), lake.checkpoint())])

    def ledger_rules(state: DataFrame, history: DataFrame) -> list[DataFrame]:
        # A lake of before the ledger was stored has its text alone.
        movements = bronze("inventory_transactions")
        movements = files.read_ledger(spark, lake.raw("inventory_transactions")) if movements is None else movements
        return [
            checks.ledger_invariants(movements, policy), checks.ledger_keys_covered(movements, state),
            checks.reconciled(state, movements, policy), checks.state_invariants(state, policy),
            checks.transfer_legs(movements), checks.transfer_rules(history),
        ]

    derived = [gold("gold_inventory_state"), gold("gold_transfer_history")]
    if any(df is None for df in derived) and files.folder_bytes(spark, lake.raw("inventory_transactions")):
        parts.append(checks.stated(spark, "ledger", "inputs", "FAIL", "raw movements exist, but the ledger run left no tables"))
    else:
        given("ledger", derived, ledger_rules)
    files.write_checks(checks.combined(parts), lake.report())
    return spark.read.schema(checks.SHAPE).json(lake.report())


def run_all(spark: SparkSession, lake: Lake, policy: Policy = DEFAULT_POLICY, with_stream: bool = True, one_per_file: bool = True) -> DataFrame:
    """Every stage in order; returns the status per section and overall. ``one_per_file`` says how events land."""
    with shuffles_released(spark):
        counts = run_bronze(spark, lake)
        files.write_checks(checks.ingest_round_trip(counts), f"{lake.root}/validation/ingest")
        # After the batch, not beside it: of equal ids the one ingested first is kept.
        if with_stream:
            run_stream(spark, lake, one_per_file)
        run_silver(spark, lake, policy)
        together(spark, lambda: run_gold(spark, lake, policy), lambda: run_ledger(spark, lake, policy))
        return checks.overall(run_checks(spark, lake, policy))
