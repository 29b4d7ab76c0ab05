"""Named queries over the star-schema tables, each over whole tables."""

from __future__ import annotations

import datetime as dt
from typing import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from granary.functions import flags, text
from granary.functions.bands import label
from granary.operators import activity, admission, board, checks, keyed, ledger, refine, shapes, sketches, stock, timeline, transfers
from granary.operators.shared_store import settle, shared_folder, shuffles_released
from granary.plans import landed, layers
from granary.sources import files, schemas
from granary.sources.files import with_lineage
from granary.sources.star import LOST_BANK, NOWHERE, Star, as_donation_events
from granary.streaming import ingest, keyed_state, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# Files of a micro-batch in the queries over streams that land in several files.
FILES_AT_ONCE = 4


def query(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Star(spark, folder))
    return build


# ---- stock -----------------------------------------------------------------------------------

@query
def stock_summary(s: Star):
    return stock.group_summary(s.inventory())


@query
def stock_availability_a(s: Star):
    return stock.tiered_availability(s.inventory(), s.policy)


@query
def stock_centers(s: Star):
    return stock.tiered_centers(s.inventory(), s.banks(), s.policy)


@query
def shortage_a(s: Star):
    return stock.tiered_shortages(s.inventory(), s.policy)


@query
def zero_stock(s: Star):
    return stock.empty_lines(s.inventory(), s.banks(), s.policy)


@query
def city_stock_a(s: Star):
    return stock.tiered_cities(s.inventory(), s.banks(), s.policy)


@query
def center_rank(s: Star):
    return stock.center_ranking(s.inventory(), s.banks(), s.policy)


@query
def stock_detail_b(s: Star):
    return stock.availability_detail(s.inventory(), s.banks(), s.policy)


@query
def group_summary_b(s: Star):
    return stock.watch_summary(s.inventory(), s.policy)


@query
def shortage_b(s: Star):
    return stock.severity_report(s.inventory(), s.policy)


@query
def bank_stock(s: Star):
    return stock.bank_stock(s.inventory(), s.banks(), s.policy)


@query
def bank_stock_in_stock(s: Star):
    return stock.bank_stock(s.inventory(), s.banks(), s.policy, in_stock_only=True)


@query
def city_stock_b(s: Star):
    return stock.cities(s.inventory(), s.banks(), s.policy)


@query
def watch_list_coverage(s: Star):
    return stock.watch_list_coverage(s.inventory(), s.banks(), s.policy)


@query
def record_status_counts(s: Star):
    return stock.record_status_counts(s.inventory(), s.policy)


@query
def group_totals(s: Star):
    return stock.totals_by(s.inventory(), "blood_group")


@query
def scale_labels(s: Star):
    """How many stock lines fall under each label of each scale."""
    units, p = F.col("available_units"), s.policy
    scales = {"four_tier": p.four_tier, "stock_out": p.stock_out, "strict": p.strict, "record": p.record}
    pairs = F.array(*[F.struct(F.lit(n).alias("scale"), label(units, sc).alias("label")) for n, sc in scales.items()])
    return s.inventory().select(F.inline(pairs)).groupBy("scale", "label").agg(F.count(F.lit(1)).alias("line_count"))


# ---- activity --------------------------------------------------------------------------------

@query
def contribution(s: Star):
    return activity.contribution(s.donations(), s.policy)


@query
def daily_trend(s: Star):
    return activity.watch_trend(s.donations(), s.policy)


@query
def daily_summary(s: Star):
    return activity.daily(s.donations(), s.policy)


@query
def monthly_summary(s: Star):
    return activity.monthly(s.donations(), s.policy)


@query
def monthly_labels(s: Star):
    return board.monthly_labels(activity.monthly(s.donations(), s.policy))


@query
def distribution(s: Star):
    return activity.distribution(s.donations(), s.policy)


@query
def bank_performance(s: Star):
    return activity.bank_performance(s.donations(), s.banks(), s.inventory(), s.policy)


@query
def camp_performance(s: Star):
    return activity.camp_performance(s.donations(), s.camps(), s.policy)


@query
def donor_roster(s: Star):
    return activity.donor_roster(s.donations(), s.donors(), s.policy)


@query
def donor_pool(s: Star):
    return activity.donor_pool(activity.donor_roster(s.donations(), s.donors(), s.policy))


# ---- cleaning and enrichment -----------------------------------------------------------------

@query
def standardise_codes(s: Star):
    group = refine.group_code("raw_code", s.policy)
    status = text.to_vocabulary(F.col("raw_status"), s.policy.status_words)
    coded = s.spelled_codes().select(
        "donation_id", group.alias("blood_group"), status.alias("donation_status"),
        text.or_unknown(F.col("raw_note")).alias("note"),
    )
    return coded.select(
        "*", flags.one_of(F.col("blood_group"), s.policy.groups).alias("is_valid_blood_group"),
        flags.one_of(F.col("blood_group"), s.policy.watch_list).alias("is_rare_blood"),
        flags.one_of(F.col("donation_status"), s.policy.donation_statuses).alias("is_valid_donation_status"),
    )


@query
def quality_flags(s: Star):
    return refine.with_quality(s.donations(), s.policy)


@query
def donor_quality(s: Star):
    return refine.donors(s.donors(), s.policy)


@query
def bank_quality(s: Star):
    return refine.banks(s.banks(), s.policy)


@query
def inventory_quality(s: Star):
    """Stock lines cleaned and flagged, some of them of a bank that does not exist."""
    raw = s.inventory().withColumn("reserved_units", F.col("available_units") % 3)
    return refine.inventory(raw, refine.banks(s.banks(), s.policy), s.policy).drop("last_updated")


@query
def camp_quality(s: Star):
    return refine.camps(s.camps())


@query
def clean_donations(s: Star):
    """Batch donations under an older column name, brought to the common shape."""
    return refine.donations(s.donations().withColumnRenamed("donation_status", "status"), s.policy)


@query
def dedup(s: Star):
    return s.unique_lines()


def _one_stream(s: Star) -> DataFrame:
    """Batch and live donations in one shape, copies still in."""
    shape = ["donation_id", "donor_id", "blood_bank_id", "camp_id", "donation_date", "blood_group", "units_donated",
             "donation_status", "event_time", "source", "event_type"]
    kinds = dict(refine.DONATION_SHAPE, event_time="timestamp_ntz")
    batch = refine.align(s.raw_donations(), {c: kinds[c] for c in shape}, refine.BATCH_DEFAULTS)
    return refine.combine(batch, s.events().select(*shape))


@query
def union_align(s: Star):
    return _one_stream(s)


@query
def union_dedup(s: Star):
    """Batch and live rows compete for an id; the source name settles it, then the other columns."""
    return keyed.dedupe(_one_stream(s), ["donation_id"], ["source"])


def _enriched(s: Star, facts: DataFrame) -> DataFrame:
    return refine.enrich(facts, s.donors(), s.banks(), s.camps(), s.inventory())


@query
def enrich(s: Star):
    return _enriched(s, s.donations())


@query
def layer_metrics(s: Star):
    clean = refine.with_quality(keyed.dedupe(_one_stream(s), ["donation_id"], ["source"]), s.policy)
    return refine.layer_metrics_by_key(s.donation_lines(), s.events(), clean, s.donors(), s.banks(), s.inventory())


# ---- ledger ----------------------------------------------------------------------------------

@query
def ledger_balance(s: Star):
    return ledger.balances(s.ledger(), s.policy)


@query
def expiry(s: Star):
    return ledger.with_freshness(ledger.balances(s.ledger(), s.policy), s.policy)


@query
def demand(s: Star):
    return ledger.demand(s.ledger())


@query
def coverage(s: Star):
    movements = s.ledger()
    return ledger.with_coverage(ledger.key_measures(movements, s.policy), movements, s.policy).select(
        *ledger.KEY, "available_units", "has_demand_data", "average_daily_demand", "average_weekly_demand",
        "average_monthly_demand", "coverage_days",
    )


@query
def trend(s: Star):
    return ledger.with_trend(ledger.key_measures(s.ledger(), s.policy)).select(
        *ledger.KEY, "recent_donation_units", "prior_donation_units", "donation_trend_sub_score"
    )


@query
def stock_state(s: Star):
    return ledger.stock_state(s.ledger(), s.policy)


@query
def reconcile(s: Star):
    """Closing snapshot (floored at zero) against the recomputed balance: overdrawn keys disagree, and the
    snapshot names one bank wrongly, so each side has keys that the other lacks."""
    movements = s.ledger()
    snapshot = ledger.closing_snapshot(movements, s.policy)
    wrong = F.when(F.col("blood_bank_id") == LOST_BANK, F.col("blood_bank_id") + NOWHERE).otherwise(F.col("blood_bank_id"))
    return ledger.reconcile(snapshot.withColumn("blood_bank_id", wrong), movements, s.policy)


@query
def ledger_keys_except(s: Star):
    """Ledger keys that hold no stock."""
    movements = s.ledger()
    stocked = ledger.balances(movements, s.policy).where(F.col("available_units") > 0)
    return keyed.missing_keys(movements, stocked, ledger.KEY)


@query
def stock_at_donation(s: Star):
    """Every donation with the last closing balance of its bank and group up to that day."""
    closing = ledger.closing_by_day(s.ledger(), ["blood_bank_id", "blood_group"], s.policy)
    given = s.donations().select("donation_id", "blood_bank_id", "blood_group", "donation_date")
    return timeline.as_of(given, closing.withColumn("known_since", F.col("day")), ["blood_bank_id", "blood_group"], "donation_date", "day", ["known_since", "balance"])


@query
def lots_at_issue(s: Star):
    return ledger.lots_at_issue(s.ledger(), s.policy)


@query
def running_balance(s: Star):
    return ledger.running_balance(s.ledger(), s.policy)


@query
def post_donations(s: Star):
    return ledger.post_donations(s.donations(), s.policy)


@query
def expiry_candidates(s: Star):
    return ledger.expiry_candidates(s.ledger(), s.policy)


@query
def closing_snapshot(s: Star):
    return ledger.closing_snapshot(s.ledger(), s.policy)


@query
def issue_list(s: Star):
    return ledger.issue_list(s.ledger())


@query
def issue_postings(s: Star):
    """Issue list taken out of the ledger and posted back."""
    listed = ledger.issue_list(s.ledger()).withColumn("hospital_id", F.concat(F.lit("H"), F.col("blood_bank_id").cast("string")))
    return ledger.post_issues(listed)


@query
def movement_counts(s: Star):
    return keyed.sizes(s.ledger(), ["transaction_type"])


@query
def distinct_counts(s: Star):
    return keyed.distinct_counts(s.ledger(), ledger.KEY)


# ---- transfers -------------------------------------------------------------------------------

@query
def transfers_valid(s: Star):
    return transfers.checked(s.transfers(), s.banks())


@query
def transfer_validity_counts(s: Star):
    return transfers.validity_counts(transfers.checked(s.transfers(), s.banks()))


@query
def transfer_pairs(s: Star):
    return transfers.paired_legs(s.ledger())


@query
def transfer_postings(s: Star):
    return transfers.post_transfers(s.transfers())


@query
def transfer_candidates(s: Star):
    return transfers.helpers(s.ledger(), s.policy)


# ---- checks ----------------------------------------------------------------------------------

@query
def orphans(s: Star):
    return keyed.orphan_keys(s.transfers(), "destination_bank_id", s.banks(), "blood_bank_id")


@query
def duplicates(s: Star):
    return keyed.duplicate_keys(s.donation_lines(), ["l_orderkey", "l_linenumber"])


@query
def null_counts(s: Star):
    columns = ["donation_id", "donor_id", "blood_bank_id", "camp_id", "donation_date", "event_time"]
    return keyed.null_counts(s.events(), columns)


@query
def allowed_values(s: Star):
    group = refine.group_code("raw_code", s.policy).alias("blood_group")
    return keyed.invalid_values(s.spelled_codes().select(group), "blood_group", s.policy.groups)


@query
def completeness(s: Star):
    return checks.complete(s.events(), ["donation_id", "donor_id", "blood_bank_id", "donation_date", "shoe_size"], "events")


@query
def allowed_sample(s: Star):
    group = refine.group_code("raw_code", s.policy).alias("blood_group")
    return checks.allowed(s.spelled_codes().select(group), "blood_group", s.policy.groups, "codes.blood_group")


@query
def quantity_rules(s: Star):
    return checks.quantities(s.donations(), s.policy)


@query
def donor_rules(s: Star):
    return checks.donor_rules(s.donors(), s.policy)


@query
def foreign_keys(s: Star):
    return checks.foreign_keys(s.events(), s.donors(), s.banks(), s.camps(), s.inventory())


@query
def enrichment_check(s: Star):
    donations = s.donations()
    return checks.enrichment(donations, _enriched(s, donations))


@query
def inventory_consistency(s: Star):
    return checks.inventory_consistency(s.inventory(), s.banks())


@query
def display_rows(s: Star):
    return checks.display_rows(stock.bank_stock(s.inventory(), s.banks(), s.policy), s.policy)


@query
def stock_precheck(s: Star):
    return checks.stock_precheck(s.inventory(), s.banks(), s.policy)


@query
def publish_precheck(s: Star):
    return checks.publish_precheck(s.donors(), s.banks(), s.inventory(), s.events(), s.policy)


@query
def gold_vs_silver(s: Star):
    donations, inventory = s.donations(), s.inventory()
    shares = activity.distribution(donations, s.policy)
    return checks.published_totals(donations, inventory, shares, stock.watch_summary(inventory, s.policy), s.policy)


@query
def distribution_rules(s: Star):
    inventory = s.inventory()
    shares = activity.distribution(s.donations(), s.policy)
    return checks.distribution_rules(shares, stock.watch_summary(inventory, s.policy), s.policy)


def _ledger_checks(s: Star) -> DataFrame:
    movements = s.ledger()
    state = settle(ledger.stock_state(movements, s.policy))
    return checks.combined([
        checks.ledger_invariants(movements, s.policy), checks.ledger_keys_covered(movements, state),
        checks.reconciled(state, movements, s.policy), checks.state_invariants(state, s.policy),
        checks.transfer_legs(movements), checks.transfer_rules(transfers.checked(s.transfers(), s.banks())),
    ])


@query
def ledger_invariants(s: Star):
    return _ledger_checks(s)


@query
def check_rollup(s: Star):
    return checks.overall(checks.combined([_ledger_checks(s), checks.donor_rules(s.donors(), s.policy)]))


@query
def event_admission(s: Star):
    stored = s.raw_donation_ids()
    judged = admission.judge(s.events(), s.donors(), s.banks(), s.camps(), stored, s.policy)
    return judged.select("donation_id", "admitted", "reject_reason")


@query
def event_rejections(s: Star):
    """Every rejected event with the value that its reason is about."""
    judged = admission.judge(s.events(), s.donors(), s.banks(), s.camps(), s.raw_donation_ids(), s.policy)
    return judged.where(~F.col("admitted")).select("donation_id", "reject_reason", "rejected_value")


# ---- board -----------------------------------------------------------------------------------

DAY = dt.date(1998, 6, 15)


@query
def kpis(s: Star):
    # Each is read several times: derived once.
    inventory, donations = settle(s.inventory()), settle(s.donations())
    return board.headline(
        stock.watch_summary(inventory, s.policy), stock.bank_stock(inventory, s.banks(), s.policy),
        activity.donor_pool(activity.donor_roster(donations, s.donors(), s.policy)),
        activity.distribution(donations, s.policy), activity.daily(donations, s.policy), DAY,
    )


@query
def donor_stats(s: Star):
    return board.donor_figures(activity.donor_roster(s.donations(), s.donors(), s.policy))


@query
def donors_by_group(s: Star):
    return board.donors_by_group(activity.donor_roster(s.donations(), s.donors(), s.policy))


@query
def state_headline(s: Star):
    return board.state_headline(settle(ledger.stock_state(s.ledger(), s.policy)))


@query
def watch_state_totals(s: Star):
    return board.watch_state_totals(ledger.stock_state(s.ledger(), s.policy), s.policy)


@query
def banks_by_units(s: Star):
    rows = activity.bank_performance(s.donations(), s.banks(), s.inventory(), s.policy)
    return board.by_measure(rows, "total_units_received", "blood_bank_id")


@query
def band_counts(s: Star):
    state = ledger.stock_state(s.ledger(), s.policy)
    return board.counts_in_order(state, "priority_level", s.policy.priority_order)


@query
def expiry_counts(s: Star):
    lines = ledger.with_freshness(ledger.balances(s.ledger(), s.policy), s.policy)
    return board.counts_in_order(lines, "expiry_status", s.policy.expiry_order)


@query
def lookup_filter(s: Star):
    rows = stock.availability_detail(s.inventory(), s.banks(), s.policy)
    return board.narrowed(rows, s.policy, watch_only=True, blood_group="O-", state="ASIA", city="All",
                          availability_status="CRITICAL")


@query
def day_range(s: Star):
    return board.between_days(activity.daily(s.donations(), s.policy), "donation_date", DAY, dt.date(1999, 6, 15))


@query
def mappable_rows(s: Star):
    return board.mappable(stock.bank_stock(s.inventory(), s.banks(), s.policy))


@query
def city_totals(s: Star):
    return board.city_totals(stock.cities(s.inventory(), s.banks(), s.policy))


@query
def shortage_alerts(s: Star):
    return board.shortage_alerts(stock.watch_summary(s.inventory(), s.policy))


@query
def bank_alerts(s: Star):
    """The alert wording at bank and group grain, where every label occurs."""
    rows = stock.bank_stock(s.inventory(), s.banks(), s.policy)
    sentence = text.shortage_message(F.col("blood_group"), F.col("available_units"), F.col("availability_status"))
    return rows.select("blood_bank_id", "blood_group", sentence.alias("alert"))


@query
def run_totals(s: Star):
    inventory = s.inventory()
    return board.run_totals(stock.watch_summary(inventory, s.policy), stock.bank_stock(inventory, s.banks(), s.policy))


@query
def urgent_alerts(s: Star):
    return board.urgent_alerts(ledger.stock_state(s.ledger(), s.policy))


@query
def most_urgent(s: Star):
    return board.most_urgent(ledger.stock_state(s.ledger(), s.policy))


@query
def topk_centers(s: Star):
    return board.top_centers(stock.tiered_centers(s.inventory(), s.banks(), s.policy))


@query
def topk_banks_by_stock(s: Star):
    return board.top_by(stock.totals_by(s.inventory(), "blood_bank_id"), "total_available_units", "blood_bank_id", 5)


@query
def topk_odd_values(s: Star):
    group = refine.group_code("raw_code", s.policy).alias("blood_group")
    bad = keyed.invalid_values(s.spelled_codes().select(group), "blood_group", s.policy.groups)
    return board.odd_values(bad, "blood_group")


@query
def topk_group_banks(s: Star):
    return board.top_for_group(stock.bank_stock(s.inventory(), s.banks(), s.policy), "O-")


@query
def topk_banks_received(s: Star):
    rows = activity.bank_performance(s.donations(), s.banks(), s.inventory(), s.policy)
    return board.top_by(rows, "total_units_received", "blood_bank_id", 10)


@query
def topk_camps(s: Star):
    return board.top_by(activity.camp_performance(s.donations(), s.camps(), s.policy), "total_units_collected", "camp_id", 10)


@query
def topk_demand(s: Star):
    return board.top_demand(ledger.demand(s.ledger()), s.policy)


@query
def topk_transfers(s: Star):
    return board.recent_transfers(transfers.checked(s.transfers(), s.banks()))


@query
def topk_live_feed(s: Star):
    return board.live_feed(s.events(), s.policy)


# ---- sketches, sets, runs, shapes ------------------------------------------------------------

def _day_sketches(s: Star) -> tuple[DataFrame, DataFrame]:
    """Donations, and their daily sketches as a stored table would hold them."""
    given = settle(s.donations().select("donor_id", "blood_group", "donation_date", "units_donated"))
    return given, settle(sketches.daily_sketches(given))


@query
def monthly_sketches(s: Star):
    """Distinct donors and median units per month and group from merged daily sketches, held against the exact figures."""
    return sketches.monthly_report(*_day_sketches(s))


@query
def returning_donors(s: Star):
    """Donors who gave in two months in a row, exactly, and whether the intersected sketches say so."""
    given, daily = _day_sketches(s)
    months = given.where(F.col("donor_id").isNotNull()).select(F.trunc("donation_date", "month").alias("month"), "blood_group", "donor_id").distinct()
    before = months.select(F.add_months("month", 1).alias("month"), "blood_group", "donor_id")
    exact = months.join(before, ["month", "blood_group", "donor_id"], "left_semi").groupBy("month", "blood_group").agg(F.count(F.lit(1)).alias("returning_donors"))
    named = sketches.returning_donors(daily)
    all_sets = named.join(exact, ["month", "blood_group"], "left").withColumn("returning_donors", F.coalesce("returning_donors", F.lit(0)))
    # The error of an intersection goes by the larger of the two sets, not by what they share.
    return all_sets.select("month", "blood_group", "returning_donors", (F.abs(F.col("returning") - F.col("returning_donors")) <= 1 + 0.1 * F.col("returning_donors")).alias("near"))


@query
def ledger_cube(s: Star):
    """Units in the ledger by place, group and component, in five groupings at once."""
    moved = s.ledger().groupBy("blood_bank_id", "blood_group", "component_type").agg(F.sum("units").alias("units"), F.count(F.lit(1)).alias("movements"))
    placed = keyed.attach(moved, s.banks(), {"blood_bank_id": "blood_bank_id"}, {"state": "state", "city": "city"})
    sets = [["state", "city", "blood_group", "component_type"], ["state", "city"], ["state", "blood_group"], ["blood_group", "component_type"], []]
    return shapes.totals_by_sets(placed, sets, {"units": "total_units", "movements": "movement_count"})


@query
def stock_outs(s: Star):
    """Periods in which a bank's group closed every day without stock."""
    closing = ledger.closing_by_day(s.ledger(), ["blood_bank_id", "blood_group"], s.policy)
    return timeline.runs(closing, ["blood_bank_id", "blood_group"], "day", F.col("balance") <= 0)


@query
def donor_pauses(s: Star):
    return timeline.pauses(s.donations().where(F.col("donor_id").isNotNull()), ["donor_id"], "donation_date", 90)


@query
def rolling_demand(s: Star):
    """Units issued in the thirty days up to each day with an issue."""
    issues = s.ledger().where(F.col("transaction_type") == "ISSUE").withColumn("_day", F.to_date("transaction_timestamp"))
    return timeline.rolling(issues, ["blood_bank_id", "blood_group"], "_day", "units", "units_30_days", 30)


def _posted_twice(s: Star) -> tuple[DataFrame, DataFrame]:
    """The ledger, and one in which some movements are absent and others were written twice."""
    posted = s.ledger().select("transaction_id", *ledger.KEY, "transaction_type", "units", "transaction_timestamp")
    number = F.col("transaction_id")
    times = F.when(number % 97 == 0, 0).when(number % 89 == 0, 2).otherwise(1)
    return posted, posted.withColumn("_time", F.explode(F.sequence(F.lit(0), times))).where("_time > 0").drop("_time")


@query
def ledger_differences(s: Star):
    return shapes.counted_difference(*_posted_twice(s))


@query
def ledger_in_common(s: Star):
    """How many movements both ledgers hold, per type, counted with their copies."""
    return shapes.in_common(*_posted_twice(s)).groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("different_movements"), F.sum("both_count").alias("movements"))


def _group_columns(s: Star) -> dict[str, str]:
    return {g: f"units_{g.lower().replace('+', '_pos').replace('-', '_neg')}" for g in s.policy.groups}


@query
def stock_matrix(s: Star):
    """Banks against groups; the groups are those of the policy."""
    return shapes.wide(s.inventory(), ["blood_bank_id"], "blood_group", "available_units", _group_columns(s))


@query
def stock_matrix_lines(s: Star):
    """The matrix as lines again."""
    return shapes.tall(stock_matrix(s), ["blood_bank_id"], "blood_group", "available_units", _group_columns(s))


# ---- streaming -------------------------------------------------------------------------------

def _clocked(s: Star) -> DataFrame:
    """Events with a fixed ingest clock, some seconds after the event."""
    late = F.make_dt_interval(secs=F.pmod(F.col("donation_id"), F.lit(13)))
    return s.events().withColumn("_ingested_at", F.col("event_time") + late)


@query
def first_ingested(s: Star):
    return board.first_ingested(_clocked(s), "donation_id").select("donation_id", "_ingested_at")


@query
def ingest_lag(s: Star):
    return ingest.ingest_lag(_clocked(s))


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/run-{uuid4().hex}"


def _event_files(s: Star) -> DataFrame:
    """The events table as a file stream; a glob serves one file as well as a folder of files."""
    reader = s.spark.readStream.schema(s.table("events").schema).option("maxFilesPerTrigger", ingest.FILES_PER_TRIGGER)
    return reader.parquet(f"{s.folder}/event[s].parquet")


@query
def stream_admission(s: Star):
    """Events land as JSON files in two arrivals, repeats of an id in the second; a run admits each in several
    micro-batches, and the second run knows the first one's ids from the state store alone."""
    run, events = _run_folder(s.spark), as_donation_events(s.table("events"), F.col("event_id"))
    for arrival in (F.col("event_id") % 3 != 1, F.col("event_id") % 3 == 1):
        landed.land_events(events.where(arrival).drop("event_id"), f"{run}/landing")
        stream = ingest.event_stream(s.spark, f"{run}/landing", FILES_AT_ONCE, s.events().schema, one_per_file=False)
        ingest.drain(keyed_state.admit_by_state(stream, (s.donors(), s.banks(), s.camps()), s.policy, f"{run}/verdicts",
                                                f"{run}/checkpoint", f"admission-{uuid4().hex}"))
    return s.spark.read.parquet(f"{run}/verdicts").select("donation_id", "admitted", "reject_reason")


def _arrivals(s: Star, astray: bool = False) -> list[DataFrame]:
    """Events in two arrivals, the earlier half first; if ``astray``, one in ten of the first half comes with the second."""
    table = s.table("events")
    half = (table.agg(F.max("event_id")).first()[0] or 0) // 2  # one row
    events = as_donation_events(table, F.col("event_id"))
    first = (F.col("event_id") <= half) & (F.col("event_id") % 10 != 4) if astray else F.col("event_id") <= half
    return [events.where(first), events.where(~first)]


def _streamed(s: Star, arrivals: list[DataFrame], start: Callable[[DataFrame, str, str, str], StreamingQuery]) -> DataFrame:
    """Lands one arrival after the other and lets the query run until it is read; each run goes on from the last one's
    checkpoint. Returns what the sink holds."""
    run = _run_folder(s.spark)
    for arrival in arrivals:
        landed.land_events(arrival, f"{run}/landing")
        stream = ingest.event_stream(s.spark, f"{run}/landing", schema=arrival.schema, one_per_file=False)
        ingest.drain(start(stream, f"{run}/sink", f"{run}/checkpoint", f"catalog-{uuid4().hex}"))
    return s.spark.read.parquet(f"{run}/sink")


@query
def tumbling_units(s: Star):
    """Units per group and six hours; of the events that come with the second arrival many are too late."""
    return _streamed(s, _arrivals(s, True), lambda events, *to: windows.append_final(
        windows.tumbling(events, ["blood_group"], "6 hours", "1 day"), *to))


@query
def sliding_units(s: Star):
    """Units per group and day, every six hours."""
    return _streamed(s, _arrivals(s, True), lambda events, *to: windows.append_final(
        windows.sliding(events, ["blood_group"], "1 day", "6 hours", "1 day"), *to))


@query
def session_units(s: Star):
    """Units per donor and run of events less than six hours apart."""
    return _streamed(s, _arrivals(s), lambda events, *to: windows.append_final(windows.sessions(events, ["donor_id"], "6 hours", "1 day"), *to))


@query
def late_events(s: Star):
    """Events that ``tumbling_units`` does not count, and the watermark that they missed."""
    found = _streamed(s, _arrivals(s, True), lambda events, *to: windows.divert_late(events, "6 hours", "1 day", *to))
    return found.select("donation_id", "blood_group", "units_donated", "event_time", "low_water")


@query
def event_follow_ups(s: Star):
    """Every event with its repeat, if that came within four minutes."""
    def start(events: DataFrame, *to: str) -> StreamingQuery:
        repeat = F.col("event_id") % 3 == 1
        later = events.where(repeat).select("donation_id", F.col("event_time").alias("later_time"), F.col("units_donated").alias("later_units"))
        first = events.where(~repeat).select("donation_id", "event_time", "units_donated")
        return windows.append_final(windows.with_follow_up(first, later, "donation_id", "4 minutes", "1 hour"), *to)

    return _streamed(s, _arrivals(s), start)


@query
def stream_ingest(s: Star):
    """The events table as a file stream, through lineage, into the append sink, read back as a batch."""
    run = _run_folder(s.spark)
    live = as_donation_events(_event_files(s), F.col("_metadata.file_path").alias("_file"))
    tagged = with_lineage(live, F.col("_file")).drop("_file")
    ingest.drain(ingest.append_sink(tagged, f"{run}/sink", f"{run}/checkpoint", f"ingest-{uuid4().hex}"))
    stored = s.spark.read.parquet(f"{run}/sink")
    return stored.drop("_ingested_at", "_source_file", "_ingestion_date")


@query
def stream_landing(s: Star):
    """Events that land as JSON files in two arrivals, with lineage, in the append sink; the second run goes on where the
    first one ended, and a third finds nothing new."""
    run, events = _run_folder(s.spark), as_donation_events(s.table("events"), F.col("event_id"))
    for arrival in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1, None):
        if arrival is not None:
            landed.land_events(events.where(arrival).drop("event_id"), f"{run}/landing")
        live = ingest.event_stream(s.spark, f"{run}/landing", FILES_AT_ONCE, s.events().schema, one_per_file=False)
        ingest.drain(ingest.append_sink(ingest.with_stream_lineage(live), f"{run}/sink", f"{run}/checkpoint", f"landing-{uuid4().hex}"))
    stored = s.spark.read.parquet(f"{run}/sink")
    return stored.select(
        *s.events().columns, F.col("_source_file").rlike(r"/landing/[^/]+\.json\.gz$").alias("from_landing"),
        (F.col("_ingestion_date") == F.to_date("_ingested_at")).alias("dated_by_its_clock"))


@query
def stream_progress(s: Star):
    """Rows that each run of a stream read, from the stored log of its micro-batches."""
    run, log = _run_folder(s.spark), ingest.ProgressLog()
    s.spark.streams.addListener(log)
    try:
        for number, arrival in enumerate(_arrivals(s)):
            landed.land_events(arrival, f"{run}/landing")
            live = ingest.event_stream(s.spark, f"{run}/landing", FILES_AT_ONCE, arrival.schema, one_per_file=False)
            stream = ingest.append_sink(live, f"{run}/sink", f"{run}/checkpoint", f"run {number}")
            ingest.drain(stream)
            log.store(s.spark, stream, f"{run}/progress")
    finally:
        s.spark.streams.removeListener(log)
    return s.spark.read.parquet(f"{run}/progress").groupBy("query_name").agg(
        F.sum("input_rows").alias("input_rows"), (F.count_distinct("batch_id") == F.count(F.lit(1))).alias("one_entry_per_batch"))


# ---- files and layers ------------------------------------------------------------------------

@query
def bronze_round_trip(s: Star):
    """Raw CSV tables into the first layer: rows read, rows stored, and stored rows without their lineage."""
    lake = layers.Lake(_run_folder(s.spark))
    landed.land_tables(s, lake)
    counts = layers.run_bronze(s.spark, lake)

    def unmarked(name: str) -> DataFrame:
        stored = files.read_table(s.spark, lake.bronze(name), name, [*schemas.REQUIRED.get(name, []), *schemas.LINEAGE])
        marked = F.coalesce((F.col("_source_file") == f"{name}.csv") & (F.col("_ingestion_date") == F.to_date("_ingested_at")), F.lit(False))
        return stored.agg(F.lit(name).alias("table_name"), F.count_if(~marked).alias("unmarked_rows"))

    return counts.join(checks.combined([unmarked(name) for name in schemas.RAW_TABLES]), "table_name")


@query
def ledger_from_csv(s: Star):
    """Balances from the movement ledger as a CSV file."""
    lake = layers.Lake(_run_folder(s.spark))
    landed.land_movements(s, lake)
    return ledger.balances(files.read_ledger(s.spark, lake.raw("inventory_transactions")), s.policy)


@query
def transfers_from_csv(s: Star):
    """Validity of transfers that came as a CSV file, and of those of a lake that has no such file."""
    lake, bare = (layers.Lake(_run_folder(s.spark)) for _ in range(2))
    landed.land_movements(s, lake)

    def counted(name: str, place: layers.Lake) -> DataFrame:
        listed = files.read_optional_csv(s.spark, place.raw("blood_transfers"), schemas.TRANSFERS)
        banks = s.banks().withColumn("blood_bank_id", F.col("blood_bank_id").cast("string"))
        return transfers.validity_counts(transfers.checked(listed, banks)).select(F.lit(name).alias("lake"), "*")

    return checks.combined([counted("with transfers", lake), counted("without", bare)])


@query
def silver_metrics(s: Star):
    """Layer counts as the second layer stores them: raw CSV and JSON events, through both layers."""
    lake = layers.Lake(_run_folder(s.spark))
    with shuffles_released(s.spark):
        layers.together(s.spark, lambda: landed.land_tables(s, lake), lambda: landed.land_events(s.events(), lake.landing()))
        layers.run_bronze(s.spark, lake)
        layers.run_stream(s.spark, lake, one_per_file=False)
        return layers.run_silver(s.spark, lake, s.policy)


@query
def layered_job(s: Star):
    """The whole job from raw files to published tables; what its stored checks say about tables, keys, scales and stream."""
    lake = layers.Lake(_run_folder(s.spark))
    with shuffles_released(s.spark):
        layers.together(
            s.spark,
            lambda: landed.land_tables(s, lake), lambda: landed.land_movements(s, lake),
            lambda: landed.land_events(s.events(), lake.landing()),
        )
    layers.run_all(s.spark, lake, s.policy, one_per_file=False)
    report = s.spark.read.schema(checks.SHAPE).json(lake.report())
    return report.where(F.col("section").isin("bronze", "silver", "gold", "duplicates", "boundaries", "streaming")).drop("detail")
