import datetime as dt
import json

from helpers import by, rows
from granary.operators import board, checks
from granary.sources import schemas
from granary.sources.files import read_optional
from granary.streaming import ingest

BASE = dict(donation_id="E1", donor_id="D1", blood_bank_id="B1", camp_id=None, donation_date="2026-08-12", blood_group="A-",
            units_donated=1, donation_status="Completed", event_time="2026-08-12T20:28:14", source="live", event_type="blood_donation")


def drop(folder, name, **change):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(json.dumps(BASE | change, indent=2))


def run(spark, root):
    events = ingest.with_stream_lineage(ingest.event_stream(spark, str(root / "landing")))
    ingest.drain(ingest.append_sink(events, str(root / "sink"), str(root / "checkpoint"), "test-ingest"))
    return spark.read.parquet(str(root / "sink"))


def test_pretty_printed_files_restart_and_new_arrivals(spark, tmp_path):
    landing = tmp_path / "landing"
    for i in range(4):
        drop(landing, f"f{i}", donation_id=f"E{i}")
    first = run(spark, tmp_path)
    got = by(first, "donation_id")
    assert set(got) == {"E0", "E1", "E2", "E3"}
    assert got["E2"]["event_time"] == dt.datetime(2026, 8, 12, 20, 28, 14) and got["E2"]["donation_date"] == dt.date(2026, 8, 12)
    assert got["E2"]["_source_file"].endswith("/f2.json") and got["E2"]["_ingested_at"] is not None
    assert rows(run(spark, tmp_path)) == rows(first)  # nothing new: nothing ingested again
    drop(landing, "late", donation_id="E2")
    again = run(spark, tmp_path)
    assert again.count() == 5 and again.where("donation_id = 'E2'").count() == 2
    report = {r["check_name"]: r["status"] for r in checks.stream_output(spark, str(tmp_path / "sink"), str(tmp_path / "checkpoint")).collect()}
    assert report == {"events": "PASS", "null_ids": "PASS", "null_event_times": "PASS", "duplicate_ids": "FAIL", "checkpoint": "PASS"}
    assert {r["donation_id"] for r in board.first_ingested(again, "donation_id", 4).collect()} == {"E0", "E1", "E2", "E3"}
    lag = ingest.ingest_lag(again).collect()
    assert all(abs(r["lag_seconds"] - (r["_ingested_at"] - r["event_time"]).total_seconds()) < 1e-3 for r in lag)


def test_missing_sink_is_reported(spark, tmp_path):
    got = checks.stream_output(spark, str(tmp_path / "none"), str(tmp_path / "none")).collect()
    assert [(r["check_name"], r["status"]) for r in got] == [("sink", "FAIL")]


def test_unreadable_cells_become_null(spark, tmp_path):
    drop(tmp_path / "landing", "bad", donation_id="E9", units_donated="many", event_time=None)
    row = run(spark, tmp_path).collect()[0]
    assert (row["units_donated"], row["event_time"]) == (None, None)


def test_polling_run_stops_and_progress_is_logged(spark, tmp_path):
    drop(tmp_path / "landing", "one")
    log = ingest.ProgressLog()
    spark.streams.addListener(log)
    try:
        events = ingest.with_stream_lineage(ingest.event_stream(spark, str(tmp_path / "landing")))
        query = ingest.append_sink(events, str(tmp_path / "sink"), str(tmp_path / "checkpoint"), "polling", every="1 second")
        query.processAllAvailable()
        assert ingest.run_for(query, 0.5) is False and not query.isActive
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(log)
    assert sum(r["input_rows"] for r in log.as_frame(spark).where("query_name = 'polling'").collect()) == 1


def test_admission_splits_batches_and_remembers_earlier_ones(spark, tmp_path, policy):
    donors = spark.createDataFrame([("D1", "A-")], "donor_id string, blood_group string")
    banks = spark.createDataFrame([("B1",)], "blood_bank_id string")
    camps = spark.createDataFrame([("C1",)], "camp_id string")
    admitted, rejected = str(tmp_path / "admitted"), str(tmp_path / "rejected")

    def admit():
        query = ingest.admit_each_batch(
            ingest.event_stream(spark, str(tmp_path / "landing")), lambda: (donors, banks, camps), policy, admitted, rejected,
            str(tmp_path / "checkpoint"), "admission")
        ingest.drain(query)

    drop(tmp_path / "landing", "a", donation_id="E1")
    drop(tmp_path / "landing", "b", donation_id="E2", donor_id="ghost")
    admit()
    drop(tmp_path / "landing", "c", donation_id="E1")
    drop(tmp_path / "landing", "d", donation_id="E3")
    admit()
    assert rows(spark.read.parquet(admitted), "donation_id") == [("E1",), ("E3",)]
    assert rows(spark.read.parquet(rejected), "donation_id", "reject_reason") == [
        ("E1", "Duplicate donation_id"), ("E2", "Unknown donor_id")]
    admit()
    assert spark.read.parquet(admitted).count() == 2


def test_live_feed_shows_latest_first(spark, policy):
    events = spark.createDataFrame(
        [(f"E{i}", "D", "B", None, None, "O-" if i % 2 else "A+", 1, "Completed", dt.datetime(2026, 1, 1, 0, 0, i), "live", "x") for i in range(40)],
        schemas.DONATION_EVENT)
    feed = board.live_feed(events, policy).collect()
    assert len(feed) == 25 and feed[0]["donation_id"] == "E39" and feed[0]["is_rare"] and feed[0]["event_clock"] == "00:00:39"


def test_absent_table_is_none(spark, tmp_path):
    assert read_optional(spark, str(tmp_path / "nothing")) is None


def test_of_identical_events_one_is_admitted(spark, policy):
    from granary.operators.admission import judge

    donors = spark.createDataFrame([("D1", "A-")], "donor_id string, blood_group string")
    banks = spark.createDataFrame([("B1",)], "blood_bank_id string")
    camps = spark.createDataFrame([("C1",)], "camp_id string")
    event = ("E1", "D1", "B1", None, dt.date(2026, 1, 1), "A-", 1, "Completed", dt.datetime(2026, 1, 1, 9), "live", "x")
    later = (*event[:8], dt.datetime(2026, 1, 1, 10), "live", "x")
    bad = (*event[:1], "ghost", *event[2:8], dt.datetime(2026, 1, 1, 8), "live", "x")
    events = spark.createDataFrame([event, event, event, later, bad], schemas.DONATION_EVENT)
    for parts in (1, 7):
        judged = judge(events.repartition(parts), donors, banks, camps, spark.createDataFrame([], "donation_id string"), policy)
        assert rows(judged, "admitted", "reject_reason", "event_time") == sorted(
            [(True, None, event[8]), *[(False, "Duplicate donation_id", event[8])] * 2, (False, "Duplicate donation_id", later[8]),
             (False, "Unknown donor_id", bad[8])], key=lambda t: [(v is not None, v) for v in t])


def test_replayed_batch_leaves_one_verdict(spark, tmp_path, policy):
    """The same files, once with the donor known and once without: the second run replaces the first."""
    banks = spark.createDataFrame([("B1",)], "blood_bank_id string")
    camps = spark.createDataFrame([("C1",)], "camp_id string")
    admitted, rejected = str(tmp_path / "admitted"), str(tmp_path / "rejected")
    drop(tmp_path / "landing", "a", donation_id="E1")
    drop(tmp_path / "landing", "b", donation_id="E2")
    for run_, donor in enumerate(("D1", "ghost")):
        donors = spark.createDataFrame([(donor, "A-")], "donor_id string, blood_group string")
        ingest.drain(ingest.admit_each_batch(
            ingest.event_stream(spark, str(tmp_path / "landing")), lambda: (donors, banks, camps), policy, admitted, rejected,
            str(tmp_path / f"checkpoint{run_}"), f"replay{run_}"))
        counts = (spark.read.parquet(admitted).count(), spark.read.parquet(rejected).count(), spark.read.parquet(f"{admitted}_ids").count() if not run_ else 0)
        assert counts == ((2, 0, 2), (0, 2, 0))[run_]


def test_stored_progress_leaves_the_driver_and_adds_up(spark, tmp_path):
    log = ingest.ProgressLog()
    spark.streams.addListener(log)
    try:
        for n, name in enumerate(("one", "two", "three")):
            drop(tmp_path / "landing", name, donation_id=name)
            events = ingest.with_stream_lineage(ingest.event_stream(spark, str(tmp_path / "landing")))
            query = ingest.append_sink(events, str(tmp_path / "sink"), str(tmp_path / "checkpoint"), f"progress-{n}")
            ingest.drain(query)
            log.store(spark, query, str(tmp_path / "progress"))
            assert not log.entries and not log._ended
    finally:
        spark.streams.removeListener(log)
    stored = spark.read.parquet(str(tmp_path / "progress"))
    assert rows(stored.where("input_rows > 0"), "query_name", "batch_id", "input_rows") == [(f"progress-{n}", n, 1) for n in range(3)]


def test_a_warehouse_of_one_machine_is_refused_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from granary.operators.shared_store import shared_folder

    def session(master, warehouse, named=None):
        folders = [named]
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: folders[0], setCheckpointDir=lambda f: folders.__setitem__(0, f))
        options = {"spark.sql.warehouse.dir": warehouse}
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: options.get(key, default)))

    for warehouse in ("file:/home/me/spark-warehouse", "/home/me/spark-warehouse"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session("yarn", warehouse))
        assert shared_folder(session("local[8]", warehouse)) == f"{warehouse}/_checkpoints"
        assert shared_folder(session("yarn", warehouse, "hdfs:///shared")) == "hdfs:///shared"
    assert shared_folder(session("yarn", "hdfs:///warehouse")) == "hdfs:///warehouse/_checkpoints"
