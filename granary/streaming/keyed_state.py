"""Admission of live events by a state that knows each admitted donation id: no earlier output is read again."""

from __future__ import annotations

from contextlib import contextmanager
from itertools import chain
from operator import itemgetter
from typing import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from granary.operators.admission import failing, with_dimensions
from granary.policy import Policy

# Fixed value: the state store that keeps state on disk and checkpoints its changes.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DUPLICATE = "Duplicate donation_id"
# Ids are judged by buckets, each with a map of its ids in the state store; a stored state fixes the number.
BUCKETS = 4096
# Events of a bucket that wait in memory; more of them wait in the state store.
HELD_AT_ONCE = 10_000


@contextmanager
def state_settings(spark: SparkSession, **more: str) -> Iterator[None]:
    """Session settings that a query started inside keeps: RocksDB state, one state partition per core (a
    query's state can't be dealt anew later, so it does not go by the shuffle width of batch jobs) and what
    ``more`` names."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism),
              **{k.replace("__", "."): v for k, v in more.items()}}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _admit_once(columns: list[str], shapes: dict[str, str], waiting: str, keep_ms: int | None) -> StatefulProcessor:
    """The processor of the ids of one bucket; a local class, so that executors need no copy of this package."""
    others, held_at_once = [c for c in columns if c != "event_time"], HELD_AT_ONCE

    class AdmitOnce(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.admitted = handle.getMapState("admitted", f"donation_id {shapes['donation_id']}", f"event_time {shapes['event_time']}", keep_ms)
            # Events that break a rule wait for the end of the batch, many of them on disk: who came first is known only then.
            self.waiting = handle.getListState("waiting", waiting)

        def handleInputRows(self, key: tuple, rows: Iterator[Row], timers: object) -> Iterator[Row]:
            def order(row: tuple) -> list[tuple]:
                named = dict(zip(columns, row))
                return [(named[c] is not None, named[c] if named[c] is not None else 0) for c in ("event_time", *others)]

            verdict, place = Row(*columns, "reject_reason"), columns.index("donation_id")

            def judged(row: tuple, reason: str | None) -> Row:
                return verdict(*row, reason)

            # Every question to the state store is a message to another process: one per id, none while the bucket is empty.
            empty, known, first, held, stored, take = not self.admitted.exists(), {}, {}, [], False, None
            for full in rows:
                take = take or itemgetter(*map(full.__fields__.index, (*columns, "_failing")))
                *row, fault = take(full)
                id_ = row[place]
                if id_ not in known:
                    known[id_] = not empty and self.admitted.containsKey((id_,))
                if known[id_]:
                    yield judged(row, DUPLICATE)
                elif fault is not None:
                    held.append((*row, fault))
                    if len(held) == held_at_once:
                        self.waiting.appendList(held)
                        held, stored = [], True
                elif id_ not in first:
                    first[id_] = row
                else:
                    earlier, later = (row, first[id_]) if order(row) < order(first[id_]) else (first[id_], row)
                    first[id_] = earlier
                    yield judged(later, DUPLICATE)
            opening = {id_: order(row) for id_, row in first.items()}
            for kept in chain(held, self.waiting.get() if stored else ()):
                *row, fault = kept
                yield judged(row, DUPLICATE if row[place] in opening and order(row) > opening[row[place]] else fault)
            if stored:
                self.waiting.clear()
            for id_, row in first.items():
                self.admitted.updateValue((id_,), (row[columns.index("event_time")],))
                yield judged(row, None)

        def close(self) -> None:
            pass

    return AdmitOnce()


def judged_stream(events: DataFrame, dimensions: tuple[DataFrame, DataFrame, DataFrame], policy: Policy, keep_ms: int | None = None) -> DataFrame:
    """The stream with ``reject_reason`` (NULL if admitted) and ``admitted``.

    Rules as in ``admission.judge``. Whether an id was admitted is a value of its own in the state store; with
    ``keep_ms`` it is forgotten that long (by the wall clock) after its admission, so state stays bounded, and
    without it never. Donors, banks and camps are read as they are when the query starts. Events without an
    id are judged by the rules alone and need no state. A batch's events of one id are read one by one; ids meet
    in Python by buckets, as a call and its messages for each id would cost more than all the judging.
    """
    spread = "_spread"
    wide = with_dimensions(events.withColumn(spread, F.xxhash64(*events.columns)), *dimensions, spread)
    # Points in time go through Python as numbers: they come out of the state in another form than they went in.
    instants = [f.name for f in events.schema.fields if isinstance(f.dataType, T.TimestampType)]
    ruled = wide.select(*[F.unix_micros(c).alias(c) if c in instants else c for c in events.columns], failing(policy).alias("_failing"))
    fields = ruled.schema.fields[:-1]
    kept = T.StructType([*fields, T.StructField("reject_reason", T.StringType())])
    processor = _admit_once(events.columns, {f.name: f.dataType.simpleString() for f in fields}, _ddl(ruled.schema), keep_ms)
    bucket = F.pmod(F.xxhash64("donation_id"), F.lit(BUCKETS)).cast("int")
    keyed = ruled.where("donation_id is not null").withColumn("_bucket", bucket).groupBy("_bucket").transformWithState(
        processor, kept, "Append", "None" if keep_ms is None else "ProcessingTime")
    unnamed = ruled.where("donation_id is null").withColumnRenamed("_failing", "reject_reason")
    verdicts = keyed.unionByName(unnamed).withColumns({c: F.timestamp_micros(c) for c in instants})
    return verdicts.withColumn("admitted", F.col("reject_reason").isNull())


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def admit_by_state(events: DataFrame, dimensions: tuple[DataFrame, DataFrame, DataFrame], policy: Policy, verdicts: str, checkpoint: str, name: str,
                   keep_ms: int | None = None) -> StreamingQuery:
    """Append the verdict on every event to a Parquet table, until what has arrived is read.

    A restart goes on from the checkpoint, which holds the state of the ids. The sink's own log hides what a
    failed batch wrote, so a replay leaves one verdict per event.
    """
    # With a time to live every batch without data would call for another one, and the run would not end.
    with state_settings(events.sparkSession, spark__sql__streaming__noDataMicroBatches__enabled="false"):
        return (
            judged_stream(events, dimensions, policy, keep_ms).writeStream.format("parquet").outputMode("append").queryName(name)
            .option("path", verdicts).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
