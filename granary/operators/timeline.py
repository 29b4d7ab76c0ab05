"""Joins and running values along time, for keys of any size.

Rows of a key that follow each other are cut into segments of a bounded number of rows. What a segment hands on to
the next (a sum, the last known state) is one small row, so a key with most of the rows is worked on by
many tasks: within a segment by a window, between segments by a window over the small rows.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from granary.operators.shared_store import settle

# Rows of a segment, a power of two: positions count from a multiple of it in every partition.
SEGMENT_ROWS = 1 << 16
_BEFORE = (Window.unboundedPreceding, -1)


def positioned(rows: DataFrame, keys: Sequence[str], order: Sequence[str], segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Adds ``_at``, the place of a row among all by keys and order, and ``_segment``.

    Rows are dealt by ranges of keys and order together, so a large key is spread over partitions. The result
    is settled: places must not change when a lost task runs again. Rows equal in keys and order follow each
    other in any order.
    """
    ranged = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    return settle(ranged.withColumn("_at", F.monotonically_increasing_id())).withColumn("_segment", F.expr(f"_at div {segment_rows}"))


def _with_openings(placed: DataFrame, keys: Sequence[str], column: str, own: Column, carry: Column) -> DataFrame:
    """One more row in front of each segment of a key, which holds in ``column`` what the segments before it
    hand on: ``own`` is the aggregate of a segment, ``carry`` folds those of earlier ones."""
    folded = placed.groupBy(*keys, "_segment").agg(own.alias("_own"))
    earlier = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(*_BEFORE)
    openings = folded.select(*keys, "_segment", F.lit(-1).cast("long").alias("_at"), carry.over(earlier).alias(column))
    return placed.unionByName(openings, allowMissingColumns=True)


def _so_far(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, "_segment").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_sum(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Adds the sum of ``value`` over the rows of a key up to each row; NULL values count as nothing.

    Rows equal in keys and order stand one after the other.
    """
    opened = _with_openings(positioned(rows, keys, order, segment_rows), keys, value, F.sum(value), F.sum("_own"))
    summed = opened.withColumn("_total", F.coalesce(F.sum(value).over(_so_far(keys)), F.lit(0)))
    return summed.where("_at >= 0").select(*rows.columns, F.col("_total").alias(name))


def as_of(facts: DataFrame, states: DataFrame, keys: Sequence[str], fact_time: str, state_time: str, take: Sequence[str],
          segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Every fact with the columns ``take`` of the last state of its key that is not later than it.

    Both sides are stacked and the last state is carried forward, so no fact meets any other state of its
    key. A fact without an earlier state, without a time or with a NULL key has NULLs. Of states
    of one key and time the largest by the taken columns counts. States without a time are never known.
    """
    state = F.struct(*[F.col(c).alias(c) for c in take])
    known = states.where(F.col(state_time).isNotNull()).select(*keys, F.col(state_time).alias("_time"), F.lit(0).alias("_turn"), state.alias("_state"))
    asked = facts.select(*keys, F.col(fact_time).alias("_time"), F.lit(1).alias("_turn"), F.struct(*facts.columns).alias("_fact"))
    placed = positioned(known.unionByName(asked, allowMissingColumns=True), keys, ["_time", "_turn", "_state"], segment_rows)
    mark = F.when(F.col("_state").isNotNull(), F.col("_at"))
    opened = _with_openings(placed, keys, "_state", F.max_by("_state", mark), F.last("_own", ignorenulls=True))
    carried = opened.withColumn("_last", F.last("_state", ignorenulls=True).over(_so_far(keys)))
    usable = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.col("_time").isNotNull())
    return carried.where("_turn = 1").withColumn("_known", F.when(usable, F.col("_last"))).select(
        "_fact.*", *[F.col("_known").getField(c).alias(c) for c in take])


def within_intervals(points: DataFrame, intervals: DataFrame, keys: Sequence[str], time: str, start: str, end: str) -> DataFrame:
    """Pairs of a point and an interval of the same key that holds it, both ends included; the columns of both.

    Times are whole numbers (days, seconds). An interval is entered in the cells of its own length's octave,
    three at most; a point looks in one cell of each octave that occurs. So the join is one of equal keys,
    every pair is met once, and no width needs to be chosen. NULL keys, times and ends match nothing, nor
    does an interval that ends before it starts. Columns other than the keys must differ in name.
    """
    lasting = intervals.where(F.col(end) >= F.col(start))
    octave = F.length(F.bin(F.col(end) - F.col(start) + 1))
    filed = lasting.withColumn("_octave", octave)
    octaves = sorted(r["_octave"] for r in filed.select("_octave").distinct().collect())  # 64 at most

    def cell(at: str) -> Column:
        return F.expr(f"shiftright(cast({at} as bigint), _octave)")

    entered = filed.withColumn("_cell", F.explode(F.sequence(cell(start), cell(end)))).withColumnsRenamed({k: f"_i_{k}" for k in keys})
    entered = entered.withColumnsRenamed({"_octave": "_i_octave", "_cell": "_i_cell"})
    looking = points.withColumn("_octave", F.explode(F.array(*map(F.lit, octaves)).cast("array<int>"))).withColumn("_cell", cell(time))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_i_{k}") for k in keys], (F.col("_octave") == F.col("_i_octave")) & (F.col("_cell") == F.col("_i_cell")))
    held = F.col(time).between(F.col(start), F.col(end))
    return looking.join(entered, same & held).select(*points.columns, *[c for c in intervals.columns if c not in keys])


def runs(rows: DataFrame, keys: Sequence[str], order: str, flag: Column) -> DataFrame:
    """Islands: unbroken runs of rows of a key for which ``flag`` holds.

    (keys, run_start, run_end, run_rows, next_start): first and last ``order``, number of rows, and the order of the
    row that ended the run, NULL if it lasts. ``rows`` has few rows per key (days), as folded before. An unknown
    flag ends a run.
    """
    in_order = Window.partitionBy(*keys).orderBy(order)
    marked = rows.withColumn("_on", F.coalesce(flag, F.lit(False)))
    numbered = marked.withColumns({
        "_run": F.sum(F.when(F.col("_on"), 0).otherwise(1)).over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_next": F.lead(order).over(in_order)})
    return numbered.where("_on").groupBy(*keys, "_run").agg(
        F.min(order).alias("run_start"), F.max(order).alias("run_end"), F.count(F.lit(1)).alias("run_rows"),
        F.max_by("_next", order).alias("next_start")).drop("_run")


def pauses(rows: DataFrame, keys: Sequence[str], day: str, least_days: int) -> DataFrame:
    """Gaps: (keys, last_day, next_day, pause_days) where ``least_days`` or more lie between a key's days that
    follow each other. Days fold before the window, so a key has at most one row per day."""
    days = rows.where(F.col(day).isNotNull()).select(*keys, F.col(day).alias("last_day")).distinct()
    following = days.withColumn("next_day", F.lead("last_day").over(Window.partitionBy(*keys).orderBy("last_day")))
    return following.withColumn("pause_days", F.datediff("next_day", "last_day")).where(F.col("pause_days") >= least_days)


def rolling(rows: DataFrame, keys: Sequence[str], day: str, value: str, name: str, days: int) -> DataFrame:
    """(keys, day, ``name``): the sum of ``value`` over a day and the ``days`` - 1 before it, by dates, not rows.

    Rows fold to days first; days without rows have none in the result but count as nothing in the frame.
    """
    folded = rows.where(F.col(day).isNotNull()).groupBy(*keys, F.col(day).alias("day")).agg(F.sum(value).alias("_moved"))
    frame = Window.partitionBy(*keys).orderBy(F.unix_date("day")).rangeBetween(1 - days, Window.currentRow)
    return folded.select(*keys, "day", F.sum("_moved").over(frame).alias(name))
