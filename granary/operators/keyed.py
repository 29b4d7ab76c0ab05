"""Operators about keys: dedup, duplicates, lookups, orphans, membership and side-by-side comparison.

Shared rule: rows are pre-aggregated per key before they cross the network wherever the result
allows it, so one key that holds a large share of the rows collapses on the map side. Joins carry
no broadcast hints; the size-checked threshold and adaptive execution choose the strategy and
split skewed partitions.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def _slot_of(columns: Sequence[Column]) -> Column:
    return F.xxhash64(*columns)


def _no_slot(columns: Sequence[Column]) -> Column:
    """Zero that follows from columns, so that it is not folded out of a join key; unlike a hash it packs to nothing."""
    return _slot_of(columns).bitwiseAND(F.lit(0).cast("bigint"))


def dedupe(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = (), collapse_null_keys: bool = False,
           known_first: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``prefer``, then by every other column.

    NULL is smallest; in the columns ``known_first``, where it means that a copy does not know the value, it is largest.

    Built as ``min(struct)`` rather than a row number over a sorted group: the minimum combines
    on the map side, so a key with very many copies is never collected in one task, and the
    winner does not depend on row order. Rows with a NULL key part are distinct facts and are
    all kept unless ``collapse_null_keys`` is set.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c in prefer if c in rest] + [c for c in rest if c not in prefer]
    order = [part for c in ordered for part in ([F.col(c).isNull().alias(f"_no_{c}"), F.col(c)] if c in known_first else [F.col(c)])]
    if not ordered:
        unique = df.distinct()
    else:
        unique = (
            df.groupBy(*keys)
            .agg(F.min(F.struct(*order)).alias("_first"))
            .select(*[c if c in keys else F.col("_first").getField(c).alias(c) for c in df.columns])
        )
    if collapse_null_keys or not any(df.schema[k].nullable for k in keys):
        return unique
    return unique.where(~_any_null(keys)).unionByName(df.where(_any_null(keys)))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def duplicates_removed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows ``dedupe`` takes away."""
    return duplicate_keys(df.where(~_any_null(keys)), keys).agg(
        F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("duplicates_removed")
    )


def attach(fact: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str], spread: str | None = None,
           found: str | None = None) -> DataFrame:
    """Left join that keeps every fact row and adds ``take`` (dimension column -> output name).

    ``on`` maps fact key to dimension key. Fact rows with a NULL key part can match nothing, so
    when ``spread`` names a fact column they take its full hash as a second join key instead of all
    landing on the one partition that NULL hashes to. Rows with a key take zero, as the dimension row does.
    ``found`` adds a flag telling whether the dimension row existed, independent of NULLs in its
    attributes.
    """
    side = dim.select(
        *[F.col(theirs).alias(f"_k{i}") for i, theirs in enumerate(on.values())],
        *[F.col(column).alias(name) for column, name in take.items()],
        _no_slot([F.col(theirs) for theirs in on.values()]).alias("_slot"),
        F.lit(True).alias("_found"),
    )
    kept = fact.columns
    if spread is not None:
        slot = F.when(_any_null(list(on)), _slot_of([F.col(spread)])).otherwise(_no_slot([F.col(ours) for ours in on]))
        fact = fact.withColumn("_fact_slot", slot)
    pairs = [fact[ours] == side[f"_k{i}"] for i, ours in enumerate(on)]
    if spread is not None:
        pairs.append(fact["_fact_slot"] == side["_slot"])
    joined = fact.join(side, reduce(lambda a, b: a & b, pairs), "left")
    extra = [F.coalesce(F.col("_found"), F.lit(False)).alias(found)] if found else []
    return joined.select(*[fact[c] for c in kept], *[side[n] for n in take.values()], *extra)


def attach_with_line(fact: DataFrame, parent: DataFrame, lines: DataFrame, key: tuple[str, str], line_key: tuple[str, str],
                     take: Mapping[str, str], line_take: Mapping[str, str], spread: str, found: str, line_found: str) -> DataFrame:
    """``attach`` of a parent and of one of its lines in one join, so that fact rows travel once for both.

    ``key`` names the parent in the fact and in both dimensions, ``line_key`` what picks a line in the fact and in
    ``lines``. A parent's lines are gathered beside it and laid out as rows, after a row for the facts that none of them
    is for. A parent without lines is found, and so are lines without a parent.
    """
    (ours, theirs), (pick, line) = key, line_key
    gathered = lines.where(~_any_null([theirs, line])).groupBy(F.col(theirs).alias("_of")).agg(F.collect_list(F.struct(
        F.col(line).alias("_line"), *[F.col(column).alias(name) for column, name in line_take.items()], F.lit(True).alias("_line_found"),
    )).alias("_lines"))
    parents = parent.where(F.col(theirs).isNotNull()).select(
        F.col(theirs).alias("_id"), *[F.col(column).alias(name) for column, name in take.items()], F.lit(True).alias("_found")
    )
    names = parents.join(gathered, F.col("_id") == F.col("_of"), "full_outer").withColumns({
        "_k0": F.coalesce("_id", "_of"), "_names": F.coalesce(F.col("_lines._line"), F.array().cast(f"array<{lines.schema[line].dataType.simpleString()}>")),
    })
    # The row at place 0 is the parent's own, with the names of all its lines; those after it are its lines.
    places = names.select("_k0", *take.values(), "_found", "_names", "_lines", F.explode(F.sequence(F.lit(0), F.size("_names"))).alias("_place"))
    own, at = F.col("_place") == 0, F.get("_lines", F.col("_place") - 1)
    side = places.select(
        "_k0", *take.values(), "_found", F.when(own, F.col("_names")).alias("_listed"), _no_slot([F.col("_k0")]).alias("_slot"),
        *[at.getField(c).alias(c) for c in ("_line", *line_take.values(), "_line_found")],
    )
    kept = fact.columns
    fact = fact.withColumn("_fact_slot", F.when(F.col(ours).isNull(), _slot_of([F.col(spread)])).otherwise(_no_slot([F.col(ours)])))
    for_none = ~F.coalesce(F.array_contains(side["_listed"], fact[pick]), side["_listed"].isNull())
    joined = fact.join(side, (fact[ours] == side["_k0"]) & (fact["_fact_slot"] == side["_slot"]) & ((fact[pick] == side["_line"]) | for_none), "left")
    return joined.select(
        *[fact[c] for c in kept], *[side[n] for n in (*take.values(), *line_take.values())],
        F.coalesce("_found", F.lit(False)).alias(found), F.coalesce("_line_found", F.lit(False)).alias(line_found),
    )


def known(fact: DataFrame, column: str, parent: DataFrame, parent_key: str, flag: str, spread: str | None = None) -> DataFrame:
    """Flag rows whose ``column`` exists among the parent's keys; NULL keys are not known."""
    ids = parent.select(F.col(parent_key).alias("_id")).where(F.col("_id").isNotNull()).distinct()
    return attach(fact, ids, {column: "_id"}, {}, spread, flag)


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str, allow_null: bool = False) -> DataFrame:
    """Child keys missing from the parent, with the rows they hold.

    Child rows are counted per key first, so the anti join moves keys, not rows.
    """
    counted = child.groupBy(F.col(key).alias("orphan_key")).agg(F.count(F.lit(1)).alias("row_count"))
    if allow_null:
        counted = counted.where(F.col("orphan_key").isNotNull())
    ids = parent.select(F.col(parent_key).alias("_id"))
    return counted.join(ids, counted["orphan_key"] == ids["_id"], "left_anti")


def orphan_total(child: DataFrame, key: str, parent: DataFrame, parent_key: str, allow_null: bool = False) -> DataFrame:
    """One row: number of orphan child rows."""
    return orphan_keys(child, key, parent, parent_key, allow_null).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphans")
    )


def side_by_side(left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Full-outer comparison of two keyed frames without a join.

    Both sides are stacked and grouped once, which matches NULL key parts with each other and
    shows keys present on one side only. ``measures`` maps a left measure to the right measure
    it is compared with. Output per pair: ``left_<m>``, ``right_<m>``; plus ``in_left``,
    ``in_right``.
    """
    def tagged(df: DataFrame, here: int, names) -> DataFrame:
        values = [
            F.col(name).alias(f"_{side}_{i}") if side == here else F.lit(None).cast(df.schema[name].dataType).alias(f"_{side}_{i}")
            for i, name in enumerate(names) for side in (0, 1)
        ]
        return df.select(*keys, F.lit(here).alias("_side"), *values)

    stacked = tagged(left, 0, list(measures)).unionByName(tagged(right, 1, list(measures.values())))
    aggregates = [
        F.max(f"_{side}_{i}").alias(f"{word}_{name}")
        for i, name in enumerate(measures) for side, word in ((0, "left"), (1, "right"))
    ]
    return stacked.groupBy(*keys).agg(
        *aggregates,
        F.bool_or(F.col("_side") == 0).alias("in_left"),
        F.bool_or(F.col("_side") == 1).alias("in_right"),
    )


def missing_keys(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct source keys the target lacks; NULL parts compare as equal."""
    return source.select(*keys).subtract(target.select(*keys))


def invalid_values(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Values outside the allowed set, NULL included, with their row counts."""
    bad = ~F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    return df.where(bad).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per listed column with its NULL count, from a single pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns], F.count(F.lit(1)).alias("_rows"))
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"), F.col("_rows").alias("row_count"))
        for c in columns
    ])
    return counted.select(F.inline(rows))


def sizes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per group."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: distinct known values per column. Rows fold to combinations first, so that only those are
    expanded, once per column."""
    return df.select(*columns).distinct().agg(*[F.count_distinct(c).alias(c) for c in columns])


def latest_first(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Top ``n`` rows; callers end ``order`` with a unique column so ties are settled."""
    return df.orderBy(*order).limit(n)
