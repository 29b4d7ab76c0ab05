"""Several groupings in one pass, tables turned on their side, and tables compared with multiplicities."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def totals_by_sets(rows: DataFrame, sets: Sequence[Sequence[str]], measures: Mapping[str, str]) -> DataFrame:
    """Sums of ``measures`` (column -> output name) for several sets of grouping columns at once.

    Rows fold to the finest grouping first, so only folded rows are expanded, once per set. Columns out of a
    set are NULL; ``grouping_id`` tells them from real NULLs (a bit per column, set if it was left out,
    the first column highest).
    """
    columns = list(dict.fromkeys(c for group in sets for c in group))
    folded = rows.groupBy(*columns).agg(*[F.sum(c).alias(f"_{c}") for c in measures])
    return folded.groupingSets([[F.col(c) for c in group] for group in sets], *columns).agg(
        F.grouping_id().cast("int").alias("grouping_id"), *[F.sum(f"_{c}").alias(name) for c, name in measures.items()])


def wide(rows: DataFrame, keys: Sequence[str], names: str, value: str, columns: Mapping[str, str]) -> DataFrame:
    """One row per key, a column for each name in ``columns`` (name -> column): the sum of its values, NULL if none.

    The columns come from a fixed list, not from the data: the result's shape is known before it is read, and
    names that the list lacks are left out.
    """
    turned = rows.groupBy(*keys).pivot(names, list(columns)).agg(F.sum(value))
    return turned.select(*keys, *[F.col(f"`{name}`").alias(column) for name, column in columns.items()])


def tall(matrix: DataFrame, keys: Sequence[str], names: str, value: str, columns: Mapping[str, str]) -> DataFrame:
    """The inverse of ``wide``: one row per key and name that has a value."""
    back = {column: name for name, column in columns.items()}
    rows = matrix.unpivot(list(keys), list(back), "_column", value)
    name = F.create_map(*[F.lit(x) for pair in back.items() for x in pair])[F.col("_column")]
    return rows.where(F.col(value).isNotNull()).select(*keys, name.alias(names), value)


def counted_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that the sides hold differently often, with ``left_count`` and ``right_count``.

    EXCEPT ALL both ways in one grouping: copies count, and NULL equals NULL. Equal rows are counted on each side
    before they are shuffled; nothing is sorted whole. Both sides must have the same columns.
    """
    both = left.select("*", F.lit(1).alias("left_count"), F.lit(0).alias("right_count")).unionByName(
        right.select("*", F.lit(0).alias("left_count"), F.lit(1).alias("right_count")))
    counts = both.groupBy(*left.columns).agg(*[F.sum(c).cast("bigint").alias(c) for c in ("left_count", "right_count")])
    return counts.where("left_count <> right_count")


def in_common(left: DataFrame, right: DataFrame) -> DataFrame:
    """INTERSECT ALL, folded: each row that both sides hold, and how often both do (``both_count``)."""
    both = left.select("*", F.lit(True).alias("_left")).unionByName(right.select("*", F.lit(False).alias("_left")))
    counts = both.groupBy(*left.columns).agg(F.count_if("_left").alias("_l"), F.count_if(~F.col("_left")).alias("_r"))
    return counts.withColumn("both_count", F.least("_l", "_r")).where("both_count > 0").drop("_l", "_r")
