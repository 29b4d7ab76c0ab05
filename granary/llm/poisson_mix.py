"""Mixing sources to target weights by Poisson replication.

A source's rate is its target number of documents over the number it has. Every document draws its
number of copies from a Poisson distribution with that mean by inverting the distribution function at
a uniform number hashed from (seed, doc_id, text), so a rerun draws the same and no coordination between
tasks is needed. Copies are exploded and shuffled over the whole output by a second hash.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import fresh, packed, unpacked

# The largest mean inverted in one piece; a larger rate is the sum of equal independent pieces.
PIECE = 16.0


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the md5 of the parts: 52 bits, never 0 or 1."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(2**52))


def rates(documents: DataFrame, weights: Mapping[str | None, float] | None, total: float | None, source: str = "source",
          power: float = 0.0) -> DataFrame:
    """Per source: rows, target share and rate. One partial aggregate over the sources.

    ``weights`` gives target weights by source name (None for the NULL source); sources it leaves out
    get weight 0. Without it a source weighs rows ** power, so 0 means equal shares. ``total`` is the
    expected size of the output, by default the size of the input.
    """
    counted = documents.groupBy(F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("_rows"))
    if weights is None:
        weight = F.pow(F.col("_rows").cast("double"), F.lit(float(power)))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("_source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    weighed = counted.withColumn("_weight", weight)
    sums = weighed.agg(F.sum("_weight").alias("w"), F.sum("_rows").cast("double").alias("n")).select(F.struct("w", "n").alias("s")).scalar()
    wanted = F.lit(float(total)) if total is not None else F.col("_sums.n")
    share = F.when(F.col("_sums.w") > 0, F.col("_weight") / F.col("_sums.w")).otherwise(F.lit(0.0))
    return weighed.withColumn("_sums", sums).select("_source", "_rows", share.alias("_share"), (wanted * share / F.col("_rows")).alias("_rate"))


def inverse(u: Column, table: Column) -> Column:
    """How many steps of a distribution table lie below ``u``."""
    return F.size(F.filter(table, lambda step: step < u))


def with_tables(rate: DataFrame) -> DataFrame:
    """Adds the number of equal pieces of each rate and the piece's distribution function, up to where
    its tail is far below the 52 bits of the uniform numbers."""
    pieces = F.greatest(F.lit(1), F.ceil(F.col("_rate") / F.lit(PIECE))).cast("int")
    mean = F.col("_mean")
    steps = F.sequence(F.lit(0), F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int"))
    cumulated = F.aggregate(
        steps, F.struct(F.array().cast("array<double>").alias("table"), F.exp(-mean).alias("p"), F.lit(0.0).alias("sum")),
        lambda acc, k: F.struct(
            F.concat(acc["table"], F.array(acc["sum"] + acc["p"])).alias("table"),
            (acc["p"] * mean / (k + 1)).alias("p"), (acc["sum"] + acc["p"]).alias("sum")),
        lambda acc: acc["table"],
    )
    return rate.withColumn("_pieces", pieces).withColumn("_mean", F.col("_rate") / F.col("_pieces")).withColumn("_table", cumulated)


def replicate(documents: DataFrame, weights: Mapping[str | None, float] | None = None, total: float | None = None, seed: str = "mix",
              source: str = "source", power: float = 0.0, copy: str = "copy", shuffle: bool = True) -> DataFrame:
    """Every document as often as its draw says (0 times for some), with ``copy`` from 0 on.

    Defined for odd input: a NULL source is a source of its own; NULL ids and texts are hashed as the
    word null; rows with equal (doc_id, text) draw the same number, each for itself; an empty table
    gives an empty result. All columns are kept; if one is called ``copy`` the new one gets a name with
    an underscore. A hot source is split by adaptive execution or met by a broadcast of the small rates.
    """
    copy = fresh(documents, copy)
    kept = documents.columns
    table = with_tables(rates(documents, weights, total, source, power)).select("_source", "_pieces", "_table")
    whole = documents.select(packed(kept).alias("_kept"), F.col(source).alias("_own"))
    joined = whole.join(table, F.col("_own").eqNullSafe(F.col("_source")), "left")
    number, text = F.col("_kept.doc_id"), F.col("_kept.text")
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("_pieces")), F.lit(0),
        lambda total_, piece: total_ + inverse(uniform(F.lit(seed), number, F.md5(F.coalesce(text, F.lit("null"))), piece), F.col("_table")),
    )
    spread = joined.select("_kept", drawn.alias("_copies")).where("_copies > 0").select("_kept", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_copy"))
    if shuffle:
        width = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        place = F.xxhash64(F.lit(seed), number, text, F.col("_copy"))
        spread = spread.withColumn("_place", place).repartition(width, "_place").sortWithinPartitions(F.xxhash64("_place"), "_copy")
    return spread.select(*unpacked("_kept", kept), F.col("_copy").alias(copy))
