"""Centroid clustering of whole-numbered vectors by scalar lookup tables.

Components are whole numbers, so a dimension takes few different values. In every round a task notes which
values occur in each dimension of its rows and tabulates the squared difference of each of them to each
centroid; a row's distances are then sums of table entries gathered by its values. Distances and sums are
exact integers, so the result does not depend on how rows are dealt to tasks.

A round reads the vectors once and returns, per task, one sum and count for each centroid and dimension;
these are added up by Spark, and the centroids, k rows of fixed length, go back to the tasks.
"""

from __future__ import annotations

import hashlib
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.shipping import ship
from granary.operators.shared_store import settle

# Rows whose distances are gathered at once.
SLAB = 8192
# Squared distances of 64 components below this size fit 64 bits.
LARGEST = 1 << 27


class Rule(NamedTuple):
    """Components of a vector, centroids, rounds, the factor before components are cut to whole numbers."""

    dimensions: int = 64
    clusters: int = 16
    rounds: int = 3
    scale: int = 64
    seed: str = "1"


def usable(embeddings: DataFrame, rule: Rule) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: the right length, no NULL or non-finite component."""
    vector = F.col("embedding").cast("array<double>")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # Vectors of unknown length are NULL here, and so left out.
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding")).where((F.size("embedding") == rule.dimensions) & ~odd)


def whole(column: pa.Array, rule: Rule) -> np.ndarray:
    """Rows of floor(scale * component)."""
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, rule.dimensions) * rule.scale)
    if values.size and np.abs(values).max() >= LARGEST:
        raise ValueError(f"a component times {rule.scale} is over {LARGEST}: squared distances may not fit 64 bits")
    return values.astype(np.int64)


# ---- tables ----------------------------------------------------------------------------------

def occurring(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different values of one dimension, and each row's place among them."""
    low, span = int(values.min()), int(values.max()) - int(values.min()) + 1
    if span > 4 * len(values):
        return np.unique(values, return_inverse=True)
    met = np.zeros(span, bool)
    met[values - low] = True
    return np.flatnonzero(met) + low, (np.cumsum(met) - 1)[values - low]


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of every row to every centroid, summed from one table per dimension."""
    total = np.zeros((len(rows), len(centroids)), np.int64)
    for own, middle in zip(rows.T, centroids.T):
        values, place = occurring(own)
        table = (values[:, None] - middle[None, :]) ** 2
        total += table[place]
    return total


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest centroid (ties: the smaller number) and its squared distance."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for at in range(0, len(rows), SLAB):
        far = distances(rows[at:at + SLAB], centroids)
        own = far.argmin(axis=1)
        found.append((own, far[np.arange(len(own)), own]))
    return tuple(np.concatenate(part) for part in zip(*found))


# ---- rounds ----------------------------------------------------------------------------------

def first_centroids(vectors: DataFrame, rule: Rule) -> np.ndarray:
    """The vectors whose ids have the smallest SHA-256, in that order; equal ids by their components, no id last."""
    digest = F.sha2(F.concat(F.lit(f"{rule.seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    picked = vectors.orderBy(digest.asc_nulls_last(), "embedding").limit(rule.clusters).select("embedding").toArrow()
    return whole(picked.column("embedding").combine_chunks(), rule)


def moved(vectors: DataFrame, centroids: np.ndarray, rule: Rule) -> np.ndarray:
    """The centroids after one round; those that no vector is nearest to stay."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            rows = whole(batch.column("embedding"), rule)
            own, _ = nearest(rows, centroids)
            np.add.at(counts, own, 1)
            for cluster in np.unique(own):
                sums[cluster] += rows[own == cluster].sum(axis=0)
        cluster, dimension = np.divmod(np.arange(sums.size), rule.dimensions)
        met = counts[cluster] > 0
        yield pa.RecordBatch.from_arrays([pa.array(c[met]) for c in (cluster, dimension, sums.ravel(), counts[cluster])], ["cluster", "dimension", "total", "n"])

    parts = vectors.select("embedding").mapInArrow(add, "cluster long, dimension long, total long, n long")
    sums = parts.groupBy("cluster", "dimension").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("total", "n")])
    after = centroids.copy()
    for row in sums.collect():  # one per centroid and dimension
        after[row["cluster"], row["dimension"]] = int(row["total"]) // int(row["n"])
    return after


def fit(vectors: DataFrame, rule: Rule) -> np.ndarray:
    centroids = first_centroids(vectors, rule)
    for _ in range(rule.rounds if len(centroids) else 0):
        centroids = moved(vectors, centroids, rule)
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray, rule: Rule) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, far = nearest(whole(batch.column("embedding"), rule), centroids)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(own, pa.int32()), pa.array(far)], ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(embeddings: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 for every vector that takes part.

    Vectors of another length, NULL vectors and those with a NULL or non-finite component are left out.
    Repeated rows are vectors of their own, also as first centroids; a row without vec_id takes part, but is
    a first centroid only if there are too few others. With fewer vectors than clusters there are fewer
    centroids; no vectors give no rows. Components beyond 2^27 in size after scaling end the job with an
    error, as distances might not fit 64 bits. Other columns are not carried.
    """
    spark = embeddings.sparkSession
    ship(spark)
    vectors = usable(embeddings, rule)
    centroids = fit(vectors, rule)
    if not len(centroids):
        return vectors.select("vec_id", *[F.lit(None).cast(kind).alias(name) for name, kind in RESULT]).limit(0)
    assigned = settle(assign(vectors, centroids, rule))
    return assigned.join(F.broadcast(_totals(spark, assigned, centroids)), "cluster").select("vec_id", *[name for name, _ in RESULT])


RESULT = (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))


def _totals(spark: SparkSession, assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """One row per non-empty cluster, at most as many as there are centroids: small enough to broadcast."""
    sums = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    lines = [(c, total, sum(sums.values()), digest(centroids[c])) for c, total in sorted(sums.items())]
    return spark.createDataFrame(lines, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
