"""Approximate nearest neighbours with a permutation index.

A vector is represented by its nearest pivots in order. Blocks of the index keep inverted files: for
every pivot, the vectors that have it among their nearest, with its place in their order. A query
walks the files of its own pivots and adds up how far the two orders agree; ranking by that sum is
ranking by the Spearman footrule distance of the truncated orders. The best share of every block is then
reranked by exact inner products in double precision.

For orders cut at m places, where an absent pivot counts as place m, the footrule distance is
m (m + 1) - 2 * sum over shared pivots of (m - max(place in query, place in vector)).
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.shipping import ship

PIVOTS = 256
LENGTH = 64
SHARE = 0.25
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
LEAST_BLOCKS = 4


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows that take part: known key, finite components without NULL, not all zero, of the most frequent
    length (the longer on ties). Columns ``_key`` and ``_vector`` (array<double>)."""
    wide = vectors.select(F.col(key).cast("long").alias("_key"), F.col(vector).cast("array<double>").alias("_vector"))
    sound = wide.where(
        F.col("_key").isNotNull() & (F.size("_vector") > 0)
        & F.forall("_vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("_vector", lambda x: x != 0)
    )
    lengths = sound.groupBy(F.size("_vector").alias("_size")).agg(F.count(F.lit(1)).alias("_n"))
    usual = lengths.agg(F.max(F.struct("_n", "_size")).alias("_most")).select("_most._size").scalar()
    return sound.where(F.size("_vector") == usual)


def choose_pivots(rows: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """At most ``pivots`` different vectors from a bounded sample: the 8 * pivots smallest key hashes."""
    sample = rows.orderBy(F.xxhash64(F.lit(23), F.col("_key")), "_key", "_vector").limit(8 * pivots).select("_vector").collect()
    seen = dict.fromkeys(tuple(r["_vector"]) for r in sample)
    return np.array(list(seen)[:pivots], float)


def orders(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Per vector its nearest pivots in order, by cosine; equal pivots in the order of their numbers."""
    unit = pivots / np.linalg.norm(pivots, axis=1, keepdims=True)
    return np.argsort(-(vectors @ unit.T), axis=1, kind="stable")[:, :length].astype(np.int16)


def represent(rows: DataFrame, pivots: np.ndarray, length: int = LENGTH) -> DataFrame:
    """Adds ``_order``: the nearest pivots of every row."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                column = batch.column("_vector")
                found = orders(column.flatten().to_numpy().reshape(batch.num_rows, -1), pivots, length)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(found.reshape(-1)), found.shape[1]).cast(pa.list_(pa.int16()))
                yield pa.RecordBatch.from_arrays([batch.column("_key"), column, flat], ["_key", "_vector", "_order"])

    return rows.select("_key", "_vector").mapInArrow(run, "_key long, _vector array<double>, _order array<short>")


class InvertedFiles:
    """The pivot files of one block: rows and places, one run per pivot."""

    def __init__(self, order: np.ndarray, pivots: int) -> None:
        self.rows, self.length = order.shape
        flat = order.reshape(-1)
        by_pivot = np.argsort(flat, kind="stable")
        self.row, self.place = by_pivot // self.length, (by_pivot % self.length).astype(np.int16)
        self.start = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every row of the block to one query order."""
        agree = np.zeros(self.rows, np.int32)
        for place, pivot in enumerate(order):
            a, b = self.start[pivot], self.start[pivot + 1]
            agree[self.row[a:b]] += self.length - np.maximum(self.place[a:b], place)  # a row is in a file once
        return self.length * (self.length + 1) - 2 * agree


def first_copies(vectors: np.ndarray, most: int) -> np.ndarray:
    """Rows in order without those that come after ``most`` equal ones. As ties go to smaller keys, later
    copies can't be among the ``most`` - 1 nearest of any query but themselves."""
    _, same = np.unique(vectors, axis=0, return_inverse=True)
    same = same.reshape(-1)
    grouped = np.argsort(same, kind="stable")
    starts = np.flatnonzero(np.diff(same[grouped], prepend=-1))
    before = np.empty(len(same), np.int64)
    before[grouped] = np.arange(len(same)) - np.repeat(starts, np.diff(starts, append=len(same)))
    return np.flatnonzero(before < most)


def search_block(key: np.ndarray, vectors: np.ndarray, order: np.ndarray, query_key: np.ndarray, queries: np.ndarray,
                 query_order: np.ndarray, pivots: int, nearest: int, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query key, key, score): per query the ``nearest`` of the block's reranked rows."""
    by_key = np.argsort(key, kind="stable")  # ties of distance and score go to smaller keys
    by_key = by_key[first_copies(vectors[by_key], nearest + 1)]
    key, vectors, order = key[by_key], vectors[by_key], order[by_key]
    files = InvertedFiles(order, pivots)
    budget = min(len(key), max(int(np.ceil(share * len(key))), 4 * nearest) + 1)  # one more: the query itself
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for own, query, places in zip(query_key, queries, query_order):
        distance = files.footrule(places)
        limit = np.partition(distance, budget - 1)[budget - 1]
        near, tied = np.flatnonzero(distance < limit), np.flatnonzero(distance == limit)
        picked = np.sort(np.concatenate([near, tied[:budget - len(near)]]))
        picked = picked[key[picked] != own]
        score = (vectors[picked] * query).sum(axis=1)
        best = np.argsort(-score, kind="stable")[:nearest]
        out.append((np.full(len(best), own), key[picked[best]], score[best]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.empty(0, int), np.empty(0, int), np.empty(0))


def search(vectors: DataFrame, is_query, nearest: int, key: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS,
           length: int = LENGTH, share: float = SHARE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``nearest`` rows by inner product for every row that meets the condition ``is_query(key column)``.

    Returns query_id, rank from 1, vec_id, score; ties go to the smaller id; a row is no neighbour of itself
    (nor are other rows with its key). A key that occurs in several rows can be found once for each vector.
    Rows that can't take part (see ``usable``) are neither queries nor neighbours; an empty table gives no rows.

    Index rows are dealt into blocks and queries into groups by hashes, whatever their values, so equal
    vectors in any number spread evenly. A task holds one block and one group. ``share`` of a block is
    reranked: a fixed part, not a fixed number, so recall does not fall as the index grows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    found = choose_pivots(rows, pivots)
    schema = "query_id long, vec_id long, score double"
    if not len(found):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    length = min(length, len(found))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query(F.col("_key"))).alias("q")).first()
    blocks, groups = max(LEAST_BLOCKS, -(-sizes["n"] // block_rows)), max(LEAST_BLOCKS, -(-sizes["q"] // query_rows))
    coded = represent(rows, found, length)

    def dealt(seed: int, parts: int):
        return F.pmod(F.xxhash64(F.lit(seed), F.col("_key"), F.col("_vector")), F.lit(parts)).cast("int")

    def everywhere(parts: int):
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    index = coded.select("*", dealt(29, blocks).alias("_block")).select("*", everywhere(groups).alias("_group"))
    asked = coded.where(is_query(F.col("_key"))).select("*", dealt(31, groups).alias("_group")).select("*", everywhere(blocks).alias("_block"))

    def stack(column: pd.Series, kind) -> np.ndarray:
        return np.stack(column.to_numpy()).astype(kind)

    def run(block: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        if block.empty or group.empty:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        got = search_block(
            block["_key"].to_numpy(), stack(block["_vector"], float), stack(block["_order"], np.int16),
            group["_key"].to_numpy(), stack(group["_vector"], float), stack(group["_order"], np.int16), len(found), nearest, share)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), got)))

    pairs = index.groupBy("_block", "_group").cogroup(asked.groupBy("_block", "_group")).applyInPandas(run, schema)
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
