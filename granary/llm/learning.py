"""Bounded samples of labelled rows for models that are fitted on the driver."""

from __future__ import annotations

from typing import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import fold_of


# Up to this many sampled ids (two numbers each) are sent to all tasks; a larger sample meets the documents in a shuffle.
BROADCAST_ROWS = 1_000_000


def labelled_features(documents: DataFrame, labels: DataFrame, label: str, features: Callable[[DataFrame], DataFrame], bound: int,
                      folds: int = 3, held_out: int = 1) -> pa.Table:
    """(label, features) of at most ``bound`` labelled documents outside the held-out fold.

    The label rows with the smallest hashes are taken, so the sample is the same on every run and does
    not depend on the layout. Rows with a NULL id or label teach nothing. Up to
    ``BROADCAST_ROWS`` sampled ids are broadcast; ``features`` maps (doc_id, text, label) to
    the columns to be learned from and runs in tasks.
    """
    fold = fold_of("doc_id", folds)
    rows = labels.where(F.col(label).isNotNull() & (fold != held_out)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    order = F.xxhash64(F.col("doc_id"), F.lit(7))
    picked = rows.orderBy(order, "doc_id", "label").limit(bound)
    known = F.broadcast(picked) if bound <= BROADCAST_ROWS else picked
    joined = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(known, "doc_id")
    return features(joined).orderBy(order, "doc_id", "label").limit(bound).toArrow()
