"""How filters of documents work together: what each of them removes in every order, and its Shapley share.

A document is described by the set of filters that it fails, a bit mask. How many documents a coalition of
filters removes is tabulated for all coalitions from the counts per mask; everything else follows from that
table. A step of an order removes the difference of two coalitions. Shapley values are the exact solution
of constrained least squares: among all additive games with the same total, the one nearest to the table
under the Shapley kernel. Its normal equations are solved in rationals. Their matrix is the same for every
table, so they are solved once for each unit table, and the solution, a rational weight per coalition, is
applied to the tables of all parts by Spark.
"""

from __future__ import annotations

import hashlib
import json
from fractions import Fraction
from functools import lru_cache, reduce
from itertools import permutations
from math import comb, factorial
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import slices
from granary.llm.shipping import ship
from granary.operators.shared_store import settle

UPPER = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"
#: The filters that look at one text alone, in the order of their bits; the last filter, E, looks at the whole table.
FILTERS = "ABCDE"
# A SHA-256 digest as four longs.
DIGEST = ("d0", "d1", "d2", "d3")


# ---- the method ------------------------------------------------------------------------------

def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """Exact solution of a regular linear system for several right sides (Gauss-Jordan elimination)."""
    rows = [[*a, *b] for a, b in zip(matrix, right)]
    size = len(matrix)
    for at in range(size):
        pivot = next(i for i in range(at, size) if rows[i][at])
        rows[at], rows[pivot] = rows[pivot], rows[at]
        rows[at] = [x / rows[at][at] for x in rows[at]]
        for i in range(size):
            if i != at and rows[i][at]:
                rows[i] = [x - rows[i][at] * y for x, y in zip(rows[i], rows[at])]
    return [row[size:] for row in rows]


@lru_cache(maxsize=8)
def shapley_weights(players: int) -> list[list[Fraction]]:
    """weights[i][s]: what the removal of coalition ``s`` (a bit mask) adds to the Shapley value of player ``i``.

    Minimises the sum over proper coalitions of kernel(s) * (v(s) - sum of the values in s)^2 under the
    constraint that all values add up to v(all); the last unknown is the constraint's multiplier.
    """
    everyone, inside = (1 << players) - 1, lambda i, s: s >> i & 1
    kernel = {s: Fraction(players - 1, comb(players, k) * k * (players - k)) for s in range(1, everyone) for k in [s.bit_count()]}
    left = [[sum((w for s, w in kernel.items() if inside(i, s) and inside(j, s)), Fraction(0)) for j in range(players)] + [Fraction(1)] for i in range(players)]
    left.append([Fraction(1)] * players + [Fraction(0)])
    right = [[kernel.get(s, Fraction(0)) * inside(i, s) for s in range(everyone + 1)] for i in range(players)]
    right.append([Fraction(int(s == everyone)) for s in range(everyone + 1)])
    return solve(left, right)[:players]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x)


def coalition_removals(per_mask: Column, players: int) -> Column:
    """Array by coalition: how many each removes, from the array of counts by mask of failed filters."""
    masks = F.sequence(F.lit(0), F.lit((1 << players) - 1))
    return F.transform(masks, lambda s: _sum(F.transform(masks, lambda m: F.when(m.bitwiseAND(s) != 0, per_mask[m]).otherwise(F.lit(0)))))


def audit(flagged: DataFrame, filters: str, measures: Sequence[str] = ()) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``flagged`` has ``part`` (string), ``mask`` (int: bit i is set if the row fails filter i) and boolean
    ``measures``. Columns: part, filter_order, step, filter, kept, removed, redundant, unique_fails, shapley
    (Shapley value times the number of orders: what the filter removes, summed over all orders) and, for
    each measure m, m_lost: rows with it that are removed in the step. NULL measures count as false.
    No rows give no parts. Rows are counted per (part, mask) before they are shuffled; a part has 2^n counts
    and n! orders, so n is a handful.
    """
    players = len(filters)
    masks, orders = 1 << players, factorial(players)
    counted = flagged.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(m)).alias(f"_n_{m}") for m in measures])
    names = ["_n", *[f"_n_{m}" for m in measures]]
    tables = counted.groupBy("part").agg(*[
        F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(name))), F.lit(0)) for m in range(masks)]).alias(name) for name in names])
    weights = F.lit([[int(w * orders) for w in row] for row in shapley_weights(players)])
    games = tables.select("part", _sum(F.col("_n")).alias("_total"), *[coalition_removals(F.col(name), players).alias(name) for name in names])
    valued = games.withColumn("_shapley", F.transform(weights, lambda row: _sum(F.zip_with(row, F.col("_n"), lambda w, removed: w * removed))))
    steps = F.from_json(F.lit(_steps(filters)), "array<struct<filter_order:string,step:int,player:int,own:int,before:int>>")
    laid = valued.select("*", F.explode(steps).alias("_step")).select("*", "_step.*").withColumn("_after", F.col("own") + F.col("before"))

    def taken(name: str) -> Column:
        return F.col(name)[F.col("_after")] - F.col(name)[F.col("before")]

    return laid.select(
        "part", "filter_order", "step", F.substring("filter_order", F.col("step"), F.lit(1)).alias("filter"),
        (F.col("_total") - F.col("_n")[F.col("_after")]).alias("kept"), taken("_n").alias("removed"),
        (F.col("_n")[F.col("own")] - taken("_n")).alias("redundant"),
        (F.col("_n")[masks - 1] - F.col("_n")[masks - 1 - F.col("own")]).alias("unique_fails"),
        *[taken(f"_n_{m}").alias(f"{m}_lost") for m in measures], F.col("_shapley")[F.col("player")].alias("shapley"))


def _steps(filters: str) -> str:
    """JSON of all steps of all orders: the filter's number and bit, and the coalition applied before it."""
    lines = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, i in enumerate(order, 1):
            lines.append({"filter_order": "".join(filters[j] for j in order), "step": step, "player": i, "own": 1 << i, "before": before})
            before |= 1 << i
    return json.dumps(lines)


# ---- the filters -----------------------------------------------------------------------------

def failed_alone(text: str | None) -> tuple[int, bytes]:
    """Bits of the filters A to D that a text fails, and its digest; NULL counts as empty."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # of bytes: at blank and U+0009 to U+000D
    fails = (len(words) < 100,
             100 * len(set(words)) < 80 * len(words),
             100 * (len(raw) - len(raw.translate(None, UPPER))) > 10 * len(text),
             len(raw) != len(raw.translate(None, SYMBOLS)))
    return sum(1 << i for i, f in enumerate(fails) if f), hashlib.sha256(raw).digest()


def failures(documents: DataFrame) -> DataFrame:
    """(doc_id, part, mask) for every row of documents.

    Filters: A under 100 words, B under 80 distinct words in 100, C over 10 capitals A-Z in 100 code points,
    D any of ``#$%&*|``, E a text that a smaller doc_id has anywhere in the table. Words are runs of bytes
    other than blank and U+0009 to U+000D; NULL text is empty. Part is the language, the empty string for
    NULL. Every row counts, also if rows repeat; rows that share the least doc_id of a text are no copies of
    each other. A row without doc_id never fails E and makes no other fail it.

    Only digests are shuffled. The least id of a text is found by a grouping that combines before the
    shuffle; then rows look for themselves among the least ones by digest and id, so a text of which there
    are very many copies meets in no task.
    """
    ship(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                masks, digests = zip(*map(failed_alone, rows.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("part"), pa.array(masks, pa.int32()), *np.frombuffer(b"".join(digests), "<i8").reshape(-1, 4).T],
                    ["doc_id", "part", "mask", *DIGEST])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "text")
    alone = settle(texts.mapInArrow(run, "doc_id long, part string, mask int, " + ", ".join(f"{d} long" for d in DIGEST)))
    first = alone.where("doc_id is not null").groupBy(*DIGEST).agg(F.min("doc_id").alias("_least")).withColumnsRenamed({d: f"_{d}" for d in DIGEST})
    met = reduce(lambda a, b: a & b, [F.col(d) == F.col(f"_{d}") for d in DIGEST], F.col("doc_id") == F.col("_least"))
    copy = F.col("_least").isNull() & F.col("doc_id").isNotNull()
    return alone.join(first, met, "left").select("doc_id", "part", (F.col("mask") + F.when(copy, 1 << 4).otherwise(0)).cast("int").alias("mask"))


def audit_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the five filters over documents, with labels' quality 1 (good_lost) and toxic 1 (toxic_lost).

    A document has a label if any of the label rows of its doc_id says so; NULL ids and labels say nothing.
    """
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.bool_or(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.bool_or(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = failures(documents)
    return audit(rows.join(known, rows["doc_id"] == known["_id"], "left").select("part", "mask", "good", "toxic"), FILTERS, ("good", "toxic"))
