"""Near-duplicate documents with HyperMinHash.

Every document's shingle set is summed up in registers: register j holds the smallest hash of the set under
the j-th hash function, compressed to its number of leading zeros and ten bits of mantissa (16 bits). Four
registers make a band; documents that agree on a band meet in a bucket. Within buckets the number of
equal registers, corrected for chance collisions of compressed values, estimates the Jaccard similarity;
pairs that may reach the limit are confirmed on full sets.

Copies of a word sequence are one class from the start. Buckets are cut into blocks, so a task holds two
blocks at most. A first pass over registers finds who has a possible partner; only their sets are built and
brought to the same blocks, where links are confirmed and a spanning forest of them is returned, so a group of
n documents sends less than n links per block pair and no list of pairs. No bucket, partner or candidate is capped.
"""

from __future__ import annotations

from functools import lru_cache
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import lists_of, slices
from granary.llm.components import components
from granary.llm.shipping import ship
from granary.llm.wordhash import chain, shingles, word_hashes
from granary.operators.shared_store import settle

REGISTERS, BAND = 128, 4
MANTISSA_BITS = 10
# Standard deviations below the limit at which an estimate still counts as possible.
MARGIN = 5.0
BLOCK = 1024
UNIT = ("band", "key", "bi", "bj")
# A class is known by these; its rep need not be its own if a doc_id stands for several texts.
CLASS = ("h1", "h2")


class Rule(NamedTuple):
    """Words per shingle, and the least similarity in hundredths."""

    size: int = 5
    percent: int = 80


# ---- registers -------------------------------------------------------------------------------

@lru_cache(maxsize=1)
def _multipliers() -> np.ndarray:
    return np.random.default_rng(41).integers(1, 1 << 63, REGISTERS, dtype=np.uint64) | np.uint64(1)


def registers(hashes: np.ndarray) -> np.ndarray:
    """REGISTERS 16-bit registers of a non-empty set of 64-bit hashes."""
    least = np.full(REGISTERS, np.uint64(2**64 - 1))
    for a in range(0, len(hashes), 2048):
        np.minimum(least, (hashes[a:a + 2048, None] * _multipliers()).min(axis=0), out=least)
    # The exponent of a double is the position of the leading one, its mantissa the bits that follow.
    bits = np.maximum(least, np.uint64(1)).astype(np.float64).view(np.uint64)
    zeros = np.uint64(1087) - (bits >> np.uint64(52))
    return (zeros << np.uint64(MANTISSA_BITS) | bits >> np.uint64(52 - MANTISSA_BITS) & np.uint64((1 << MANTISSA_BITS) - 1)).astype(np.uint16)


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of disjoint sets of n and m elements agree: two exponential minima fall in
    the same cell, summed over the levels of leading zeros."""
    zeros = np.arange(64)[:, None]
    low, total = 2.0 ** -(zeros + 1), (n + m).astype(float)
    inside = np.exp(-np.minimum(total * low, 700)) - np.exp(-np.minimum(total * 2 * low, 700))
    return (n * m / total * low * 2.0**-MANTISSA_BITS * inside).sum(axis=0)


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, corrected for chance collisions."""
    by_chance = chance(n, m)
    return np.maximum((equal / REGISTERS - by_chance) / (1 - by_chance), 0)


def possible(equal: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    limit = percent / 100
    reachable = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    return reachable & (estimate(equal, n, m) >= limit - MARGIN * np.sqrt(limit * (1 - limit) / REGISTERS))


def class_key(words: np.ndarray) -> tuple[int, int]:
    """Two hashes of a word sequence."""
    places = np.arange(1, len(words) + 1, dtype=np.uint64)
    return tuple(int(chain(*pair).sum(dtype=np.uint64).view(np.int64)) for pair in ((words, places), (places, words)))


def describe(documents: DataFrame, rule: Rule) -> DataFrame:
    """Per row: doc_id, n_shingles, two hashes of the word sequence, registers as 32 longs (a band each)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, first, second, bands = [], [], [], []
                for row, text in enumerate(part.column("text").to_pylist()):
                    words = word_hashes(text)
                    found = shingles(words, rule.size)
                    sizes.append(len(found))
                    h1, h2 = class_key(words)
                    first.append(h1)
                    second.append(h2)
                    bands.append(registers(found).tobytes() if len(found) else b"")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), lists_of(bands, pa.int64())],
                    ["doc_id", "n_shingles", "h1", "h2", "bands"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>")


# ---- blocks of a bucket ----------------------------------------------------------------------

class Unit(NamedTuple):
    """Documents of one pair of blocks of a bucket."""

    band: int
    key: int
    bi: int
    bj: int
    rep: np.ndarray
    block: np.ndarray
    n: np.ndarray
    registers: np.ndarray
    sets: list[np.ndarray] | None
    classes: list[np.ndarray]


def units(batches: Iterator[pa.RecordBatch]) -> Iterator[Unit]:
    """Whole units from a stream that is sorted by unit."""
    def made(rows: pa.Table) -> Iterator[Unit]:
        key = [rows.column(c).to_numpy() for c in UNIT]
        starts = np.flatnonzero(np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in key])]) if rows.num_rows else []
        numbers = [rows.column(c).to_numpy() for c in ("rep", "block", "n")]
        bands = rows.column("bands").combine_chunks().flatten().to_numpy().astype("<i8").view(np.uint16).reshape(rows.num_rows, REGISTERS)
        classes, sets = [rows.column(c).to_numpy() for c in CLASS if c in rows.column_names], None
        if "shingles" in rows.column_names:
            column = rows.column("shingles").combine_chunks()
            values, ends = column.flatten().to_numpy(), column.value_lengths().to_numpy().cumsum()
            sets = np.split(values, ends[:-1])
        for a, b in zip(starts, [*starts[1:], rows.num_rows]):
            yield Unit(*[int(k[a]) for k in key], *[x[a:b] for x in numbers], bands[a:b], sets[a:b] if sets is not None else None, [c[a:b] for c in classes])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = [batch.column(c).to_numpy() for c in UNIT]
        last = np.logical_and.reduce([k == k[-1] for k in key])
        tail = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if held and not all(held[0].column(c)[0].as_py() == k[0] for c, k in zip(UNIT, key)):
            yield from made(pa.Table.from_batches(held))
            held = []
        if tail:
            yield from made(pa.Table.from_batches([*held, batch.slice(0, tail)]))
            held = []
        held.append(batch.slice(tail))
    if held:
        yield from made(pa.Table.from_batches(held))


def pairs(unit: Unit, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Possible pairs of a unit, as positions, for which this band is the first that they share: a pair
    that meets in several buckets is looked at once. Comes in slabs of rows to bound memory."""
    within = unit.bi == unit.bj
    left = np.arange(len(unit.rep)) if within else np.flatnonzero(unit.block == unit.bi)
    right = left if within else np.flatnonzero(unit.block == unit.bj)
    turned = np.ascontiguousarray(unit.registers[right].T)
    longs = np.ascontiguousarray(unit.registers).view(np.int64)
    floor = int(REGISTERS * (percent / 100 - MARGIN * 0.4 / REGISTERS**0.5)) - 1
    for a in range(0, len(left), 256):
        rows = left[a:a + 256]
        equal = np.zeros((len(rows), len(right)), np.uint8)
        for register, column in zip(unit.registers[rows].T, turned):
            equal += register[:, None] == column
        x, y = np.nonzero(equal >= max(floor, 0))
        count, x, y = equal[x, y], rows[x], right[y]
        use = x < y if within else unit.rep[x] != unit.rep[y]
        count, x, y = count[use], x[use], y[use]
        use = possible(count.astype(float), unit.n[x], unit.n[y], percent)
        x, y = x[use], y[use]
        use = (longs[x] == longs[y]).argmax(axis=1) == unit.band
        yield x[use], y[use]


def with_partners(unit: Unit, percent: int) -> np.ndarray:
    """Positions of the documents that have a possible partner in the unit."""
    met = np.zeros(len(unit.rep), bool)
    for x, y in pairs(unit, percent):
        met[x] = True
        met[y] = True
    return np.flatnonzero(met)


def confirmed(unit: Unit, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the unit's links: pairs confirmed on full sets, each from a component's least
    document. Pairs already connected are not looked at again."""
    parent = np.arange(len(unit.rep))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    _, ids = np.unique(np.concatenate(unit.sets), return_inverse=True)
    sizes = np.array([len(s) for s in unit.sets])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    member = np.zeros(int(ids.max()) + 1, bool)
    for x, y in pairs(unit, percent):
        for at in np.unique(x):
            own = root(int(at))
            others = np.array([j for j in y[x == at].tolist() if root(j) != own], int)
            if not len(others):
                continue
            mine = ids[starts[at]:ends[at]]
            member[mine] = True
            lengths = sizes[others]
            begin = np.cumsum(lengths) - lengths
            flat = np.arange(int(lengths.sum())) + np.repeat(starts[others] - begin, lengths)
            both = np.add.reduceat(member[ids[flat]].astype(np.int64), begin)
            member[mine] = False
            for j in others[100 * both >= percent * (len(mine) + lengths - both)].tolist():
                a, b = root(int(at)), root(j)
                if a != b:
                    if unit.rep[b] < unit.rep[a]:
                        a, b = b, a
                    parent[b] = a
    least = [root(i) for i in range(len(unit.rep))]
    return [(int(unit.rep[r]), int(unit.rep[i])) for i, r in enumerate(least) if r != i]


# ---- documents -------------------------------------------------------------------------------

def classes_of(described: DataFrame) -> DataFrame:
    """One row per word sequence: its hashes, least document (rep), set size n and bands."""
    named = described.where("n_shingles > 0 and doc_id is not null")
    return named.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "n_shingles", "bands")).alias("_first")).select(
        "h1", "h2", F.col("_first.doc_id").alias("rep"), F.col("_first.n_shingles").alias("n"), F.col("_first.bands").alias("bands"))


def _dealt(rows: DataFrame) -> DataFrame:
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(width, *UNIT).sortWithinPartitions(*UNIT, "rep", *CLASS)


def links(documents: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Confirmed links (a, b) between class representatives that connect whatever the limit connects."""
    keyed = classes.select("rep", *CLASS, F.posexplode("bands").alias("band", "key"))
    crowded = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").withColumnsRenamed({"band": "_b", "key": "_k"})
    entries = keyed.join(crowded, (F.col("band") == F.col("_b")) & (F.col("key") == F.col("_k")))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(F.lit(43), *CLASS), blocks).cast("int")
    # A block meets every block of its bucket, itself included.
    placed = entries.select("band", "key", "rep", *CLASS, own.alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_other")).select(
        "band", "key", F.least("block", "_other").alias("bi"), F.greatest("block", "_other").alias("bj"), "rep", *CLASS, "block")
    traits = classes.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("n"), F.col("bands"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in units(batches):
            at = with_partners(unit, rule.percent)
            if len(at):
                fixed = [pa.array(np.full(len(at), v), pa.int64()) for v in (unit.band, unit.key, unit.bi, unit.bj)]
                yield pa.RecordBatch.from_arrays(
                    [*fixed, pa.array(unit.rep[at]), pa.array(unit.block[at], pa.int64()), pa.array(unit.n[at]),
                     lists_of([unit.registers[i].tobytes() for i in at], pa.int64()), *[pa.array(c[at]) for c in unit.classes]],
                    [*UNIT, "rep", "block", "n", "bands", *CLASS])

    columns = "band long, key long, bi long, bj long, rep long, block long, n long, bands array<long>, h1 long, h2 long"
    wide = placed.join(traits, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).select(
        *[F.col(c).cast("long") for c in (*UNIT, "rep", "block")], "n", "bands", *CLASS)
    near = settle(_dealt(wide).mapInArrow(find, columns))
    sets = shingle_sets(documents, near.select("rep").distinct(), rule)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in units(batches):
            found = confirmed(unit, rule.percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    full = near.join(sets, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).select(*near.columns, "shingles")
    return _dealt(full).mapInArrow(confirm, "a long, b long")


def shingle_sets(documents: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """(_h1, _h2, shingles): sorted distinct shingle hashes of the wanted documents; one row per word sequence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = [word_hashes(t) for t in part.column("text").to_pylist()]
                found = [shingles(w, rule.size).astype("<u8").tobytes() for w in words]
                keys = [pa.array(k, pa.int64()) for k in zip(*map(class_key, words))]
                yield pa.RecordBatch.from_arrays([*keys, lists_of(found, pa.int64())], ["_h1", "_h2", "shingles"])

    texts = documents.select(F.col("doc_id").cast("long").alias("_id"), "text")
    picked = texts.join(wanted, texts["_id"] == wanted["rep"], "left_semi")
    # Rows that share an id may repeat a text; the join that follows needs the same exchange.
    return picked.mapInArrow(run, "_h1 long, _h2 long, shingles array<long>").groupBy("_h1", "_h2").agg(F.first("shingles").alias("shingles"))


def shared_ids(described: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) from each doc_id that stands for several word sequences to the reps of their classes."""
    named = described.where("n_shingles > 0 and doc_id is not null").select("doc_id", *CLASS)
    key = F.struct(*CLASS)
    several = named.groupBy("doc_id").agg(F.min(key).alias("_a"), F.max(key).alias("_b")).where("_a != _b").select(F.col("doc_id").alias("_id"))
    rows = named.join(several, named["doc_id"] == several["_id"], "left_semi").distinct()
    return rows.join(classes.select(*CLASS, "rep"), list(CLASS)).where("doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))


def near_duplicates(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row.

    Words are runs of characters other than blank and U+0009 to U+000D; A-Z counts as a-z. A document with
    fewer words than a shingle has its whole sequence as one shingle. NULL, empty and white texts have no
    shingle and are linked with nothing. A row without doc_id is its own: component_id is NULL, kept
    is true. Repeated rows get equal results; if one doc_id stands for different texts, those are one
    document to the links. Component: least doc_id reachable over links of at least ``rule.percent``.
    """
    spark = documents.sparkSession
    ship(spark)
    described = settle(describe(documents, rule))
    classes = settle(classes_of(described))
    joined = components(links(documents, classes, rule).unionByName(shared_ids(described, classes)))
    group = classes.join(joined, classes["rep"] == joined["vertex"], "left").select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.coalesce("component", "rep").alias("_component"), F.col("n").alias("_n"))
    spread = F.when(F.col("n_shingles") > 0, F.col("h1")).otherwise(F.xxhash64("doc_id"))  # rows without words match nothing, anywhere
    rows = described.select("doc_id", "n_shingles", spread.alias("h1"), "h2")
    found = rows.join(group, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")) & (F.col("n_shingles") == F.col("_n")), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(documents: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One whole row of each group of near copies: that of its least doc_id (of rows that share it, the
    least). Rows without doc_id all stay, as nothing can be named their copy."""
    found = near_duplicates(documents, rule)
    least = found.where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept")).distinct()
    rest = [c for c in documents.columns if c != "doc_id"]
    named = documents.join(least, documents["doc_id"].cast("long") == least["_kept"], "left_semi").groupBy("doc_id").agg(
        F.min(F.struct(*rest)).alias("_row")).select(*["doc_id" if c == "doc_id" else F.col("_row")[c].alias(c) for c in documents.columns])
    return named.unionByName(documents.where("doc_id is null"))
