"""Jaccard join of documents on word n-grams by token-combination prefixes.

A document is the set of its n-grams (tokens). All tokens have one order, the rarest first, and every document
posts signatures of a prefix of its set. A plain prefix is so long that two similar sets must share a token
of it. Frequent tokens say little, so they post combinations: tokens are put in classes by frequency, and
in class k only combinations of k tokens of the same group (a hash of the token) are posted. Prefixes are
extended to make up for that: a group with c tokens of class k in the prefix still shares k of them unless
c - k + 1 are missing on the other side, so a prefix is complete once these numbers add up to one more than
the tokens that a similar set may miss. Any two similar sets therefore share a signature, whatever the
classes; frequencies decide only how many others do.

How many groups there are goes by size: sets of one octave use the same number, small enough that even the
smallest set that can be linked into the octave has tokens for a complete prefix. A set posts for its own
octave and those above that a similar set can be of.

Frequencies are those of buckets of tokens, counted over all documents in an array of fixed size; classes and order
of the tokens follow from it. Equal sets are one class of documents from the start. Documents that post the
same signature form a list; lists with equal members count once. Lists are cut into blocks, and a task holds
two blocks. A first pass compares sizes and token counts in 64 buckets, which bounds the common tokens from above
without loss. Links between documents that still have a possible partner are confirmed on whole sets. Documents
that lists connect are first gathered to one list, cut into blocks, where that sends fewer sets.
A task returns spanning forests, no lists of pairs. Nothing is capped.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import lists_of, slices
from granary.llm.components import components
from granary.llm.hyperminhash import CLASS, shared_ids
from granary.llm.shipping import ship
from granary.llm.wordhash import chain, mix, shingles, word_hashes
from granary.operators.shared_store import settle

# Rows of a block; two blocks meet in a task.
BLOCK = 1024
# Buckets in which a set's tokens are counted to bound what two sets have in common.
MASS = 64
# Bits of the filters that tell which rows a join can need; more keys only make them let more through.
FILTER_BITS = 1 << 23
# Buckets of the frequency array that travel in one row.
CHUNK = 1 << 12
UNIT = ("sig", "bi", "bj")
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Rule(NamedTuple):
    """Words per n-gram, and the least similarity in hundredths."""

    size: int = 3
    percent: int = 90

    def may_miss(self, n: int) -> int:
        """How many of a set's n tokens a similar set may lack."""
        return (100 - self.percent) * n // 100

    def largest(self, n: int) -> int:
        """The largest set that may be similar to one of n tokens."""
        return 100 * n // self.percent

    def octaves(self, n: int) -> range:
        """The octaves that a set of n tokens posts for; none if only equal sets are similar to it."""
        if self.largest(n) == n and not self.may_miss(n):
            return range(0)
        return range(n.bit_length() - 1, self.largest(n).bit_length())

    def groups(self, octave: int) -> int:
        """Groups of each class above 1 in an octave; 0 if sets are too small for combinations."""
        low = 1 << octave
        least = -(-self.percent * low // 100)
        return max(0, min(self.may_miss(low) + 1, (least - self.may_miss(least) - 1) // 3))


class Classes(NamedTuple):
    """Tokens are counted in ``1 << bits`` buckets. A bucket with up to twice the mean load and ``slack``
    more is class 1, up to eight times that class 2, beyond it class 3."""

    bits: int = 18
    slack: int = 64

    def of(self, tokens: np.ndarray) -> np.ndarray:
        return (tokens >> np.uint64(64 - self.bits)).astype(np.int64)


class Frequency(NamedTuple):
    """Per bucket: rank in the order of tokens (finer than the class) and class."""

    order: np.ndarray
    kind: np.ndarray
    classes: Classes


def frequency(loads: np.ndarray, classes: Classes) -> Frequency:
    base = 2 * loads.mean() + classes.slack
    order = np.clip(8 * np.log2(np.maximum(loads, 1) / max(loads.mean(), 1)) + 64, 0, 255).astype(np.uint8)
    return Frequency(order, (1 + (loads > base) + (loads > 8 * base)).astype(np.uint8), classes)


# ---- signatures ------------------------------------------------------------------------------

def set_key(tokens: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set."""
    return tuple(int(mix(tokens * _ODD + np.uint64(k)).sum(dtype=np.uint64).view(np.int64)) for k in (1, 2))


def _rank_in_group(group: np.ndarray) -> np.ndarray:
    by_group = np.argsort(group, kind="stable")
    ordered = group[by_group]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    rank = np.empty(len(group), np.int64)
    rank[by_group] = np.arange(len(group)) - np.repeat(first, np.diff(first, append=len(group)))
    return rank


def posted(tokens: np.ndarray, kind: np.ndarray, octave: int, rule: Rule) -> np.ndarray:
    """Signatures of a set for one octave; ``tokens`` in their global order, ``kind`` their classes."""
    need, groups, seed = rule.may_miss(len(tokens)) + 1, rule.groups(octave), np.uint64(octave)
    if not groups or kind[:need].max() == 1:
        return mix(tokens[:need] * _ODD + seed)
    group = np.where(kind == 1, np.arange(len(tokens)) + 2 * groups, (mix(tokens) % np.uint64(groups)).astype(np.int64) + groups * (kind.astype(np.int64) - 2))
    shared = np.cumsum(_rank_in_group(group) >= kind - 1)
    cut = int(np.searchsorted(shared, need)) + 1
    tokens, kind, group = tokens[:cut], kind[:cut], group[:cut]
    found = [mix(tokens[kind == 1] * _ODD + seed)]
    for k in (2, 3):
        for g in np.unique(group[kind == k]):
            own = np.sort(tokens[group == g])
            if len(own) >= k:
                picked = np.array(list(combinations(range(len(own)), k)))
                found.append(chain(np.full(len(picked), seed), *[own[picked[:, i]] for i in range(k)]))
    return np.concatenate(found)


def signatures(tokens: np.ndarray, seen: Frequency, rule: Rule) -> np.ndarray:
    """All different signatures of a set of tokens, given in ascending order."""
    octaves = rule.octaves(len(tokens))
    if not len(octaves):
        return np.empty(0, np.uint64)
    bucket = seen.classes.of(tokens)
    rare_first = np.argsort(seen.order[bucket], kind="stable")
    tokens, kind = tokens[rare_first], seen.kind[bucket][rare_first]
    return np.unique(np.concatenate([posted(tokens, kind, octave, rule) for octave in octaves]))


def masses(tokens: np.ndarray) -> np.ndarray:
    """How many tokens of a set are in each of the MASS buckets; counts beyond 32767 stay there."""
    return np.minimum(np.bincount((tokens & np.uint64(MASS - 1)).astype(np.int64), minlength=MASS), 32767).astype("<i2")


# ---- passes over texts -----------------------------------------------------------------------

def _sets(part: pa.RecordBatch, rule: Rule) -> list[np.ndarray]:
    return [shingles(word_hashes(text), rule.size) for text in part.column("text").to_pylist()]


def _keys(sets: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array(k, pa.int64()) for k in zip(*map(set_key, sets))]


def describe(documents: DataFrame, rule: Rule, classes: Classes) -> DataFrame:
    """Per row: doc_id, n_shingles, h1, h2; and at the end of every task rows of (chunk, at, count): how
    many tokens it met in each bucket, buckets without tokens left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = np.zeros(1 << classes.bits, np.int64)
        names = ["doc_id", "n_shingles", *CLASS, "chunk", "at", "count"]
        for batch in batches:
            for part in slices(batch, "text"):
                sets = _sets(part, rule)
                np.add.at(loads, classes.of(np.concatenate(sets)), 1)
                nothing = [pa.nulls(len(sets), kind) for kind in (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(map(len, sets), pa.int64()), *_keys(sets), *nothing], names)
        for k in range(0, len(loads), CHUNK):
            at = np.flatnonzero(loads[k:k + CHUNK])
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [*[pa.nulls(1, pa.int64())] * 4, pa.array([k], pa.int32()), pa.array([at], pa.list_(pa.int32())), pa.array([loads[k + at]], pa.list_(pa.int64()))], names)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, h1 long, h2 long, chunk int, at array<int>, count array<long>")


def measured(described: DataFrame, classes: Classes) -> Frequency:
    """Bucket loads of all tasks, added up by Spark; the array of fixed size comes to the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, at, count in zip(*[batch.column(c).to_pylist() for c in ("chunk", "at", "count")]):
                np.add.at(total.setdefault(k, np.zeros(CHUNK, np.int64)), at, count)
        for k, loads in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([loads], pa.list_(pa.int64()))], ["chunk", "loads"])

    parts = described.where("chunk is not null").select("chunk", "at", "count").repartition("chunk").mapInArrow(add, "chunk int, loads array<long>")
    loads = np.zeros(max(1 << classes.bits, CHUNK), np.int64)
    found = parts.toArrow()
    for k, own in zip(found.column("chunk").to_pylist(), found.column("loads").to_pylist()):
        loads[k:k + CHUNK] = own
    return frequency(loads[:1 << classes.bits], classes)


def sign(documents: DataFrame, rule: Rule, seen: Frequency) -> DataFrame:
    """(h1, h2, sigs, mass) of every text that posts a signature."""
    known = documents.sparkSession.sparkContext.broadcast(seen)  # 2 bytes per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = _sets(part, rule)
                sigs = [signatures(tokens, known.value, rule) for tokens in sets]
                rows = pa.RecordBatch.from_arrays(
                    [*_keys(sets), lists_of([s.tobytes() for s in sigs], pa.int64()), lists_of([masses(t).tobytes() for t in sets], pa.int64())],
                    [*CLASS, "sigs", "mass"])
                yield rows.filter(pa.array([len(s) > 0 for s in sigs], pa.bool_()))

    return documents.where("doc_id is not null").select("text").mapInArrow(run, "h1 long, h2 long, sigs array<long>, mass array<long>")


def bit_filter(keys: DataFrame, place: Column) -> np.ndarray:
    """One bit for each place (from 0 to FILTER_BITS) that a key has, in an array of fixed size."""
    bits = keys.select(place.alias("_p")).groupBy(F.shiftright("_p", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_p & 63 as int))")).alias("bits"))
    words, found = np.zeros(FILTER_BITS // 64, np.int64), bits.toArrow()
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return words


def passes(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (words[places >> 6] >> (places & 63) & 1).astype(bool)


def sets_of(documents: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """(_h1, _h2, shingles): the sets of the wanted doc_ids (column rep), and of some others.

    Which ids are wanted is kept as one bit per hash in an array of fixed size, so that texts need not be
    shuffled; whoever joins the result drops the others.
    """
    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))

    known = documents.sparkSession.sparkContext.broadcast(bit_filter(wanted, place("rep")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            there = passes(known.value, batch.column("_p").to_numpy())
            for part in slices(batch.filter(pa.array(there)), "text"):
                sets = _sets(part, rule)
                yield pa.RecordBatch.from_arrays([*_keys(sets), lists_of([s.astype("<u8").tobytes() for s in sets], pa.int64())], ["_h1", "_h2", "shingles"])

    texts = documents.select(F.col("doc_id").cast("long").alias("_id"), "text").where("_id is not null").select(place("_id").alias("_p"), "text")
    # Rows that repeat a text make equal rows; the join that follows needs the same exchange.
    return texts.mapInArrow(run, "_h1 long, _h2 long, shingles array<long>").groupBy("_h1", "_h2").agg(F.first("shingles").alias("shingles"))


# ---- blocks of a list ------------------------------------------------------------------------

def whole_units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold only whole units, and where each begins, from a stream that is sorted by unit."""
    def keys(rows) -> np.ndarray:
        return np.stack([rows.column(c).to_numpy() for c in UNIT])

    def made(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        key = keys(rows)
        return rows, np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = keys(batch)
        if held and (keys(held[-1])[:, -1] != key[:, 0]).any():
            yield made(held)
            held = []
        other = np.flatnonzero((key != key[:, -1:]).any(axis=0))
        tail = int(other[-1]) + 1 if len(other) else 0
        if tail:
            yield made([*held, batch.slice(0, tail)])
            held = []
        held.append(batch.slice(tail))
    if held:
        yield made(held)


class Members(NamedTuple):
    """Columns of the rows of some units."""

    block: np.ndarray
    bi: np.ndarray
    bj: np.ndarray
    n: np.ndarray
    mass: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> Members:
        masses_ = rows.column("mass").combine_chunks().flatten().to_numpy().astype("<i8").view("<i2").reshape(rows.num_rows, MASS)
        return cls(*[rows.column(c).to_numpy() for c in ("block", "bi", "bj", "n")], masses_)


def possible(members: Members, x: np.ndarray, y: np.ndarray, rule: Rule) -> np.ndarray:
    """Whether the sets at x and y can be similar: what they have in common is at most half of what
    their sizes exceed the differences of their counts by bucket."""
    n, m = members.n[x], members.n[y]
    can = 100 * np.minimum(n, m) >= rule.percent * np.maximum(n, m)
    at = np.flatnonzero(can)
    apart = np.abs(members.mass[x[at]].astype(np.int32) - members.mass[y[at]]).sum(axis=1)
    common = (n[at] + m[at] - apart) // 2
    can[at] = 100 * common >= rule.percent * (n[at] + m[at] - common)
    return can


def candidates(members: Members, start: int, end: int, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a unit that can be similar, each once, in slabs of bounded size."""
    at = np.arange(start, end)
    within = members.bi[start] == members.bj[start]
    left = at if within else at[members.block[at] == members.bi[start]]
    right = at if within else at[members.block[at] == members.bj[start]]
    for a in range(0, len(left), 128):
        x, y = (g.ravel() for g in np.meshgrid(left[a:a + 128], right, indexing="ij"))
        if within:
            x, y = x[x < y], y[x < y]
        can = possible(members, x, y, rule)
        yield x[can], y[can]


def with_partners(rows: pa.Table, starts: np.ndarray, rule: Rule) -> np.ndarray:
    """Which rows have a possible partner in their unit."""
    members, ends = Members.of(rows), np.append(starts[1:], rows.num_rows)
    met = np.zeros(rows.num_rows, bool)
    two = starts[(ends - starts == 2) & (members.bi[starts] == members.bj[starts])]
    can = two[possible(members, two, two + 1, rule)]
    met[can] = met[can + 1] = True
    for start, end in zip(starts, ends):
        if end - start > 2 or end - start == 2 and members.bi[start] != members.bj[start]:
            for x, y in candidates(members, start, end, rule):
                met[x] = met[y] = True
    return met


def confirmed(rows: pa.Table, starts: np.ndarray, rule: Rule) -> Iterator[tuple[int, int]]:
    """Links between the rows of each unit, found on whole sets, that connect what the rule connects: pairs
    already connected are not looked at again."""
    members, ends = Members.of(rows), np.append(starts[1:], rows.num_rows)
    reps = rows.column("rep").to_numpy()
    column = rows.column("shingles").combine_chunks()
    tokens = column.flatten().to_numpy()
    until = column.value_lengths().to_numpy().astype(np.int64).cumsum()
    since = until - column.value_lengths().to_numpy()
    for start, end in zip(starts, ends):
        parent = {i: i for i in range(start, end)}

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        low = since[start]
        _, ids = np.unique(tokens[low:until[end - 1]], return_inverse=True)
        member = np.zeros(len(ids), bool)
        for x, y in candidates(members, start, end, rule):
            first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else []
            for a, b in zip(first, [*first[1:], len(x)]):
                i = int(x[a])
                own = root(i)
                others = np.array([j for j in y[a:b].tolist() if root(j) != own], np.int64)
                if not len(others):
                    continue
                mine = ids[since[i] - low:until[i] - low]
                member[mine] = True
                lengths = members.n[others]
                begin = np.cumsum(lengths) - lengths
                flat = np.arange(int(lengths.sum())) + np.repeat(since[others] - low - begin, lengths)
                both = np.add.reduceat(member[ids[flat]].astype(np.int64), begin)
                member[mine] = False
                for j in others[100 * both >= rule.percent * (len(mine) + lengths - both)].tolist():
                    if root(i) != root(j):
                        parent[root(j)] = root(i)
                        yield int(reps[i]), int(reps[j])


# ---- the join --------------------------------------------------------------------------------

def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(*UNIT).sortWithinPartitions(*UNIT, "h1", "h2")


def lists(signed: DataFrame, rule: Rule) -> DataFrame:
    """(sig, size, h1, h2): members of the lists that can hold a link; of lists with equal members one.

    A list is known by how many members it has and by the exclusive or of their hashes, which combine
    before the shuffle."""
    rows = signed.select(F.explode("sigs").alias("sig"), *CLASS, "n")
    stats = rows.groupBy("sig").agg(
        F.count(F.lit(1)).alias("size"), *[F.bit_xor(h).alias(f"x_{h}") for h in CLASS], F.min("n").alias("low"), F.max("n").alias("high"))
    # Two members whose sizes alone rule a link out; larger lists may hold others.
    useful = stats.where((F.col("size") > 2) | (F.col("size") == 2) & (100 * F.col("low") >= rule.percent * F.col("high")))
    kept = settle(useful.groupBy("size", "x_h1", "x_h2").agg(F.min("sig").alias("_sig")).select("_sig", "size"))
    # Few signatures have a list that is kept: most rows need not be shuffled for the join.
    known = signed.sparkSession.sparkContext.broadcast(bit_filter(kept, F.col("_sig").bitwiseAND(F.lit(FILTER_BITS - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = batch.column("sigs")
            sig, row = sigs.flatten().to_numpy(), np.repeat(np.arange(batch.num_rows), sigs.value_lengths().to_numpy())
            at = np.flatnonzero(passes(known.value, sig & (FILTER_BITS - 1)))
            yield pa.RecordBatch.from_arrays([pa.array(sig[at]), *[batch.column(h).take(pa.array(row[at])) for h in CLASS]], ["sig", *CLASS])

    posts = signed.select("sigs", *CLASS).mapInArrow(run, "sig long, h1 long, h2 long")
    return posts.join(kept, posts["sig"] == kept["_sig"]).select("sig", "size", *CLASS)


def _in_blocks(rows: DataFrame, key: str, size: Column, *rest: str) -> DataFrame:
    """Rows of lists cut into blocks by a hash: a block meets every block of its list, itself included."""
    blocks = F.ceil(size / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(F.lit(47), *CLASS), blocks).cast("int")
    return rows.select(F.col(key).alias("sig"), own.alias("block"), *CLASS, *rest, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_other")).select(
        "sig", F.least("block", "_other").alias("bi"), F.greatest("block", "_other").alias("bj"), "block", *CLASS, *rest)


def gathered(near: DataFrame) -> DataFrame:
    """The rows of units, dealt so that sets travel less: documents that are connected by units make one
    list, cut into blocks like the others, unless the units of its members have fewer rows than that."""
    least = near.groupBy(*UNIT).agg(F.min("rep").alias("_least")).withColumnsRenamed({c: f"_{c}" for c in UNIT})
    met = near.join(least, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in UNIT]))
    found = components(met.select(F.col("_least").alias("a"), F.col("rep").alias("b")))
    members = near.groupBy(*CLASS).agg(*[F.first(c).alias(c) for c in ("rep", "n", "mass")], F.count(F.lit(1)).alias("_rows"))
    # Members that share one doc_id are no link's ends; they are known by that id.
    grouped = settle(members.join(found, F.col("rep") == F.col("vertex"), "left").select(
        *members.columns, F.coalesce("component", "rep").alias("component")))
    size = F.col("_size")
    sizes = grouped.groupBy("component").agg(F.count(F.lit(1)).alias("_size"), F.sum("_rows").alias("_all")).select(
        F.col("component").alias("_component"), "_size", (size * F.ceil(size / BLOCK) <= F.col("_all")).alias("_gather"))
    sized = grouped.join(sizes, F.col("component") == F.col("_component"))
    # Lists have blocks from 0, so a component can't be taken for the list that has its number.
    own = _in_blocks(sized.where("_gather"), "component", size, "rep", "n", "mass").withColumns({c: -1 - F.col(c) for c in ("bi", "bj", "block")})
    others = sized.where("not _gather").select(*[F.col(h).alias(f"_{h}") for h in CLASS])
    kept = near.join(others, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left_semi")
    return own.unionByName(kept.select(*own.columns))


def links(documents: DataFrame, signed: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) between class representatives that connect whatever the rule connects."""
    entries = lists(signed, rule)
    placed = _in_blocks(entries, "sig", F.col("size")).withColumnsRenamed({h: f"_{h}" for h in CLASS})
    same = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    columns = [*UNIT, "block", *CLASS, "rep", "n", "mass"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_units(batches):
            yield from rows.filter(pa.array(with_partners(rows, starts, rule))).to_batches()

    wide = placed.join(signed.select(*CLASS, "rep", "n", "mass"), same).select(*columns)
    near = settle(_dealt(wide).mapInArrow(find, wide.schema))
    sets = sets_of(documents, near.select("rep").distinct(), rule)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_units(batches):
            found = list(confirmed(rows, starts, rule))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return _dealt(gathered(near).join(sets, same).select(*columns, "shingles")).mapInArrow(confirm, "a long, b long")


def join(documents: DataFrame, rule: Rule = Rule(), classes: Classes = Classes()) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of documents.

    Words are runs of characters other than blank and U+0009 to U+000D; A-Z counts as a-z. A document with
    fewer words than an n-gram has its whole sequence as one. NULL, empty and white texts have no n-gram
    and are linked with nothing. Two documents link if 100 times what they have in common is at least
    ``rule.percent`` times all that they have; component_id is the least doc_id reachable over links, one's
    own included. A row without doc_id is linked with nothing, its component_id is NULL. Repeated rows get
    equal results; if one doc_id stands for several texts, those are one document to the links. Other
    columns are not read, so their names can't clash.
    """
    ship(documents.sparkSession)
    described = settle(describe(documents, rule, classes))
    rows = described.where("chunk is null").select("doc_id", "n_shingles", *CLASS)
    groups = settle(rows.where("n_shingles > 0 and doc_id is not null").groupBy(*CLASS).agg(
        F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n")))
    posts = sign(documents, rule, measured(described, classes)).groupBy(*CLASS).agg(F.first("sigs").alias("sigs"), F.first("mass").alias("mass"))
    signed = settle(posts.join(groups, list(CLASS)))
    joined = components(links(documents, signed, rule).unionByName(shared_ids(rows, groups)))
    found = groups.join(joined, groups["rep"] == joined["vertex"], "left").select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.coalesce("component", "rep").alias("_component"))
    # Rows without words match nothing, anywhere.
    spread = F.when(F.col("n_shingles") > 0, F.col("h1")).otherwise(F.xxhash64("doc_id"))
    keyed = rows.select("doc_id", "n_shingles", spread.alias("h1"), F.when(F.col("n_shingles") > 0, F.col("h2")).alias("h2"))
    met = keyed.join(found, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
    return met.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id")).alias("component_id"))
