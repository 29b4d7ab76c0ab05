import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from odd import crowded, documents, empty

from granary.llm import hyperminhash as hmh
from granary.llm.components import components
from granary.llm.wordhash import WHITE, shingles, word_hashes

LOWER = {k: k + 32 for k in range(65, 91)}


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    size = min(size, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def plain_components(rows, size, percent):
    """doc_id -> (set size, least reachable id), by comparing all pairs that share a shingle."""
    sets, at = {i: shingle_set(t, size) for i, t in rows}, defaultdict(set)
    for i, s in sets.items():
        for shingle in s:
            at[shingle].add(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j in {j for shingle in s for j in at[shingle] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def compared(spark, rows, rule):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in hmh.near_duplicates(frame, rule).collect()}
    assert found == plain_components(rows, rule.size, rule.percent)


def variants(seed, groups, copies, words, edits):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{i}" for i in rng.integers(0, 5000, words)]
        for _ in range(copies):
            own = list(base)
            for at in rng.integers(0, words, rng.integers(0, edits + 1)):
                own[at] = f"x{rng.integers(0, 10**6)}"
            rows.append((len(rows) * 3 % 10_007, " ".join(own)))
    return rows


@pytest.mark.parametrize("rule", [hmh.Rule(2, 80), hmh.Rule(5, 80)])
def test_components_equal_all_pairs(spark, rule):
    compared(spark, variants(1, 12, 12, 120, 10), rule)


def test_short_texts_and_large_groups(spark):
    rows = variants(3, 1, 150, 60, 6)
    rows += [(20_000 + i, t) for i, t in enumerate(["one", "ONE", "one two", "two one", "a b c d e f", "a b c d e f g", "", " \n", "one"])]
    compared(spark, rows, hmh.Rule(2, 80))


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = variants(4, 1, 60, 80, 5)
    monkeypatch.setattr(hmh, "BLOCK", 7)
    compared(spark, rows, hmh.Rule(2, 80))


def test_sample_of_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    compared(spark, [tuple(r) for r in table.select("doc_id", "text").collect()], hmh.Rule(2, 80))


def test_odd_rows(spark):
    rows = crowded(documents(spark), "bands", "N_shingles", "rep", "_component")
    found = hmh.near_duplicates(rows, hmh.Rule(2)).collect()
    assert len(found) == rows.count()
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in found}
    assert got[1] == (1, True) and got[2] == (1, False) and got[None] == (None, True)
    assert all(got[i] == (i, True) for i in (3, 4, 5, 6, 7, 8))
    kept = hmh.keep_one(rows, hmh.Rule(2))
    assert kept.columns == rows.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 8]
    assert hmh.near_duplicates(empty(spark)).count() == hmh.keep_one(empty(spark)).count() == 0


def test_rows_that_share_an_id(spark):
    rows = documents(spark, [(1, "a b c", "en", "s", 1), (1, "x y z", "en", "s", 1), (2, "x y z", "en", "s", 1)])
    assert {r["component_id"] for r in hmh.near_duplicates(rows, hmh.Rule(2)).collect()} == {1}
    assert [(r["doc_id"], r["text"]) for r in hmh.keep_one(rows, hmh.Rule(2)).collect()] == [(1, "a b c")]


def test_shared_id_with_near_copies_of_other_lengths(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    near, short, long = words[:250] + ["x"] + words[251:], [f"s{i}" for i in range(40)], [f"l{i}" for i in range(900)]
    near_long = long[:700] + ["y"] + long[701:]
    texts = [(3, near), (7, words), (7, words), (7, short), (7, long), (2, near_long), (9, short[:-1]), (12, ["alone", "here", "now"])]
    rows = documents(spark, [(i, " ".join(t), "en", "s", 1) for i, t in texts])
    for block in (hmh.BLOCK, 1):
        monkeypatch.setattr(hmh, "BLOCK", block)
        found = {(r["doc_id"], r["component_id"]) for r in hmh.near_duplicates(rows, hmh.Rule(2)).collect()}
        assert found == {(2, 2), (3, 2), (7, 2), (9, 2), (12, 12)}
        assert sorted(r["doc_id"] for r in hmh.keep_one(rows, hmh.Rule(2)).collect()) == [2, 12]


def test_shared_id_joins_its_exact_copies(spark):
    rows = documents(spark, [(i, t, "en", "s", 1) for i, t in ((1, "x y z"), (2, "x y z"), (2, "a b c"), (5, "a b c"))])
    assert {r["component_id"] for r in hmh.near_duplicates(rows, hmh.Rule(2)).collect()} == {1}


def test_registers_are_zeros_and_mantissa():
    found = hmh.registers(np.array([1 << 40], np.uint64))
    least = np.uint64(1 << 40) * hmh._multipliers()
    for register, value in zip(found.tolist(), least.tolist()):
        zeros = 64 - value.bit_length()
        assert register >> 10 in (zeros, zeros + 1) and (register & 1023) == (value << 1 + zeros) % 2**64 >> 54


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    for shared in (0, 1000, 1800):
        a, b = pool[:2000], pool[2000 - shared:4000 - shared]
        equal = np.array([(hmh.registers(a) == hmh.registers(b)).sum()], float)
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(hmh.estimate(equal, np.array([len(a)]), np.array([len(b)]))[0] - truth) < 0.2
    chance = hmh.chance(np.array([1000]), np.array([1000]))[0]
    assert 0 < chance < 0.01


def test_words_are_hashed_as_they_are_defined():
    for text in ("A b\tc", "", None, " x ", "É é", "a" * 100_000 + " " + "b" * 10, "a\x1cb a\x85b"):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        found = word_hashes(text, WHITE)
        assert len(found) == len(words) and len(set(found.tolist())) == len(set(words))
        assert len(shingles(found, 2)) == len(shingle_set(text, 2))


def test_long_texts_are_cut_at_separators(monkeypatch):
    from granary.llm import wordhash

    text = " ".join(f"word{i % 50}" for i in range(3000)) + " " + "z" * 500
    whole = word_hashes(text)
    monkeypatch.setattr(wordhash, "PIECE_BYTES", 64)
    assert (word_hashes(text) == whole).all()


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    links = spark.createDataFrame([*chain, (5, 3), (3, 5), (7, 7), (3, 9), (None, 4), (200, 150), (150, 300)], "a long, b long")
    found = {r["vertex"]: r["component"] for r in components(links).collect()}
    assert found == {**{i: 100 for i in range(100, 141)}, 3: 3, 5: 3, 9: 3, 150: 150, 200: 150, 300: 150}
    assert components(links.limit(0)).count() == 0


def test_units_survive_any_batch_borders():
    rng = np.random.default_rng(6)
    unit = np.sort(rng.integers(0, 9, 60))
    zero = pa.array(np.zeros(60, np.int64))
    bands = pa.array(rng.integers(0, 9, (60, 32)).tolist(), pa.list_(pa.int64()))
    whole = pa.RecordBatch.from_arrays([zero, pa.array(unit), zero, zero, pa.array(np.arange(60)), zero, zero, bands], [*hmh.UNIT, "rep", "block", "n", "bands"])
    for step in (1, 7, 60):
        got = [(u.key, u.rep.tolist()) for u in hmh.units(whole.slice(a, step) for a in range(0, 60, step))]
        assert got == [(k, np.flatnonzero(unit == k).tolist()) for k in sorted(set(unit.tolist()))]


def test_query_equals_sql(spark):
    import duckdb

    from granary.llm.oracles import ORACLES
    from granary.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    expected = con.execute(f"SELECT doc_id, n_shingles, component_id, kept FROM ({ORACLES['op3_hyperminhash']})").fetchall()
    found = QUERIES["op3_hyperminhash"](spark, folder).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, found)) == sorted(expected)
