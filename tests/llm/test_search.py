import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import permutation_index as pi
from granary.llm.queries import QUERIES


def exact(ids, vectors, query_ids, k):
    out = {}
    for q in query_ids:
        score = (vectors * vectors[ids.index(q)]).sum(axis=1)
        out[q] = sorted(((-s, i) for s, i in zip(score, ids) if i != q))[:k]
    return out


def test_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, vectors = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float)
    found = {}
    for r in QUERIES["op1_permutation_index"](spark, "/root/testdata/sf0.1").collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    queries = [i for i in ids if i % 20 == 0]
    assert set(found) == set(queries)
    hits = 0
    for q, best in exact(ids, vectors, queries, 20).items():
        assert sorted(found[q]) == list(range(1, 21))
        scores = [found[q][k][1] for k in range(1, 21)]
        assert scores == sorted(scores, reverse=True)
        for i, s in found[q].values():
            assert s == pytest.approx(float((vectors[ids.index(i)] * vectors[ids.index(q)]).sum()), abs=1e-12)
        hits += len({i for _, i in best} & {i for i, _ in found[q].values()})
    assert hits / (20 * len(queries)) >= 0.9


def test_footrule_is_the_definition():
    rng = np.random.default_rng(0)
    pivots, length = 12, 5
    order = np.array([rng.permutation(pivots)[:length] for _ in range(30)], np.int16)
    files = pi.InvertedFiles(order, pivots)
    place = lambda o, p: list(o).index(p) if p in o else length
    for query in order[:6]:
        assert files.footrule(query).tolist() == [sum(abs(place(query, p) - place(o, p)) for p in range(pivots)) for o in order]


def test_ties_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 300)]
    rows += [(1000 + i, rng.normal(size=3).tolist()) for i in range(50)]
    rows += [(2000, None), (2001, []), (2002, [0.0, 0.0, 0.0]), (2003, [1.0, None, 1.0]), (2004, [float("nan"), 1.0, 1.0]),
             (2005, [float("inf"), 1.0, 1.0]), (2006, [1.0, 2.0]), (None, [9.0, 9.0, 9.0]), (2100, [0.1, 0.1, 0.1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("_order", F.lit(1)).withColumn("score", F.lit("own"))
    found = pi.search(frame, lambda key: key % 100 == 0, nearest=5, share=1.0, block_rows=100, query_rows=2).collect()
    usable = [(i, v) for i, v in rows if i is not None and v and len(v) == 3 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, vectors = [i for i, _ in usable], np.array([v for _, v in usable])
    expected = exact(ids, vectors, [i for i in ids if i % 100 == 0], 5)
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert got == {q: [(pytest.approx(s), i) for s, i in best] for q, best in expected.items()}


def test_few_and_no_rows(spark):
    two = spark.createDataFrame([(0, [1.0]), (20, [2.0])], "vec_id long, embedding array<float>")
    found = sorted(tuple(r) for r in pi.search(two, lambda key: key % 20 == 0, nearest=20).collect())
    assert found == [(0, 1, 20, 2.0), (20, 1, 0, 2.0)]
    assert pi.search(two.limit(0), lambda key: key % 20 == 0, nearest=20).count() == 0
    assert pi.search(two.where("vec_id = 0"), lambda key: key % 20 == 0, nearest=20).count() == 0
