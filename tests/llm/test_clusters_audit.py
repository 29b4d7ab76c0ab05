import hashlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from odd import crowded, documents, empty

from granary.llm import filter_audit as fa
from granary.llm import table_clusters as tc

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_clusters(rows, rule):
    kept = [(i, [int(np.floor(float(np.float32(x)) * rule.scale)) for x in v]) for i, v in rows
            if v is not None and len(v) == rule.dimensions and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted((r for r in kept if r[0] is not None), key=lambda r: (hashlib.sha256(f"{rule.seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in (named + [r for r in kept if r[0] is None])[:rule.clusters]]

    def near(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
        return min(range(len(far)), key=lambda k: (far[k], k)), min(far)

    for _ in range(rule.rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[near(v)[0]].append(v)
        for k, vs in own.items():
            centroids[k] = [sum(c) // len(vs) for c in zip(*vs)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, k, far in found:
        inertia[k] += far
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, k, far, inertia[k], sum(inertia.values()), sha[k]) for i, k, far in found)


RULE = tc.Rule(dimensions=4, clusters=5, rounds=3)


def clustered(spark, rows, rule=RULE):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    return Counter(tuple(r) for r in tc.cluster(frame, rule).collect())


def test_clusters_equal_plain_rounds(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 4)) * 3)]
    assert clustered(spark, rows) == plain_clusters(rows, RULE)


def test_ties_copies_and_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i % 40, [float(i % 3), 0.0, -0.5, -0.01]) for i in range(120)]
    rows += [(500, None), (501, []), (502, [1.0]), (503, [1.0, None, 1.0, 1.0]), (504, [nan, 0.0, 0.0, 0.0]), (505, [inf, 0.0, 0.0, 0.0]),
             (506, [0.0] * 4), (506, [0.0] * 4), (None, [9.0, 9.0, 9.0, 9.0]), (507, [-1e-9, 0.0, 100000.0, -100000.0])]
    assert clustered(spark, rows) == plain_clusters(rows, RULE)


def test_few_and_no_vectors(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0]), (2, [1.0, 2.0, 3.0, 5.0])]
    assert clustered(spark, rows) == plain_clusters(rows, RULE)
    assert clustered(spark, []) == Counter() and clustered(spark, [(1, None)]) == Counter()


def test_other_columns_cannot_clash(spark):
    frame = crowded(spark.createDataFrame([(i, [float(i)] * 4, 0) for i in range(9)], VECTORS), "cluster", "distance", "inertia", "total")
    assert tc.cluster(frame, RULE).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert tc.cluster(frame, RULE).count() == 9


def test_components_too_large_are_refused(spark):
    with pytest.raises(Exception, match="may not fit 64 bits"):
        clustered(spark, [(1, [1e30, 0.0, 0.0, 0.0])])


@pytest.mark.parametrize("spread", [3, 10**6])
def test_tables_give_the_distances(spread):
    rng = np.random.default_rng(spread)
    rows, centroids = rng.integers(-spread, spread, (50, 6)), rng.integers(-spread, spread, (4, 6))
    assert (tc.distances(rows, centroids) == ((rows[:, None] - centroids[None]) ** 2).sum(axis=2)).all()


# ---- filter audit ----------------------------------------------------------------------------

def marginal(v, players):
    """Shapley values as means of what a player adds, over all orders."""
    total = [Fraction(0)] * players
    orders = list(permutations(range(players)))
    for order in orders:
        before = 0
        for i in order:
            total[i] += v[before | 1 << i] - v[before]
            before |= 1 << i
    return [t / len(orders) for t in total]


@pytest.mark.parametrize("players", [1, 2, 3, 4, 5])
def test_least_squares_gives_shapley_values(players):
    rng = np.random.default_rng(players)
    v = [0, *map(int, rng.integers(-50, 50, (1 << players) - 1))]
    weights = fa.shapley_weights(players)
    assert [sum(w * x for w, x in zip(row, v)) for row in weights] == marginal(v, players)


def plain_audit(rows, labels):
    """Every order applied to the documents one after the other."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    docs = []
    for i, t, lang in rows:
        t = t or ""
        words = t.encode().split()
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > least.get(t, i)}
        docs.append((lang or "", {f for f in fails if fails[f]}, i is not None and i in good, i is not None and i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shares = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shares[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                                          sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for (p, order, step), line in out.items():
            if p == part:
                line.append(shares[order[step - 1]])
    return out


def audited(frame, labels):
    found = fa.audit_documents(frame, labels).collect()
    assert all(r["filter"] == r["filter_order"][r["step"] - 1] for r in found)
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in found}


def test_audit_equals_every_order_applied(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(120):
        words = [f"w{k}" for k in rng.integers(0, rng.choice([40, 4000]), rng.integers(0, 200))]
        text = " ".join(words) + " " * (i % 3) + ("#" if i % 5 == 0 else "") + ("ABCDEF" * 40 if i % 7 == 0 else "")
        rows.append((i * 7 % 131, text, [None, "", "de", "en"][i % 4]))
    rows += [(1000 + i, rows[i][1], "fr") for i in range(0, 40, 3)] + [(2000, None, "de"), (1999, "", "de"), (None, rows[0][1], "de"), (rows[0][0], rows[0][1], "en")]
    labels = [(i, int(i % 2), int(i % 3 == 0)) for i in range(0, 1100, 2)] + [(4, 1, None), (4, 0, 1), (None, 1, 1), (6, None, None)]
    frame = crowded(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "part", "mask", "d0", "good", "_least")
    got = audited(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got == plain_audit(rows, labels)


def test_audit_of_odd_rows_and_empty_tables(spark):
    frame = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audited(frame, none) == plain_audit([(r["doc_id"], r["text"], r["lang"]) for r in frame.collect()], [])
    assert fa.audit_documents(empty(spark), none).collect() == []


def test_other_filters_and_no_measures(spark):
    flagged = spark.createDataFrame([("a", 3), ("a", 1), ("a", 0), ("b", 0)], "part string, mask int")
    found = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in fa.audit(flagged, "XY").collect()}
    assert found == {("a", "XY", 1): (1, 2, 0, 1, 3), ("a", "XY", 2): (1, 0, 1, 0, 1), ("a", "YX", 1): (2, 1, 0, 0, 1), ("a", "YX", 2): (1, 1, 1, 1, 3),
                     ("b", "XY", 1): (1, 0, 0, 0, 0), ("b", "XY", 2): (1, 0, 0, 0, 0), ("b", "YX", 1): (1, 0, 0, 0, 0), ("b", "YX", 2): (1, 0, 0, 0, 0)}
