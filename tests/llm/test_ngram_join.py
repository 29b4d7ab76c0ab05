import numpy as np
import pytest
from odd import crowded, documents, empty
from test_copies import plain_components, variants

from granary.llm import ngram_join as nj
from granary.llm.wordhash import shingles, word_hashes

ALL_FREQUENT = nj.Classes(bits=6, slack=-10**6)
MIXED = nj.Classes(bits=8, slack=0)


def compared(spark, rows, rule, classes=nj.Classes()):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nj.join(frame, rule, classes).collect()}
    assert found == plain_components(rows, rule.size, rule.percent)
    return found


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
@pytest.mark.parametrize("classes", [nj.Classes(), MIXED, ALL_FREQUENT])
def test_every_pair_that_is_similar_enough_shares_a_signature(percent, classes):
    """Sets of few tokens of a small vocabulary, compared with all others; whatever the classes of the tokens."""
    rng = np.random.default_rng(percent)
    rule, vocabulary = nj.Rule(1, percent), word_hashes(" ".join(f"w{i}" for i in range(400)))
    sets = []
    for _ in range(150):
        base = rng.choice(vocabulary, rng.integers(1, 120), replace=False)
        for _ in range(4):
            cut = base[rng.random(len(base)) > rng.choice([0, 0.02, 0.06, 0.3])]
            own = np.unique(np.concatenate([cut, rng.choice(vocabulary, rng.integers(0, 4))]))
            if len(own):
                sets.append(own)
    loads = np.bincount(np.concatenate([classes.of(s) for s in sets]), minlength=1 << classes.bits)
    seen = nj.frequency(loads, classes)
    posted = [set(nj.signatures(s, seen, rule).tolist()) for s in sets]
    met = 0
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= percent * (len(a) + len(sets[j]) - both) and not np.array_equal(a, sets[j]):
                met += 1
                assert posted[i] & posted[j]
    assert met or percent == 100


def test_frequent_tokens_are_posted_as_combinations_only():
    tokens, rule = np.sort(word_hashes(" ".join(f"w{i}" for i in range(200)))), nj.Rule(1, 90)
    for kind in (2, 3):
        seen = nj.Frequency(np.zeros(1 << 6, np.uint8), np.full(1 << 6, kind, np.uint8), nj.Classes(bits=6))
        for octave in rule.octaves(len(tokens)):
            singles = set(nj.mix(tokens * nj._ODD + np.uint64(octave)).tolist())
            found = set(nj.signatures(tokens, seen, rule).tolist())
            assert found and not found & singles


def test_counts_by_bucket_never_rule_out_a_link():
    rule = nj.Rule(3, 80)
    sets = [shingles(word_hashes(t), 3) for _, t in variants(5, 8, 6, 150, 6)]
    members = nj.Members(*[np.zeros(len(sets), int)] * 3, np.array([len(s) for s in sets]), np.stack([nj.masses(s) for s in sets]))
    x, y = (g.ravel() for g in np.meshgrid(range(len(sets)), range(len(sets))))
    can = nj.possible(members, x, y, rule)
    both = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(x, y)])
    linked = 100 * both >= 80 * (members.n[x] + members.n[y] - both)
    assert linked.sum() > len(sets) and not (linked & ~can).any() and (~can).any()


@pytest.mark.parametrize("classes", [nj.Classes(), ALL_FREQUENT])
def test_groups_of_copies_equal_brute_force(spark, classes):
    rows = variants(11, 25, 8, 140, 3)
    found = compared(spark, rows, nj.Rule(3, 90), classes)
    assert 25 <= len({c for _, c in found.values()}) < len(rows)


def test_lower_limit_and_short_texts(spark):
    rows = variants(2, 30, 5, 12, 3) + [(90_001, "one"), (90_002, "ONE"), (90_003, "one two"), (90_004, "one two"), (90_005, "")]
    compared(spark, rows, nj.Rule(2, 50), MIXED)


def test_lists_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 7)
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(80):
        own = list(base)
        own[rng.integers(0, 200)] = f"x{i}"
        rows.append((i, " ".join(own)))
    found = compared(spark, rows, nj.Rule(3, 90), ALL_FREQUENT)
    assert {c for _, c in found.values()} == {0}


def test_a_passage_that_many_share_links_nothing(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"{' '.join(f'u{i}x{k}' for k in range(40))} {passage}") for i in range(300)]
    found = compared(spark, rows, nj.Rule(3, 90), nj.Classes(bits=12, slack=4))
    assert all(c == i for i, (_, c) in found.items())


def test_odd_rows_and_no_rows(spark):
    frame = crowded(documents(spark), "n", "h1", "sig", "component", "rep", "_id")
    found = sorted({tuple(r) for r in nj.join(frame).collect()}, key=repr)
    assert (2, 6, 1) in found and (1, 6, 1) in found and (3, 0, 3) in found and (4, 0, 4) in found and (5, 0, 5) in found
    assert (7, 1, 7) in found and (None, 1, None) in found
    assert nj.join(frame).count() == documents(spark).count()
    assert nj.join(empty(spark)).collect() == []


def test_rows_that_share_an_id_are_one_document(spark):
    long, short = " ".join(f"a{i}" for i in range(300)), " ".join(f"b{i}" for i in range(40))
    rows = [(7, long), (3, long + " end"), (7, short), (12, short), (20, "else where here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in nj.join(frame).collect()} == {(7, 3), (3, 3), (12, 3), (20, 20)}
