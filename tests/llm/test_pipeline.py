"""Every stage against a plain version on its own input."""

from collections import Counter

import numpy as np
import pytest
from odd import crowded, documents, empty
from test_copies import plain_components
from test_tokens import plain  # noqa: F401

import corpus_pipeline as cp
from granary.llm import gru_language, pairwise_quality, poisson_mix

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output of each stage."""
    docs, found = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        place = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, FOLDER).write.parquet(place)
        found[name] = (docs, spark.read.parquet(place))
        docs = found[name][1]
    return found


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_in_order():
    assert [n for n, _ in cp.STAGES] == ["quality", "language", "near_copies", "mixture", "tokens"]


def test_quality_stage(spark, steps):
    before, after = steps["quality"]
    model = pairwise_quality.learn(before, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = before.collect()
    score = model.score(np.array([pairwise_quality.describe(r["text"]) for r in rows]))
    assert after.columns == COLUMNS and ids(after) == Counter(r["doc_id"] for r, s in zip(rows, score) if s >= 0.5)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = [ids(after)[i] for i in labels if labels[i] == 1]
    assert np.mean(kept) > 0.97 and 0 < after.count() < before.count()


def test_language_stage(steps):
    before, after = steps["language"]
    names, scores = gru_language.predict(gru_language.learn(before), [r["text"] for r in before.collect()])
    assert after.columns == COLUMNS
    assert ids(after) == Counter(r["doc_id"] for r, n, s in zip(before.collect(), names, scores) if n != "und" and s >= 0.3)
    assert after.count() > 0.98 * before.count()


def test_near_copy_stage(steps):
    before, after = steps["near_copies"]
    expected = {c for _, c in plain_components([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80).values()}
    assert after.columns == COLUMNS and set(ids(after)) == expected and after.count() == len(expected)


def test_mixture_stage(steps):
    before, after = steps["mixture"]
    assert after.columns == COLUMNS
    assert ids(after) == ids(poisson_mix.replicate(before, shuffle=False))


def test_token_stage(steps, plain):  # noqa: F811
    before, after = steps["tokens"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    assert ids(after) == ids(before)
    for row in after.collect():
        assert row["ids"] == plain.encode_ordinary(texts[row["doc_id"]]) and row["n_tokens"] == len(row["ids"]) and row["round_trip"]


def test_run_gives_the_last_stage(spark, steps):
    assert ids(cp.run(spark, FOLDER)) == ids(steps["tokens"][1])


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_stages_take_odd_and_no_rows(spark, name):
    stage = dict(cp.STAGES)[name]
    rows = crowded(documents(spark), "Score", "copy", "_copy", "label")
    found = stage(spark, rows, FOLDER)
    if name == "tokens":
        assert found.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "round_trip"]
    else:
        assert found.columns == rows.columns
    assert found.count() >= 0
    assert stage(spark, empty(spark), FOLDER).count() == 0


def test_pipeline_is_registered():
    import __spark_entry__ as entry_point

    assert "pipeline" in entry_point.queries() and sum(n.startswith("op") for n in entry_point.queries()) == 13
