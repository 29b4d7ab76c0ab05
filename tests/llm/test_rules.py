import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from odd import crowded, documents, empty
from pyspark.sql import functions as F

from granary.llm import decision_lists as dl
from granary.llm import license_scan, poisson_mix
from granary.llm.oracles import ORACLES
from granary.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


# ---- decision lists --------------------------------------------------------------------------

def counted(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + d for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for d in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in dl.SYMBOLS for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside), "n_lines": len(lines), "n_distinct": len(set(words))}


def test_statistics_of_odd_rows(spark):
    rows = crowded(documents(spark), "N_WORDS", "_w")
    extra = [(20, "a b c a b c", None, None, 0), (21, "a a a a", None, None, 0), (22, "x y z w x y z", None, None, 0), (23, "a\n\na\n \n \nb\na", None, None, 0),
             (24, "a\x1cb\x85c d\x0be 😀", None, None, 0)]
    rows = rows.unionByName(crowded(documents(spark, extra), "N_WORDS", "_w"))
    found = dl.statistics(rows).join(rows.select(F.col("doc_id").alias("i"), F.col("text").alias("t")).distinct(), F.col("doc_id").eqNullSafe(F.col("i"))).collect()
    assert len(found) == rows.count()
    for row in found:
        assert {k: row[k] for k in counted("")} == counted(row["t"]), row["doc_id"]
    assert dl.statistics(empty(spark)).count() == 0


@pytest.mark.parametrize("short", [lambda h: F.lit(0).cast("long"), lambda h: h.bitwiseAND(F.lit(3 << dl.PLACE_BITS))])
def test_repeats_are_exact_under_colliding_hashes(spark, monkeypatch, short):
    whole = dl.window_hash
    monkeypatch.setattr(dl, "window_hash", lambda *words: short(whole(*words)))
    rng = np.random.default_rng(2)
    texts = ["a b c x a b c", "a b c a b d a b c", "a b", "a a a a", "p q r s t u v w x y z", *[" ".join(f"w{k}" for k in rng.integers(0, 6, n)) for n in (20, 60, 200)]]
    rows = documents(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)])
    found = {r["doc_id"]: r["n_repeat_words"] for r in dl.statistics(rows).collect()}
    assert found == {i: counted(t)["n_repeat_words"] for i, t in enumerate(texts)}


def test_query_is_native_and_right(spark):
    found = QUERIES["op7_decision_lists"](spark, FOLDER)
    assert not re.search(r"Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(texts)
    for row in rows:
        own = counted(texts[row["doc_id"]])
        assert all(row[c] == own[c] for c in dl.BASE)
        assert row["base_failed"] == (own["n_words"] < 50 or 100 * own["n_repeat_words"] > 50 * own["n_words"])
        assert not (row["base_failed"] and row["kept"])
    judged = [r for r in rows if r["doc_id"] in quality and not r["base_failed"]]
    assert np.mean([r["kept"] for r in judged if quality[r["doc_id"]] == 1]) > 0.97


def test_rules_are_learned_and_ordered(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(600):
        kind = i % 6
        words = [f"w{k}" for k in rng.integers(0, 500, 80)]
        text = " ".join(w + "$$$" if kind == 0 else w for w in words) if kind != 1 else " | ".join(words)
        rows.append((i, text, None, None, 0, int(kind > 1)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, quality int")
    stats = dl.statistics(frame)
    rules = dl.learn(stats, frame.select("doc_id", "quality"))
    assert 1 <= len(rules) <= 4 and all(str(r).startswith("reject if ") for r in rules)
    judged = dl.judge(stats, rules).collect()
    assert np.mean([r["kept"] == bool(r["quality"]) for r in judged]) > 0.98
    assert dl.learn(stats, frame.select("doc_id", "quality").limit(0)) == []
    assert dl.learn(stats, frame.select("doc_id", F.lit(1).alias("quality"))) == []
    assert dl.judge(dl.statistics(empty(spark)), rules).count() == 0


def plain_rules(rows, limits=dl.Limits()):
    """Sequential covering by counting every condition over lists of rows."""
    names = list(dl.features())
    cuts = {f: sorted({sorted(r[f] for r in rows)[max(math.ceil(q * len(rows)), 1) - 1] for q in dl.QUANTILES}) for f in names}

    def holds(rule, row):
        return all((row[f] > cut) == above for f, above, cut in rule)

    def counts(rule, some):
        covered = [r["_bad"] for r in some if holds(rule, r)]
        return sum(covered), len(covered) - sum(covered)

    found = []
    while len(found) < limits.rules:
        rule, inside = (), [r for r in rows if r["_grows"]]
        while len(rule) < limits.conditions and all(counts((), inside)):
            all_p, all_n = counts((), inside)
            best, most = None, 1e-9
            for option in [(f, above, cut) for f in names for cut in cuts[f] for above in (False, True)]:
                p, n = counts((option,), inside)
                gain = p * (math.log2(p / (p + n)) - math.log2(all_p / (all_p + all_n))) if p else 0.0
                if gain > most:
                    best, most = option, gain
            if best is None:
                break
            f, above, cut = best
            low, high = [r[f] for r in inside if r[f] <= cut], [r[f] for r in inside if r[f] > cut]
            rule += ((f, above, (max(low) + min(high)) / 2 if low and high else cut),)
            inside = [r for r in inside if holds(rule, r)]
        if not rule:
            break
        tried = [((p - n) / (p + n) if p + n else -1.0, -k, p, n) for k in range(1, len(rule) + 1)
                 for p, n in [counts(rule[:k], [r for r in rows if not r["_grows"]])]]
        _, k, p, n = max(tried)
        if p < limits.covered or p < limits.precision * (p + n):
            break
        found.append(rule[:-k])
        rows = [r for r in rows if not holds(rule[:-k], r)]
    return found


def test_rules_equal_plain_covering(spark):
    rng = np.random.default_rng(5)
    texts = []
    for i in range(500):
        words = [f"w{k}" for k in rng.integers(0, 400, rng.integers(30, 120))]
        kind = i % 7
        words = [w + "$" * 3 if kind == 0 and rng.random() < 0.6 else w.upper() if kind == 1 and rng.random() < 0.7 else w for w in words]
        texts.append((i, (" | " if kind == 2 else " ").join(words), None, None, 0, int(kind > 2) if rng.random() > 0.04 else int(kind <= 2)))
    frame = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long, quality int")
    stats = dl.statistics(frame)
    rules = dl.learn(stats, frame.select("doc_id", "quality"))
    learned = stats.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1)
    rows = [r.asDict() for r in learned.select(*[v.alias(n) for n, v in dl.features().items()], (F.col("quality") == 0).alias("_bad"),
                                                   (F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0).alias("_grows")).collect()]
    expected = plain_rules(rows)
    assert len(rules) >= 2 and [[(c.feature, c.above, pytest.approx(c.cut)) for c in r.conditions] for r in rules] == [list(r) for r in expected]
    judged = dl.judge(stats, rules).select("kept", "base_failed", *[v.alias(f"_{n}") for n, v in dl.features().items()]).collect()
    for row in judged:
        rejected = any(all((row[f"_{f}"] > cut) == above for f, above, cut in rule) for rule in expected)
        assert row["kept"] == (not row["base_failed"] and not rejected)


# ---- mixing ----------------------------------------------------------------------------------

def test_mix_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    expected = con.execute(ORACLES["op8_poisson_mix"]).fetchall()
    found = [tuple(r) for r in QUERIES["op8_poisson_mix"](spark, FOLDER).collect()]
    assert sorted(found) == sorted(expected)
    assert found != sorted(found)


def test_inverse_of_the_distribution(spark):
    rate = spark.createDataFrame([(0.2,), (3.0,), (16.0,), (50.0,)], "_rate double")
    for row in poisson_mix.with_tables(rate).collect():
        assert row["_pieces"] == max(1, math.ceil(row["_rate"] / 16))
        p, total = math.exp(-row["_mean"]), 0.0
        for k, reached in enumerate(row["_table"]):
            total += p
            assert reached == pytest.approx(total, rel=1e-12)
            p *= row["_mean"] / (k + 1)
        assert row["_table"][-1] == pytest.approx(1.0, abs=1e-12)


def test_mix_hits_the_weights_and_is_repeatable(spark):
    rows = documents(spark, [(i, f"t{i}", "en", ("a", "a", "a", "b", None)[i % 5], 1) for i in range(3000)])
    weights = {"a": 1.0, "b": 2.0, None: 1.0}
    mixed = poisson_mix.replicate(rows, weights, total=8000)
    assert mixed.columns == [*rows.columns, "copy"]
    share = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert all(abs(share[s] - 8000 * w / 4) < 5 * math.sqrt(8000 * w / 4 * 5) for s, w in weights.items())
    again = poisson_mix.replicate(rows.repartition(5), weights, total=8000)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, again.collect()))
    counts = Counter(r["doc_id"] for r in mixed.where("source = 'b'").collect())
    values = [counts.get(i, 0) for i in range(3, 3000, 5)]
    assert np.var(values) == pytest.approx(np.mean(values), rel=0.25)  # Poisson: variance equals mean
    assert poisson_mix.replicate(rows, {"a": 1.0}, total=10).where("source = 'b' or source is null").count() == 0


def test_mix_of_odd_rows(spark):
    rows = crowded(documents(spark), "Copy", "_rate", "_source")
    mixed = poisson_mix.replicate(rows, total=400.0)
    assert mixed.columns == [*rows.columns, "copy_"] and mixed.count() > 100
    per = Counter((r["doc_id"], r["copy_"]) for r in mixed.collect())
    assert all(n == (2 if i == 2 else 1) for (i, _), n in per.items())
    assert poisson_mix.replicate(empty(spark)).count() == 0


# ---- licences --------------------------------------------------------------------------------

def plain_cosines(pieces, templates):
    """(piece, template) -> cosine, by dictionaries."""
    terms = lambda t: [x for x in (y.strip(".-") for y in re.split(r"[^a-z0-9.-]+", t.lower())) if x]
    df = Counter()
    for p in pieces:
        df.update(set(terms(p)))
    def vector(t):
        v = {k: n * (math.log((1 + len(pieces)) / (1 + df[k])) + 1) for k, n in Counter(terms(t)).items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {k: x / length for k, x in v.items()}
    return {p: {n: max(sum(vector(p).get(k, 0) * x for k, x in vector(t).items()) for t in ts) for n, ts in templates.items()} for p in set(pieces)}


def test_cosines_are_the_definition(spark):
    pieces = ["Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC 4.0.", "our license is the apache license", "permission is not given here",
              "This is GNU General Public License version 3 code", "license"]
    expected = plain_cosines(pieces, license_scan.TEMPLATES)
    found = {r["_piece"]: r for r in license_scan.match(spark.createDataFrame([(p,) for p in pieces], "_piece string"), least=0.0).collect()}
    for piece, scores in expected.items():
        best = max(scores.values())
        if best > 0:
            assert found[piece]["score"] == pytest.approx(best) and scores[found[piece]["licence"]] == pytest.approx(best)


def test_files_inherit_from_the_nearest_directory(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [("LICENSE", mit), ("a/x.py", "code"), ("a/b/COPYING.txt", gpl), ("a/b/c/d/y.py", "code\n" * 3), ("a/b/c/z.py", f"text\n{mit}\nmore"),
            ("q/LICENSE", "nothing known"), ("q/w.py", None), ("v.py", ""), (None, "code"), (None, mit), ("a/x.py", "code")]
    files = crowded(spark.createDataFrame(rows, "path string, text string"), "Score", "_in", "_dir")
    found = Counter((r["path"], r["licence"], r["via"], r["licence_from"]) for r in license_scan.scan(files).collect())
    assert found == Counter({
        ("LICENSE", "MIT", "file", ""): 1, ("a/x.py", "MIT", "inherited", ""): 2, ("a/b/COPYING.txt", "GPL-3.0", "file", "a/b"): 1,
        ("a/b/c/d/y.py", "GPL-3.0", "inherited", "a/b"): 1, ("a/b/c/z.py", "MIT", "header", "a/b/c"): 1, ("q/LICENSE", "MIT", "inherited", ""): 1,
        ("q/w.py", "MIT", "inherited", ""): 1, ("v.py", "MIT", "inherited", ""): 1, (None, None, None, None): 1, (None, "MIT", "header", None): 1})
    assert license_scan.scan(files.limit(0)).count() == 0


def test_statements_of_the_table(spark):
    said = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
            "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Released under the MIT License.": "MIT"}
    expected = defaultdict(set)
    for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        for sentence, name in said.items():
            if sentence in row["text"]:
                expected[row["doc_id"]].add(name)
    found = {r["doc_id"]: r["licence"] for r in QUERIES["op9_license_scan"](spark, FOLDER).where("via in ('header', 'file')").collect()}
    assert found.keys() == expected.keys() and all(found[i] in expected[i] for i in found)


def wrapped(text, mark="# ", width=70):
    import textwrap

    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def test_wrapped_headers_identifiers_and_whole_files(spark):
    scan = license_scan
    rows = [(f"{n}.py", wrapped("Copyright 2020 A. Writer. " + scan.GNU_GRANT.format(*w)) + "\nimport os\n", n) for n, *w in scan.FAMILY]
    rows += [(f"{n}.c", "/*\n" + wrapped(scan.GNU_GRANT.format(*w) + scan.GNU_REST.format(*w), " * ") + "\n */\nint x;\n", n) for n, *w in scan.FAMILY]
    rows += [("mit.js", wrapped(scan.MIT_GRANT, "// "), "MIT"), ("two/LICENSE", wrapped(scan.BSD_TWO + scan.BSD_REST, ""), "BSD-2-Clause"),
             ("three/LICENSE", wrapped(scan.BSD_TWO + scan.BSD_THIRD + scan.BSD_REST, ""), "BSD-3-Clause"),
             ("s.py", "# SPDX-License-Identifier: Apache-2.0\nx = 1", "Apache-2.0"), ("t.c", "/* SPDX-License-Identifier: MIT OR Apache-2.0 */", "MIT OR Apache-2.0"),
             ("plain.py", "# this code redistributes load\nx = 1", None)]
    rows += [(f"f{k}/COPYING", t, n) for n, texts in scan.whole_texts().items() for k, t in enumerate(texts)]
    files = spark.createDataFrame([(f"d{i}/{p}", t, n) for i, (p, t, n) in enumerate(rows)], "path string, text string, want string")
    assert [(r["path"], r["licence"], r["want"]) for r in scan.scan(files).collect() if r["licence"] != r["want"]] == []


def test_notices_without_the_word_licence(spark):
    rows = [("isc.c", "/*\n" + wrapped(license_scan.TEMPLATES["ISC"][0], " * ") + "\n */", "ISC"), ("z.c", license_scan.TEMPLATES["Zlib"][0], "Zlib"),
            ("u.c", "// This is free and unencumbered software released into the public domain.", "Unlicense"), ("plain.c", "// taken as is from the shelf", None)]
    files = spark.createDataFrame([(f"d{i}/{p}", t, n) for i, (p, t, n) in enumerate(rows)], "path string, text string, want string")
    assert [(r["path"], r["licence"]) for r in license_scan.scan(files).collect() if r["licence"] != r["want"]] == []


def test_whole_texts_are_read_from_an_archive(tmp_path):
    import subprocess
    import sys
    import zipfile
    from pathlib import Path

    root = Path(license_scan.__file__).parents[2]
    with zipfile.ZipFile(tmp_path / "package.zip", "w") as out:
        for path in (root / "granary").rglob("*"):
            if path.suffix in (".py", ".txt"):
                out.write(path, path.relative_to(root))
    code = "from granary.llm import license_scan as s; print(s.__file__); assert set(s.FULL_TEXTS) <= set(s.whole_texts())"
    done = subprocess.run([sys.executable, "-c", code], env={"PYTHONPATH": str(tmp_path / "package.zip"), "PATH": ""}, cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0 and "package.zip" in done.stdout, done.stderr
