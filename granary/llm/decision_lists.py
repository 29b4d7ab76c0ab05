"""Quality rules as learned decision lists, with DataFrame functions only.

Statistics of whole texts are Spark expressions. Rules to reject are learned from labelled statistics by
sequential covering: a rule grows one threshold condition at a time by information gain, is pruned on
rows that did not grow it, and the rows it covers leave before the next rule is learned. Counts for every
possible condition come from one grouped aggregate per step; the driver sees only those counts. The list
becomes ordered ``when`` expressions.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import Callable, NamedTuple, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import fold_of, packed, unpacked
from granary.operators.shared_store import settle

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"
# Low bits of a window key hold its place in the text; a text has fewer words than this.
PLACE_BITS = 28

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_upper", "n_digits", "n_shouts", "n_bars", "n_lines", "n_distinct")
QUANTILES = (.002, .005, .01, .02, .03, .05, .08, .12, .16, .2, .25, .3, .4, .5, .6, .7, .75, .8, .84, .88, .92, .95, .97, .98, .99, .995, .998)


# ---- statistics ------------------------------------------------------------------------------

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body reads it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def chars_in(text: Column, characters: str) -> Column:
    """How many of ``characters`` a text holds."""
    held = F.coalesce(text, F.lit(""))
    return (F.length(held) - F.length(F.translate(held, characters, ""))).cast("long")


def window_hash(*words: Column) -> Column:
    return F.xxhash64(*words)


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice; exact whatever the hashes.

    High bits of window hashes are sorted together with their places. If neighbours with one hash always
    have the same words, so has every run of that hash, and members of runs are the repeats. A text where
    two different windows share a hash is sorted by the words themselves. The places found are then
    merged as intervals.
    """
    mask = (1 << PLACE_BITS) - 1

    def at(items, i):
        return F.get(items, i.cast("int"))

    def alike(a, b):
        return F.shiftrightunsigned(a.bitwiseXOR(b), PLACE_BITS) == 0

    def windows(words_):
        return F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(words_) - 3),
            lambda i: window_hash(at(words_, i), at(words_, i + 1), at(words_, i + 2)).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))))

    def collides(words_, keys):
        def differ(a, b):
            p, q = a.bitwiseAND(F.lit(mask)), b.bitwiseAND(F.lit(mask))
            return alike(a, b) & ((at(words_, p) != at(words_, q)) | (at(words_, p + 1) != at(words_, q + 1)) | (at(words_, p + 2) != at(words_, q + 2)))

        return F.size(F.filter(keys, lambda key, i: (i > 0) & differ(key, at(keys, F.greatest(i - 1, F.lit(0)))))) > 0

    def twice(keys, same):
        return F.filter(keys, lambda key, i: F.coalesce(same(key, at(keys, i + 1)), F.lit(False))
                        | ((i > 0) & same(key, at(keys, F.greatest(i - 1, F.lit(0))))))

    def by_hash(keys):
        return F.sort_array(F.transform(twice(keys, alike), lambda key: key.bitwiseAND(F.lit(mask))))

    def by_words(words_):
        keys = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words_) - 3), lambda i: F.struct(
            F.struct(at(words_, i).alias("a"), at(words_, i + 1).alias("b"), at(words_, i + 2).alias("c")).alias("w"), i.cast("long").alias("place"))))
        return let(keys, lambda k: F.sort_array(F.transform(twice(k, lambda x, y: x["w"] == y["w"]), lambda key: key["place"])))

    def places(words_, keys):
        return F.when(collides(words_, keys), by_words(words_)).otherwise(by_hash(keys))

    def covered(found):
        gaps = F.transform(found, lambda p, i: F.least(F.lit(3), F.coalesce(at(found, i + 1) - p, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    inside = let(words, lambda w: let(windows(w), lambda keys: let(places(w, keys), covered)))
    return F.when(F.size(words) < 3, F.lit(0).cast("long")).otherwise(inside)


def statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """All columns but ``text``, and the statistics of the whole text (long; 0 for NULL or empty).

    Repeated rows stay. Columns with a statistic's name give way to it.
    """
    whole = F.col(text)
    lines = F.filter(F.split(F.coalesce(whole, F.lit("")), "\n"), lambda line: F.length(F.translate(line, WHITE, "")) > 0)
    numbers = {
        "n_words": lambda w: F.size(w).cast("long"),
        "n_repeat_words": repeated_words,
        "n_distinct": lambda w: F.size(F.array_distinct(w)).cast("long"),
    }
    of_words = let(words_of(whole), lambda w: F.struct(*[f(w).alias(n) for n, f in numbers.items()]))
    of_lines = let(lines, lambda a: F.struct(
        F.size(a).cast("long").alias("n_lines"), (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines")))
    plain = {
        "word_chars": F.length(F.translate(F.coalesce(whole, F.lit("")), WHITE, "")).cast("long"),
        "n_symbols": chars_in(whole, SYMBOLS), "n_upper": chars_in(whole, UPPER), "n_digits": chars_in(whole, DIGITS),
        "n_shouts": chars_in(whole, "!"), "n_bars": chars_in(whole, "|"),
    }
    kept = [c for c in documents.columns if c != text and c.lower() not in {*BASE, *MORE}]
    wide = documents.select(packed(kept).alias("_kept"), of_words.alias("_w"), of_lines.alias("_l"), *[v.alias(n) for n, v in plain.items()])
    return wide.select(*unpacked("_kept", kept), *[F.col(f"_w.{n}").alias(n) for n in numbers], "_l.n_lines", "_l.n_dup_lines", *plain)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def features() -> dict[str, Column]:
    """Interpretable numbers that conditions may test."""
    c = F.col
    return {
        "words": c("n_words").cast("double"),
        "chars_per_word": _share(c("word_chars"), c("n_words")),
        "symbols_per_word": _share(c("n_symbols"), c("n_words")),
        "bars_per_word": _share(c("n_bars"), c("n_words")),
        "shouts_per_word": _share(c("n_shouts"), c("n_words")),
        "upper_share": _share(c("n_upper"), c("word_chars")),
        "digit_share": _share(c("n_digits"), c("word_chars")),
        "same_line_share": _share(c("n_dup_lines"), c("n_lines")),
        "repeat_share": _share(c("n_repeat_words"), c("n_words")),
        "distinct_share": _share(c("n_distinct"), c("n_words")),
        "words_per_line": _share(c("n_words"), c("n_lines")),
    }


# ---- rules -----------------------------------------------------------------------------------

class Condition(NamedTuple):
    """feature > cut, or feature <= cut."""

    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


class Rule(NamedTuple):
    """Reject when every condition holds."""

    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, [c.column() for c in self.conditions])

    def __str__(self) -> str:
        return "reject if " + " and ".join(map(str, self.conditions))


def verdict(rules: Sequence[Rule]) -> Column:
    """The list as one ordered conditional expression: True keeps, False rejects."""
    chain = reduce(lambda chain, rule: (chain.when if chain is not None else F.when)(rule.column(), F.lit(False)), rules, None)
    return chain.otherwise(F.lit(True)) if chain is not None else F.lit(True)


class Limits(NamedTuple):
    """When to stop: rules in a list, conditions in a rule, precision on the pruning rows, rows covered."""

    rules: int = 12
    conditions: int = 3
    precision: float = 0.75
    covered: int = 3


def _gain(p: int, n: int, all_p: int, all_n: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(all_p / (all_p + all_n))) if p else 0.0


def _midway(rows: DataFrame, condition: Condition) -> Condition:
    """The cut moved half way to the next larger value: the same rows, but room for values not seen yet."""
    value = features()[condition.feature]
    around = rows.agg(F.max(F.when(value <= condition.cut, value)).alias("a"), F.min(F.when(value > condition.cut, value)).alias("b")).first()
    return condition if around["a"] is None or around["b"] is None else condition._replace(cut=(around["a"] + around["b"]) / 2)


def _grow(rows: DataFrame, names: list[str], cuts: list[list[float]], most: int) -> tuple[Condition, ...]:
    """Add the condition with the highest gain until no good row is covered or nothing is gained."""
    rule: tuple[Condition, ...] = ()
    while len(rule) < most:
        inside = rows.where(Rule(rule).column()) if rule else rows
        counted = inside.select("_bad", F.posexplode("_bins").alias("f", "b")).groupBy("f", "b").agg(
            F.count_if("_bad").alias("p"), F.count_if(~F.col("_bad")).alias("n")).collect()
        best, best_gain = None, 1e-9
        for f, name in enumerate(names):
            steps = [(0, 0)] * (len(cuts[f]) + 1)
            for row in counted:
                if row["f"] == f:
                    steps[row["b"]] = (row["p"], row["n"])
            all_p, all_n = sum(s[0] for s in steps), sum(s[1] for s in steps)
            if not all_p or not all_n:
                continue
            p = n = 0
            for (here_p, here_n), cut in zip(steps, cuts[f]):
                p, n = p + here_p, n + here_n
                for condition, got in ((Condition(name, False, cut), (p, n)), (Condition(name, True, cut), (all_p - p, all_n - n))):
                    gain = _gain(*got, all_p, all_n)
                    if gain > best_gain:
                        best, best_gain, left = condition, gain, got[1]
        if best is None:
            break
        rule += (_midway(inside, best),)
        if not left:
            break
    return rule


def _prune(rows: DataFrame, rule: tuple[Condition, ...]) -> tuple[tuple[Condition, ...], int, int]:
    """The start of the rule with the best (p - n) / (p + n) on rows that did not grow it; the shorter on ties."""
    starts = [rule[:k] for k in range(1, len(rule) + 1)]
    counts = rows.agg(*[F.count_if(Rule(s).column() & (F.col("_bad") == bad)).alias(f"{word}{k}")
                        for k, s in enumerate(starts) for word, bad in (("p", True), ("n", False))]).first()
    scored = [((p - n) / (p + n) if p + n else -1.0, -k, p, n) for k in range(len(starts)) for p, n in [(counts[f"p{k}"], counts[f"n{k}"])]]
    value, k, p, n = max(scored)
    return starts[-k], p, n


def _passed(value: Column, cuts: Sequence[float]) -> Column:
    """How many of the cuts lie below the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < value)) if cuts else F.lit(0)


def learn(stats: DataFrame, labels: DataFrame, label: str = "quality", limits: Limits = Limits(), folds: int = 3, held_out: int = 1) -> list[Rule]:
    """Rules from all labelled statistics outside the held-out fold.

    Rows without an id or label teach nothing. Without both classes the list is empty and keeps all.
    """
    known = labels.where(F.col(label).isNotNull() & (fold_of("doc_id", folds) != held_out)).select(
        F.col("doc_id").alias("_id"), (F.col(label) == 0).alias("_bad"))
    joined = stats.join(known, stats["doc_id"] == known["_id"]).select("doc_id", *BASE, *MORE, "_bad")
    rows = settle(joined)
    named = features()
    names = list(named)
    found = rows.agg(*[F.percentile_approx(v, F.array(*map(F.lit, QUANTILES)), 2000).alias(n) for n, v in named.items()]).first()
    cuts = [sorted(set(found[n] or [])) for n in names]
    if not any(cuts):
        return []
    bins = F.array(*[_passed(named[n], c) for n, c in zip(names, cuts)])
    rows = settle(rows.select("*", bins.alias("_bins"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0).alias("_grows")))
    rules: list[Rule] = []
    while len(rules) < limits.rules:
        rule = _grow(rows.where("_grows"), names, cuts, limits.conditions)
        if not rule:
            break
        rule, p, n = _prune(rows.where("not _grows"), rule)
        if p < limits.covered or p < limits.precision * (p + n):
            break
        rules.append(Rule(rule))
        rows = rows.where(~Rule(rule).column())
    return rules


def judge(stats: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds base_failed (fewer than 50 words, or over half of them in repeated windows) and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(rules))
