"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into windows of a fixed number of bytes; both directions read a window from a zero state.
Every position gets a probability for each language from the two states that meet there, and a document's
probability is the mean over all positions of the whole text. The network is trained in numpy by
backpropagation through time on windows of a bounded sample.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.batches import fold_of, keep_rows, slices
from granary.llm.shipping import ship
from granary.operators.shared_store import settle

WINDOW = 64
HIDDEN = 6
PADDING = 256
TOGETHER = 1024
UNDETERMINED = "und"
# Bounds of the learning sample: documents of each language and of all (every language has its share), characters of each.
PER_LANGUAGE, SAMPLE, EXCERPT = 600, 38_400, 768

_letter = regex.compile(r"\p{L}").search


class Network(NamedTuple):
    """Weights by direction (0 forwards, 1 backwards): byte tables and recurrent matrices of the two
    gates and of the candidate state; and the output layer over both states."""

    gates: np.ndarray
    candidate: np.ndarray
    gates_back: np.ndarray
    candidate_back: np.ndarray
    out: np.ndarray
    bias: np.ndarray


class Model(NamedTuple):
    network: Network
    languages: tuple[str, ...]


def _logistic(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def start(languages: int, hidden: int = HIDDEN, seed: int = 3) -> Network:
    rng = np.random.default_rng(seed)

    def draw(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return Network(
        draw(2, PADDING + 1, 2 * hidden, scale=0.3), draw(2, PADDING + 1, hidden, scale=0.5), draw(2, hidden, 2 * hidden, scale=hidden**-0.5),
        draw(2, hidden, hidden, scale=hidden**-0.5), draw(2 * hidden, languages, scale=hidden**-0.5), np.zeros(languages, np.float32),
    )


def states(net: Network, windows: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States at every position, shape (time, windows, 2 * hidden); ``keep`` gets what training needs."""
    n, length = windows.shape
    hidden = net.candidate.shape[2]
    steps = np.ascontiguousarray(windows.T).astype(np.intp)
    found = np.empty((length, n, 2 * hidden), np.float32)
    for way in (0, 1):
        h = np.zeros((n, hidden), np.float32)
        for t in range(length) if way == 0 else range(length - 1, -1, -1):
            g = net.gates[way][steps[t]]
            g += h @ net.gates_back[way]
            _logistic(g)
            z, r = g[:, :hidden], g[:, hidden:]
            m = h @ net.candidate_back[way]
            c = r * m
            c += net.candidate[way][steps[t]]
            c *= 2
            _logistic(c)  # tanh(x) = 2 logistic(2 x) - 1
            c *= 2
            c -= 1
            if keep is not None:
                keep.append((way, t, h, z, r, m, c))
            h = c + z * (h - c)
            found[t, :, way * hidden:(way + 1) * hidden] = h
    return found


def label_positions(net: Network, windows: np.ndarray) -> np.ndarray:
    """Probabilities of the languages at every position, shape (time, windows, languages)."""
    with np.errstate(over="ignore"):
        score = states(net, windows) @ net.out
    score += net.bias
    score -= score.max(axis=2, keepdims=True)
    np.exp(score, out=score)
    score /= score.sum(axis=2, keepdims=True)
    return score


def gradients(net: Network, windows: np.ndarray, language: np.ndarray) -> tuple[float, Network]:
    """Mean loss over the positions that hold text, and its gradient by backpropagation through time."""
    keep: list = []
    with np.errstate(over="ignore"):
        found = states(net, windows, keep)
    hidden, steps = net.candidate.shape[2], np.ascontiguousarray(windows.T).astype(np.intp)
    score = found @ net.out + net.bias
    score -= score.max(axis=2, keepdims=True)
    p = np.exp(score)
    p /= p.sum(axis=2, keepdims=True)
    real = (steps != PADDING).astype(np.float32)
    real /= real.sum()
    index = np.broadcast_to(language, steps.shape)
    loss = float(-(np.log(np.take_along_axis(p, index[..., None], 2)[..., 0] + 1e-9) * real).sum())
    np.put_along_axis(p, index[..., None], np.take_along_axis(p, index[..., None], 2) - 1, 2)
    p *= real[..., None]
    grad = Network(*[np.zeros_like(a) for a in net])
    grad.out[:] = np.tensordot(found, p, ((0, 1), (0, 1)))
    grad.bias[:] = p.sum((0, 1))
    into = p @ net.out.T
    back = np.zeros((len(windows), hidden), np.float32)
    for way, t, h, z, r, m, c in reversed(keep):
        if t == (len(steps) - 1 if way == 0 else 0):
            back = np.zeros((len(windows), hidden), np.float32)
        d = into[t, :, way * hidden:(way + 1) * hidden] + back
        da = d * (1 - z) * (1 - c * c)
        dm = da * r
        dg = np.concatenate([d * (h - c) * z * (1 - z), da * m * r * (1 - r)], axis=1)
        grad.candidate_back[way][:] += h.T @ dm
        grad.gates_back[way][:] += h.T @ dg
        np.add.at(grad.candidate[way], steps[t], da)
        np.add.at(grad.gates[way], steps[t], dg)
        back = d * z + dm @ net.candidate_back[way].T + dg @ net.gates_back[way].T
    return loss, grad


def train(windows: np.ndarray, language: np.ndarray, languages: int, steps: int = 320, batch: int = 256, rate: float = 0.015, seed: int = 4) -> Network:
    """Adam over seeded batches with a falling rate and clipped gradients."""
    net = start(languages)
    first, second = [np.zeros_like(a) for a in net], [np.zeros_like(a) for a in net]
    rng = np.random.default_rng(seed)
    for step in range(1, steps + 1):
        at = rng.integers(0, len(windows), batch)
        _, grad = gradients(net, windows[at], language[at])
        size = float(np.sqrt(sum((g * g).sum() for g in grad)))
        now = rate * (1 - 0.9 * step / steps)
        for weight, g, a, b in zip(net, grad, first, second):
            g = g / max(1.0, size)
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            weight -= now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return net


def cut(texts: Sequence[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Windows of whole texts, the last of each padded, and how many windows each text has."""
    counts = np.array([-(-len(t) // window) for t in texts], np.int64)
    rows = np.full((int(counts.sum()), window), PADDING, np.int16)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        rows[at:at + n].reshape(-1)[:len(text)] = np.frombuffer(text, np.uint8)
        at += n
    return rows, counts


def predict(model: Model, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
    """Language and probability of every text. NULL texts and texts without a letter are undetermined
    with probability 0, as is everything when no language was learned."""
    seen = [bool(t and _letter(t)) and bool(model.languages) for t in texts]
    raw = [t.encode() if use else b"" for t, use in zip(texts, seen)]
    rows, counts = cut(raw)
    sums = np.zeros((len(rows), max(len(model.languages), 1)))
    for a in range(0, len(rows), TOGETHER):
        part = rows[a:a + TOGETHER]
        p = label_positions(model.network, part)
        sums[a:a + TOGETHER] = (p * (part.T != PADDING)[..., None]).sum(axis=0)
    names, scores, at = [], [], 0
    for text, n, use in zip(raw, counts.tolist(), seen):
        if use:
            mean = sums[at:at + n].sum(axis=0) / len(text)
            best = int(mean.argmax())
            names.append(model.languages[best])
            scores.append(float(min(max(mean[best], 0.0), 1.0)))
        else:
            names.append(UNDETERMINED)
            scores.append(0.0)
        at += n
    return names, scores


def learn(documents: DataFrame, folds: int = 4, held_out: int = 2, per_language: int = PER_LANGUAGE, steps: int = 320) -> Model:
    """Train on excerpts of at most ``per_language`` documents of every language, and of about SAMPLE in all,
    picked by a hash of the id outside the held-out fold. NULL languages, texts and ids teach nothing."""
    spark = documents.sparkSession
    ship(spark)
    known = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of("doc_id", folds) != held_out))
    counts = settle(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    languages = tuple(sorted(r["lang"] for r in counts.select("lang").collect()))
    if not languages:
        return Model(start(1), ())
    each = max(1, min(per_language, SAMPLE // len(languages)))
    shares = counts.select(F.col("lang").alias("_lang"), F.least(F.lit(1.0), each / F.col("n")).alias("share"))
    dice = F.xxhash64(F.lit(17), F.col("doc_id"))
    span = F.length("text") - EXCERPT
    begin = F.when(span > 0, F.pmod(F.xxhash64(F.lit(19), F.col("doc_id")), span) + 1).otherwise(F.lit(1)).cast("int")
    drawn = known.join(shares, known["lang"] == shares["_lang"]).where(F.pmod(dice, F.lit(1 << 20)) < F.col("share") * (1 << 20))
    picked = drawn.select(
        "lang", F.substring(F.col("text"), begin, F.lit(EXCERPT)).alias("piece"), dice.alias("dice"))
    table = picked.orderBy("dice", "lang", "piece").limit(2 * each * len(languages)).toArrow()
    rows, counts_ = cut([t.encode() for t in table.column("piece").to_pylist()])
    if not len(rows):
        return Model(start(1), ())
    index = np.repeat([languages.index(name) for name in table.column("lang").to_pylist()], counts_)
    return Model(train(rows, index, len(languages), steps), languages)


def identify(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text", into: str = "lang_pred", score: str = "score") -> DataFrame:
    """``key``, predicted language and score for every row, from its whole text."""
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, 1 << 19):
                names, scores = predict(model, part.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(names, pa.string()), pa.array(scores, pa.float64())], [key, into, score])

    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, `{into}` string, `{score}` double")


def keep(documents: DataFrame, model: Model, least: float = 0.3, text: str = "text") -> DataFrame:
    """The rows in a learned language with a probability of ``least`` or more, with all their columns."""
    ship(documents.sparkSession)

    def decide(texts: Sequence[str | None]) -> list[bool]:
        return [name != UNDETERMINED and score >= least for name, score in zip(*predict(model, texts))]

    return keep_rows(documents, text, decide, 1 << 19)
