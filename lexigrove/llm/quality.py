"""Quality classifier from weak labels.

Heuristic labellers vote *good*, *bad* or nothing on each document. Expectation-maximisation over the counts of all vote
patterns in the corpus (at most 3 to the number of labellers, however many documents) estimates how often each labeller
is right on good documents and on each kind of bad ones, and the shares of these; no hand-made label is read. The posterior of a
document's pattern is its soft label, and a linear scorer over hashed features (shapes of words, bins of the statistics) is
trained on a bounded sample of ``SAMPLE`` documents with these labels. The scorer judges every whole text.

Defined results: null, empty and blank texts get no vote and one feature of their own, so their score is one
constant; every row gets a result, repeated rows the same one. An empty corpus keeps everything (score 0.5).
Other columns pass through ``keep_good``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from lexigrove.llm.sampling import by_hash
from lexigrove.plans.runtime import materialize

#: Documents the scorer is trained on: those with the smallest text hash. The vote counts use all documents.
SAMPLE = 20_000
DIMENSION = 1 << 14
KEEP = 0.5
#: Labellers are written to be precise: the most that one may reject of the good documents it votes on.
FALSE_ALARM = 0.005

#: Frequent short words of four languages.
STOP_WORDS = frozenset([
    "the", "of", "and", "to", "a", "in", "is", "it", "that", "was", "for", "on", "with", "as", "are", "by", "at", "this", "be", "from",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "im", "für", "auf", "ein", "eine", "nicht", "sich", "dem", "als",
    "le", "la", "les", "de", "des", "et", "un", "une", "du", "est", "que", "qui", "dans", "pour", "par", "sur", "avec", "au",
    "el", "los", "las", "y", "del", "se", "por", "con", "una", "no", "lo", "su", "es", "al", "para",
])

LABELLERS = ("symbols", "capitals", "repeated word", "stop words", "bars", "word length", "sentences", "repeated lines", "word again")
GOOD, BAD = 1, 2

_CLASSES = bytearray(range(256))
for _b in range(256):
    if 97 <= _b <= 122 or _b >= 128:
        _CLASSES[_b] = ord("a")
    elif 65 <= _b <= 90:
        _CLASSES[_b] = ord("A")
    elif 48 <= _b <= 57:
        _CLASSES[_b] = ord("0")
_CLASSES = bytes(_CLASSES)


def _between(value: float, good_below: float, bad_above: float) -> int:
    return GOOD if value <= good_below else BAD if value >= bad_above else 0


def statistics(text: str) -> dict[str, float]:
    """The numbers the labellers look at."""
    words = text.split()
    n = max(1, len(words))
    kinds = text.encode("utf-8", "surrogatepass").translate(_CLASSES)
    lower, upper = kinds.count(b"a"), kinds.count(b"A")
    seen = sum(map(kinds.count, (b" ", b"\n", b"\t", b"\r", b"0")))
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    return {
        "words": len(words),
        "symbols": max(0, len(kinds) - lower - upper - seen) / max(1, len(kinds) - seen),
        "capitals": upper / max(1, lower + upper),
        "top": max(counts.values(), default=0) / n,
        "stop": sum(c for w, c in counts.items() if w.lower() in STOP_WORDS) / n,
        "bars": counts["|"] / n,
        "length": sum(map(len, words)) / n,
        "ends": sum(c for w, c in counts.items() if w[-1] in ".!?") / n,
        "lines": 1 - len(set(lines)) / max(1, len(lines)),
        "again": sum(map(eq, words, words[1:])) / n,
    }


def votes(s: dict[str, float]) -> tuple[int, ...]:
    """One vote per labeller; short texts leave those that need many words silent."""
    n = s["words"]
    if n < 8:
        return (0,) * len(LABELLERS)
    return (
        _between(s["symbols"], 0.08, 0.14),
        _between(s["capitals"], 0.2, 0.4),
        _between(s["top"], 0.12, 0.2) if n >= 20 else 0,
        _between(-s["stop"], -0.1, -0.03) if n >= 20 else 0,
        _between(s["bars"], 0.0, 0.1),
        (GOOD if 2.5 <= s["length"] <= 9 else BAD if not 1.5 <= s["length"] <= 14 else 0) if n >= 10 else 0,
        _between(-s["ends"], -0.02, -0.002) if n >= 50 else 0,
        _between(s["lines"], 0.1, 0.5) if n >= 20 else 0,
        _between(s["again"], 0.03, 0.1),
    )


def features(text: str, s: dict[str, float]) -> dict[int, float]:
    """Hashed features: share of each word shape, and a bin of each statistic."""
    shapes = text.encode("utf-8", "surrogatepass").translate(_CLASSES)
    for letter in (b"aa", b"AA", b"00"):
        while letter in shapes:
            shapes = shapes.replace(letter, letter[:1])
    out: dict[int, float] = {}

    def add(name: bytes, value: float) -> None:
        at = xxhash.xxh32_intdigest(name) % DIMENSION
        out[at] = out.get(at, 0.0) + value

    n = max(1.0, s["words"])
    for shape, count in Counter(shapes.split()).items():
        add(b"shape " + shape[:12], count / n)
    for name, width in (("symbols", 0.04), ("capitals", 0.1), ("top", 0.05), ("stop", 0.05), ("bars", 0.05), ("length", 1.5), ("ends", 0.02), ("lines", 0.2), ("again", 0.05)):
        add(f"{name} {min(int(s[name] / width), 12)}".encode(), 0.5)
    add(f"words {int(s['words']).bit_length()}".encode(), 0.1)
    return out


def _profile(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """``(*keep, text_hash, pattern, at, value)``: the vote pattern as a number in base 3, and the features."""
    source = docs.select(*keep, F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), F.col(text).alias("_text"))
    kept = source.schema.fields[:-1]
    schema = T.StructType([*kept, T.StructField("pattern", T.IntegerType()),
                           T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("value", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            patterns, ats, values = [], [], []
            for item in batch.column("_text"):
                body = item.as_py() or ""
                numbers = statistics(body)
                patterns.append(sum(v * 3**i for i, v in enumerate(votes(numbers))))
                found = features(body, numbers)
                ats.append(list(found))
                values.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(patterns, pa.int32()), pa.array(ats, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                schema.names,
            )

    return source.mapInArrow(run, schema)


@dataclass
class Model:
    #: P(bad vote | class) per labeller and class, and P(class); class 0 is good.
    rates: np.ndarray
    shares: np.ndarray
    posterior: dict[int, float]
    weights: np.ndarray
    bias: float

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """How often each labeller that votes is right, on good and on bad documents."""
        faults = self.rates[:, 1:] @ (self.shares[1:] / self.shares[1:].sum())
        return {name: (1 - self.rates[j, 0], faults[j]) for j, name in enumerate(LABELLERS)}

    def score(self, at: np.ndarray, value: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + (self.weights[at] * value).sum(), -40, 40))))


def estimate(patterns: dict[int, int], rounds: int = 100) -> tuple[np.ndarray, np.ndarray, dict[int, float]]:
    """Expectation-maximisation over counted vote patterns: vote rates, class shares, posterior of *good* per pattern.

    Class 0 is good; a bad document has one of as many kinds of fault as there are labellers, each class started from one
    labeller, because labellers overlap and a document with one fault is good in the eyes of the others. ``rates[j, c]`` is
    the chance that labeller j, if it votes, votes *bad* on class c; on good documents it is held below ``FALSE_ALARM``,
    else a common fault would pass for good, and each kind's own labeller sees at least four fifths of it, else a kind could take
    in the good ones. A kind is considered only where its labeller votes; else silence says nothing about the class.
    """
    keys = sorted(patterns)
    count = np.array([patterns[k] for k in keys], float)
    m = len(LABELLERS)
    vote = np.array([[k // 3**j % 3 for j in range(m)] for k in keys]).reshape(len(keys), m)
    bad, good = (vote == BAD).astype(float), (vote == GOOD).astype(float)
    rates = np.full((m, m + 1), 0.2)
    rates[:, 0] = FALSE_ALARM / 2
    rates[np.arange(m), np.arange(m) + 1] = 0.9
    shares = np.array([0.9, *[0.1 / m] * m])
    post = np.zeros((len(keys), m + 1))
    for _ in range(rounds):
        logs = np.log(shares) + bad @ np.log(rates) + good @ np.log(1 - rates)
        logs[:, 1:] = np.where(vote == 0, -np.inf, logs[:, 1:])
        post = np.exp(logs - logs.max(1, initial=-np.inf, keepdims=True))
        post /= post.sum(1, keepdims=True)
        weighed = post * count[:, None]
        rates = (bad.T @ weighed + 0.2) / ((bad + good).T @ weighed + 1)
        rates = np.clip(rates, 1e-4, 0.999)
        rates[:, 0] = np.minimum(rates[:, 0], FALSE_ALARM)
        own = np.arange(m)
        rates[own, own + 1] = np.maximum(rates[own, own + 1], 0.8)
        shares = (weighed.sum(0) + 1) / (weighed.sum() + m + 1)
    return rates, shares, dict(zip(keys, post[:, 0].tolist(), strict=True))


def _train(ats: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by full-batch AdaGrad."""
    weights, bias = np.zeros(DIMENSION), 0.0
    if not len(labels):
        return weights, bias
    sizes = np.array([len(a) for a in ats])
    row = np.repeat(np.arange(len(ats)), sizes)
    at, value = np.concatenate(ats).astype(np.int64), np.concatenate(values).astype(float)
    square, square_bias = np.full(DIMENSION, 1e-8), 1e-8
    for _ in range(rounds):
        z = bias + np.bincount(row, weights[at] * value, len(ats))
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) / len(ats)
        slope = np.bincount(at, error[row] * value, DIMENSION) + 1e-6 * weights
        square += slope**2
        square_bias += error.sum() ** 2
        weights -= 0.5 * slope / np.sqrt(square)
        bias -= 0.5 * error.sum() / np.sqrt(square_bias)
    return weights, bias


def fit_profiled(profiled: DataFrame) -> Model:
    """Estimate and train on a stored profile; counts cover all rows, the scorer's sample is bounded."""
    counts = {r["pattern"]: r["count"] for r in profiled.groupBy("pattern").count().collect()}
    rates, shares, posterior = estimate(counts)
    spread = by_hash(profiled.select("text_hash", "pattern", "at", "value"), "text_hash", SAMPLE, sum(counts.values()))
    sample = spread.toPandas()
    labels = np.array([posterior[p] for p in sample["pattern"]])
    weights, bias = _train(list(sample["at"]), list(sample["value"]), labels)
    return Model(rates, shares, posterior, weights, bias)


def fit(docs: DataFrame, *, text: str = "text") -> Model:
    return fit_profiled(materialize(_profile(docs, [], text)))


def score_documents(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, weak_label, score, keep)`` per row: the posterior of its votes, the scorer's judgement, the decision."""
    profiled = materialize(_profile(docs, [doc_id], text))
    model = fit_profiled(profiled)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_field = profiled.schema[doc_id]
    schema = T.StructType([id_field, T.StructField("weak_label", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            pairs = zip(batch.column("at").to_pylist(), batch.column("value").to_pylist(), strict=True)
            scores = [known.score(np.array(a, np.int64), np.array(v)) for a, v in pairs]
            labels = [known.posterior[p] for p in batch.column("pattern").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(doc_id), pa.array(labels, pa.float64()), pa.array(scores, pa.float64())], schema.names)

    return profiled.mapInArrow(run, schema).withColumn("keep", F.col("score") >= KEEP)


def keep_good(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` without the rejected ones, all columns as they were."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, text=text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            good = []
            for item in batch.column(text):
                body = item.as_py() or ""
                found = features(body, statistics(body))
                good.append(known.score(np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.float32, len(found))) >= KEEP)
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
