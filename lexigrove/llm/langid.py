"""Language identification by unigrams of pieces, summed over all segmentations.

The pieces are a fixed public vocabulary. Per language each piece has a probability; the probability of a word is the sum over
all ways to cut it into pieces, by a forward recursion over its letters, and that of a text the product over its words. The
probabilities are estimated by expectation-maximisation: forward-backward expected counts over the words of a sample of
about ``SAMPLE`` distinct texts per language, chosen by text hash. All of it runs in blocks of words of one length.

Words are runs of letters in lower case behind a start mark. Runs of over ``LONGEST`` letters take the same recursion by
logarithms, one at a time, and teach in parts of that length. A letter that is no piece has one fixed probability in every language.

Defined results: a text that is null or has no letter is ``und`` with score 0, so is every text if nothing could be
learned. Equal scores take the first language in order. Every row gets a row; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from lexigrove.llm.bpe import parse_ranks, read_ranks

SAMPLE, ROUNDS, LONGEST = 400, 6, 40
START, UNKNOWN = "▁", 1e-7
#: Words whose probabilities a task remembers; a full table is emptied.
MAX_WORDS = 400_000
_LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


def read_pieces(ranks_path: str) -> list[str]:
    """The tokens that are letters, in lower case, with a mark where they begin a word; and every letter alone."""
    pieces = {START}
    for token in parse_ranks(read_ranks(ranks_path)):
        try:
            piece = token.decode("utf-8").lower()
        except UnicodeDecodeError:
            continue
        body = piece.removeprefix(" ")
        if body.isalpha():
            pieces.add(piece.replace(" ", START))
            pieces.update(body)
    return sorted(pieces)


class Pieces:
    """Cuts words into matrices of piece numbers."""

    def __init__(self, pieces: Sequence[str]):
        self.number = {p: i for i, p in enumerate(pieces)}
        self.size = len(pieces) + 2  # one letter that is no piece; what is neither
        self.longest = max(map(len, pieces), default=1)

    def spans(self, words: Sequence[str]) -> dict[int, tuple[np.ndarray, dict[tuple[int, int], np.ndarray]]]:
        """By length: places of the words in the list, and the piece from i to j of each, where any has one."""
        by_length = defaultdict(list)
        for k, word in enumerate(words):
            by_length[len(word) + 1].append(k)
        out = {}
        get, none = self.number.get, self.size - 1
        for n, places in by_length.items():
            marked = [START + words[k] for k in places]
            table = {}
            for i in range(n):
                for j in range(i + 1, min(n, i + self.longest) + 1):
                    default = self.size - 2 if j == i + 1 else none
                    found = np.fromiter((get(w[i:j], default) for w in marked), np.int32, len(marked))
                    if (found != none).any():
                        table[i, j] = found
            out[n] = (np.array(places), table)
        return out

    def forward(self, n: int, table: dict, chances: np.ndarray) -> list[np.ndarray]:
        """``a[j]``: probability of the first j characters, per word and language; ``chances`` is (pieces, languages)."""
        rows = len(next(iter(table.values())))
        a = [np.zeros((rows, chances.shape[1])) for _ in range(n + 1)]
        a[0][:] = 1
        for i, j in sorted(table, key=lambda ij: ij[1]):
            a[j] += a[i] * chances[table[i, j]]
        return a

    def backward(self, n: int, table: dict, chances: np.ndarray) -> list[np.ndarray]:
        rows = len(next(iter(table.values())))
        b = [np.zeros((rows, chances.shape[1])) for _ in range(n + 1)]
        b[n][:] = 1
        for i, j in sorted(table, key=lambda ij: -ij[0]):
            b[i] += chances[table[i, j]] * b[j]
        return b

    def log_chances(self, words: Sequence[str], chances: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language, over all segmentations."""
        out = np.empty((len(words), chances.shape[1]))
        for n, (places, table) in self.spans(words).items():
            out[places] = np.log(self.forward(n, table, chances)[n])
        return out

    def log_chance_of_long(self, word: str, logs: np.ndarray) -> np.ndarray:
        """The same for one word of any length, with log probabilities; only the last ``longest`` sums are held."""
        marked = START + word
        last = deque([np.zeros(logs.shape[1])], maxlen=self.longest)
        for j in range(1, len(marked) + 1):
            first = j - len(last)
            found = [self.number.get(marked[i:j], self.size - 2 if i == j - 1 else self.size - 1) for i in range(first, j)]
            terms = np.array([a + logs[k] for a, k in zip(last, found, strict=True) if k != self.size - 1])
            top = terms.max(0)
            last.append(top + np.log(np.exp(terms - top).sum(0)))
        return last[-1]


def estimate(counts: dict[str, dict[str, int]], pieces: Pieces, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """``(languages, chances)`` from words counted per language."""
    languages = sorted(counts)
    chances = np.full((pieces.size, len(languages)), 1.0 / pieces.size)
    for k, language in enumerate(languages):
        words = list(counts[language])
        weights = np.array([counts[language][w] for w in words], float)
        spans = pieces.spans(words)
        own = np.full((pieces.size, 1), 1.0 / pieces.size)
        own[-2:] = [[UNKNOWN], [0]]
        for _ in range(rounds):
            expected = np.full(pieces.size, 0.02)
            for n, (places, table) in spans.items():
                a, b = pieces.forward(n, table, own), pieces.backward(n, table, own)
                share = weights[places] / a[n][:, 0]
                for (i, j), found in table.items():
                    expected += np.bincount(found, a[i][:, 0] * own[found, 0] * b[j][:, 0] * share, pieces.size)
            expected[-2:] = 0
            own = (expected / expected.sum())[:, None]
            own[-2:] = [[UNKNOWN], [0]]
        chances[:, k] = own[:, 0]
    return languages, chances


def _parts(words: list[str]) -> list[str]:
    if all(len(w) <= LONGEST for w in words):
        return words
    return [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]


def fit(training: DataFrame, ranks_path: str, *, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> tuple[list[str], list[str], np.ndarray]:
    """``(pieces, languages, chances)``; rows without a language or a letter teach nothing.

    About ``sample`` texts per language are used: those with the smallest text hashes, equal texts once. Their words are
    counted by Spark.
    """
    pieces = read_pieces(ranks_path)
    named = training.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in named.groupBy(lang).count().collect()}
    if not sizes:
        return pieces, [], np.empty((len(pieces) + 2, 0))
    spread = float(1 << 32)
    limits = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample / n) * spread)))
    low = named.filter(F.pmod(F.xxhash64(text), F.lit(1 << 32)) <= F.element_at(limits, F.col(lang)))
    texts = low.groupBy(F.col(lang).alias("lang"), F.xxhash64(text)).agg(F.first(text).alias("text")).select("lang", "text")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for language, body in zip(frame["lang"], frame["text"], strict=True):
                yield pd.DataFrame({"word": _parts(words_of(body))}).assign(lang=language)

    rows = texts.mapInPandas(cut, T.StructType([T.StructField("word", T.StringType()), T.StructField("lang", texts.schema["lang"].dataType)]))
    counted = rows.groupBy("lang", "word").count().toPandas()
    counts = {k: dict(zip(g["word"], g["count"].tolist(), strict=True)) for k, g in counted.groupby("lang")}
    return pieces, *estimate(counts, Pieces(pieces))


class Scorer:
    """Scores texts; remembers the words it has met."""

    def __init__(self, pieces: Sequence[str], languages: Sequence[str], chances: np.ndarray):
        self.pieces, self.languages, self.chances = Pieces(pieces), list(languages), chances
        with np.errstate(divide="ignore"):
            self.logs = np.log(chances)
        self._reset()

    def _reset(self) -> None:
        self.places: dict[str, int] = {}
        self.known = np.empty((1 << 16, len(self.languages)))

    def _learn(self, words: list[str]) -> None:
        if len(self.places) > MAX_WORDS:
            self._reset()
        new = list({w for w in words if w not in self.places})
        if not new:
            return
        start = len(self.places)
        while start + len(new) > len(self.known):
            self.known = np.concatenate([self.known, np.empty_like(self.known)])
        self.known[start : start + len(new)] = self.pieces.log_chances(new, self.chances)
        self.places.update(zip(new, range(start, start + len(new)), strict=True))

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        cut = [words_of(t) for t in texts]
        if self.languages:
            self._learn([w for words in cut for w in words if len(w) <= LONGEST])
        names, scores = [], []
        for words in cut:
            if not words or not self.languages:
                names.append("und")
                scores.append(0.0)
                continue
            usual = [self.places[w] for w in words if len(w) <= LONGEST]
            total = self.known[usual].sum(0)
            if len(usual) < len(words):
                total = total + sum(self.pieces.log_chance_of_long(w, self.logs) for w in words if len(w) > LONGEST)
            best = int(total.argmax())
            names.append(self.languages[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return names, scores


def identify(docs: DataFrame, model: tuple[list[str], list[str], np.ndarray], *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, lang_pred, score)``; the score is the language's share of the probability of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([source.schema[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*sent.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                names, scores = scorer.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema.names)

    return source.mapInArrow(run, schema)
