"""Toxic spans and document scores by a linear-chain conditional random field.

Tokens are words with two labels, clean and toxic. The field has weights for the word, the word before and the word
after (hashed), and for pairs of neighbouring labels. Token labels come from document labels: in toxic documents a word is
labelled toxic if it is found in many of them and in hardly any other; all else is clean. Forward-backward
gives every token's marginal. A document's score is a logistic function of its largest marginal, of the expected number of toxic
tokens and of their share, fitted on the same labelled documents; spans are runs of tokens with a marginal of ``SPAN`` and more.

Fitting takes at most ``POSITIVES`` toxic and ``NEGATIVES`` other labelled documents, those with the smallest hashes, equal
texts once, and cuts the chains into pieces of ``PIECE`` tokens. Scoring runs over whole texts: chains are cut into
blocks whose 2 x 2 transfer matrices are multiplied, so messages cross the cuts exactly.

Defined results: null, empty and wordless texts have no span and the score of a document without toxic words; without
labelled documents of both kinds the score is the share of toxic ones, 0 if there are none. Every row gets a row; a
document with several labels is toxic if one says so. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from lexigrove.llm.sampling import by_hash
from lexigrove.plans.runtime import materialize

POSITIVES, NEGATIVES, PIECE, BLOCK = 2000, 3000, 256, 64
BITS = 18
STEMS = (1 << BITS) - 1
SPAN = 0.5
#: A word is a sign of toxicity if it is in this share of toxic documents (and in three) and so many times rarer elsewhere.
SIGN_SHARE, SIGN_RATIO = 0.01, 25.0
#: The same for the first letters of words, which many compounds share and which chance repeats more often.
STEM, STEM_RATIO = 5, 5.0
_WORDS = re.compile(r"[^\W\d_]+")
#: Words whose numbers a task remembers; a full table is emptied.
MAX_WORDS = 500_000


def _hashed(word: str) -> int:
    return xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass")) >> (32 - BITS)


class Numbers(dict):
    """Hashed numbers of each word and of its stem, case aside, in one integer."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        low = word.lower()
        number = _hashed(low) << BITS | _hashed("stem " + low[:STEM])
        self[word] = number
        return number


@dataclass
class Field:
    """Weights of the word, the word before, the word after and the stem; log weights of label pairs [before, now]."""

    words: np.ndarray
    pairs: np.ndarray

    def emissions(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log weight of *toxic* against *clean* per token; ``first`` marks where a document starts."""
        now, before, after, stem = self.words
        out = (now[ids >> BITS] + stem[ids & STEMS]).astype(np.float64)
        ids = ids >> BITS
        out[1:] += np.where(first[1:], 0, before[ids[:-1]])
        out[:-1] += np.where(first[1:], 0, after[ids[1:]])
        return out


def _scaled(m: np.ndarray) -> np.ndarray:
    return m / m.sum(-1, keepdims=True)


def marginals(field: Field, emissions: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """P(toxic) of every token of the documents that lie one after the other; ``sizes`` has their lengths.

    The chain starts from a clean token. Blocks of all documents step together.
    """
    sizes = np.asarray(sizes, np.int64)
    n = int(sizes.sum())
    if not n:
        return np.empty(0)
    blocks = -(-sizes // BLOCK)
    total = int(blocks.sum())
    document = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.cumsum(sizes) - sizes
    within = np.arange(n) - starts[document]
    block = (np.cumsum(blocks) - blocks)[document] + within // BLOCK
    place = within % BLOCK
    factor = np.ones((BLOCK, total))  # weight of the toxic label
    factor[place, block] = np.exp(np.clip(emissions, -30, 30))
    used = np.zeros((BLOCK, total), bool)
    used[place, block] = True
    t = np.exp(field.pairs)

    # transfer matrix of each block
    whole = np.tile(np.eye(2), (total, 1, 1))
    for k in range(BLOCK):
        step = whole @ t
        step[:, :, 1] *= factor[k][:, None]
        step /= step.sum((1, 2), keepdims=True)
        whole = np.where(used[k][:, None, None], step, whole)
    # messages into each block from the left and from the right, block by block, documents together
    left, right = np.empty((total, 2)), np.empty((total, 2))
    base = np.cumsum(blocks) - blocks
    order = np.argsort(-blocks, kind="stable")
    most = int(blocks.max())
    counts = np.searchsorted(-blocks[order], -np.arange(most), side="left")
    state = np.tile([1.0, 0.0], (len(sizes), 1))
    for k in range(most):
        who = order[: counts[k]]
        at = base[who] + k
        left[at] = state[who]
        state[who] = _scaled((state[who][:, None, :] @ whole[at])[:, 0])
    state = np.full((len(sizes), 2), 0.5)
    for k in range(most - 1, -1, -1):
        who = order[: counts[k]]
        at = base[who] + k
        right[at] = state[who]
        state[who] = _scaled((whole[at] @ state[who][:, :, None])[:, :, 0])
    # within blocks
    ahead = np.empty((BLOCK, total, 2))
    state = left
    for k in range(BLOCK):
        step = state @ t
        step[:, 1] *= factor[k]
        state = np.where(used[k][:, None], _scaled(step), state)
        ahead[k] = state
    out = np.empty((BLOCK, total))
    state = right
    for k in range(BLOCK - 1, -1, -1):
        both = ahead[k] * state
        out[k] = both[:, 1] / both.sum(1)
        back = state.copy()
        back[:, 1] *= factor[k]
        state = np.where(used[k][:, None], _scaled(back @ t.T), state)
    return out[place, block]


def _gradient(field: Field, ids: np.ndarray, labels: np.ndarray, mask: np.ndarray):
    """Expected less observed counts over a batch of pieces, (tokens, pieces) arrays: marginals and label pairs."""
    steps, rows = ids.shape
    now, before, after, stem = field.words
    e = now[ids >> BITS] + stem[ids & STEMS]
    ids = ids >> BITS
    e[1:] += before[ids[:-1]] * mask[:-1]
    e[:-1] += after[ids[1:]] * mask[1:]
    factor = np.exp(np.clip(e, -30, 30))
    t = np.exp(field.pairs)
    ahead = np.empty((steps, rows, 2))
    state = np.tile([1.0, 0.0], (rows, 1))
    for k in range(steps):
        step = state @ t
        step[:, 1] *= factor[k]
        state = np.where(mask[k][:, None], _scaled(step), state)
        ahead[k] = state
    p = np.zeros((steps, rows))
    pairs = np.zeros((2, 2))
    state = np.full((rows, 2), 0.5)
    for k in range(steps - 1, -1, -1):
        both = ahead[k] * state
        p[k] = both[:, 1] / both.sum(1)
        back = state.copy()
        back[:, 1] *= factor[k]
        previous = ahead[k - 1] if k else np.tile([1.0, 0.0], (rows, 1))
        joint = previous[:, :, None] * t * back[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        pairs += joint[mask[k]].sum(0)
        state = np.where(mask[k][:, None], _scaled(back @ t.T), state)
    observed = np.zeros((2, 2))
    earlier = np.concatenate([np.zeros((1, rows), np.int64), labels[:-1]])
    np.add.at(observed, (earlier[mask], labels[mask]), 1)
    return np.where(mask, p - labels, 0), pairs - observed


def train_field(ids: Sequence[np.ndarray], labels: Sequence[np.ndarray], epochs: int = 6, batch: int = 128) -> Field:
    """Maximum likelihood by AdaGrad over batches of pieces; weights shrink a little."""
    field = Field(np.zeros((4, 1 << BITS)), np.zeros((2, 2)))
    square = np.full((4, 1 << BITS), 1e-6)
    square_pairs = np.full((2, 2), 1e-6)
    pieces = [(d[i : i + PIECE], y[i : i + PIECE]) for d, y in zip(ids, labels, strict=True) for i in range(0, len(d), PIECE)]
    # all pieces with a toxic token, and of the others every fourth
    pieces = [p for k, p in enumerate(pieces) if p[1].any() or k % 4 == 0]
    order = np.random.default_rng(7).permutation(len(pieces))
    for _ in range(epochs):
        for start in range(0, len(order), batch):
            chosen = [pieces[k] for k in order[start : start + batch]]
            steps = max(len(d) for d, _ in chosen)
            at, y = np.zeros((steps, len(chosen)), np.int64), np.zeros((steps, len(chosen)), np.int64)
            mask = np.zeros((steps, len(chosen)), bool)
            for c, (d, label) in enumerate(chosen):
                at[: len(d), c], y[: len(d), c], mask[: len(d), c] = d, label, True
            error, pairs = _gradient(field, at, y, mask)
            word = at >> BITS
            slopes = ((0, word, error), (1, word[:-1], error[1:] * mask[:-1]), (2, word[1:], error[:-1] * mask[1:]), (3, at & STEMS, error))
            for row, where, slope in slopes:
                g = np.bincount(where.ravel(), slope.ravel(), 1 << BITS)
                touched = np.flatnonzero(g)
                g = g[touched] + 1e-3 * field.words[row, touched]
                square[row, touched] += g * g
                field.words[row, touched] -= 0.5 * g / np.sqrt(square[row, touched])
            square_pairs += pairs**2
            field.pairs -= 0.2 * pairs / np.sqrt(square_pairs)
            field.pairs -= field.pairs[0, 0]
    field.words = field.words.astype(np.float32)
    return field


def _summary(p: np.ndarray) -> tuple[float, float, float]:
    """Largest marginal, expected number of toxic tokens (log), their share (root)."""
    if not len(p):
        return 0.0, 0.0, 0.0
    return float(p.max()), float(np.log1p(p.sum())), float(np.sqrt(p.mean()))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Newton's method with a small ridge; the last weight is the constant."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - q) - 1e-2 * w)
    return w


@dataclass
class Model:
    field: Field
    weights: np.ndarray
    signs: tuple[str, ...]

    def summaries(self, texts: Sequence[str | None], numbers: Numbers) -> list[np.ndarray]:
        """Marginals of each text's words."""
        ids = [np.fromiter(map(numbers.__getitem__, _WORDS.findall(t)), np.int64) if t else np.empty(0, np.int64) for t in texts]
        sizes = [len(i) for i in ids]
        flat = np.concatenate([np.empty(0, np.int64), *ids])
        first = np.zeros(len(flat), bool)
        starts = np.cumsum([0, *sizes[:-1]])
        first[starts[starts < len(flat)]] = True
        p = marginals(self.field, self.field.emissions(flat, first), sizes) if len(flat) else np.empty(0)
        return np.split(p, np.cumsum(sizes)[:-1]) if sizes else []

    def score(self, p: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot([*_summary(p), 1.0], self.weights), -30, 30))))


def spans_of(text: str, p: np.ndarray) -> list[dict]:
    """Runs of toxic words: first character, character after the last, largest marginal."""
    out: list[dict] = []
    if not len(p) or p.max() < SPAN:
        return out
    last = -2
    for k, match in enumerate(_WORDS.finditer(text)):
        if p[k] >= SPAN:
            if last == k - 1:
                out[-1]["end"], out[-1]["probability"] = match.end(), max(out[-1]["probability"], float(p[k]))
            else:
                out.append({"start": match.start(), "end": match.end(), "probability": float(p[k])})
            last = k
    return out


def _signs(tokens: Sequence[list[str]], toxic: np.ndarray, ratio: float) -> set[str]:
    """Strings found in many toxic documents and, set against that, hardly in others."""
    found = [Counter(), Counter()]
    for words, y in zip(tokens, toxic, strict=True):
        found[int(y)].update(set(words))
    n = [max(1, int((toxic == 0).sum())), max(1, int((toxic == 1).sum()))]
    least = max(3, SIGN_SHARE * n[1])
    return {w for w, c in found[1].items() if c >= least and c / n[1] >= ratio * (found[0][w] + 0.5) / n[0]}


def fit(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic") -> Model:
    """Learn from the labelled ones among ``docs``; labels are joined by id, which is no input of a score."""
    marked = labels.filter(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(toxic).alias("toxic"))
    wanted = docs.select(F.col(doc_id).alias("doc_id")).filter("doc_id is not null")
    known = materialize(marked.join(wanted, "doc_id", "left_semi"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = None
    for value, most in ((1, POSITIVES), (0, NEGATIVES)):
        some = by_hash(known.filter(F.col("toxic") == value), "doc_id", most, sizes.get(value, 0))
        chosen = some if chosen is None else chosen.unionByName(some)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    sample = rows.toPandas().drop_duplicates("text").sort_values("text")
    y = sample["toxic"].to_numpy(np.int64)
    empty = Field(np.zeros((4, 1 << BITS), np.float32), np.zeros((2, 2)))
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(empty, np.array([0.0, 0.0, 0.0, np.log((share + 1e-9) / (1 - share + 1e-9))]), ())
    texts = [t or "" for t in sample["text"]]
    tokens = [[w.lower() for w in _WORDS.findall(t)] for t in texts]
    signs = _signs(tokens, y, SIGN_RATIO)
    stems = _signs([[w[:STEM] for w in words if len(w) > STEM] for words in tokens], y, STEM_RATIO)
    numbers = Numbers()
    ids = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in tokens]
    token_labels = [np.fromiter((t and (w in signs or len(w) > STEM and w[:STEM] in stems) for w in words), np.int64, len(words)) for words, t in zip(tokens, y, strict=True)]
    del tokens
    model = Model(train_field(ids, token_labels), np.zeros(4), (*sorted(signs), *sorted(f"{x}-" for x in stems)))
    x = []
    for start in range(0, len(texts), 256):
        x += [_summary(p) for p in model.summaries(texts[start : start + 256], numbers)]
    model.weights = _logistic(np.array(x), y)
    return model


def tag(docs: DataFrame, model: Model, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, score, spans)``: spans are ``(start, end, probability)`` in characters of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("probability", T.DoubleType())])
    schema = T.StructType([source.schema[0], T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers = sent.value, Numbers()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = part.column("text").to_pylist()
                chances = known.summaries(texts, numbers)
                scores = [known.score(p) for p in chances]
                spans = [spans_of(t or "", p) for t, p in zip(texts, chances, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, kind)], schema.names)

    return source.mapInArrow(run, schema)
