"""Documents as token sequences of a fixed length, in as few sequences as best-two-fit finds.

A document is its token ids and an end token; one that is too long is cut into full pieces, of which the first may be
shorter. Which pieces share a sequence depends on their lengths alone, so packing runs on a histogram with one count per
length, whose size is fixed however many documents there are. A sequence is filled greedily, with the longest piece left
that fits; then its shortest piece is taken out if two pieces that are left fill the wider gap better. Such a pattern is
repeated as often as the counts allow, which uses up a length or nearly so each time; so there are few patterns.

The plan says which pieces of a length, by number, go where. Pieces are numbered by runs: a task numbers the pieces
of each length as it writes them, and the runs' sums are the offsets. So no task sees all pieces of a length.

Token ids are those of the vocabulary file's own library. As it takes most of the time, a text is first cut by the file's split pattern,
and the ids of a match are looked up; the library encodes what is not known yet. Texts with characters on whose class two
pattern libraries might differ go to the library whole.

Defined results: a null text is empty and has the end token alone; repeated rows are packed each; ids may be null or repeat; an empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from lexigrove.llm.wordstream import slices
from lexigrove.plans.runtime import materialize, scratch_scope

CAPACITY = 1024
#: Matches whose ids a task knows at a time.
MOST_KNOWN = 600_000

#: Characters whose class all pattern libraries agree on: printable ASCII, tab, line ends and the older Latin letters.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7E¡-¬®-ſ‐-‧€]*").fullmatch
_LETTER, _DIGIT = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾"
# Fixed value: the split of byte-level vocabularies without a pattern of their own, with letters and digits of plain texts.
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^\s{_LETTER}{_DIGIT}]+|\s+(?!\S)|\s+"
#: Matches that the library encodes as one text, with line ends between them; short texts stay in its cache.
LINES = 32


class Ids:
    """Token ids of whole texts as the library gives them, with the ids of known matches kept."""

    def __init__(self, file: str, most_known: int = MOST_KNOWN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.split = re.compile(SPLIT).findall
        self.line_end, = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.most, self.known = most_known, {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of(self, texts: list[str]) -> list[np.ndarray]:
        plain = [bool(_PLAIN(t)) for t in texts]
        whole = iter(self._library([t for t, p in zip(texts, plain, strict=True) if not p]))
        matches = [self.split(t) if p else None for t, p in zip(texts, plain, strict=True)]
        self._learn(matches)
        found = (next(whole) if m is None else b"".join(map(self.known.__getitem__, m)) for m in matches)
        return [np.frombuffer(ids, np.uint32) for ids in found]

    def _learn(self, matches: list[list[str] | None]) -> None:
        """The library's ids of all matches that are not known yet, asked for at once."""
        met = set().union(*(m for m in matches if m))
        if len(self.known) > self.most:
            self.known = {m: self.known[m] for m in met & self.known.keys()}
        new = met - self.known.keys()
        blank = [m for m in new if m.isspace()]
        self.known.update(zip(blank, self._library(blank), strict=True))
        # no other match holds a line end, so one between two matches is a match and a token of its own
        words = [m for m in new if not m.isspace()]
        texts = ["\n".join(words[k : k + LINES]) for k in range(0, len(words), LINES)]
        for k, ids in enumerate(self._library(texts)):
            ids = np.frombuffer(ids, np.uint32)
            ends = np.flatnonzero(ids == self.line_end) * 4
            ids, starts = ids.tobytes(), [0, *(ends + 4).tolist()]
            part = words[k * LINES : (k + 1) * LINES]
            self.known.update(zip(part, [ids[a:b] for a, b in zip(starts, [*ends.tolist(), len(ids)], strict=True)], strict=True))


def tokenize(
    docs: DataFrame, file: str, end: int, *, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, run, number[, ids])``: the pieces, numbered by run and length."""
    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    fields = [T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType()), T.StructField("run", T.LongType()), T.StructField("number", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType(), False)))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(file)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for part in slices(batches, "text"):
            texts = [t.decode() for t in part.column(1).to_pylist()]
            found = [np.append(i, np.uint32(end)) for i in ids.of(texts)]
            out: list[list] = [[] for _ in range(6)]
            pieces = []
            for row, tokens in enumerate(found):
                edges = np.arange(len(tokens), 0, -capacity)[::-1].tolist()
                for number, (a, b) in enumerate(zip([0, *edges], edges)):
                    piece = tokens[a:b].astype("<u4")
                    seen[b - a] += 1
                    for column, value in zip(out, (row, number, a, b - a, zlib.crc32(piece.tobytes()), seen[b - a] - 1), strict=True):
                        column.append(value)
                    if with_ids:
                        pieces.append(piece.astype(np.int64))
            of_row = part.column(0).take(pa.array(out[0], pa.int64()))
            arrays = [of_row, pa.array(out[1], pa.int32()), *(pa.array(c, pa.int64()) for c in out[2:5]),
                      pa.array([task] * len(out[0]), pa.int64()), pa.array(out[5], pa.int64())]
            if with_ids:
                arrays.append(pa.array(pieces, pa.list_(pa.field("element", pa.int64(), False))))
            yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, T.StructType(fields))


class Plan:
    """Where the pieces of each length go, from the number of pieces of each length.

    ``spans[length]`` are arrays over ranges of piece numbers: the first number, the first sequence, pieces of this length in each
    sequence, and the place of the first of them in it; equal pieces lie side by side.
    """

    def __init__(self, counts: np.ndarray):
        """``counts[length]`` for lengths from 0 to the capacity; length 0 has none."""
        self.capacity = len(counts) - 1
        left = counts.astype(np.int64).copy()
        used = np.zeros_like(left)
        spans: list[list[tuple[int, int, int, int]]] = [[] for _ in counts]
        self.sequences = 0
        self.patterns = 0
        while left.any():
            pattern = self._improved(self._greedy(left), left)
            sizes, each = np.unique(pattern, return_counts=True)
            times = int((left[sizes] // each).min())
            at = 0
            for size, n in zip(sizes[::-1].tolist(), each[::-1].tolist(), strict=True):
                spans[size].append((int(used[size]), self.sequences, n, at))
                used[size] += n * times
                left[size] -= n * times
                at += size * n
            self.sequences += times
            self.patterns += 1
        self.spans = [np.array(s, np.int64).reshape(-1, 4).T for s in spans]

    def _greedy(self, left: np.ndarray) -> list[int]:
        """The longest piece that fits, again and again."""
        pattern: list[int] = []
        gap = self.capacity
        while True:
            fits = np.flatnonzero(left[: gap + 1])
            if not len(fits):
                return pattern
            size = int(fits[-1])
            n = min(int(left[size]) - pattern.count(size), gap // size)
            if not n:
                # all of this length are in the pattern
                left = left.copy()
                left[size] = 0
                continue
            pattern += [size] * n
            gap -= n * size

    def _improved(self, pattern: list[int], left: np.ndarray) -> list[int]:
        """The shortest piece gives way to the two pieces that fill its place and the gap best, if they do it better."""
        shortest = min(pattern)
        gap = self.capacity - sum(pattern)
        if not gap or len(pattern) == 1 and shortest == self.capacity:
            return pattern
        rest = left.copy()
        sizes, each = np.unique(pattern, return_counts=True)
        rest[sizes] -= each
        free = np.flatnonzero(rest)
        room = gap + shortest
        first = free[free < room]
        if not len(first):
            return pattern
        # the longest free piece beside each first one
        index = np.searchsorted(free, room - first, "right") - 1
        second = np.where(index >= 0, free[np.maximum(index, 0)], 0)
        alone = (second == first) & (rest[first] < 2)
        index = np.where(alone, index - 1, index)
        second = np.where(index >= 0, free[np.maximum(index, 0)], 0)
        both = np.where(second > 0, first + second, 0)
        best = int(np.lexsort((-np.maximum(first, second), -both))[0])
        if both[best] <= shortest:
            return pattern
        return [*_without_one(pattern, shortest), int(first[best]), int(second[best])]

    def place(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        bounds = np.flatnonzero(np.r_[True, np.diff(lengths[order]) != 0, True]) if len(lengths) else [0]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            rows = order[a:b]
            size = int(lengths[rows[0]])
            start, base, each, at = self.spans[size]
            span = np.searchsorted(start, numbers[rows], "right") - 1
            copy, slot = np.divmod(numbers[rows] - start[span], each[span])
            sequence[rows], offset[rows] = base[span] + copy, at[span] + slot * size
        return sequence, offset


def _without_one(pattern: list[int], size: int) -> list[int]:
    at = pattern.index(size)
    return pattern[:at] + pattern[at + 1 :]


def pack(
    docs: DataFrame, file: str, end: int, *, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids])``, a row for each piece. Runs jobs when called."""
    with scratch_scope(docs.sparkSession):
        pieces = materialize(tokenize(docs, file, end, capacity=capacity, text=text, doc_id=doc_id, with_ids=with_ids))
        runs = materialize(pieces.groupBy("length", "run").agg(F.count("*").alias("n")))
        counts = np.zeros(capacity + 1, np.int64)
        for length, n in runs.groupBy("length").agg(F.sum("n")).collect():  # a row per length
            counts[length] = n
        plan = docs.sparkSession.sparkContext.broadcast(Plan(counts))
        before = Window.partitionBy("length").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
        starts = runs.select("length", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
        numbered = pieces.join(starts, ["length", "run"]).withColumn("number", F.col("number") + F.col("before"))
        columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
        fields = [pieces.schema[c] for c in columns] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
                sequence, offset = plan.value.place(length, number)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], [f.name for f in fields])

        return materialize(numbered.select(*columns, "number").mapInArrow(place, T.StructType(fields)), outlive=True)
