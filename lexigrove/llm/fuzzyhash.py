"""Context-triggered piecewise hashing of documents.

A hash rolls over seven bytes; where it hits a condition that gets rarer with the block size, a chunk ends, so boundaries depend
on near-by bytes only and an edit changes the chunks around it. Each chunk becomes one character; a fingerprint holds the
signatures for the smallest block size with at most ``LENGTH`` chunks and for twice that. The condition for a block size
implies that for half of it, so one pass gives the boundaries for all. Fingerprints of equal or neighbouring block sizes are
compared by the edit distance of the signatures of one block size; others are unlike (0).

Defined results: a null text counts as empty; the empty text has the fingerprint ``3::``; equal texts have equal
fingerprints and likeness 1. Repeated rows get a row each. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

WINDOW, BLOCK, LENGTH = 7, 3, 64
#: Two unequal signatures with this many characters must share a run of as many, or they are unlike.
COMMON = 7
_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def rolling(data: bytes) -> np.ndarray:
    """A 32-bit hash of the seven bytes that end at each place."""
    values = np.frombuffer(data, np.uint8).astype(np.uint32) + np.uint32(1)
    out = values.copy()
    factor = 1
    for back in range(1, WINDOW):
        factor = factor * 0x2C1B3C6D & 0xFFFFFFFF
        out[back:] += values[:-back] * np.uint32(factor)
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x297A2D39)
    out ^= out >> np.uint32(15)
    return out


def fingerprint(data: bytes) -> str:
    """``block size:signature:signature at twice the size``."""
    if not data:
        return f"{BLOCK}::"
    hashes = rolling(data)
    places = np.flatnonzero(hashes % np.uint32(BLOCK) == 0)
    parts = (hashes[places] // np.uint32(BLOCK)).astype(np.int64) | 1 << 40
    levels = np.bitwise_count((parts & -parts) - 1)  # how often the block size can double
    at_least = np.bincount(levels, minlength=42)[::-1].cumsum()[::-1]
    level = int(np.argmax(at_least < LENGTH))

    def signature(level: int) -> str:
        ends = (places[levels >= level] + 1).tolist()
        if not ends or ends[-1] < len(data):
            ends.append(len(data))
        view, start, out = memoryview(data), 0, []
        for end in ends:
            out.append(_DIGITS[zlib.crc32(view[start:end]) & 63])
            start = end
        return "".join(out)

    return f"{BLOCK << level}:{signature(level)}:{signature(level + 1)}"


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance; a column of the table is one integer of vertical differences."""
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, distance = full, 0, len(a)
    for c in b:
        same = where.get(c, 0)
        zero = ((same & up) + up ^ up) | same | down
        rise, fall = down | full & ~(zero | up), up & zero
        distance += bool(rise & top) - bool(fall & top)
        rise, fall = rise << 1 | 1, fall << 1
        up, down = (fall | ~(zero | rise)) & full, rise & zero & full
    return distance


def _squeezed(signature: str) -> str:
    """Runs of one character say little: at most three of it stay."""
    out = []
    for c in signature:
        if len(out) < 3 or not out[-1] == out[-2] == out[-3] == c:
            out.append(c)
    return "".join(out)


def _alike(a: str, b: str) -> float:
    a, b = _squeezed(a), _squeezed(b)
    if a == b:
        return 1.0 if a else 0.0
    if min(len(a), len(b)) >= COMMON:
        runs = {a[i : i + COMMON] for i in range(len(a) - COMMON + 1)}
        if not any(b[i : i + COMMON] in runs for i in range(len(b) - COMMON + 1)):
            return 0.0
    return 1 - edit_distance(a, b) / max(len(a), len(b))


def likeness(one: str, other: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if one == other:
        return 1.0
    size_a, a, a2 = one.split(":")
    size_b, b, b2 = other.split(":")
    if size_a == size_b:
        return max(_alike(a, b), _alike(a2, b2))
    if int(size_a) == 2 * int(size_b):
        return _alike(a, b2)
    if int(size_b) == 2 * int(size_a):
        return _alike(a2, b)
    return 0.0


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as many first characters of ``following``, or all of them."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def fingerprints(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, fingerprint)`` of every whole text."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([source.schema[0], T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())], schema.names)

    return source.mapInArrow(run, schema)


def _in_order(docs: DataFrame, text: str, doc_id: str) -> DataFrame | None:
    """Rows in ranges of descending ids, each range followed by a copy of the first row of the next one.

    Ranges come from quantiles of the id; each is sorted in its own partition. The range after the last is the first.
    Columns ``(range, copy, doc_id, text_hash, text)``; None where there are no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = rows.select("doc_id").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n)
    cuts = F.array(*(F.lit(int(p)) for p in sorted(set(points))))
    place = F.when(F.col("doc_id").isNull(), len(points) + 1).otherwise(F.size(F.filter(cuts, lambda c: c > F.col("doc_id"))))
    firsts = {r[0]: r[1] for r in rows.select(place.alias("r"), "doc_id").groupBy("r").agg(F.max("doc_id")).collect()}
    if not firsts:
        return None
    ranges = sorted(firsts)
    before = F.create_map(*(F.lit(x) for a, b in zip([ranges[-1], *ranges], ranges, strict=False) for x in (b, a)))
    heads = F.create_map(*(F.lit(x).cast("long") for r in ranges for x in (r, firsts[r])))
    place = place.cast("int")
    with_place = rows.select(place.alias("range"), "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    is_head = F.col("doc_id").eqNullSafe(F.element_at(heads, F.col("range").cast("long")))
    own = F.struct(F.col("range"), F.lit(False).alias("copy"))
    more = F.struct(F.element_at(before, F.col("range")).alias("range"), F.lit(True).alias("copy"))
    spots = F.when(is_head, F.array(own, more)).otherwise(F.array(own))
    dealt = with_place.select(F.explode(spots).alias("spot"), "doc_id", "text_hash", "text")
    dealt = dealt.select("spot.range", "spot.copy", "doc_id", "text_hash", "text").repartition("range")
    return dealt.sortWithinPartitions("range", "copy", F.col("doc_id").desc_nulls_last(), "text_hash")


def compare_edited(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Each text's fingerprint, that of its edited text, and the likeness of its own to this and to the next document's.

    The next document is the one with the next smaller id, after the last the first; equal ids follow the text's hash, and null
    ids come last. Texts are shuffled once.
    """
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
    ])
    ordered = _in_order(docs, text, doc_id)
    if ordered is None:
        return docs.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # range, id, text, fingerprint of the row that waits for its next one
        for batch in batches:
            out = []
            for spot, copy, key, body in zip(*(batch.column(n) for n in ("range", "copy", "doc_id", "text")), strict=True):
                spot, copy = spot.as_py(), copy.as_py()
                if copy and (last is None or last[0] != spot):
                    continue  # a second copy of the first row of the next range
                following = body.as_py()
                mark = fingerprint(following.encode("utf-8", "surrogatepass"))
                if last is not None and last[0] == spot:
                    _, own_key, own, own_mark = last
                    new = edited(own, following).encode("utf-8", "surrogatepass")
                    new_mark = fingerprint(new)
                    out.append((own_key, len(own), hashlib.sha256(new).hexdigest(), own_mark, new_mark,
                                likeness(own_mark, new_mark), likeness(own_mark, mark)))
                last = None if copy else (spot, key.as_py(), following, mark)
            columns = list(zip(*out, strict=True)) if out else [()] * len(schema)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], schema.names)

    return ordered.mapInArrow(run, schema)
