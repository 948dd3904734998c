"""Words of many texts as bytes, and a bounded sieve for what may be frequent; shared by the counting operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

#: Bytes of text that are split into words at a time, longer single texts apart.
SLICE_BYTES = 1 << 22
#: Bits of the largest sieve (8 MB); with more keys it lets more through, which exact counts sort out afterwards.
MOST_BITS = 1 << 26
#: Spark's seed of XXH64.
SEED = 42


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Parts of batches with about ``SLICE_BYTES`` of text each, null texts as empty ones, texts as bytes."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        column = pc.fill_null(batch.column(at).cast(pa.large_string()), "").cast(pa.large_binary())
        batch = batch.set_column(at, text, column)
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            yield batch.slice(start, end - start)
            start = end


class Sieve:
    """A bitmap of hashed keys: a key that was put in always passes, another one seldom does."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 64 - 1)

        self.as_bytes, self.last = bits.astype("<u8").tobytes(), len(bits) * 64 - 1

    def holds(self, hashed: int) -> bool:
        place = hashed & self.last
        return bool(self.as_bytes[place >> 3] >> (place & 7) & 1)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & self.mask
        return (self.bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def seeded(first: str) -> int:
    """The seed under which XXH64 of a second column is Spark's ``xxhash64`` of both."""
    return xxhash.xxh64_intdigest(first, seed=SEED)


def build_sieve(keys: DataFrame, hashed: str, count: int) -> Broadcast:
    """Broadcast of the sieve over the long column ``hashed`` of about ``count`` rows: 16 bits a key, ``MOST_BITS`` at most.

    The bits are put together by tasks; the driver gets the words of the bitmap, whose number is bounded.
    """
    bits = 1 << 12
    while bits < min(MOST_BITS, 16 * count):
        bits *= 2
    place = F.col(hashed).bitwiseAND(F.lit(bits - 1))
    words = keys.select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast({hashed} & 63 as int))").alias("bit"))
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(bits // 64, np.uint64)
    bitmap[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(bitmap)


def passing(sieve: Broadcast, hashed: Column) -> Column:
    """Whether the sieve lets the long column through; the rows themselves stay where they are."""

    @F.arrow_udf("boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept = Sieve(sieve.value)
        for hashes in batches:
            yield pa.array(kept.passes(hashes.to_numpy(zero_copy_only=False).view(np.uint64)))

    return run(hashed)
