"""SimHash near-duplicates by deletion variants.

A fingerprint is cut into ``max_bits // 2 + 1`` segments. Of two fingerprints that differ in at most ``max_bits`` bits one
segment differs in at most one bit, so the two agree on that segment with this bit left out. Each fingerprint is indexed
under all its one-wildcard segment variants; rows of one variant meet by hash partitioning and sorting, and every
pair is verified on all 64 bits. A variant looks only for pairs that differ in its wildcard bit (the first wildcard
of a segment also for those that agree on it), so no pair is looked at for each of 32 wildcards.

Nothing is paired as rows. Equal fingerprints are one node before anything is indexed. A variant with up to
``BUCKET`` rows is solved in its task and gives one link per row to the smallest of its cluster. Larger ones are cut
further: the bits that are free are indexed by their own one-wildcard variants, level by level, until at most
256 fingerprints can share a variant. Links become components by star steps.

Defined results: a text without words (null, empty, white space) has fingerprint zero and is linked like any other; fewer
words than a shingle give one shingle; every input row gives one output row, also repeated ones; a null id is never the
smallest of its component unless all its ids are null, then the component is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from lexigrove.llm import shingles
from lexigrove.llm.components import connected_components
from lexigrove.llm.wordstream import build_sieve, passing
from lexigrove.plans.runtime import materialize, scratch_scope, shuffles_deleted

#: Rows of one variant that a task compares directly; beyond it the variant is cut further.
BUCKET = 1024
ALL = (1 << 64) - 1


@dataclass(frozen=True)
class Feature:
    """What a fingerprint sums over: shingles of ``words`` words of at least ``min_chars`` bytes, hashed with ``seed``."""

    words: int = 3
    seed: int = 42
    min_chars: int = 1


def words_of(text: str | None) -> list[bytes]:
    """Words between the six ASCII blanks, A-Z in lower case; bytes know no other blanks or capitals."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fingerprint(words: list[bytes], feature: Feature) -> int:
    """Unsigned 64-bit fingerprint; a bit is set if it is set in over half of the shingle hashes."""
    if feature.min_chars > 1:
        words = [w for w in words if len(w) >= feature.min_chars] or words
    n = len(words)
    if not n:
        return 0
    size = min(feature.words, n)
    grams = words if size == 1 else map(b" ".join, zip(*(words[i : n - size + 1 + i] for i in range(size)), strict=True))
    seed = feature.seed
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in grams), np.uint64, n - size + 1)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[start : start + 8192].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, features: dict[str, Feature], *, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, text_hash, <one long per feature>)``, a row for each row; ``text_hash`` is XXH64 of the text."""
    names = list(features)
    source = docs.select(*keep, F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), F.col(text).alias("_text"))
    kept = source.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.empty((len(names), batch.num_rows), np.uint64)
            for i, value in enumerate(batch.column("_text")):
                words = words_of(value.as_py())
                for k, name in enumerate(names):
                    prints[k, i] = fingerprint(words, features[name])
            columns = [*batch.columns[:-1], *(pa.array(p.view(np.int64)) for p in prints)]
            yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in kept), *names])

    return source.mapInArrow(run, T.StructType([*kept, *(T.StructField(n, T.LongType()) for n in names)]))


def segments(max_bits: int) -> list[tuple[int, int]]:
    """``(first bit, width)`` of the segments: as few as let one differ by one bit at most."""
    n = max_bits // 2 + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def variants(blocks: Sequence[tuple[int, int]]) -> dict[int, tuple[int, bool]]:
    """Mask of the fixed bits of every one-wildcard variant: its wildcard bit, whether the first of the segment."""
    out = {}
    for first, width in blocks:
        whole = ((1 << width) - 1) << first
        for bit in range(first, first + width):
            out[whole & ~(1 << bit)] = (bit, bit == first)
    return out


def deeper(mask: int, max_bits: int) -> list[int]:
    """Masks that cut a variant with too many rows: the bits still free, without lone wildcards, in segments again."""
    free, bit = [], 0
    while bit < 64:  # runs of free bits; a run of one or two is a wildcard or what an earlier cut left
        if mask >> bit & 1:
            bit += 1
            continue
        start = bit
        while bit < 64 and not mask >> bit & 1:
            bit += 1
        free.append((start, bit - start))
    longest = max(free, key=lambda r: r[1])
    free = [r for r in free if 2 * r[1] > longest[1]]
    bits = [b for start, width in free for b in range(start, start + width)]
    n = max_bits // 2 + 1
    if len(bits) < 2 * n:
        return []
    edges = [len(bits) * i // n for i in range(n + 1)]
    out = []
    for a, b in zip(edges, edges[1:], strict=False):
        whole = sum(1 << x for x in bits[a:b])
        out += [mask | whole & ~(1 << x) for x in bits[a:b]]
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _clusters(prints, max_bits, wild):
    """Labels (index of the smallest member) of the clusters among the rows of one variant."""
    apart = prints[:, None] ^ prints[None, :]
    near = np.bitwise_count(apart) <= max_bits
    if wild is not None:
        bit, first, whole = wild
        differs = (apart >> np.uint64(bit) & np.uint64(1)).astype(bool)
        near &= differs | ((apart & np.uint64(whole)) == 0) if first else differs
    np.fill_diagonal(near, True)
    labels = np.arange(len(prints))
    while True:
        lowest = np.where(near, labels[None, :], len(prints)).min(1)
        lowest = lowest[lowest]
        if (lowest == labels).all():
            return labels
        labels = lowest


def _solve(index: DataFrame, max_bits: int, wilds: dict) -> DataFrame:
    """Rows ``(mask, fp, node)`` to ``(deeper, mask or 0, fp, node, other)``: links and rows to cut further."""
    columns = ["mask", "fp", "node"]
    schema = T.StructType(
        [T.StructField("deeper", T.BooleanType()), *(T.StructField(c, T.LongType()) for c in (*columns, "other"))]
    )

    def rows_out(table: np.ndarray, deep: bool, other: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array(np.full(len(other), deep)), *(pa.array(np.ascontiguousarray(t)) for t in table), pa.array(other)]
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    def solve_run(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = table.shape[1]
        mask = int(table[0, 0]) & ALL
        if n > BUCKET and deeper(mask, max_bits):
            yield from extend(table)
            return
        wild = wilds.get(mask)
        # beyond the last cut every pair of blocks is compared
        step = BUCKET // 2 if n > BUCKET else n
        starts = range(0, n, step)
        for i, j in [(i, j) for i in starts for j in starts if i < j] or [(0, n)]:
            part = np.concatenate([table[:, i : i + step], table[:, j : j + step]], axis=1)
            labels = _clusters(part[1].view(np.uint64), max_bits, wild)
            moved = np.flatnonzero(labels != np.arange(len(labels)))
            if len(moved):
                yield rows_out(part[:, moved], False, part[2, labels[moved]])

    def extend(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        for m in deeper(int(table[0, 0]) & ALL, max_bits):
            rows = table.copy()
            rows[0] = _signed(m)
            yield rows_out(rows, True, np.zeros(table.shape[1], np.int64))

    def pairs(table: np.ndarray, a: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Variants with two rows, all at once."""
        x, y = table[:, a], table[:, a + 1]
        apart = (x[1] ^ y[1]).view(np.uint64)
        good = (np.bitwise_count(apart) <= max_bits) & (x[2] != y[2])
        if wilds:
            found, which = np.unique(x[0], return_inverse=True)
            rules = [wilds[int(m) & ALL] for m in found]
            differs = (apart >> np.array([r[0] for r in rules], np.uint64)[which] & np.uint64(1)).astype(bool)
            whole = np.array([r[2] if r[1] else 0 for r in rules], np.uint64)[which]
            good &= differs | ((whole != 0) & (apart & whole == 0))
        if good.any():
            yield rows_out(y[:, good], False, x[2, good])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((len(columns), 0), np.int64)
        hot: tuple[int, int] | None = None  # a run too long to hold: its rows are passed on as they come
        for batch in batches:
            table = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1)
            if not table.shape[1]:
                continue
            keys = table[1] & table[0]
            cut = np.flatnonzero((np.diff(table[0]) != 0) | (np.diff(keys) != 0)) + 1
            starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [table.shape[1]]])
            if hot is not None and hot == (table[0, 0], keys[0]):
                yield from extend(table[:, : ends[0]])
                starts, ends = starts[1:], ends[1:]
                if not len(starts):
                    continue
            hot = None
            sizes = (ends - starts)[:-1]
            yield from pairs(table, starts[:-1][sizes == 2])
            for i in np.flatnonzero(sizes > 2):
                yield from solve_run(table[:, starts[i] : ends[i]])
            held = table[:, starts[-1] :]
            if held.shape[1] > 8 * BUCKET and deeper(int(held[0, 0]) & ALL, max_bits):
                yield from extend(held)
                hot, held = (held[0, 0], keys[-1]), held[:, :0]
        if held.shape[1] > 1:
            yield from solve_run(held)

    parts = index.repartition(F.col("mask"), F.col("fp").bitwiseAND(F.col("mask")))
    ordered = parts.sortWithinPartitions("mask", F.col("fp").bitwiseAND(F.col("mask")), "fp", "node")
    return ordered.select(*columns).mapInArrow(run, schema)


def links(nodes: DataFrame, prints: Sequence[str], *, max_bits: int = 3) -> DataFrame:
    """``(node, other)``: links that join all nodes within reach of each other, each verified.

    ``nodes`` has one row per distinct ``node`` with a fingerprint in each of the columns ``prints``, and no two nodes have all the
    same ones; nodes are linked if one of these differs in at most ``max_bits`` bits.
    """
    masks = variants(segments(max_bits))
    widths = {m: ((1 << w) - 1) << f for f, w in segments(max_bits) for m in variants([(f, w)])}
    wilds = {m: (bit, first, widths[m]) for m, (bit, first) in masks.items()}
    fixed = F.array(*(F.lit(_signed(m)) for m in masks))
    index = None
    for name in prints:
        one = nodes.select(F.explode(fixed).alias("mask"), F.col(name).alias("fp"), "node")
        index = one if index is None else index.unionByName(one)
    found = None
    while True:
        solved = materialize(_solve(index, max_bits, wilds))
        wilds = {}
        good = solved.filter("not deeper").select("node", "other")
        found = good if found is None else found.unionByName(good)
        index = solved.filter("deeper").select("mask", "fp", "node")
        if index.isEmpty():
            return found


def _grouped(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """``(node, component_id)`` for all nodes; ``nodes`` has the smallest id of each."""
    roots = connected_components(found)
    rooted = nodes.select("node", "smallest").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = materialize(rooted)
    least = materialize(rooted.groupBy("root").agg(F.min("smallest").alias("component_id")))
    return materialize(rooted.join(least, "root").select("node", "component_id"))


def components(docs: DataFrame, *, feature: Feature = Feature(), max_bits: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row. Runs jobs when called."""
    rows = materialize(fingerprints(docs, {"node": feature}, text=text, keep=[doc_id]))
    nodes = materialize(rows.groupBy("node").agg(F.min(doc_id).alias("smallest")))
    found = links(nodes.withColumn("fp", F.col("node")), ["fp"], max_bits=max_bits)
    groups = _grouped(nodes, found)
    return rows.join(groups, "node").select(
        doc_id, F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: Fingerprint over longer words that proposes near copies, and the bits in which it may differ.
CANDIDATE, CANDIDATE_BITS = Feature(1, 42, 5), 5


def _print_sets(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``(doc_id, text_hash, node, fp, n, profile)``: number, size and profile of the set of five-word shingles, and the candidate fingerprint."""
    source = docs.select(doc_id, F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), F.col(text).alias("_text"))
    kept = source.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, profiles = np.empty((3, batch.num_rows), np.int64), []
            for i, value in enumerate(batch.column("_text")):
                words = words_of(value.as_py())
                found = shingles.shingle_set(shingles.word_hashes(words))
                out[:, i] = shingles.node_of(found), _signed(fingerprint(words, CANDIDATE)), len(found)
                profiles.append(shingles.profile_of(found))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *map(pa.array, out), pa.array(profiles, pa.binary())], [*(f.name for f in kept), "node", "fp", "n", "profile"])

    return source.mapInArrow(run, T.StructType(
        [*kept, *(T.StructField(n, T.LongType()) for n in ("node", "fp", "n")), T.StructField("profile", T.BinaryType())]))


def near_copies(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, text_hash, component_id, first)`` for every row: components of texts alike to 0.8 on five-word shingles.

    Fingerprints propose pairs, an exact join adds all that they miss, and every link is verified on the whole texts.
    ``first`` marks the one row of a group to keep: the smallest id, of equal ids the smallest text hash.
    """
    rows = materialize(_print_sets(docs, text, doc_id))
    key = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col("text_hash").alias("hash"))
    nodes = materialize(rows.groupBy("node").agg(F.min(key).alias("smallest"), F.min("text_hash").alias("text_hash"), F.min("fp").alias("fp"),
                                               F.min("n").alias("n"), F.min("profile").alias("profile")))
    prints = materialize(nodes.groupBy("fp").agg(F.min("node").alias("node")))
    near = links(prints.select(F.col("fp").alias("node"), "fp"), ["fp"], max_bits=CANDIDATE_BITS)
    ends = [prints.select(F.col("fp").alias(c), F.col("node").alias(n)) for c, n in (("node", "a"), ("other", "b"))]
    proposed = near.join(ends[0], "node").join(ends[1], "other").select("a", "b")
    proposed = proposed.union(nodes.join(prints.withColumnRenamed("node", "b"), "fp").select("node", "b"))
    found = shingles.alike(docs, nodes.select("node", "text_hash", "n", "profile"), proposed, words_of, text=text)
    groups = _grouped(nodes, found)
    return rows.join(groups, "node").select(
        doc_id, "text_hash", F.col("component_id")["id"].alias("component_id"), (key == F.col("component_id")).alias("first")
    )


def keep_one(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of near copies, all columns as they were.

    A row whose text is in no row that goes or comes twice stays without being moved; a sieve finds these.
    """
    with scratch_scope(docs.sparkSession), shuffles_deleted(docs.sparkSession):
        marked = near_copies(docs, text=text, doc_id=doc_id)
        keys = marked.groupBy(F.col(doc_id).alias("_id"), F.col("text_hash").alias("_hash")).agg((~F.min("first")).alias("gone"), F.count("*").alias("n"))
        unsure = materialize(keys.filter("gone or n > 1").select("_id", "_hash", "gone"), outlive=True)
        sieve = build_sieve(unsure, "_hash", shingles.WIDE * unsure.count())
    packed = docs.select(F.struct("*").alias("_row"), F.col(doc_id).alias("_key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_text"))
    packed = packed.withColumn("_unsure", passing(sieve, F.col("_text")))
    left = packed.filter("_unsure").join(unsure.filter("gone"), (F.col("_text") == F.col("_hash")) & F.col("_key").eqNullSafe(F.col("_id")), "left_anti")
    once = Window.partitionBy("_text", "_key").orderBy(F.xxhash64(F.col("_row").cast("string")))
    left = left.withColumn("_n", F.row_number().over(once)).filter("_n = 1")
    return packed.filter("not _unsure").select("_row.*").unionByName(left.select("_row.*"))
