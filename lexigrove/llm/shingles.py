"""Exact joins of texts by the Jaccard similarity of their sets of five-word shingles.

Two sets that are alike to 0.8 share one of the first ``n - ceil(0.8 n) + 1`` shingles of each, in any order common to all
texts. Only these are indexed, the ones known to be frequent last; shingles with one text are dropped as soon as they meet. The
frequent ones come from a sample of texts, which decides the order and so the cost, never the result. What can't be
ruled out by the sizes and the positions meets first by its profiles: the number of a set's shingles in each of ``CELLS`` cells
of the hash. Two sets share at most the sum of the smaller numbers, so most pairs go before a set moves. The others are
verified on the whole sets, by integers. A shingle with more than ``BLOCK``
texts is cut into pairs of blocks, so that no task holds all its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lexigrove.llm.components import connected_components
from lexigrove.llm.wordstream import build_sieve, passing
from lexigrove.plans.runtime import materialize

WORDS = 5
#: Texts of one shingle that a task compares directly.
BLOCK = 2048
#: Shingles that are put last because they are frequent, and the share of texts that are asked for them.
FREQUENT, SAMPLED = 100_000, 8
#: Shingles that a task gathers before it passes them on.
FLUSH = 1 << 19

#: Texts of a shingle that all others there are tried with in the first turn, turns, and how many pairs a link may cost for another one.
CENTRES, TURNS, WORTH = 16, 4, 100
#: Texts that are compared with a hub in one task, and how much wider than usual a sieve is that keeps texts in their place.
LEAVES, WIDE = 256, 4
#: Cells of a profile; a cell counts up to 254, more stands for any number.
CELLS, MANY = 256, 255

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words than a shingle give one, no words none."""
    n = len(hashes)
    size = min(WORDS, n)
    if not n:
        return np.empty(0, np.int64)
    out = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        out += hashes[i : n - size + 1 + i] * _ODD[i]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(29)
    return np.unique(out.view(np.int64))


def node_of(shingles: np.ndarray) -> int:
    """One number per set."""
    h = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return h - (1 << 64) if h >> 63 else h


def profile_of(shingles: np.ndarray) -> bytes:
    """How many shingles of a set fall into each cell, a byte each."""
    cells = np.bincount((shingles.view(np.uint64) >> np.uint64(56)).astype(np.int64), minlength=CELLS)
    return np.minimum(cells, MANY).astype(np.uint8).tobytes()


def may_be_alike(p: np.ndarray, q: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which rows of profiles leave room for 0.8; ``sizes`` are the sums of both sets' sizes."""
    common = np.minimum(p, q)
    open_ended = (common == MANY).any(1)
    return open_ended | (9 * common.sum(1, dtype=np.int64) >= 4 * sizes)


def _plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The ``pairs`` that sizes and profiles don't rule out."""
    sides = [nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("profile").alias(f"p_{c}")) for c in ("a", "b")]
    both = pairs.join(sides[0], "a").join(sides[1], "b").filter("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            p, q = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, CELLS) for c in ("p_a", "p_b"))
            sizes = batch.column("size").to_numpy()
            good = pa.array(may_be_alike(p, q, sizes))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(good) for c in ("a", "b")], ["a", "b"])

    return both.select("a", "b", (F.col("n_a") + F.col("n_b")).cast("long").alias("size"), "p_a", "p_b").mapInArrow(run, "a long, b long")


def _sets(batch: pa.RecordBatch, words_of) -> Iterator[tuple[int, np.ndarray]]:
    """``(node, set)`` of a batch's texts, each set once."""
    seen = set()
    for value in batch.column(0):
        shingles = shingle_set(word_hashes(words_of(value.as_py())))
        node = node_of(shingles)
        if node not in seen:
            seen.add(node)
            yield node, shingles


def _frequent(docs: DataFrame, text: str, words_of) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent in a sample of texts, sorted, and how often they were met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(parts):
            found, counts = np.unique(np.concatenate(parts), return_counts=True)
            often = counts > 2
            return pa.RecordBatch.from_arrays([pa.array(found[often]), pa.array(counts[often].astype(np.int64))], ["h", "n"])

        for batch in batches:
            parts, held = [], 0
            for _, shingles in _sets(batch, words_of):
                parts.append(shingles)
                held += len(shingles)
                if held > 4 * FLUSH:
                    yield counted(parts)
                    parts, held = [], 0
            if parts:
                yield counted(parts)

    some = docs.select(text).filter(F.pmod(F.xxhash64(text), F.lit(SAMPLED)) == 0)
    top = some.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(FREQUENT)
    rows = sorted((r["h"], r["n"]) for r in top.collect())
    return np.array([h for h, _ in rows], np.int64), np.array([n for _, n in rows], np.int64)


def _index(docs: DataFrame, text: str, words_of) -> DataFrame:
    """``(h, node, n, pos)``: the first shingles of each text that it shares with another."""
    often, counts = _frequent(docs, text, words_of)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts):
            h, node, n, size = (list(x) for x in zip(*parts, strict=True))
            pos = [np.arange(s, dtype=np.int32) for s in size]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(h)), pa.array(np.repeat(np.array(node, np.int64), size)),
                 pa.array(np.repeat(np.array(n, np.int32), size)), pa.array(np.concatenate(pos))], ["h", "node", "n", "pos"])

        parts, held = [], 0
        for batch in batches:
            for node, shingles in _sets(batch, words_of):
                n = len(shingles)
                if not n:
                    continue
                if len(often):
                    at = np.minimum(np.searchsorted(often, shingles), len(often) - 1)
                    shingles = shingles[np.argsort(np.where(often[at] == shingles, counts[at], 0), kind="stable")]
                size = n - (4 * n + 4) // 5 + 1
                parts.append((shingles[:size].copy(), node, n, size))
                held += size
                if held > FLUSH:
                    yield out(parts)
                    parts, held = [], 0
        if parts:
            yield out(parts)

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows whose shingle another text has too, each once; the last row waits for the next batch."""
        names, held, met = ["h", "node", "n", "pos"], None, False
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate([a, b]) for a, b in zip(held, columns, strict=True)]
            h, node = columns[:2]
            if not len(h):
                continue
            fresh = np.concatenate([[True], (np.diff(h) != 0) | (np.diff(node) != 0)])
            columns = [c[fresh] for c in columns]
            h = columns[0]
            same = h[1:] == h[:-1]
            keep = np.concatenate([[met], same]) | np.concatenate([same, [False]])
            held, met = [c[-1:] for c in columns], bool(keep[-1])
            if keep[:-1].any():
                yield pa.RecordBatch.from_arrays([pa.array(c[:-1][keep[:-1]]) for c in columns], names)
        if met:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names)

    schema = "h long, node long, n int, pos int"
    rows = docs.select(text).mapInArrow(first, schema)
    return materialize(rows.repartition("h").sortWithinPartitions("h", "node").mapInArrow(shared, schema))


def _stars(index: DataFrame) -> DataFrame:
    """``(a, b)``: each text of a shingle with the one before it by size, and with the first that its size allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = first = last = None
        for batch in batches:
            a, b = [], []
            for h, node, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if h != key or 5 * first[1] < 4 * n:
                    if h == key and 5 * last[1] >= 4 * n:
                        a.append(last[0])
                        b.append(node)
                    key, first = h, (node, n)
                else:
                    a += [first[0], last[0]]
                    b += [node, node]
                last = (node, n)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    ordered = index.select("h", "node", "n").repartition("h").sortWithinPartitions("h", "n", "node")
    return ordered.mapInArrow(run, "a long, b long")


def _open(index: DataFrame, roots: DataFrame) -> DataFrame:
    """The index with each text's group; a shingle all of whose texts lie in one group has nothing to compare and goes."""
    known = index.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = known.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("h")
    return known.join(several, "h", "left_semi")


def _centred(index: DataFrame, roots: DataFrame, turn: int) -> DataFrame:
    """``(a, b)``: each text of a shingle with the turn's centres of other groups there, those with the most indexed shingles first.

    A turn has twice as many centres as the one before it, and other ones.
    """
    first, last = CENTRES * (2**turn - 1), CENTRES * (2 ** (turn + 1) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate([a, b]) for a, b in zip(held, columns, strict=True)]
            h, node, n, pos, root = columns
            if not len(h):
                continue
            n, left = n.astype(np.int64), n.astype(np.int64) - pos
            edges = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1])
            starts, rows = np.repeat(edges, np.diff(np.append(edges, len(h)))), np.arange(len(h))
            for c in range(first, last):
                j = np.flatnonzero(starts + c < rows)
                if not len(j):
                    break
                i = starts[j] + c
                good = (root[i] != root[j]) & (9 * np.minimum(left[i], left[j]) >= 4 * (n[i] + n[j]))
                yield pa.RecordBatch.from_arrays([pa.array(node[i[good]]), pa.array(node[j[good]])], ["a", "b"])
            held = [c[edges[-1] : edges[-1] + last] for c in columns]

    # a text that others are changed copies of shares more of its first shingles than they do
    degrees = index.groupBy("node").agg(F.count("*").alias("degree"))
    rows = _open(index, roots).join(degrees, "node").select("h", "node", "n", "pos", "root", "degree")
    rows = rows.repartition("h").sortWithinPartitions("h", F.desc("degree"), "node").drop("degree")
    return rows.mapInArrow(run, "a long, b long")


def _across(index: DataFrame, roots: DataFrame) -> DataFrame:
    """``(a, b)``: texts of different groups that share an indexed shingle and can be alike by their sizes and positions."""
    sizes = index.groupBy("h").agg(F.count("*").alias("rows")).filter(F.col("rows") > BLOCK)
    sizes = materialize(sizes.select("h", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")))
    cut = _open(index, roots).join(sizes, "h", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("h", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "n", "pos", "root")

    def pairs(run: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        _, x, y, own, node, n, pos, root = run
        n, left = n.astype(np.int64), n.astype(np.int64) - pos
        for start in range(0, len(n) - 1, 512):
            stop = min(start + 512, len(n))
            far = int(np.searchsorted(n, 5 * n[stop - 1] // 4, side="right"))
            i, j = slice(start, stop), slice(start, far)
            good = np.arange(start, stop)[:, None] < np.arange(start, far)[None, :]
            good &= root[i, None] != root[None, j]
            if x[0] != y[0]:
                good &= own[i, None] != own[None, j]
            good &= 9 * np.minimum(left[i, None], left[None, j]) >= 4 * (n[i, None] + n[None, j])
            p, q = np.nonzero(good)
            if len(p):
                yield pa.RecordBatch.from_arrays([pa.array(node[start + p]), pa.array(node[start + q])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate([a, b]) for a, b in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            new = np.flatnonzero(np.logical_or.reduce([np.diff(c) != 0 for c in columns[:3]])) + 1
            edges = [0, *new.tolist()]
            for a, b in zip(edges, edges[1:], strict=False):
                if b - a > 1:
                    yield from pairs([c[a:b] for c in columns])
            held = [c[edges[-1] :] for c in columns]
        if held is not None and len(held[0]) > 1:
            yield from pairs(held)

    return cut.repartition("h", "x", "y").sortWithinPartitions("h", "x", "y", "n", "node").mapInArrow(run, "a long, b long")


def _cells(pairs: DataFrame) -> DataFrame:
    """``(hub, chunk, leaf)``: each pair by its end with the most pairs; a hub's leaves are dealt to chunks of about ``LEAVES``."""
    degrees = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    ends = [degrees.select(F.col("node").alias(c), F.col("degree").alias(f"degree_{c}")) for c in ("a", "b")]
    both = pairs.join(ends[0], "a").join(ends[1], "b")
    first = F.col("degree_a") >= F.col("degree_b")
    both = both.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("leaf"),
                       F.ceil(F.greatest("degree_a", "degree_b") / LEAVES).alias("chunks"))
    return both.select("hub", F.pmod(F.xxhash64("leaf"), "chunks").cast("int").alias("chunk"), "leaf")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, text: str, words_of) -> DataFrame:
    """The ``pairs`` whose whole sets are alike to 0.8.

    A text moves to the cells of its pairs, where the hub's set is held and its leaves pass by. No set is stored or paired as a row, and
    only texts that a sieve lets through leave their place, so the documents are never shuffled as a whole.
    """
    cells = _cells(pairs)
    places = cells.select(F.col("leaf").alias("node"), "hub", "chunk").union(cells.select(F.col("hub").alias("node"), "hub", "chunk").distinct())
    places = places.join(nodes.select("node", "text_hash"), "node").groupBy("text_hash", "node").agg(F.collect_list(F.struct("hub", "chunk")).alias("places"))
    places = materialize(places)
    sieve = build_sieve(places, "text_hash", WIDE * places.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = held = None
        for batch in batches:
            a, b = [], []
            for hub, chunk, node, value in zip(*batch.columns, strict=True):
                hub, chunk, node = hub.as_py(), chunk.as_py(), node.as_py()
                shingles = shingle_set(word_hashes(words_of(value.as_py())))
                if node_of(shingles) != node:  # another text with the same hash
                    continue
                if node == hub:
                    cell, held = (hub, chunk), shingles
                elif cell == (hub, chunk):
                    common = len(np.intersect1d(held, shingles, assume_unique=True))
                    if 9 * common >= 4 * (len(held) + len(shingles)):
                        a.append(min(hub, node))
                        b.append(max(hub, node))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    some = docs.select(F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), F.coalesce(text, F.lit("")).alias("_text"))
    some = some.filter(passing(sieve, F.col("text_hash"))).distinct().join(places, "text_hash")
    some = some.select("node", "_text", F.explode("places").alias("_place")).select("_place.*", "node", "_text")
    ordered = some.repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", F.col("node") != F.col("hub"), "node")
    return materialize(ordered.mapInArrow(run, "a long, b long"))


def _pairs(links: DataFrame) -> DataFrame:
    a, b = links.columns
    return links.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def alike(docs: DataFrame, nodes: DataFrame, proposed: DataFrame, words_of, *, text: str = "text") -> DataFrame:
    """``(node, other)``: links whose components are those of all pairs of sets alike to 0.8.

    ``nodes`` has ``(node, text_hash, n, profile)``, one text of each set; ``proposed`` has pairs of nodes that may be alike. Those and the
    neighbours in the index are verified first; what then lies in one group needn't be compared any more. A group whose texts are alike
    in few of its pairs, as changed copies of one text are, would be left in parts, so all texts of a shingle meet its likely centres, in up to ``TURNS`` turns as long as one pair in ``WORTH`` is a link. All pairs that are still in different groups are
    compared at the end, so these numbers decide no result.
    """
    index = _index(docs, text, words_of)
    tried = materialize(_pairs(proposed.toDF("a", "b").union(_stars(index))))
    found = _verified(materialize(_plausible(tried, nodes)), docs, nodes, text, words_of)
    asked, links = tried.count(), found.count()
    for turn in range(TURNS):
        if links * WORTH < asked or not asked:
            break
        more = materialize(_pairs(_centred(index, connected_components(found), turn)).join(tried, ["a", "b"], "left_anti"))
        good = _verified(materialize(_plausible(more, nodes)), docs, nodes, text, words_of)
        found, tried = found.union(good), tried.union(more)
        asked, links = more.count(), good.count()
    rest = _pairs(_across(index, connected_components(found))).join(tried, ["a", "b"], "left_anti")
    rest = materialize(_plausible(rest, nodes))
    if not rest.isEmpty():
        found = found.union(_verified(rest, docs, nodes, text, words_of))
    return found.toDF("node", "other")
