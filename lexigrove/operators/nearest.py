"""Exact nearest vectors for a batch of queries, without forming query-item pairs as rows.

Two physical forms, chosen by measured size:

* the items fit the broadcast bound (centroids): each batch of queries is answered in place,
  with no shuffle;
* otherwise the queries are cut into blocks that fit the bound. One block is broadcast at a time, the items stream
  by once for it, each task keeps a running best ``k`` per query, and only those lists are shuffled and merged. Items
  never move.

``key`` restricts a query to the items with the same key (cluster-aware search). A key's queries share blocks, and a
block reads the items of its keys only.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lexigrove.plans.runtime import BROADCAST_BYTES, broadcast_if_small, materialize

# Cosines are compared at this precision, so that equal vectors tie whatever the summing order.
COSINE_DIGITS = 9
# Sums of term weights, likewise.
TERM_DIGITS = 12
# Squared distances are compared at so many significant digits, for the same reason; they are returned as they are.
DISTANCE_DIGITS = 13
#: What two distances that are equal at that precision may differ by.
TIED = 10.0 ** (1 - DISTANCE_DIGITS)
CHUNK_CELLS = 1_000_000
#: Rows and columns of the products that are looked at together; one such tile stays in the processor's cache.
TILE = 1024
#: A key's queries are cut into so many parts of a block, from which blocks are put together.
PARTS = 8

RESULT = "query_id long, item_id long, score double, settled double"
_RESULT_ARROW = pa.schema([("query_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("settled", pa.float64())])


class _Block(NamedTuple):
    ids: np.ndarray
    keys: np.ndarray
    vectors: np.ndarray


def _to_block(data: pa.Table | pa.RecordBatch) -> _Block:
    """Columns ``(id, key, vector)`` of Arrow data as numpy arrays."""
    table = pa.Table.from_batches([data]) if isinstance(data, pa.RecordBatch) else data
    ids, keys = table.column("id").to_numpy(), table.column("key").to_numpy()
    chunks = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in table.column("vector").chunks]
    flat = np.concatenate(chunks).astype(np.float64) if chunks else np.empty(0)
    return _Block(ids, keys, flat.reshape(len(ids), len(flat) // max(1, len(ids))))


def _cosines(queries: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Query by item matrix of negative cosines; NaN where one is undefined."""
    norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(items, axis=1)[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        scores = np.where(norms > 0, -(queries @ items.T) / norms, np.nan)
    return np.round(scores, COSINE_DIGITS) + 0.0


class _Tiles:
    """Queries in single precision, ready to be multiplied with items.

    A product of single precision is fast and only selects, by its error bound, the pairs that may be within a query's bound. Those
    are computed again as sums of squared gaps in double precision. Both sides are moved to the middle of the queries and brought
    to the size of one by a power of two, so neither a common offset nor the scale of the vectors costs digits.
    """

    def __init__(self, queries: np.ndarray):
        self.queries, self.width = queries, queries.shape[1]
        finite = queries[np.isfinite(queries).all(axis=1)]
        self.middle = finite.mean(axis=0) if len(finite) else np.zeros(self.width)
        if not np.isfinite(self.middle).all():
            self.middle = np.zeros(self.width)
        self.largest, self.exponent = _largest(finite - self.middle), None
        self.length = _largest(finite) + _largest(self.middle)

    def _scaled(self, exponent: int) -> None:
        self.exponent = exponent
        moved = np.ldexp(self.queries - self.middle, -exponent)
        self.squares = (moved * moved).sum(axis=1)
        self.factors = np.hstack([-2.0 * moved, np.ones((len(moved), 1))]).astype(np.float32)

    def pairs(self, items: np.ndarray, k: int, bound, inside: tuple[np.ndarray, np.ndarray] | None = None):
        """``(rows, columns, scores)``, tile by tile, of all pairs within ``bound(rows)`` and among a tile's best ``k`` of a query.

        ``bound`` is asked again for each tile, as the best known get better. ``inside`` holds from and to which item a query looks.
        """
        with np.errstate(all="ignore"):
            moved = items - self.middle
            finite = np.isfinite(moved).all(axis=1)
            exponent = int(np.frexp(max(self.largest, _largest(moved[finite]), np.finfo(np.float64).tiny))[1])
            if exponent != self.exponent:
                self._scaled(exponent)
            # what moving both sides costs, in units of the scaled vectors
            shift = np.ldexp(8 * np.finfo(np.float64).eps * (self.length + _largest(items[finite])) * self.width, -exponent)
            moved = np.ldexp(moved, -exponent)
            squares = (moved * moved).sum(axis=1)
            factors = np.hstack([moved, squares[:, None]]).astype(np.float32)
            for low in range(0, len(items), TILE):
                high = min(low + TILE, len(items))
                known = finite[low:high]
                widest = float(squares[low:high][known].max(initial=0.0))
                for first in range(0, len(self.queries), TILE):
                    rows = slice(first, min(first + TILE, len(self.queries)))
                    if inside is not None and not ((inside[0][rows] < high) & (inside[1][rows] > low)).any():
                        continue
                    yield from self._tile(rows, low, high, factors[low:high], widest, shift, items, k, bound, inside)

    def _tile(self, rows: slice, low: int, high: int, factors: np.ndarray, widest: float, shift: float, items: np.ndarray, k: int, bound, inside):
        single, own = np.finfo(np.float32), self.squares[rows]
        rough = self.factors[rows] @ factors.T
        reach = np.sqrt(own) + np.sqrt(widest)
        least = np.ldexp((self.width + 4) * np.finfo(np.float64).smallest_subnormal, -2 * self.exponent)
        error = (2 * self.width + 16) * (single.eps * (own + 2 * widest) + single.tiny) + 2 * reach * shift + shift * shift + least
        limit = np.ldexp(bound(rows) * (1 + TIED), -2 * self.exponent) - own + error
        fresh = np.flatnonzero(~np.isfinite(limit))
        if len(fresh) and high - low > k:
            some = rough[fresh]
            if inside is not None:
                place = np.arange(low, high)
                some[(place < inside[0][rows][fresh, None]) | (place >= inside[1][rows][fresh, None])] = np.inf
            some[np.isnan(some)] = np.inf
            kth = np.partition(some, k - 1, axis=1)[:, k - 1].astype(np.float64)
            slack = 2 * error[fresh] + np.abs(kth + own[fresh]) * TIED
            limit[fresh] = np.where(np.isfinite(kth), kth + slack, np.inf)
        limit = np.nextafter(limit.astype(np.float32), np.float32(np.inf))
        chosen = np.flatnonzero(rough <= limit[:, None])
        row, column = np.divmod(chosen, high - low)
        row, column = row + rows.start, column + low
        if inside is not None:
            held = (column >= inside[0][row]) & (column < inside[1][row])
            row, column = row[held], column[held]
        step = max(1, CHUNK_CELLS // max(1, self.width))
        for start in range(0, len(row), step):
            r, c = row[start : start + step], column[start : start + step]
            gaps = self.queries[r] - items[c]
            yield r, c, (gaps * gaps).sum(axis=1)


def _largest(values: np.ndarray) -> float:
    return float(np.abs(values).max(initial=0.0))


def _significant(values: np.ndarray) -> np.ndarray:
    """Rounded to ``DISTANCE_DIGITS`` significant digits, whatever the scale; so equal distances tie whatever the summing order."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        factor = 10.0 ** (DISTANCE_DIGITS - 1 - np.floor(np.log10(values)))
        rounded = np.round(values * factor) / factor
    return np.where(np.isfinite(rounded), rounded, values)


class _Best:
    """Running best ``k`` per query, in the order of settled score and id; the scores themselves go along."""

    def __init__(self, n_queries: int, k: int, metric: str = "l2"):
        self.k, self.metric = k, metric
        self.scores = np.full((n_queries, k), np.inf)
        self.settled = np.full((n_queries, k), np.inf)
        self.ids = np.full((n_queries, k), -1, dtype=np.int64)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        k = self.k
        scores = np.where(np.isnan(scores), np.inf, scores)
        settled = scores
        if self.metric == "l2":
            settled, known = scores.copy(), np.isfinite(scores)
            settled[known] = _significant(scores[known])
        elif self.metric == "terms":
            settled = np.round(scores, TERM_DIGITS)
        scores = np.concatenate([self.scores[rows], scores], axis=1)
        settled = np.concatenate([self.settled[rows], settled], axis=1)
        kth = np.partition(settled, k - 1, axis=1)[:, k - 1 : k]
        row, col = np.nonzero((settled <= kth) & np.isfinite(settled))
        known = np.concatenate([self.ids[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
        order = np.lexsort((known[row, col], settled[row, col], row))
        row, col = row[order], col[order]
        place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
        row, col, place = row[place < k], col[place < k], place[place < k]
        for held, new, blank in ((self.scores, scores, np.inf), (self.settled, settled, np.inf), (self.ids, known, -1)):
            best = np.full((len(rows), k), blank, dtype=held.dtype)
            best[row, place] = new[row, col]
            held[rows] = best

    def add_pairs(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """The same for single pairs of a row and an item."""
        settled = _significant(scores) if self.metric == "l2" else scores
        close = np.isfinite(settled) & (settled <= self.settled[rows, -1])
        if not close.any():
            return
        rows, scores, settled, ids = rows[close], scores[close], settled[close], ids[close]
        touched, place = np.unique(rows, return_inverse=True)
        old = np.repeat(np.arange(len(touched)), self.k)
        row = np.concatenate([old, place])
        columns = [np.concatenate([held[touched].ravel(), new]) for held, new in ((self.scores, scores), (self.settled, settled), (self.ids, ids))]
        order = np.lexsort((columns[2], columns[1], row))
        row = row[order]
        order = order[np.arange(len(row)) - np.searchsorted(row, row, side="left") < self.k]
        for held, both in zip((self.scores, self.settled, self.ids), columns, strict=True):
            held[touched] = both[order].reshape(len(touched), self.k)

    def to_arrow(self, query_ids: np.ndarray) -> pa.RecordBatch:
        row, col = np.nonzero(np.isfinite(self.settled))
        return pa.RecordBatch.from_arrays(
            [pa.array(query_ids[row]), pa.array(self.ids[row, col]), pa.array(self.scores[row, col]), pa.array(self.settled[row, col])],
            schema=_RESULT_ARROW,
        )


def best_within(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, items: np.ndarray, k: int, bound: np.ndarray, start: np.ndarray, end: np.ndarray
) -> pa.RecordBatch:
    """The best ``k`` items of each query among ``items[start:end]`` of its own, none of them beyond ``bound`` if it is finite."""
    best = _Best(len(queries), k)
    # queries of near windows lie together, so that a tile has few pairs outside of them
    order = np.argsort(start, kind="stable")
    order = order[end[order] > start[order]]
    asked, limit, inside = _Tiles(queries[order]), bound[order], (start[order], end[order])
    for rows, columns, scores in asked.pairs(items, k, lambda part: np.minimum(limit[part], best.settled[order[part], -1]), inside):
        best.add_pairs(order[rows], scores, ids[columns])
    return best.to_arrow(query_ids)


class _Asked:
    """A block of queries by key, each key's made ready once."""

    def __init__(self, queries: _Block):
        self.block, self.order = queries, np.argsort(queries.keys, kind="stable")
        names, starts = np.unique(queries.keys[self.order], return_index=True)
        self.rows = dict(zip(names.tolist(), np.split(self.order, starts[1:]), strict=True)) if len(names) else {}
        self.tiles: dict[int, _Tiles] = {}

    def tiles_of(self, key: int) -> _Tiles:
        if key not in self.tiles:
            self.tiles[key] = _Tiles(self.block.vectors[self.rows[key]])
        return self.tiles[key]


def _search(best: _Best, asked: _Asked, items: _Block, metric: str) -> None:
    """Fold a block of items into the running best of a block of queries, key by key."""
    if not len(items.ids) or not asked.rows:
        return
    for key in np.unique(items.keys).tolist():
        rows = asked.rows.get(key)
        if rows is None:
            continue
        chosen = np.flatnonzero(items.keys == key)
        if metric == "l2":
            vectors, ids = items.vectors[chosen], items.ids[chosen]
            for row, column, scores in asked.tiles_of(key).pairs(vectors, best.k, lambda part: best.settled[rows[part], -1]):
                best.add_pairs(rows[row], scores, ids[column])
            continue
        # both sides in pieces, so that what a task holds at a time depends on neither
        for first in range(0, len(rows), TILE):
            piece = rows[first : first + TILE]
            step = max(1, CHUNK_CELLS // len(piece))
            for start in range(0, len(chosen), step):
                part = chosen[start : start + step]
                best.add(piece, _cosines(asked.block.vectors[piece], items.vectors[part]), items.ids[part])


def _prepared(df: DataFrame, id_col: str, vector_col: str, key: str | None) -> DataFrame:
    return df.filter(F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        (F.col(key) if key else F.lit(0)).cast("long").alias("key"),
        F.col(vector_col).alias("vector"),
    )


def vector_bytes(df: DataFrame) -> tuple[int, int]:
    """Row count and total bytes of the vectors at double precision."""
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("vector")), F.lit(0)).alias("cells")).first()
    return row["n"], row["cells"] * 8


def _by_broadcast_items(queries: DataFrame, items: DataFrame, k: int, metric: str) -> DataFrame:
    held = queries.sparkSession.sparkContext.broadcast(tuple(_to_block(items.toArrow())))

    def answer(batches):
        for batch in batches:
            if batch.num_rows:
                asked = _to_block(batch)
                best = _Best(len(asked.ids), k, metric)
                _search(best, _Asked(asked), _Block(*held.value), metric)
                yield best.to_arrow(asked.ids)

    return queries.mapInArrow(answer, RESULT)


def _by_broadcast_queries(queries: DataFrame, items: DataFrame, k: int, metric: str) -> DataFrame:
    asked = _to_block(queries.toArrow())
    held = queries.sparkSession.sparkContext.broadcast(tuple(asked))
    keys = [int(v) for v in np.unique(asked.keys)]

    def scan(batches):
        wanted = _Block(*held.value)
        best, ready = _Best(len(wanted.ids), k, metric), _Asked(wanted)
        for batch in batches:
            if batch.num_rows:
                _search(best, ready, _to_block(batch), metric)
        yield best.to_arrow(wanted.ids)

    return items.filter(F.col("key").isin(keys)).mapInArrow(scan, RESULT)


def _query_block(queries: DataFrame, blocks: int, limit: int) -> DataFrame:
    """``queries`` with the block of each: a key's queries lie together, parts of a hot key in several blocks."""
    size = F.sum(F.size("vector").cast("long") * 8)
    parts = broadcast_if_small(queries.groupBy("key").agg(F.ceil(size * PARTS / F.lit(limit)).cast("long").alias("parts")))
    part = F.pmod(F.xxhash64("id"), F.greatest(F.col("parts"), F.lit(1)))
    return queries.join(parts, "key").withColumn("query_block", F.pmod(F.xxhash64("key", part), F.lit(blocks)).cast("int")).drop("parts")


def _by_query_blocks(queries: DataFrame, items: DataFrame, k: int, metric: str, query_bytes: int, limit: int) -> DataFrame:
    """One block of queries after the other; each one's merged lists are stored."""
    blocks = max(1, math.ceil(query_bytes / limit))
    dealt = materialize(_query_block(queries, blocks, limit))
    found = None
    for block in range(blocks):
        asked = dealt.filter(F.col("query_block") == block).drop("query_block")
        best = materialize(_merged(_by_broadcast_queries(asked, items, k, metric), k))
        found = best if found is None else found.unionByName(best)
    return found


def nearest(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    *,
    metric: str = "l2",
    query_id: str = "query_id",
    item_id: str = "doc_id",
    query_vector: str = "embedding",
    item_vector: str = "embedding",
    key: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(query_id, item_id, rank, score)``: the ``k`` nearest items of every query.

    ``metric`` is ``l2`` (score = squared distance) or ``cosine`` (score = similarity). Ids are
    longs. A query without any item, or an undefined cosine, gives no row; ``k`` above the number
    of items gives them all.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if metric not in ("l2", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    asked = _prepared(queries, query_id, query_vector, key)
    stored = _prepared(items, item_id, item_vector, key)
    n_queries, query_bytes = vector_bytes(asked)
    # a task holds the queries and the best k of each
    query_bytes += n_queries * k * 24
    if query_bytes <= broadcast_bytes:
        rows = _by_broadcast_queries(asked, stored, k, metric)
    elif vector_bytes(stored)[1] <= broadcast_bytes:
        rows = _by_broadcast_items(asked, stored, k, metric)
    else:
        rows = _by_query_blocks(asked, stored, k, metric, query_bytes, broadcast_bytes)
    return _ranked(rows, k, metric, query_id, item_id)


def nearest_of_few(
    queries: DataFrame,
    items: DataFrame,
    k: int = 1,
    *,
    metric: str = "cosine",
    query_id: str = "query_id",
    item_id: str = "cluster_id",
    query_vector: str = "embedding",
    item_vector: str = "centroid",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``nearest`` for items that are few by nature (centroids): queries never move.

    Where the items turn out to exceed the bound, the general form takes over.
    """
    # computed once: the size check and the broadcast read the stored rows
    stored = materialize(_prepared(items, item_id, item_vector, None))
    if vector_bytes(stored)[1] > broadcast_bytes:
        return nearest(
            queries, items, k, metric=metric, query_id=query_id, item_id=item_id,
            query_vector=query_vector, item_vector=item_vector, broadcast_bytes=broadcast_bytes,
        )
    asked = _prepared(queries, query_id, query_vector, None)
    rows = _by_broadcast_items(asked, stored, k, metric)
    if k > 1:
        return _ranked(rows, k, metric, query_id, item_id)
    return rows.select(
        F.col("query_id").alias(query_id), F.col("item_id").alias(item_id), F.lit(1).alias("rank"),
        _shown(metric).alias("score"),
    )


def placed_by_nearest(
    queries: DataFrame, items: DataFrame, *, metric: str = "cosine", query_id: str = "query_id", query_vector: str = "embedding",
    item_id: str = "cluster_id", item_vector: str = "centroid", broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(query_id, query_vector, item_id, score)``: queries with the nearest of few items, in one pass and without a join.

    Where the items exceed the bound, the general form and a join take over.
    """
    stored = materialize(_prepared(items, item_id, item_vector, None))
    asked = _prepared(queries, query_id, query_vector, None)
    if vector_bytes(stored)[1] > broadcast_bytes:
        found = nearest(asked, stored, 1, metric=metric, query_id="id", item_id="item_id", query_vector="vector",
                        item_vector="vector", broadcast_bytes=broadcast_bytes)
        rows = asked.join(found.select("id", "item_id", "score"), "id").select("id", "vector", "item_id", "score")
    else:
        held = queries.sparkSession.sparkContext.broadcast(tuple(_to_block(stored.toArrow())))

        def place(batches):
            for batch in batches:
                if batch.num_rows:
                    asked = _to_block(batch)
                    best = _Best(len(asked.ids), 1, metric)
                    _search(best, _Asked(asked), _Block(*held.value), metric)
                    known = pa.array(np.flatnonzero(np.isfinite(best.settled[:, 0])))
                    score = best.scores[:, 0] if metric == "l2" else 0.0 - best.scores[:, 0]
                    yield pa.RecordBatch.from_arrays([
                        batch.column("id").take(known), batch.column("vector").take(known), pa.array(best.ids[:, 0]).take(known),
                        pa.array(score).take(known)], ["id", "vector", "item_id", "score"])

        kind = asked.schema["vector"].dataType.simpleString()
        rows = asked.mapInArrow(place, f"id long, vector {kind}, item_id long, score double")
    return rows.select(F.col("id").alias(query_id), F.col("vector").alias(query_vector), F.col("item_id").alias(item_id), "score")


def _shown(metric: str):
    # Adding zero turns a negative zero into zero.
    return -F.col("score") + F.lit(0.0) if metric == "cosine" else F.col("score")


def ranked(rows: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each query with their ``rank``; partial lists are cut before the shuffle."""
    order = Window.partitionBy("query_id").orderBy("settled", "item_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _merged(rows: DataFrame, k: int) -> DataFrame:
    return ranked(rows, k).drop("rank")


def _ranked(rows: DataFrame, k: int, metric: str, query_id: str, item_id: str) -> DataFrame:
    return ranked(rows, k).select(
        F.col("query_id").alias(query_id), F.col("item_id").alias(item_id), "rank", _shown(metric).alias("score"))
