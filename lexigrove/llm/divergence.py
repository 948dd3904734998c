"""How far the sources of a language differ in their words, and by which words.

A language's matrix has a row for each source and a column for each kept term; it holds counts. Columns are ordered by how
frequent a term is, so that the rare ones, which most sources lack, lie together. The matrix is cut into blocks of
``ROWS`` by ``COLUMNS``, and one task compares two blocks of rows over one block of columns. It builds a k²-tree (k = 2) over
each: a node is a quadrant with a count in it, a quadrant without one has no node. Both trees are walked together from the
roots. Where both quadrants are empty nothing below is visited: every pair of their rows differs by the gap of the two smoothed
zeros in each of its columns. Other quadrants are cut into four, and single cells are compared at the bottom.

The share of a term in a group of rows is ``1 + floor(10**9 * (count + 5) / (N + 5 V))``; all arithmetic is in whole numbers of up to 38
digits. A group's row of the result compares it with each other source of its language (part ``pair``), and lists the terms
it uses more than its language does (part ``term``).

Terms are counted in two passes: documents per term first, then occurrences of the terms that may be kept, which reach the
tasks as a sieve of bounded size; the exact join that follows sorts out what else it let through.

Defined results: null text, language and source are empty strings; repeated rows count each; ties rank by the item's bytes; a language without
kept terms has pairs of value 0 and no terms; an empty table gives an empty result. Other columns are ignored. A
language's list of sources is sorted in one task, as is each source's result, which has a row per other source.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigrove.llm.wordstream import Sieve, build_sieve, seeded, slices
from lexigrove.plans.runtime import materialize, scratch_scope

LEAST_DOCS, SMOOTHING, UNIT = 30, 5, 1_000_000_000
#: Sources and terms of a block of the matrix; both powers of two.
ROWS, COLUMNS = 64, 512
#: Entries of a task's counts before they are sent on.
MOST_ENTRIES = 400_000
#: Columns that are numbered in one task, about.
CELL_TERMS = 20_000

_LETTERS = set(range(0x41, 0x5B)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: Letters A-Z to lower case, what belongs to no term to a blank.
_BYTES = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _LETTERS else 0x20 for b in range(256))


def split_terms(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


# counting

def _counts(found: dict[tuple[str, ...], Counter], names: list[str]) -> Iterator[pa.RecordBatch]:
    for key, counter in found.items():
        terms = list(counter)
        for start in range(0, len(terms), 50_000):
            part = terms[start : start + 50_000]
            fixed = [pa.array([k] * len(part), pa.string()) for k in key]
            n = pa.array([counter[t] for t in part], pa.int64())
            yield pa.RecordBatch.from_arrays([*fixed, pa.array(part, pa.binary()).cast(pa.string()), n], names)


def _documents_per_term(body: DataFrame) -> DataFrame:
    names = ["lang", "term", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, ...], Counter] = {}
        for part in slices(batches, "text"):
            for lang, text in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True):
                found.setdefault((lang,), Counter()).update(set(split_terms(text)))
            if sum(map(len, found.values())) > MOST_ENTRIES:
                yield from _counts(found, names)
                found.clear()
        yield from _counts(found, names)

    sent = body.mapInArrow(run, "lang string, term string, n long")
    return sent.repartition("lang", "term").groupBy("lang", "term").agg(F.sum("n").alias("docs"))


def _occurrences(body: DataFrame, sieve) -> DataFrame:
    """Occurrences by group of the terms that pass the sieve."""
    names = ["lang", "source", "term", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Sieve(sieve.value)
        found: dict[tuple[str, ...], Counter] = {}
        known: dict[str, dict[bytes, bool]] = {}

        class Known(dict):
            def __init__(self, lang: str):
                self.seed = seeded(lang)

            def __missing__(self, term: bytes) -> bool:
                passes = self[term] = kept.holds(xxhash.xxh64_intdigest(term, seed=self.seed))
                return passes

        for part in slices(batches, "text"):
            for lang, source, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if lang not in known:
                    known[lang] = Known(lang)
                terms = split_terms(text)
                found.setdefault((lang, source), Counter()).update(filter(known[lang].__getitem__, terms))
            if sum(map(len, found.values())) > MOST_ENTRIES:
                yield from _counts(found, names)
                found.clear()
            if sum(map(len, known.values())) > MOST_ENTRIES:
                known.clear()
        yield from _counts(found, names)

    sent = body.mapInArrow(run, "lang string, source string, term string, n long")
    return sent.repartition("lang", "source", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))


def _share(count: Column | str, total: Column | str, terms: Column | str) -> Column:
    """``1 + floor(UNIT * (count + 5) / (total + 5 terms))``, exact; null without terms."""
    return F.expr(f"1 + (cast({UNIT} as decimal(10, 0)) * cast({count} + {SMOOTHING} as decimal(19, 0))) div "
                  f"nullif(cast({total} + {SMOOTHING} * {terms} as decimal(20, 0)), 0)")


def _numbered(terms: DataFrame, count: int) -> DataFrame:
    """``(lang, term, col)``: columns from 0 in each language, frequent terms first, numbered cell by cell."""
    parts = max(1, math.ceil(count / CELL_TERMS))
    octave = F.lit(64) - F.length(F.bin("n"))
    cell = octave * parts + F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int")
    placed = materialize(terms.select("lang", "term", cell.alias("cell")))
    sizes = placed.groupBy("lang", "cell").agg(F.count("*").alias("size"))
    before = Window.partitionBy("lang").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("lang", "cell", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    number = F.row_number().over(Window.partitionBy("lang", "cell").orderBy("term"))
    return placed.withColumn("number", number).join(starts, ["lang", "cell"]).select(
        "lang", "term", (F.col("start") + F.col("number") - 1).cast("int").alias("col"))


# the tree

class Quadtree:
    """A k²-tree with k = 2 over a matrix of ``2**levels`` rows and columns: the quadrants that hold something, by level."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, levels: int):
        order = np.lexsort((cols, rows))
        self.rows, self.cols, self.values, self.levels = rows[order], cols[order], values[order], levels
        self.nodes = [np.unique(self._key(level)) for level in range(levels)]
        self.nodes.append(self._key(levels))

    def _key(self, level: int) -> np.ndarray:
        down = self.levels - level
        return (self.rows >> down) << level | self.cols >> down

    def find(self, level: int, row: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each quadrant among the nodes of the level, and whether there is one."""
        nodes = self.nodes[level]
        key = row << level | col
        if not len(nodes):
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        place = np.minimum(np.searchsorted(nodes, key), len(nodes) - 1)
        return place, nodes[place] == key


def joint_distances(
    a: Quadtree, b: Quadtree, zeros_a: np.ndarray, zeros_b: np.ndarray, width: int
) -> np.ndarray:
    """``out[i, j]``: sum over ``width`` columns of the absolute gaps between row i of ``a`` and row j of ``b``.

    ``zeros`` are the values of empty cells by row. If both are one tree, only the half with i < j is filled in.
    """
    height_a, height_b, levels = len(zeros_a), len(zeros_b), a.levels
    gaps = np.zeros((height_a, height_b), np.int64)
    empty = np.zeros((height_a, height_b), np.int64)  # columns in which both rows lie in empty quadrants
    u = v = c = np.zeros(1, np.int64)
    for level in range(levels + 1):
        side = levels - level
        at_u, in_u = a.find(level, u, c)
        at_v, in_v = b.find(level, v, c)
        if level == levels:
            value_u, value_v = zeros_a[u], zeros_b[v]
            value_u[in_u], value_v[in_v] = a.values[at_u[in_u]], b.values[at_v[in_v]]
            np.add.at(gaps, (u, v), np.abs(value_u - value_v))
            break
        nothing = ~(in_u | in_v)
        if nothing.any():
            columns = np.minimum(width, (c[nothing] + 1) << side) - (c[nothing] << side)
            tally = np.zeros((-(-height_a >> side), -(-height_b >> side)), np.int64)
            np.add.at(tally, (u[nothing], v[nothing]), columns)
            empty += tally.repeat(1 << side, 0).repeat(1 << side, 1)[:height_a, :height_b]
        u, v, c = u[~nothing], v[~nothing], c[~nothing]
        parts = []
        for du, dv, dc in np.ndindex(2, 2, 2):
            child = (u << 1 | du, v << 1 | dv, c << 1 | dc)
            inside = (child[0] << side - 1 < height_a) & (child[1] << side - 1 < height_b) & (child[2] << side - 1 < width)
            if a is b:
                inside &= child[0] < child[1] if side == 1 else child[0] <= child[1]
            parts.append([x[inside] for x in child])
        u, v, c = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(u):
            break
    out = gaps + empty * np.abs(zeros_a[:, None] - zeros_b[None, :])
    return np.triu(out, 1) if a is b else out


_BLOCK = "lang string, i int, j int, block int, width int, second boolean, row int, col int, p long"


def _compare(table: pa.Table) -> pa.Table:
    """One pair of row blocks over one block of columns; rows without a column carry the value of an empty cell."""
    first = {n: table[n][0].as_py() for n in ("lang", "i", "j", "width")}
    second, row, col, p = (table[n].to_numpy() for n in ("second", "row", "col", "p"))
    levels = max(ROWS, COLUMNS).bit_length() - 1
    sides = []
    for side, base in ((False, first["i"] * ROWS), (True, first["j"] * ROWS)):
        mine = second == side
        heads, cells = mine & (col < 0), mine & (col >= 0)
        zeros = np.zeros(int(heads.sum()), np.int64)
        zeros[row[heads] - base] = p[heads]
        sides.append((Quadtree((row[cells] - base).astype(np.int64), col[cells].astype(np.int64) % COLUMNS, p[cells], levels), zeros, base))
        if first["i"] == first["j"]:
            sides *= 2
            break
    (a, zeros_a, base_a), (b, zeros_b, base_b) = sides
    out = joint_distances(a, b, zeros_a, zeros_b, first["width"])
    x, y = np.triu_indices(len(out), 1) if a is b else (k.ravel() for k in np.indices(out.shape))
    return pa.table({
        "lang": pa.array([first["lang"]] * len(x), pa.string()), "a": pa.array(x + base_a, pa.int32()),
        "b": pa.array(y + base_b, pa.int32()), "value": pa.array(out[x, y], pa.int64()),
    })


def _pairs(groups: DataFrame, cells: DataFrame, langs: DataFrame) -> DataFrame:
    """``(lang, a, b, value)`` by source numbers, a < b; ``cells`` has ``(lang, row, col, p)``."""
    heads = groups.join(langs, "lang").select(
        "lang", "row", F.col("zero").alias("p"), "sources", "terms",
        F.explode(F.expr(f"sequence(0, greatest(1, cast(ceil(terms / {COLUMNS}) as int)) - 1)")).alias("block"))
    heads = heads.withColumn("col", F.lit(-1))
    held = cells.join(langs, "lang").withColumn("block", F.floor(F.col("col") / COLUMNS).cast("int"))
    columns = ["lang", "row", "p", "sources", "terms", "block", "col"]
    both = heads.select(columns).unionByName(held.select(columns))
    mine, other = F.floor(F.col("row") / ROWS).cast("int"), F.col("other")
    dealt = both.withColumn("other", F.explode(F.expr(f"sequence(0, cast(ceil(sources / {ROWS}) as int) - 1)")))
    dealt = dealt.select(
        "lang", F.least(mine, other).alias("i"), F.greatest(mine, other).alias("j"), "block",
        F.least(F.lit(COLUMNS), F.col("terms") - F.col("block") * COLUMNS).cast("int").alias("width"),
        (mine > other).alias("second"), "row", "col", F.coalesce("p", F.lit(0)).cast("long").alias("p"))
    parts = dealt.groupBy("lang", "i", "j", "block").applyInArrow(_compare, "lang string, a int, b int, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = 50
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``. Runs jobs when called."""
    empty = F.lit("")
    body = docs.select(*(F.coalesce(F.col(c).cast("string"), empty).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    with scratch_scope(docs.sparkSession):
        kept = materialize(_documents_per_term(body).filter(F.col("docs") >= least_docs).select(
            "lang", "term", F.xxhash64("lang", "term").alias("hash")))
        sieve = build_sieve(kept, "hash", kept.count())
        counts = materialize(_occurrences(body, sieve).join(kept.select("lang", "term"), ["lang", "term"]))
        terms = materialize(counts.groupBy("lang", "term").agg(F.sum("n").alias("n")))
        sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        names = body.select("lang", "source").distinct()
        row = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        named = names.join(sums, ["lang", "source"], "left").withColumn("row", row.cast("int"))
        sizes = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
        langs = materialize(names.groupBy("lang").agg(F.count("*").alias("sources")).join(sizes, "lang", "left").select(
            "lang", "sources", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("lang_total", F.lit(0)).alias("lang_total")))
        groups = materialize(named.join(langs.select("lang", "terms"), "lang").select(
            "lang", "source", "row", F.coalesce("total", F.lit(0)).alias("total"), _share("0", "coalesce(total, 0)", "terms").alias("zero")))
        shares = terms.join(langs, "lang").select("lang", "term", _share("n", "lang_total", "terms").alias("q"))
        shares = shares.join(_numbered(terms, terms.count()), ["lang", "term"])
        cells = materialize(counts.join(shares, ["lang", "term"]).join(groups.select("lang", "source", "row", "total"), ["lang", "source"])
                            .join(langs.select("lang", "terms"), "lang")
                            .select("lang", "source", "row", "term", "col", "q", _share("n", "total", "terms").alias("p")))
        pairs = materialize(_pairs(groups, cells.select("lang", "row", "col", "p"), langs))
        both = pairs.unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
        label = groups.select("lang", "source", "row")
        between = both.join(label.withColumnRenamed("row", "a"), ["lang", "a"]).join(
            label.select("lang", F.col("row").alias("b"), F.col("source").alias("item")), ["lang", "b"])
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        ranked = between.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
        used = cells.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        listed = used.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        return materialize(ranked.unionByName(listed), outlive=True)
