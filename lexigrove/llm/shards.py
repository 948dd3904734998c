"""Shards of near equal bytes by a k-d tree over metadata.

Rows with one text form a group that stays together. The tree splits a node along its widest dimension at the weighted
median of bytes (or the share that fits the number of leaves on either side) until each leaf is one shard. Medians are found by
distributed histograms: each round counts bytes per node and interval of the key, combined before the shuffle, and the
driver keeps one interval per node, so a few rounds end at a single key. Keys are 20 bits of the dimension followed by
bits of the group's hash, so equal values can be split. A group of at least a whole shard's bytes gets its own shard first.

Only the split table, one row per node, passes through the driver; groups and rows never do.

Defined results: a null text has no bytes and is grouped with the empty text; size counts one more than the bytes.
Repeated rows are rows of their own in one group. Null dimensions count as the smallest value. An empty table gives
an empty result; with fewer groups than shards some shards stay empty. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from lexigrove.plans.runtime import broadcast_if_small, materialize

VALUE_BITS, HASH_BITS, ROUND_BITS = 20, 24, 11
#: Rows that are numbered in one task.
CELL_ROWS = 50_000


def _category(column: str) -> Column:
    """A place on a line for a name."""
    return F.shiftrightunsigned(F.xxhash64(F.col(column)), 33)


def default_dimensions(columns: list[str]) -> dict[str, Column]:
    """Language and source by name, length and id by value, as far as there are such columns."""
    found = {c: _category(c) for c in ("lang", "source") if c in columns}
    found |= {c: F.col(c).cast("double") for c in ("n_chars",) if c in columns}
    return found


def _groups(rows: DataFrame, names: list[str]) -> DataFrame:
    """One row per text: bytes, and each dimension scaled to whole numbers of ``VALUE_BITS`` bits."""
    groups = materialize(rows.groupBy("text_hash", "text_crc32", "size").agg(
        F.sum("size").alias("bytes"), *(F.min(n).alias(n) for n in names)))
    ends = groups.agg(*(f(n).alias(f"{n}_{k}") for n in names for k, f in (("low", F.min), ("high", F.max)))).first()
    scaled = []
    for n in names:
        low, high = ends[f"{n}_low"], ends[f"{n}_high"]
        wide = low is not None and high > low
        value = (F.coalesce(F.col(n), F.lit(low)) - low) / (high - low) * (2**VALUE_BITS - 1) if wide else F.lit(0)
        scaled.append(F.floor(value).cast("long"))
    tie = F.xxhash64("text_hash", "text_crc32").bitwiseAND(F.lit(2**HASH_BITS - 1))
    keys = F.array(*(F.shiftleft(v, HASH_BITS) + tie for v in scaled))
    return groups.select("text_hash", "text_crc32", "size", "bytes", keys.alias("keys"))


def _narrowed(groups: DataFrame, bounds: dict[int, dict], width_bits: int) -> None:
    """One round: of each node's interval only the part that holds the wanted share of bytes is left."""
    spark = groups.sparkSession
    table = spark.createDataFrame([(n, b["dim"], b["low"], b["high"], b["below"], b["wanted"]) for n, b in bounds.items()],
                                  "node long, dim int, low long, high long, below double, wanted double")
    inside = groups.join(F.broadcast(table), "node").select("node", "low", "high", "below", "wanted", "bytes", F.get("keys", F.col("dim")).alias("key"))
    inside = inside.filter(F.col("key").between(F.col("low"), F.col("high")))
    part = F.shiftright(F.col("key") - F.col("low"), width_bits)
    sums = inside.groupBy("node", "below", "wanted", part.alias("part")).agg(F.sum("bytes").alias("bytes"))
    upto = F.sum("bytes").over(Window.partitionBy("node").orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    reached = sums.withColumn("upto", F.col("below") + upto)
    enough = reached.filter(F.col("upto") >= F.col("wanted")).groupBy("node").agg(F.min(F.struct("part", "upto", "bytes")).alias("m"))
    for row in enough.collect():
        b, m = bounds[row["node"]], row["m"]
        b["low"] += m["part"] << width_bits
        b["high"] = min(b["high"], b["low"] + (1 << width_bits) - 1)
        b["below"] = float(m["upto"] - m["bytes"])
        b["upto"] = float(m["upto"])


def _leaves(groups: DataFrame, n: int, quota: int) -> DataFrame:
    """``groups``, each with ``n`` keys, and a column ``shard`` from 0: the leaves from left to right."""
    current = groups.withColumn("node", F.lit(0).cast("long"))
    quotas = {0: (0, quota)}  # node: first shard, number of shards
    while any(q > 1 for _, q in quotas.values()):
        ranges = [f(F.get("keys", F.lit(k))).alias(f"{name}{k}") for k in range(n) for name, f in (("low", F.min), ("high", F.max))]
        bounds = {}
        for row in current.groupBy("node").agg(F.sum("bytes").alias("bytes"), *ranges).collect():
            first, q = quotas[row["node"]]
            if q > 1:
                spread = [(row[f"high{k}"] >> HASH_BITS) - (row[f"low{k}"] >> HASH_BITS) for k in range(n)]
                dim = max(range(n), key=lambda k: (spread[k], -k))
                bounds[row["node"]] = {"dim": dim, "low": 0, "high": (1 << VALUE_BITS + HASH_BITS) - 1, "below": 0.0,
                                       "upto": 0.0, "wanted": row["bytes"] * (q // 2) / q}
        bits = VALUE_BITS + HASH_BITS
        while bits:
            step = min(ROUND_BITS, bits)
            bits -= step
            _narrowed(current, bounds, bits)
        # the last key goes to the side that then is nearer to the wanted share
        cuts = {k: b["high"] if abs(b["upto"] - b["wanted"]) <= abs(b["wanted"] - b["below"]) else b["low"] - 1 for k, b in bounds.items()}
        after = {}
        for node, (first, q) in quotas.items():
            if node in cuts:
                after[2 * node] = (first, q // 2)
                after[2 * node + 1] = (first + q // 2, q - q // 2)
            else:
                after[2 * node] = (first, 1)  # one shard already, or no groups left for more
        spark = groups.sparkSession
        table = spark.createDataFrame([(k, bounds[k]["dim"], c) for k, c in cuts.items()], "node long, dim int, cut long")
        moved = current.join(F.broadcast(table), "node", "left")
        right = F.coalesce((F.get("keys", F.col("dim")) > F.col("cut")).cast("long"), F.lit(0))
        current = materialize(moved.select(*(c for c in current.columns if c != "node"), (F.col("node") * 2 + right).alias("node")))
        quotas = after
    places = groups.sparkSession.createDataFrame([(k, first) for k, (first, _) in quotas.items()], "node long, shard int")
    return current.join(F.broadcast(places), "node").drop("node")


def kd_shards(
    docs: DataFrame, *, n_shards: int | None = None, target_bytes: int | None = None,
    dimensions: dict[str, Column] | None = None, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row; slots count from 0 in each shard.

    Give the number of shards or the bytes a shard may have. Runs jobs when called.
    """
    dims = dimensions or default_dimensions(docs.columns)
    names = [f"d{k}" for k in range(len(dims) + 1)]
    body = F.coalesce(F.col(text), F.lit(""))
    rows = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("text_hash"), F.crc32(body).alias("text_crc32"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        *(c.cast("double").alias(n) for n, c in zip(names, [*dims.values(), F.octet_length(body)], strict=True)),
    ))
    totals = rows.agg(F.sum("size"), F.count("*")).first()
    total, count = totals[0] or 0, totals[1]
    quota = n_shards or max(1, math.ceil(total / target_bytes))
    groups = _groups(rows, names)
    # groups that fill a shard each; their number is less than the number of shards
    giants: list[tuple[int, int, int]] = []
    rest, left = total, quota
    for g in groups.filter(F.col("bytes") >= total / quota).orderBy(F.desc("bytes"), "text_hash", "text_crc32").limit(quota).collect():
        if left > 1 and g["bytes"] >= rest / left:
            giants.append((g["text_hash"], g["text_crc32"], left - 1))
            rest, left = rest - g["bytes"], left - 1
    large = docs.sparkSession.createDataFrame(giants, "text_hash long, text_crc32 long, shard int")
    small = groups.join(F.broadcast(large), ["text_hash", "text_crc32"], "left_anti")
    placed = _leaves(small, len(names), left).select("text_hash", "text_crc32", "shard").unionByName(large)
    placed = materialize(placed)
    cells = max(1, math.ceil(count / CELL_ROWS))
    cell = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(cells)).cast("int")
    dealt = materialize(rows.join(placed, ["text_hash", "text_crc32"]).select("doc_id", "size", "text_crc32", "text_hash", "shard", cell.alias("cell")))
    sizes = dealt.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = broadcast_if_small(sizes.select("shard", "cell", before.alias("start")))
    number = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "text_hash"))
    numbered = dealt.withColumn("number", number)
    return numbered.join(starts, ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("number") - 1).cast("long").alias("slot"))
