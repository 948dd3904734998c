"""Bounded samples that do not depend on the layout of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def by_hash(rows: DataFrame, key: str, most: int, total: int) -> DataFrame:
    """At most ``most`` of about ``total`` rows: those with the smallest hashes of the column ``key``, one for each value.

    A threshold on the hash leaves about a quarter more than wanted before repeated values go and rows are ordered, so what
    the tasks send doesn't grow with their number. Ties of the hash follow the key.
    """
    hashed = F.pmod(F.xxhash64(key), F.lit(1 << 32))
    share = min(1.0, (1.25 * most + 100) / max(1, total))
    return rows.filter(hashed <= int(share * (1 << 32))).dropDuplicates([key]).orderBy(hashed, key).limit(most)
