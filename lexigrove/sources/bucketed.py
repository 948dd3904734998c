"""Tables cut into buckets by document, whose joins move no rows.

Every table of a layout has the same number of buckets, a document lies in the same bucket of each, and each bucket is one
sorted file. A join on the document id then reads bucket with bucket where they lie. Rows are shuffled once, when written.

Null ids lie in one bucket and join nothing. Repeated ids stay repeated rows. An empty table has its schema and joins as empty.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from lexigrove.plans.runtime import scratch_path

BUCKETS = 64


class Buckets:
    """Tables by document in one folder. ``number`` of buckets is chosen for the largest table and then kept."""

    def __init__(self, spark: SparkSession, path: str | None = None, *, number: int = BUCKETS, key: str = "doc_id"):
        self.spark, self.number, self.key = spark, number, key
        self.path = path or scratch_path(spark, "buckets")
        self.prefix = f"buckets_{uuid.uuid4().hex[:12]}"
        self.names: list[str] = []

    def _table(self, name: str) -> str:
        return f"{self.prefix}_{name}"

    def write(self, name: str, rows: DataFrame) -> DataFrame:
        """Store a table, replacing one of that name, and give it back as read from its buckets."""
        placed = rows.repartition(self.number, self.key).sortWithinPartitions(self.key)
        placed.write.format("parquet").bucketBy(self.number, self.key).sortBy(self.key).mode("overwrite").option(
            "path", f"{self.path}/{name}").saveAsTable(self._table(name))
        if name not in self.names:
            self.names.append(name)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self._table(name))

    def join(self, first: str, *others: str, how: str = "left") -> DataFrame:
        """``first`` joined with the others on the document; the merge hint keeps each side in its buckets."""
        return reduce(lambda left, name: left.join(self.read(name).hint("merge"), self.key, how), others, self.read(first))

    def forget(self) -> None:
        """Take the names out of the catalog; the files stay where they are."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
        self.names = []
