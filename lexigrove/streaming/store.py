"""A keyed table that a stream upserts into: the last write of a document stays, reads fold no log.

The table is cut by a hash of the key into a fixed number of buckets. A batch reads and rewrites only the buckets it touches. A
bucket's new version is written beside the old one and named by the batch; then one small manifest of the batch says which version of
each bucket counts, and is put in place by a rename. So a reader sees a batch whole or not at all, a batch that failed half way leaves
files that no manifest names, and a batch that is sent again finds its manifest and changes nothing. Versions that the
last two manifests don't name are deleted.

Rows of one key are ordered by ``order_by``; where that ties, the write that came with the later batch stays. All rows of a key
combine before the shuffle, so a key that is sent over and over stays cheap.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

BUCKETS = 64


class KeyedStore:
    """The table under ``path`` with one row per ``key``."""

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType | str, *, key: str = "doc_id", order_by: Sequence[str] = (), buckets: int = BUCKETS
    ):
        self.spark, self.path, self.key, self.order_by, self.buckets = spark, path.rstrip("/"), key, list(order_by), buckets
        self.schema = spark.createDataFrame([], schema).schema
        jvm = spark.sparkContext._jvm
        self._place = jvm.org.apache.hadoop.fs.Path
        self._files = self._place(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # manifests: one short JSON file per batch, a row per bucket

    def _manifests(self) -> list[int]:
        folder = self._place(f"{self.path}/manifests")
        if not self._files.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _manifest(self, batch: int) -> dict:
        text = self.spark.read.option("wholetext", True).text(f"{self.path}/manifests/{batch}.json").first()
        return json.loads(text[0])

    def current(self) -> dict:
        """``{"batch": last batch, "buckets": {bucket: version folder}}``; batch -1 before the first."""
        known = self._manifests()
        return self._manifest(known[-1]) if known else {"batch": -1, "buckets": {}}

    def _publish(self, batch: int, buckets: dict) -> None:
        folder = f"{self.path}/manifests"
        self._files.mkdirs(self._place(folder))
        draft, final = self._place(f"{folder}/{batch}.draft"), self._place(f"{folder}/{batch}.json")
        out = self._files.create(draft, True)
        try:
            out.write(bytearray(json.dumps({"batch": batch, "buckets": buckets}).encode()))
        finally:
            out.close()
        if not self._files.rename(draft, final):
            raise RuntimeError(f"batch {batch} is published already")

    # reading

    def bucket_of(self, key) -> F.Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _rows(self, versions: dict) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{v}" for _, v in sorted(versions.items())))

    def read(self) -> DataFrame:
        """All current rows: one scan of the versions that count."""
        return self._rows(self.current()["buckets"])

    def get(self, value) -> DataFrame:
        """The row of one key; only its bucket is read."""
        kind = self.schema[self.key].dataType
        bucket = self.spark.range(1).select(self.bucket_of(F.lit(value).cast(kind))).first()[0]
        versions = self.current()["buckets"]
        held = {b: v for b, v in versions.items() if int(b) == bucket}
        return self._rows(held).filter(F.col(self.key) == F.lit(value).cast(kind))

    # writing

    def upsert(self, rows: DataFrame, batch: int) -> int:
        """Put the last row of each key in place of the stored one; returns the number of buckets rewritten.

        ``batch`` numbers grow. A batch up to the last published one changes nothing.
        """
        now = self.current()
        if batch <= now["batch"]:
            return 0
        names = self.schema.fieldNames()
        fresh = rows.select(*(F.col(n).cast(self.schema[n].dataType).alias(n) for n in names), F.lit(1).alias("_new"),
                            self.bucket_of(self.key).alias("_bucket")).persist()
        try:
            touched = [r[0] for r in fresh.select("_bucket").distinct().collect()]  # at most one row per bucket
            if touched:
                held = self._rows({b: v for b, v in now["buckets"].items() if int(b) in touched})
                both = fresh.unionByName(held.select(*names, F.lit(0).alias("_new"), self.bucket_of(self.key).alias("_bucket")))
                order = F.struct(*(F.col(c) for c in self.order_by), F.col("_new"))
                last = both.groupBy("_bucket", self.key).agg(F.max_by(F.struct(*names), order).alias("_row"))
                folder = f"batch={batch}"
                last.select("_row.*", "_bucket").repartition("_bucket").write.partitionBy("_bucket").mode("overwrite").parquet(f"{self.path}/{folder}")
                now["buckets"].update({str(b): f"{folder}/_bucket={b}" for b in touched})
            self._publish(batch, now["buckets"])
        finally:
            fresh.unpersist()
        self._clean()
        return len(touched)

    def _clean(self) -> None:
        """Delete versions that neither of the last two manifests names; a reader of the last but one goes on."""
        known = self._manifests()
        named = {v for b in known[-2:] for v in self._manifest(b)["buckets"].values()}
        for batch in known[:-2]:
            for version in self._manifest(batch)["buckets"].values():
                if version not in named:
                    self._files.delete(self._place(f"{self.path}/{version}"), True)
            self._files.delete(self._place(f"{self.path}/manifests/{batch}.json"), False)


def start_upserts(
    rows: DataFrame, store: KeyedStore, state_path: str, *, on_batch: Callable[[int, int], None] | None = None
) -> StreamingQuery:
    """Upsert a stream into the store, all that waits now and then stop; ``on_batch`` gets the batch number and the buckets rewritten.

    A batch that Spark sends again after a failure has its old number, which the store knows.
    """

    def write(batch: DataFrame, number: int) -> None:
        rewritten = store.upsert(batch, number)
        if on_batch:
            on_batch(number, rewritten)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", state_path).trigger(availableNow=True).start()
