"""Session settings, size checks and lineage cuts shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

BROADCAST_BYTES = 32 * 1024 * 1024
#: Text of one task where its table of distinct values takes many times the text.
TASK_BYTES = 16 * 1024 * 1024


def local_session(app: str = "lexigrove", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster use the one given."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A local folder is set only where the session names none and runs in local mode.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="lexigrove-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str, *, outlive: bool = False) -> str:
    """A fresh path for a written table in the shared checkpoint folder; ``outlive`` leaves it to the scope around this one."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    scopes = _scopes[:-1] if outlive else _scopes
    if scopes:
        scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what operators stored inside; results that are still to be read must be written before.

    Operators store steps when they are called, and outside of a scope these tables stay.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each job inside when it ends, instead of when the driver happens to collect garbage.

    For steps that store their tables: a stored table is read again, never its shuffles.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def materialize(df: DataFrame, *, outlive: bool = False) -> DataFrame:
    """Compute once into a table of the shared folder, from which later plans read their columns only.

    The table outlives lost executors, and its size is known to the planner. With ``outlive`` it also outlives the
    scratch scope it is computed in, as a result of steps that end there must.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stored", outlive=outlive)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage with the partitions kept as they are."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes in memory."""
    sizes = [F.lit(16)]
    for field in df.schema.fields:
        kind, column = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(column), F.lit(0)) + 16)
        elif isinstance(kind, T.ArrayType):
            width = 8 if isinstance(kind.elementType, T.NumericType) else 32
            sizes.append(F.coalesce(F.size(column), F.lit(0)) * width + 32)
        else:
            sizes.append(F.lit(8))
    return reduce(Column.__add__, [s.cast("long") for s in sizes])


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = BROADCAST_BYTES, *, stored: bool = False) -> DataFrame:
    """Materialise a narrow table and mark it for broadcast only if it has few rows and bytes; ``stored`` says that it is stored already.

    Beyond the bounds the join is left to Spark (sort-merge with adaptive skew handling).
    """
    table = df if stored else materialize(df)
    rows, size = table.agg(F.count("*"), F.sum(_row_bytes(table))).first()
    return F.broadcast(table) if rows <= max_rows and (size or 0) <= max_bytes else table


def spread(df: DataFrame, task_bytes: int | None = None) -> DataFrame:
    """Spread an input of fewer files than cores over all cores; other inputs keep their own splits.

    With ``task_bytes`` the rows are counted in bytes first, and dealt so that a task gets about as many, where there are fewer files than
    such tasks: for steps whose tables grow with a task's input. Only speed and memory depend on it: what depends on the layout
    (K-means) takes a fixed one of its own.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    if task_bytes:
        size = df.agg(F.sum(_row_bytes(df))).first()[0] or 0
        tasks = max(tasks, -(-size // task_bytes))
    return df.repartition(tasks) if len(df.inputFiles()) < tasks else df
