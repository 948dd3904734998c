"""Running totals that no single task has to hold, also over one huge or a single group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lexigrove.functions.constants import MILESTONE_INTERVAL_BEYOND, MILESTONE_INTERVALS
from lexigrove.plans.runtime import checkpointed


def running_totals(
    rows: DataFrame, value: str, order_by: list[str], *, run: str | None = None, partitions: int | None = None
) -> DataFrame:
    """Add ``ordinal``, ``cumulative`` and ``running_mean`` in the given order, per ``run`` if named.

    ``order_by`` must be unique within a run. The rows are cut into ordered ranges, which are
    stored once so that a range keeps its number. A running sum inside each (run, range) plus the
    totals of the ranges before it gives the running sum of the run, and a run of any size is
    spread over many ranges.
    """
    cut = rows.repartitionByRange(*([partitions] if partitions else []), *([run] if run else []), *order_by)
    stored = checkpointed(cut).withColumn("_range", F.spark_partition_id())
    keys = ([run] if run else []) + ["_range"]
    totals = stored.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.sum(F.coalesce(value, F.lit(0.0))).alias("_sum")
    )
    # one row per run and range
    before = (
        Window.partitionBy(*([run] if run else [F.lit(0)])).orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *keys,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0.0)).alias("_sum_before"),
    )
    inside = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    local = stored.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))).withColumn(
        "_local", F.sum(F.coalesce(value, F.lit(0.0))).over(inside)
    )
    joined = local.join(offsets, keys)
    ordinal = F.col("_n_before") + F.col("_place")
    cumulative = F.col("_sum_before") + F.col("_local")
    return joined.select(
        *rows.columns, ordinal.alias("ordinal"), cumulative.alias("cumulative"), (cumulative / ordinal).alias("running_mean")
    )


def milestone_interval(total):
    """Interval between reported document counts for a corpus of the given size."""
    interval = F.lit(MILESTONE_INTERVAL_BEYOND)
    for limit, step in reversed(MILESTONE_INTERVALS):
        interval = F.when(total <= limit, F.lit(step)).otherwise(interval)
    return interval


def milestones(totals: DataFrame, *, run: str | None = None) -> DataFrame:
    """The rows of ``running_totals`` at every milestone of their run and at its last document."""
    keys = [run] if run else []
    sizes = totals.groupBy(*keys).agg(F.count("*").alias("total_documents"))
    if run:
        sized = totals.join(sizes, run)
    else:
        sized = totals.withColumn("total_documents", sizes.scalar())
    at = F.col("ordinal") % milestone_interval(F.col("total_documents")) == 0
    return sized.filter(at | (F.col("ordinal") == F.col("total_documents")))
