"""Row numbers per group without holding a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadlift.sources.scratch import materialise


def positions(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Add ``position`` (1-based, by ``order`` within ``group``) and ``group_size``.

    Rows are range partitioned on group and order columns together, so a group of
    any size spreads over many sorted partitions. Each partition then needs only
    one number per group it holds: the rows before it. ``order`` should end in a
    unique key, both to make positions repeatable and to let ties spread.

    The sorted rows are written once; the range bounds are sampled, and numbers
    taken from two different evaluations would not fit together.
    """
    keys = [*group, *order]
    placed = materialise(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "positions",
    ).withColumn("_part", F.shiftright("_pos", 33))

    spans = placed.groupBy(*group, "_part").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # At most one row per partition plus one per group, so these windows are small.
    whole = W.partitionBy(*(group or [F.lit(0)]))
    before = whole.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    spans = materialise(
        spans.select(
            *group,
            "_part",
            "_first",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
            F.sum("_rows").over(whole).alias("group_size"),
        ),
        "spans",
    )
    # Usually broadcast by its file size; else no key has more than a partition's rows.
    return placed.join(spans, [*group, "_part"]).select(
        *df.columns,
        (F.col("_pos") - F.col("_first") + F.col("_before") + 1).alias("position"),
        "group_size",
    )
