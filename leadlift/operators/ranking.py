"""Percentiles, deciles, flags and interest classes of scored accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift import config
from leadlift.functions.bins import ntile_bin, quantile_bin
from leadlift.operators.joins import dimension_join
from leadlift.operators.positions import positions


def rank_scores(
    scores: DataFrame,
    by: str = "product_code",
    score: str = "score",
    account: str = "account_id",
    decile_source: str = "score",
) -> DataFrame:
    """Add ``percentile`` 1 (best) to 100 and ``decile`` per product, all at once.

    ``decile_source="score"`` numbers deciles like percentiles, best = 1. With
    ``"percentile"`` the percentile is what gets binned and inverted, best = 10;
    rows of one percentile keep their score order.
    """
    placed = positions(scores.drop("percentile", "decile"), [by], [score, account])
    pos, size = F.col("position"), F.col("group_size")
    if decile_source == "score":
        decile = 11 - quantile_bin(pos, size, 10)
    elif decile_source == "percentile":
        decile = 11 - quantile_bin(size + 1 - pos, size, 10)
    else:
        raise ValueError(f"unknown decile source {decile_source!r}")
    return (
        placed.withColumn("percentile", (101 - quantile_bin(pos, size, 100)).cast("int"))
        .withColumn("decile", decile.cast("int"))
        .drop("position", "group_size")
    )


def global_buckets(
    df: DataFrame, value: str, key: str, bins: int = 100, name: str = "bucket"
) -> DataFrame:
    """``ntile(bins)`` over the whole table, ordered by value then key."""
    placed = positions(df, [], [value, key])
    return placed.withColumn(
        name, ntile_bin(F.col("position"), F.col("group_size"), bins)
    ).drop("position", "group_size")


def damp_scores(scores: DataFrame, accounts: DataFrame) -> DataFrame:
    """Divide scores of accounts without a usable segment; keeps known accounts only."""
    segments = accounts.select("account_id", "internal_segment", "market_segment").distinct()
    weak = F.col("internal_segment").isin(*config.DAMPED_INTERNAL_SEGMENTS) | F.col(
        "market_segment"
    ).isin(*config.DAMPED_MARKET_SEGMENTS)
    return (
        dimension_join(scores, segments, "account_id")
        .withColumn(
            "score",
            F.when(weak, F.col("score") / config.DAMPING_DIVISOR).otherwise(F.col("score")),
        )
        .drop("internal_segment", "market_segment")
    )


def logical_flag(product: str = "product_code") -> Column:
    return F.col(product).rlike("^(" + "|".join(config.LOGICAL_PREFIXES) + ")").cast("int")


def sweet_spot(ranked: DataFrame) -> DataFrame:
    """Flag scores strictly above the lowest score of percentile 1 in their product."""
    floor = (
        ranked.filter(F.col("percentile") == 1)
        .groupBy("product_code")
        .agg(F.min("score").alias("_floor"))
    )
    flagged = dimension_join(ranked, floor, "product_code", "left").withColumn(
        "flag1", F.when(F.col("score") > F.col("_floor"), 1).otherwise(0)
    )
    for i in range(2, 6):
        flagged = flagged.withColumn(f"flag{i}", F.lit(None).cast("int"))
    return flagged.drop("_floor")


def interest_class(bucket: str = "bucket") -> Column:
    out = None
    lower = 0
    for upper, label in config.INTEREST_BANDS:
        band = (F.col(bucket) > lower) & (F.col(bucket) <= upper)
        out = F.when(band, label) if out is None else out.when(band, label)
        lower = upper
    return out
