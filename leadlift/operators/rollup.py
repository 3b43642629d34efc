"""Scores rolled up the tree, interest classes, and the export."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift import config as fixed
from leadlift.functions.hashing import hash_uniform
from leadlift.functions.periods import ymd
from leadlift.operators.joins import dimension_join
from leadlift.operators.ranking import global_buckets, interest_class, rank_scores
from leadlift.sources.readers import with_suffix
from leadlift.sources.schemas import INTEREST_EXPORT, ROLLUP


def rollup_inputs(scores: DataFrame, year: str) -> DataFrame:
    """Scores of logical products of the hierarchy year."""
    return with_suffix(scores.filter(F.col("logical_product") == 1), year)


def scores_with_parent(scores: DataFrame, level_map: DataFrame) -> DataFrame:
    """Scores with their level-3 node, once per parent of the product."""
    return dimension_join(scores, level_map, "product_code")


def small_sample(joined: DataFrame, seed: int, n: int = 1000) -> DataFrame:
    """A sample to look at: n rows in hash order, a top-n and not a full sort. No run writes it."""
    draw = hash_uniform("account_id", "product_code", "l3", seed=seed)
    return joined.orderBy(draw, "account_id", "product_code", "l3").limit(n)


def rollup(joined: DataFrame) -> DataFrame:
    """Best score and last date per (level-3 node, account).

    Dates are compared as numbers, which lets the aggregate hash instead of sort.
    """
    last = F.max(F.col("score_date").cast("int")).cast("string")
    return joined.groupBy(F.col("l3").alias("product_code"), "account_id").agg(
        F.max("score").alias("score"), last.alias("score_date")
    )


def ranked_rollup(rolled: DataFrame) -> DataFrame:
    """The roll-up table: ranks within each node over the accounts it has."""
    return (
        rank_scores(rolled, decile_source="score")
        .withColumn("scenario", F.lit(fixed.SCENARIO))
        .withColumn("exclude", F.lit(None).cast("int"))
        .withColumn("logical_product", F.lit(0))
        .select(*ROLLUP.fieldNames())
    )


def mean_percentile(ranked: DataFrame, as_of: date) -> DataFrame:
    """Whole-number mean percentile per account, with the calculation date."""
    return (
        ranked.groupBy("account_id")
        .agg(F.round(F.avg("percentile"), 0).alias("raw_score"))
        .withColumn("calc_date", F.lit(str(ymd(as_of))))
    )


def interest_classes(means: DataFrame) -> DataFrame:
    """Five classes from 100 equal buckets of all accounts."""
    return global_buckets(means, "raw_score", "account_id").select(
        "calc_date", "account_id", "raw_score", interest_class("bucket").alias("interest_class")
    )


def interest_export(
    ranked: DataFrame,
    names: DataFrame,
    classes: DataFrame,
    parents: DataFrame | None = None,
) -> DataFrame:
    """The export: one row per (account, level-3 node) with the account's class.

    ``parents`` (unique per account) adds ``parent_id``.
    """
    named = dimension_join(
        ranked.select("account_id", "percentile", F.col("product_code").alias("model_id")),
        names,
        "model_id",
    )
    out = named.join(
        classes.select("account_id", "interest_class", F.col("calc_date").alias("report_date")),
        "account_id",
    )
    columns = INTEREST_EXPORT.fieldNames()
    if parents is None:
        return out.select(*columns)
    return out.join(parents, "account_id", "left").select(*columns, "parent_id")
