"""Which products get a model, and which are due for scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.config import RunConfig
from leadlift.operators.activity import created_since
from leadlift.operators.joins import dimension_join
from leadlift.sources.readers import with_suffix


def buyers_by_node(
    lines: DataFrame, nodes: DataFrame, accounts: DataFrame, config: RunConfig
) -> DataFrame:
    """Distinct buying accounts per node, most first, above the threshold.

    Lines shrink to distinct (account, product) pairs before the tree join.
    """
    pairs = (
        created_since(lines, config.as_of, config.candidate_months)
        .filter(F.col("status").isin(*config.won_statuses))
        .select("account_id", "product_id")
        .distinct()
    )
    named = nodes.filter(F.trim("node_code") != "").select("product_id", "node_code", "level")
    kept = dimension_join(pairs, accounts.select("account_id"), "account_id", "left_semi")
    return (
        dimension_join(kept, named, "product_id")
        .select("node_code", "level", "account_id")
        .distinct()
        .groupBy("node_code", "level")
        .agg(F.count(F.lit(1)).alias("buyers"))
        .filter(F.col("buyers") >= config.min_accounts)
    )


def candidate_products(buyers: DataFrame, config: RunConfig) -> DataFrame:
    """Every node of the wanted levels, most buyers first.

    A code that stands on several levels is taken at the first of them, so a code names
    one model.
    """
    wanted = buyers.filter(F.col("level").isin(*config.wanted_levels) & F.col("node_code").isNotNull())
    first = wanted.groupBy("node_code").agg(F.min_by(F.struct("level", "buyers"), "level").alias("_n"))
    return first.select("node_code", "_n.level", "_n.buyers").orderBy(F.desc("buyers"), "node_code")


def stalest_products(scores: DataFrame, year: str, n: int) -> DataFrame:
    """The products whose scores are oldest, each once."""
    return (
        with_suffix(scores, year)
        .groupBy("product_code")
        .agg(F.min(F.col("score_date").cast("int")).cast("string").alias("score_date"))
        .orderBy("score_date", "product_code")
        .limit(n)
    )


def unscored_products(available: DataFrame, scores: DataFrame) -> DataFrame:
    """Products with a model but no scores yet."""
    done = scores.select("product_code").distinct()
    return available.select("product_code").distinct().join(done, "product_code", "left_anti")
