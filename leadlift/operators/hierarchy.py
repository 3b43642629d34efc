"""The product tree in wide and long form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.config import LEVELS
from leadlift.operators.joins import dimension_join
from leadlift.sources.schemas import LEVEL_COLUMNS


def tree_nodes(
    tree: DataFrame, levels: tuple[str, ...] = LEVELS, key: str = "product_id"
) -> DataFrame:
    """One row per leaf and wanted level: key, node_code, node_text, level.

    Levels are picked before the unnest, so a one-level caller pays for one row
    per leaf. A level the tree does not have gives no rows.
    """
    nodes = [
        F.struct(
            F.col(c).alias("node_code"),
            F.col(f"{c}_text").alias("node_text"),
            F.lit(name).alias("level"),
        )
        for c, name in zip(LEVEL_COLUMNS, LEVELS)
        if name in levels
    ]
    kind = "array<struct<node_code:string,node_text:string,level:string>>"
    return tree.select(F.col(key).alias("product_id"), F.inline(F.array(*nodes).cast(kind)))


def full_paths(tree: DataFrame) -> DataFrame:
    """Distinct paths with a code at every level."""
    complete = reduce(lambda a, b: a & b, [F.col(c) != "" for c in LEVEL_COLUMNS])
    return tree.filter(complete).select(*LEVEL_COLUMNS).distinct()


def combine_levels(
    paths: DataFrame, leaves: tuple[str, ...] = ("l5", "l6"), name: str = "l5_or_l6"
) -> DataFrame:
    """Fold several leaf levels into one column, one row per path and leaf."""
    upper = [c for c in LEVEL_COLUMNS if c not in leaves]
    return paths.select(*upper, F.explode(F.array(*leaves)).alias(name))


def level_map(
    paths: DataFrame, leaves: tuple[str, ...] = ("l5", "l6"), parent: str = "l3"
) -> DataFrame:
    """Distinct (product_code, parent) pairs; a code may have several parents."""
    return combine_levels(paths, leaves, "product_code").select("product_code", parent).distinct()


def level_names(tree: DataFrame, level: str = "l3") -> DataFrame:
    """Distinct non-blank codes of one level with their texts."""
    return (
        tree.filter(F.col(level) != "")
        .select(F.col(level).alias("model_id"), F.col(f"{level}_text").alias("model_name"))
        .distinct()
    )


def branch_nodes(tree: DataFrame, products: DataFrame, level: str) -> DataFrame:
    """(product_code, node_code) for every ``level`` node on a path through a product."""
    column = dict(zip(LEVELS, LEVEL_COLUMNS))[level]
    paths = tree.select(*LEVEL_COLUMNS).distinct()
    on_path = paths.select(
        F.col(column).alias("node_code"),
        F.explode(F.array_distinct(F.array(*LEVEL_COLUMNS))).alias("product_code"),
    ).filter(F.trim("node_code") != "")
    wanted = products.select("product_code")
    return dimension_join(on_path, wanted, "product_code", "left_semi").distinct()
