"""Roll-up run: product scores in, level-3 ranks and the interest export out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadlift.config import RunConfig
from leadlift.operators.accounts import account_parents, one_parent
from leadlift.operators.hierarchy import full_paths, level_map, level_names
from leadlift.operators.rollup import (
    interest_classes,
    interest_export,
    mean_percentile,
    ranked_rollup,
    rollup,
    rollup_inputs,
    scores_with_parent,
)
from leadlift.sources.readers import read_table
from leadlift.sources.schemas import ROLLUP
from leadlift.sources.scratch import run_scratch
from leadlift.sources.sinks import overwrite


def rolled_up(scores: DataFrame, tree: DataFrame, config: RunConfig) -> DataFrame:
    picked = rollup_inputs(scores, config.hierarchy_year)
    joined = scores_with_parent(picked, level_map(full_paths(tree)))
    return ranked_rollup(rollup(joined))


def exported(
    ranked: DataFrame, tree: DataFrame, dim: DataFrame | None, config: RunConfig
) -> DataFrame:
    classes = interest_classes(mean_percentile(ranked, config.as_of))
    parents = None if dim is None else one_parent(account_parents(dim))
    return interest_export(ranked, level_names(tree), classes, parents)


def run_rollup(
    spark: SparkSession,
    scores: DataFrame,
    tree: DataFrame,
    config: RunConfig,
    rollup_path: str,
    export_path: str,
    single_file: bool = False,
    dim: DataFrame | None = None,
) -> None:
    """Write the roll-up table, then the export from what was written.

    ``dim``, the account table, adds each account's parent to the export.
    """
    with run_scratch(spark):
        overwrite(rolled_up(scores, tree, config), rollup_path)
        ranked = read_table(spark, rollup_path, ROLLUP)
        overwrite(exported(ranked, tree, dim, config), export_path, single_file)
