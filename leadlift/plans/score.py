"""Scoring run: models and current activity in, ranked scores and conversions out."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlift.config import RunConfig
from leadlift.functions.periods import ymd
from leadlift.operators.accounts import eligible_accounts
from leadlift.operators.activity import created_since, line_profile, node_profile, recent_lines
from leadlift.operators.candidates import stalest_products
from leadlift.operators.conversion import (
    exclude_flag,
    first_open_by_node,
    last_refresh,
    new_conversions,
    new_opens,
)
from leadlift.operators.features import PREFIX, feature_rows
from leadlift.operators.hierarchy import tree_nodes
from leadlift.operators.ranking import damp_scores, logical_flag, rank_scores, sweet_spot
from leadlift.operators.refresh import account_keys, kept_scores, state_rows
from leadlift.operators.scoring import needed_names, registered_models, score_products
from leadlift.operators.vectors import all_names, vector_table
from leadlift.plans.inputs import CODE_COLUMNS, Inputs, written_lines
from leadlift.sources import versions
from leadlift.sources.readers import conversion_history, existing_scores, read_table
from leadlift.sources.schemas import (
    CONVERSION,
    CONVERSION_CONSULTING,
    MODEL_REGISTRY,
    SCORE,
    SCORE_CONSULTING,
    SCORE_STATE,
    conform,
)
from leadlift.sources.scratch import materialise, run_scratch
from leadlift.sources.sinks import append, dated_copy, replace_partitions
from leadlift.sources.versions import drop_old_versions


def scoring_lines(lines: DataFrame, config: RunConfig) -> DataFrame:
    lines = recent_lines(lines, config.as_of, config.line_months)
    if config.reference_apply:
        return lines
    return created_since(lines, config.as_of, config.history_months)


def scoring_behaviour(inputs: Inputs, config: RunConfig) -> DataFrame:
    """Behaviour entries of all known accounts as of the run's day."""
    nodes = tree_nodes(inputs.tree, (config.feature_level,))
    behaving, weight = inputs.behaviour_lines
    profile = node_profile(
        line_profile(
            scoring_lines(behaving, config),
            config,
            tuple(PREFIX),
            periods=1,
            serving=config.reference_apply,
            weight=weight,
        ),
        nodes,
        inputs.dim.select("account_id"),
    )
    return feature_rows(profile, config)


def scoring_vectors(
    accounts: DataFrame, behaviour: DataFrame, models: list
) -> tuple[DataFrame, list[str]]:
    """One vector per account, holding what the models read."""
    names, categories = needed_names(models)
    base = accounts.select(
        "account_id", *CODE_COLUMNS, F.lit(1).alias("period")
    )
    return vector_table(base, behaviour, names, categories), all_names(names, categories)


def raw_scores(
    spark: SparkSession,
    inputs: Inputs,
    accounts: DataFrame,
    models: list,
    config: RunConfig,
    state_path: str | None,
) -> DataFrame:
    """Every account with every model; with a state, only accounts that changed are scored anew."""

    def scored(of: DataFrame, behaviour: DataFrame) -> DataFrame:
        vectors, names = scoring_vectors(of, behaviour, models)
        return score_products(vectors, names, models, config.as_of, config.nodes_per_pass)

    behaviour = scoring_behaviour(inputs, config)
    if state_path is None:
        # Written before ranking: the range sort would run the models a second time.
        return materialise(scored(accounts, behaviour), "scores")
    behaviour = materialise(behaviour, "behaviour")
    keys = materialise(account_keys(accounts, behaviour, CODE_COLUMNS), "keys")
    state = versions.read(spark, state_path, SCORE_STATE)
    state = spark.createDataFrame([], SCORE_STATE) if state is None else state
    wanted = spark.createDataFrame([(m["product_code"], m["path"]) for m in models], "product_code string, path string")
    kept = materialise(kept_scores(state, wanted, len(models), keys), "kept")
    changed = materialise(accounts.join(kept.select("account_id"), "account_id", "left_anti"), "changed")
    day = F.lit(str(ymd(config.as_of))).alias("score_date")
    raw = scored(changed, behaviour).unionByName(kept.select("*", day))
    raw = materialise(raw, "scores")
    replace_partitions(
        materialise(state_rows(raw, wanted, keys), "state"), state_path, values=[m["product_code"] for m in models]
    )
    drop_old_versions(spark, state_path)
    return raw


def staged_scores(
    scores: DataFrame, accounts: DataFrame, opens: DataFrame, config: RunConfig
) -> DataFrame:
    """Damp, flag and rank raw scores, in that order."""
    if config.model_type == "generic":
        scores = damp_scores(scores, accounts)
    flagged = exclude_flag(scores, opens).withColumn("logical_product", logical_flag())
    ranked = rank_scores(flagged, decile_source=config.decile_source)
    if config.model_type == "consulting":
        return conform(sweet_spot(ranked), SCORE_CONSULTING)
    return conform(ranked, SCORE)


def _read_or_empty(spark: SparkSession, path: str, schema, exists: bool) -> DataFrame:
    return read_table(spark, path, schema) if exists else spark.createDataFrame([], schema)


def run_score(
    spark: SparkSession,
    inputs: Inputs,
    config: RunConfig,
    registry_path: str,
    scores_path: str,
    history_path: str,
    copies_path: str,
    state_path: str | None = None,
) -> None:
    """Score, record conversions, then replace the scored products.

    ``mode="first"`` scores every registered model and sees no earlier scores;
    ``"refresh"`` takes the ``refresh_products`` products whose scores are oldest.
    With ``state_path`` a run keeps raw scores there, and scores only the accounts that
    changed since; the result is the same.
    """
    if config.mode != "first" and config.refresh_products is None:
        raise ValueError("a refresh needs refresh_products")
    with run_scratch(spark):
        _score(spark, inputs, config, registry_path, scores_path, history_path, copies_path, state_path)


def _score(
    spark: SparkSession,
    inputs: Inputs,
    config: RunConfig,
    registry_path: str,
    scores_path: str,
    history_path: str,
    copies_path: str,
    state_path: str | None,
) -> None:
    consulting = config.model_type == "consulting"
    score_schema = SCORE_CONSULTING if consulting else SCORE
    first = config.mode == "first"
    previous = _read_or_empty(spark, scores_path, score_schema, not first)
    history = conversion_history(
        _read_or_empty(
            spark, history_path, CONVERSION_CONSULTING if consulting else CONVERSION, not first
        ),
        config.hierarchy_year,
    )
    available = registered_models(read_table(spark, registry_path, MODEL_REGISTRY), config.model_type)
    if not first:
        due = stalest_products(previous, config.hierarchy_year, config.refresh_products)
        available = available.join(due.select("product_code"), "product_code", "left_semi")
    models = available.orderBy("product_code").collect()  # at most one row per product
    if not models:
        return

    accounts = materialise(
        eligible_accounts(inputs.master, inputs.roles, None if consulting else inputs.dim), "accounts"
    )
    lines = scoring_lines(inputs.lines, config)
    if inputs.cells is None:  # Both behaviour and first opens read them.
        lines = written_lines(lines, (*config.open_statuses, *config.first_open), config)
    raw = raw_scores(spark, replace(inputs, lines=lines), accounts, models, config, state_path)

    products = raw.select("product_code").distinct()
    target = inputs.target_lines(lines, config)
    known = inputs.dim.select("account_id")
    # Only nodes that are scored: the others would be unfolded, shuffled, and dropped by the refresh's join.
    codes = spark.createDataFrame([(m["product_code"],) for m in models], "node_code string")
    nodes = tree_nodes(inputs.tree).join(F.broadcast(codes), "node_code", "left_semi")
    opens = first_open_by_node(target, nodes, known, config)
    seen = existing_scores(previous, products, config.mode)
    opens = materialise(new_opens(opens, last_refresh(seen, products, config.as_of)), "opens")

    # Before the replacement below, which overwrites what this reads.
    converted = materialise(new_conversions(seen, opens, history), "conversions")
    append(converted, history_path)
    run_date = F.lit(str(ymd(config.as_of))).alias("run_date")
    dated_copy(converted.select("*", run_date), f"{copies_path}/history")

    staged = materialise(staged_scores(raw, accounts, opens, config), "staged")
    # A product that was scored and has no rows left loses the ones it had.
    replace_partitions(staged, scores_path, values=[m["product_code"] for m in models])
    # What the version before names stays, for readers that began on it.
    drop_old_versions(spark, scores_path)
    dated_copy(staged.select("*", run_date), f"{copies_path}/staging")
