"""Sparse feature vectors per (account, period), and feature pruning."""

from __future__ import annotations

import numpy as np
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlift.operators.features import PREFIX
from leadlift.operators.forest import sparse
from leadlift.operators.prepare import strong_pairs_of_models
from leadlift.sources.scratch import materialise


def feature_names(nodes: DataFrame, level: str) -> list[str]:
    """Behaviour feature names in order; as many as three per node of the level."""
    codes = (
        nodes.filter((F.col("level") == level) & (F.trim("node_code") != ""))
        .select("node_code")
        .distinct()
    )
    found = sorted(r[0] for r in codes.collect())
    return [p + c for p in PREFIX.values() for c in found]


def vector_table(
    base: DataFrame, rows: DataFrame, names: list[str], categories: dict[str, list[str]]
) -> DataFrame:
    """Keys of ``base`` with ``features``: behaviour first, then one-hot codes.

    ``base`` has account_id, period and the code columns. Index and value arrays
    are built by the engine and read back as a vector column; no Python runs per row.
    A key has at most one entry per feature, so its list is bounded by the names. An account's
    periods go through the join together: entries that come by account are not shuffled again.
    """
    spark = base.sparkSession
    index = spark.createDataFrame(
        list(zip(names, range(len(names)))), "feature string, idx int"
    )
    # The names come from the driver. Spark knows no size of such a table and would shuffle the rows for it.
    entries = rows.join(F.broadcast(index), "feature")
    behaviour = entries.groupBy("account_id", "period").agg(
        F.sort_array(
            F.collect_list(F.struct("idx", F.col("value").cast("double").alias("value")))
        ).alias("_b")
    )
    behaviour = behaviour.groupBy("account_id").agg(F.collect_list(F.struct("period", "_b")).alias("_periods"))
    joined = base.join(behaviour, "account_id", "left")
    joined = joined.withColumn("_b", F.get(F.filter("_periods", lambda e: e["period"] == F.col("period")), F.lit(0))["_b"])

    offset, codes = len(names), F.array().cast("array<int>")
    for column, values in categories.items():
        place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
        hit = F.array((place - 1 + offset).cast("int"))
        codes = F.concat(codes, F.when(place > 0, hit).otherwise(F.array().cast("array<int>")))
        offset += len(values)

    behaviour_idx = F.coalesce(F.col("_b.idx"), F.array().cast("array<int>"))
    behaviour_val = F.coalesce(F.col("_b.value"), F.array().cast("array<double>"))
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"),
        F.lit(offset).alias("size"),
        F.concat(behaviour_idx, F.col("_codes")).alias("indices"),
        F.concat(behaviour_val, F.transform("_codes", lambda _: F.lit(1.0))).alias("values"),
    )
    keys = ["account_id", "period"]
    built = joined.withColumn("_codes", codes).select(*keys, vector.alias("features"))
    schema = T.StructType([*built.select(*keys).schema.fields, T.StructField("features", VectorUDT())])
    return materialise(built, "vectors", schema)


def all_names(names: list[str], categories: dict[str, list[str]]) -> list[str]:
    return names + [f"{c}_{v}" for c, values in categories.items() for v in values]


def correlated(matrix: np.ndarray, threshold: float, mode: str) -> list[int]:
    """Indices to drop. Pairs with an undefined correlation count as uncorrelated.

    ``drop_both`` drops every member of a pair above the threshold; ``keep_first``
    only those that have such a partner before them.
    """
    strong = np.nan_to_num(np.abs(matrix), nan=0.0) > threshold
    np.fill_diagonal(strong, False)
    if mode == "drop_both":
        return np.flatnonzero(strong.any(axis=1)).tolist()
    if mode == "keep_first":
        return np.flatnonzero(np.tril(strong, -1).any(axis=1)).tolist()
    raise ValueError(f"unknown mode {mode!r}")


def strong_pairs(vectors: DataFrame, column: str, threshold: float) -> DataFrame:
    """(i, j), i < j: features whose correlation is beyond the threshold in size.

    One table of vectors is one model's rows; no p x p matrix is made.
    """
    indices, values = sparse(column)
    rows = vectors.select(F.lit("").alias("model"), indices, values)
    return strong_pairs_of_models(rows, threshold).select(F.col("i").cast("long"), F.col("j").cast("long"))


def correlated_features(
    vectors: DataFrame, column: str = "features", threshold: float = 0.60, mode: str = "keep_first"
) -> list[int]:
    """Indices to drop, as ``correlated`` says of the whole matrix, without the matrix."""
    return dropped(strong_pairs(vectors, column, threshold), mode)


def dropped(pairs: DataFrame, mode: str) -> list[int]:
    """Of strong pairs, the indices that the mode drops."""
    if mode == "drop_both":
        members = pairs.select(F.explode(F.array("i", "j")).alias("f"))
    elif mode == "keep_first":
        members = pairs.select(F.col("j").alias("f"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return sorted(r[0] for r in members.distinct().collect())
