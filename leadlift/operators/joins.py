"""Joins of a large table with one that is usually, but not provably, small."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def task_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, on: list[str], tasks: int, share: float) -> DataFrame:
    """Hash and salt count of the keys that hold more than ``share`` of the rows.

    At most 1/share rows. A key gets as many salts as it is fair shares of ``tasks``
    tasks, and at least two. Found in one pass with a heavy-hitter sketch and no
    shuffle of rows; salting is right for whatever keys this returns, so the
    sketch's error only costs balance.
    """
    most = max(1, int(1 / share))
    row = (
        df.select(F.xxhash64(*on).alias("_h"))
        .selectExpr(
            f"approx_top_k(_h, {most}, {min(max(10 * most, 1000), 1_000_000)}) AS top", "count(1) AS n"
        )
        .first()
    )
    found = [
        (e["item"], max(2, math.ceil(e["count"] / row["n"] * tasks)))
        for e in row["top"]
        if e["count"] > row["n"] * share
    ]
    return df.sparkSession.createDataFrame(found, "_h long, _salts int")


def _with_salts(df: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """Add ``_salts``: the salt count of the row's key, 1 for most."""
    marked = df.withColumn("_h", F.xxhash64(*on)).join(F.broadcast(hot), "_h", "left")
    return marked.withColumn("_salts", F.coalesce("_salts", F.lit(1))).drop("_h")


def with_salt(df: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """Add ``_salt`` below the key's salt count, fixed by the row's values."""
    salt = F.pmod(F.xxhash64(*df.columns), F.col("_salts")).cast("int")
    return _with_salts(df, on, hot).withColumn("_salt", salt).drop("_salts")


def salted_join(
    facts: DataFrame,
    other: DataFrame,
    on: list[str],
    how: str = "inner",
    share: float | None = None,
) -> DataFrame:
    """Shuffle join in which the facts of hot keys are spread over many tasks.

    Hot is more than two tasks' share of the rows. Only rows of hot keys are
    repeated on the other side.
    """
    tasks = task_count(facts)
    hot = hot_keys(facts, on, tasks, share or min(1.0, 2.0 / tasks))
    left = with_salt(facts, on, hot)
    right = _with_salts(other, on, hot)
    right = right.withColumn("_salt", F.explode(F.expr("sequence(0, _salts - 1)"))).drop("_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def dimension_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str | list[str],
    how: str = "inner",
) -> DataFrame:
    """Join that leaves the choice to Spark, which knows the sizes once it has shuffled.

    Adaptive execution broadcasts a small side and splits the rows of a hot key; no job
    starts before the query's own. ``how`` is one of inner, left, left_semi and left_anti.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return facts.join(dim, keys, how)
