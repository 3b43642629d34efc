"""Labels and behaviour features read off the node profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.config import RunConfig
from leadlift.operators.activity import windows

# Prefix of a feature's name; the node code follows.
PREFIX = {
    "open_quarter": "open_quarter_",
    "open_year": "open_year_",
    "first_open": "first_open_",
}


def _periods(profile: DataFrame, family: str) -> list[int]:
    head = f"{family}_"
    return sorted(int(c[len(head) :]) for c in profile.columns if c.startswith(head))


def labels_by_period(profile: DataFrame) -> DataFrame:
    """Who bought which node in which period: count of won lines and label 1."""
    slots = ", ".join(f"struct({p} AS period, label_{p} AS count)" for p in _periods(profile, "label"))
    return (
        profile.selectExpr("account_id", "level", "node_code", f"inline(array({slots}))")
        .filter("count > 0")
        .withColumn("label", F.lit(1))
    )


def _feature_rows(profile: DataFrame, config: RunConfig, families: tuple[str, ...]) -> DataFrame:
    """Long form of some families by one unnest: account_id, feature, period, value.

    Counts of zero and nodes never opened before a period give no row.
    """
    slots = []
    for family in families:
        starts = {w.period: w.hi_date for w in windows(config, family)}
        for p in _periods(profile, family):
            if family == "first_open":
                value = f"CAST(datediff(DATE '{starts[p]}', first_open_{p}) AS BIGINT)"
            else:
                value = f"nullif({family}_{p}, 0L)"
            slots.append(
                f"struct(concat('{PREFIX[family]}', node_code) AS feature, {p} AS period, {value} AS value)"
            )
    return profile.selectExpr("account_id", f"inline(array({', '.join(slots)}))").filter(
        "value IS NOT NULL"
    )


def open_counts(profile: DataFrame, config: RunConfig, family: str) -> DataFrame:
    """Open lines per (account, feature, period); ``family`` open_quarter or open_year."""
    return _feature_rows(profile, config, (family,))


def first_open_days(profile: DataFrame, config: RunConfig) -> DataFrame:
    """Days from the first matching line to the start of each period."""
    return _feature_rows(profile, config, ("first_open",))


def feature_rows(profile: DataFrame, config: RunConfig) -> DataFrame:
    """All families; unioning them one by one would read the profile three times."""
    return _feature_rows(profile, config, tuple(PREFIX))


def wide(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """One column per feature name. Values are unique per key, so the sum is the value."""
    return rows.groupBy(*keys).pivot("feature", names).sum("value")


def align(df: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """Exactly the features ``names``: missing ones added, others dropped, blanks 0."""
    have = set(df.columns)
    return df.select(
        *keys,
        *[
            (F.coalesce(F.col(f"`{n}`"), F.lit(0)) if n in have else F.lit(0)).cast("double").alias(n)
            for n in names
        ],
    )
