"""Eligible accounts and their planning parents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift import config

ATTRIBUTES = (
    "master_code",
    "industry_code",
    "crm_segment",
    "internal_segment",
    "owner_flag",
    "target_class",
    "partner_kind",
    "activity_status",
)


def eligibility() -> Column:
    """NULL in any tested column fails the account, as in SQL."""
    return (
        ~F.col("partner_kind").isin(*config.EXCLUDED_PARTNER_KINDS)
        & (F.col("account_id") != "")
        & ~F.col("internal_segment").isin(*config.EXCLUDED_SEGMENTS)
        & (F.col("not_released") != "X")
        & (F.col("deleted") != "X")
        & (F.col("blocked") != "X")
    )


def eligible_accounts(
    master: DataFrame,
    roles: DataFrame,
    dim: DataFrame | None = None,
    with_parent: bool = False,
) -> DataFrame:
    """Distinct eligible accounts that hold some role other than the excluded one.

    ``dim`` adds the market segment. Roles are reduced to one row per account
    before the join, so an account with very many roles costs nothing.
    """
    columns = ["account_id", *ATTRIBUTES, *(["parent_id"] if with_parent else [])]
    holders = roles.filter(F.col("role") != config.EXCLUDED_ROLE).select("account_id").distinct()
    kept = master.filter(eligibility()).select(*columns)
    kept = kept.join(holders, "account_id", "left_semi").distinct()
    if dim is None:
        return kept
    segments = dim.select("account_id", "market_segment").distinct()
    return kept.join(segments, "account_id", "left")


def account_parents(dim: DataFrame, trimmed: bool = False) -> DataFrame:
    """Distinct (account_id, parent_id), the parent falling back to the account.

    ``trimmed`` also strips both, the form used with the alternate tree.
    """
    account, parent = F.col("account_id"), F.col("parent_id")
    strip = F.trim if trimmed else (lambda c: c)
    return dim.select(
        "account_id",
        F.when(parent == "", strip(account)).otherwise(strip(parent)).alias("parent_id"),
    ).distinct()


def one_parent(parents: DataFrame) -> DataFrame:
    """At most one parent per account, so that joining it cannot repeat rows."""
    return parents.groupBy("account_id").agg(F.min("parent_id").alias("parent_id"))
