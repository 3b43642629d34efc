"""Opportunity lines with tree nodes, at row level and as one pre-aggregated profile."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.config import RunConfig
from leadlift.functions.periods import Window, period_bounds, quarter_ts14
from leadlift.operators.joins import dimension_join

FAMILIES = ("label", "open_quarter", "open_year", "first_open")
_KIND = {"label": "label", "open_quarter": "quarter", "open_year": "year", "first_open": "first"}


def recent_lines(lines: DataFrame, as_of: date, months: int = 40) -> DataFrame:
    return lines.filter(F.col("status_date") > F.add_months(F.lit(as_of), -months))


def created_since(lines: DataFrame, as_of: date, months: int) -> DataFrame:
    """Lines created after the start of the quarter ``months`` back."""
    return lines.filter(F.col("created_ts14") > F.lit(quarter_ts14(as_of, -months)))


def consulting_lines(lines: DataFrame, source: DataFrame, item_types: tuple[str, ...]) -> DataFrame:
    """Lines of opportunities that have some consulting item in ``source``."""
    wanted = source.filter(F.col("item_type").isin(*item_types)).select("opportunity_id").distinct()
    return dimension_join(lines, wanted, "opportunity_id", "left_semi")


def activity_lines(lines: DataFrame, nodes: DataFrame, accounts: DataFrame) -> DataFrame:
    """Every line once per tree node of its product, for known accounts.

    Further columns of ``accounts``, such as the parent, are carried along; blank
    nodes are dropped before the join multiplies rows.
    """
    named = nodes.filter(F.trim("node_code") != "")
    kept = dimension_join(
        lines, accounts, "account_id", "inner" if len(accounts.columns) > 1 else "left_semi"
    )
    return dimension_join(kept, named, "product_id")


def windows(config: RunConfig, family: str, periods: int | None = None) -> list[Window]:
    return period_bounds(
        config.as_of, _KIND[family], periods or config.periods, config.year_window
    )


def _in(column: str, values: tuple[str, ...]) -> str:
    return f"{column} IN ({', '.join(repr(str(v)) for v in values)})"


def line_profile(
    lines: DataFrame,
    config: RunConfig,
    families: tuple[str, ...] = FAMILIES,
    periods: int | None = None,
    serving: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """All periods of all families per (account, product) in one pass over the lines.

    Windows of one family may overlap, so each is its own conditional aggregate.
    The only shuffle is on (account, product) after partial aggregation; neither
    a busy account nor a popular product gathers in one task.
    ``serving`` leaves the quarter counts without a date range. A row of ``lines`` stands
    for as many lines as its column ``weight`` says, as the cells of a line store do.
    """
    statuses = {
        "label": config.won_statuses,
        "open_quarter": config.open_statuses,
        "open_year": config.open_statuses,
        "first_open": config.first_open,
    }
    unbounded = {"open_quarter"} if serving else set()
    aggs, spans = [], []
    for family in families:
        status = _in("status", statuses[family])
        for w in windows(config, family, periods):
            hit = status
            if family not in unbounded:
                hit += f" AND status_ymd >= {w.lo} AND status_ymd < {w.hi}"
                spans.append(w)
            if family == "first_open":
                measure = f"min(if({hit}, status_date, NULL))"
            else:
                measure = f"sum(if({hit}, {weight}, 0L))" if weight else f"count_if({hit})"
            aggs.append(F.expr(f"{measure} AS {family}_{w.period}"))
    # A plain range and code list around all windows, for the scan to skip rows by.
    wanted = _in("status", tuple(dict.fromkeys(c for f in families for c in statuses[f])))
    if not unbounded & set(families):
        wanted += f" AND status_ymd >= {min(w.lo for w in spans)} AND status_ymd < {max(w.hi for w in spans)}"
    return lines.filter(wanted).groupBy("account_id", "product_id").agg(*aggs)


def node_profile(profile: DataFrame, nodes: DataFrame, accounts: DataFrame) -> DataFrame:
    """The profile rolled up from products to tree nodes, for known accounts.

    One shuffle by account serves the roll-up, the join with the accounts, and what is grouped by
    account next. An account has at most a row per product and level there.
    """
    slots = [c for c in profile.columns if c not in ("account_id", "product_id")]
    named = nodes.filter(F.trim("node_code") != "").select("product_id", "level", "node_code")
    rolled = (
        dimension_join(profile, named, "product_id")
        .repartition("account_id")
        .groupBy("account_id", "level", "node_code")
        .agg(*[(F.min if s.startswith("first_open") else F.sum)(s).alias(s) for s in slots])
    )
    return dimension_join(rolled, accounts.select("account_id"), "account_id", "left_semi")
