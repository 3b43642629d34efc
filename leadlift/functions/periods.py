"""Quarter arithmetic on an injected day, and the period windows built from it.

A period is a whole number of quarters back from the as-of day. Bounds are
computed on the driver, so every filter on them is a literal that Spark can push
into the scan.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple


class Window(NamedTuple):
    """Half-open range ``[lo, hi)`` of yyyymmdd integers for one period."""

    period: int
    lo: int
    hi: int

    @property
    def hi_date(self) -> date:
        return date(self.hi // 10000, self.hi // 100 % 100, self.hi % 100)


def _shift(day: date, months: int) -> tuple[int, int]:
    serial = day.year * 12 + day.month - 1 + months
    return serial // 12, serial % 12 + 1


def quarter_ymd(as_of: date, months: int, quarter_of: int | None = None) -> int:
    """First day of a shifted quarter as yyyymmdd.

    The year comes from the day moved by ``months``; the quarter too, unless
    ``quarter_of`` names another shift to take it from.
    """
    year, month = _shift(as_of, months)
    if quarter_of is not None:
        _, month = _shift(as_of, quarter_of)
    return year * 10000 + ((month - 1) // 3 * 3 + 1) * 100 + 1


def quarter_ts14(as_of: date, months: int) -> int:
    """Same as ``quarter_ymd`` but as a 14-digit number at midnight."""
    return quarter_ymd(as_of, months) * 1_000_000


def period_bounds(
    as_of: date, kind: str, periods: int = 8, year_window: str = "reference"
) -> list[Window]:
    """Windows for ``kind`` in label, quarter, year or first.

    ``year_window="reference"`` takes year and quarter of the lower bound from
    different dates, which gives 15 months, or 3 where the upper bound opens a
    calendar year. ``"rolling12"`` gives 12 months.
    """
    out = []
    for p in range(1, periods + 1):
        hi = quarter_ymd(as_of, -3 * p)
        if kind == "label":
            lo, hi = hi, quarter_ymd(as_of, -3 * (p - 1))
        elif kind == "quarter":
            lo = quarter_ymd(as_of, -3 * (p + 1))
        elif kind == "year" and year_window == "reference":
            lo = quarter_ymd(as_of, -3 * p - 12, -3 * (p + 1))
        elif kind == "year" and year_window == "rolling12":
            lo = quarter_ymd(as_of, -3 * p - 12)
        elif kind == "first":
            lo = 19000102  # strictly after 1900-01-01
        else:
            raise ValueError(f"unknown window {kind!r} / {year_window!r}")
        out.append(Window(p, lo, hi))
    return out


def ymd(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day
