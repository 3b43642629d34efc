"""Quantile bins and ntile from a row's position in its group."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quantile_bin(position: Column, size: Column, bins: int) -> Column:
    """Equal-width quantile bin 1..bins of the ``position``-th of ``size`` rows.

    Edges lie at fractions of ``size - 1``, with the upper edge inside the bin;
    whole-number arithmetic, so no rounding on an edge. A one-row group is bin 1.
    """
    span = F.nullif(size - 1, F.lit(0))
    steps = (position - 1) * bins + size - 2
    whole = F.call_function("div", steps, span)
    return F.greatest(F.coalesce(whole, F.lit(1)), F.lit(1)).cast("int")


def ntile_bin(position: Column, size: Column, bins: int) -> Column:
    """What ``ntile(bins)`` gives for a row, without a window over all rows."""
    base = F.floor(size / bins)
    extra = size - base * bins
    in_large = position <= extra * (base + 1)
    large = F.ceil(position / (base + 1))
    small = extra + F.ceil((position - extra * (base + 1)) / F.nullif(base, F.lit(0)))
    return F.when(in_large, large).otherwise(small).cast("int")
