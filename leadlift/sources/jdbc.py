"""JDBC query scans, whole or in parallel slices."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSource:
    """Where a relation lives. All values come from the caller."""

    url: str
    driver: str
    user: str
    password: str

    def __repr__(self) -> str:
        return f"JdbcSource(url={self.url!r}, driver={self.driver!r})"


def jdbc_options(
    source: JdbcSource, query: str | None = None, custom: dict[str, Any] | None = None
) -> dict[str, str]:
    """Reader options for ``query``; the caller's own options win.

    Spark takes a relation either by ``query`` or by ``dbtable``, and only the
    latter can be read in slices, so a ``dbtable`` from the caller replaces the query.
    """
    options: dict[str, Any] = {
        "url": source.url,
        "driver": source.driver,
        "user": source.user,
        "password": source.password,
    }
    if query is not None:
        options["dbtable"] = f"({query}) q"
    options.update(custom or {})
    if "query" in options and not (custom and "dbtable" in custom):
        options.pop("dbtable", None)
    return {k: str(v) for k, v in options.items()}


def sliced(
    column: str, lower: int, upper: int, slices: int = 100, fetch_size: int = 10_000
) -> dict[str, int | str]:
    """Options that split a scan on a numeric column into parallel queries."""
    return {
        "partitionColumn": column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": slices,
        "fetchsize": fetch_size,
    }


def percentile_slices() -> dict[str, int | str]:
    """A score table in 100 slices of its percentile."""
    return sliced("percentile", 0, 100)


def read_jdbc(
    spark: SparkSession,
    source: JdbcSource,
    query: str | None = None,
    custom: dict[str, Any] | None = None,
) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(source, query, custom)).load()
