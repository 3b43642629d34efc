"""Table scans under the declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlift.operators.joins import dimension_join
from leadlift.sources import versions


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table under ``schema``; Spark prunes the rest. Of a versioned table the
    rows published last.

    The types of folder columns are the schema's too: a code of digits stays text.
    """
    latest = versions.read(spark, path, schema)
    found = spark.read.schema(schema).parquet(path) if latest is None else latest
    return found.select(*schema.fieldNames())


def read_recursive(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Every parquet file below ``path``, whatever its folder."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def product_tree(
    table: DataFrame, key: str = "product_id", version: Column | None = None
) -> DataFrame:
    """A flat tree with leading zeros off its key; ``version`` picks the hierarchy."""
    picked = table if version is None else table.filter(version)
    return picked.withColumn(key, F.ltrim(F.col(key), F.lit("0")))


def existing_scores(scores: DataFrame, products: DataFrame, mode: str) -> DataFrame:
    """Earlier scores of the wanted products; a first run sees none of them."""
    if mode == "first":
        return scores.filter(F.lit(False))
    return dimension_join(scores, products.select("product_code"), "product_code", "left_semi")


def with_suffix(df: DataFrame, year: str, column: str = "product_code") -> DataFrame:
    """Rows whose product belongs to the hierarchy year."""
    return df.filter(F.col(column).endswith(f".{year}"))


def conversion_history(conversions: DataFrame, year: str) -> DataFrame:
    return with_suffix(conversions, year).select(
        "account_id", "product_code", F.col("score_date").alias("conversion_date")
    )
