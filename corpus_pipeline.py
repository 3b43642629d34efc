"""The corpus pipeline: five stages, each on all rows that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet and reads it again as the next stage's documents. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlift.llm import benchmark, language, lines, near, packing
from leadlift.llm.common import query, scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text is kept if its language holds at least this share of its n-grams.
LEAST_SCORE = 0.4
#: A line of so many words is a repeat by itself; shorter ones only in runs.
LEAST_LINE = 6


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language is not found.

    The filters learn from all labelled documents.
    """
    docs = docs.select(*COLUMNS)
    fitted = language.fit(docs, F.lit(True))
    got = language.predict(docs, fitted, COLUMNS)
    return got.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later repeats of runs of lines and of long lines; a document that loses all its lines goes."""
    left = lines.dedup_lines(docs, keep=[c for c in COLUMNS if c not in ("doc_id", "text")], alone=LEAST_LINE)
    whole = (F.col("n_removed") == 0) | (F.trim("text") != "")
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    changed = left.withColumn("n_chars", F.when(F.col("n_removed") > 0, n_chars).otherwise(F.col("n_chars")))
    return changed.filter(whole).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies, five words a shingle."""
    return near.drop_near_copies(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of the benchmark."""
    return benchmark.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences."""
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack_windows),
]
#: Tokens and n-gram filters are beyond SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


@query(ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
