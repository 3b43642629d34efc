"""What the text operators share: reading tables, row keys, word splitting, registry."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The key that stands in for a NULL doc_id.
NO_ID = -(2**63)


def query(sql: str | None = None):
    """Register a query, with its SQL where SQL can express it, under its function name."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/leadlift-llm-{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's tables of this kind, once nothing reads them any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: lineage ends here."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """Two never-NULL longs that tell apart rows with different id or text.

    Rows alike in both share the key, and by it the result.
    """
    return (
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("d"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"),
    )


def words(text: str | None) -> list[bytes]:
    """Words between the bytes 0x20 and 0x09-0x0D, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def remainder(doc_id: int | None, of: int) -> Column | int:
    """crc32 of the id as text, modulo ``of``; a NULL id counts as the empty text."""
    import zlib

    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % of


def remainder_column(doc_id: str, of: int) -> Column:
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % F.lit(of)


def slices(batches: Iterator, size: int) -> Iterator:
    """Arrow batches cut into parts of about ``size`` bytes, one row at least."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, int(rows * size / max(1, batch.nbytes)))
        for at in range(0, rows, step):
            yield batch.slice(at, min(step, rows - at))


def tokenizer_folder() -> str:
    import public_tokenizers

    return os.path.dirname(public_tokenizers.path("word_bpe_49k.json"))


KINDS = {"long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType(),
         "binary": T.BinaryType(), "int": T.IntegerType(), "longs": T.ArrayType(T.LongType())}


def fields(**kinds: str) -> T.StructType:
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in kinds.items()])
