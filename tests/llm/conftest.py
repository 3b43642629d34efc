import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside, or give to their results.
        *(T.StructField(n, T.StringType()) for n in ("d", "h", "n_words", "score", "word", "key", "spans", "sequence_id", "comp")),
    ]
)


@pytest.fixture
def documents(spark):
    """A documents table from (id, text[, lang]) with further columns of clashing names."""

    def make(rows, partitions=2):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), *["x"] * 9) for r in rows
        ]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions) if full else spark.createDataFrame([], SCHEMA)

    return make


def prose(seed: int, n: int, names=("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha")) -> str:
    """n made-up words, the same for the same seed."""
    import random

    draw = random.Random(seed)
    return " ".join("".join(draw.choice(names) for _ in range(draw.randint(1, 4))) for _ in range(n))


@pytest.fixture
def words():
    return prose


#: Rows that every operator must bear.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "x"),
    (4, "x"),
    (None, "no id here at all"),
    (5, "é ß 中文 \U0001f600 \x00 a"),
    (6, "1234567890" * 3000),
    (7, "word " * 20000),
]


@pytest.fixture
def odd():
    return list(ODD)
