import pytest
from pyspark.sql import functions as F

from leadlift.operators.joins import (
    dimension_join,
    hot_keys,
    salted_join,
    with_salt,
)
from leadlift.operators.positions import positions


@pytest.fixture
def facts(spark):
    """A third of the rows on one key."""
    return spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 WHEN id % 100 = 1 THEN NULL ELSE id % 50 END AS k", "id AS v"
    )


@pytest.fixture
def dim(spark):
    return spark.range(-1, 40).selectExpr("id AS k", "concat('n', id) AS name").unionAll(
        spark.createDataFrame([(-1, "again")], "k long, name string")
    )


def test_hot_keys_are_found(spark, facts):
    want = spark.sql("SELECT xxhash64(-1L) AS h").first()["h"]
    # A third of the rows, so a third of the tasks.
    assert [tuple(r) for r in hot_keys(facts, ["k"], 30, 0.2).collect()] == [(want, 10)]
    assert hot_keys(facts.filter("false"), ["k"], 30, 0.2).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_and_broadcast_joins_agree(facts, dim, rows, how):
    plain = rows(facts.join(dim, "k", how))
    assert rows(salted_join(facts, dim, ["k"], how)) == plain
    assert rows(salted_join(facts, dim, ["k"], how, share=0.01)) == plain
    assert rows(dimension_join(facts, dim, "k", how)) == plain


def test_salting_spreads_the_hot_key_only(spark, facts):
    salted = with_salt(facts, ["k"], hot_keys(facts, ["k"], 30, 0.2))
    sizes = [r["count"] for r in salted.filter("k = -1").groupBy("_salt").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 200
    assert salted.filter("(k <> -1 OR k IS NULL) AND _salt <> 0").count() == 0


def test_positions_match_a_window(spark, rows):
    df = spark.range(5000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('p', id % 17) END AS g",
        "CASE WHEN id % 5 = 0 THEN 0.5D ELSE CAST(hash(id) % 100 AS DOUBLE) END AS s",
        "cast(id AS string) AS a",
    )
    got = rows(positions(df, ["g"], ["s", "a"]), "g", "a", "position", "group_size")
    df.createOrReplaceTempView("placed")
    want = spark.sql(
        """SELECT g, a, row_number() OVER (PARTITION BY g ORDER BY s, a) AS position,
                  count(*) OVER (PARTITION BY g) AS group_size FROM placed"""
    )
    assert got == rows(want, "g", "a", "position", "group_size")


def test_positions_over_the_whole_table(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"))
    got = positions(df, [], ["x"])
    assert got.filter("position <> x + 1 OR group_size <> 1000").count() == 0
    assert got.count() == 1000


def test_a_hot_group_spreads_over_partitions(spark):
    """One group's rows are cut by the unique last key (small partitions not merged here)."""
    df = spark.range(20000).selectExpr("'one' AS g", "0.0D AS s", "id AS a")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        placed = df.repartitionByRange("g", "s", "a")
        sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 20000 * 0.4
        got = positions(df, ["g"], ["s", "a"])
        assert got.filter("position <> a + 1 OR group_size <> 20000").count() == 0
    finally:
        spark.conf.unset(merge)
