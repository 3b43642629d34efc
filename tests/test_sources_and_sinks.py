import pytest
from pyspark.sql import functions as F

from leadlift.sources import jdbc, readers, scratch, sinks, versions
from leadlift.sources.schemas import SCORE, conform

SOURCE = jdbc.JdbcSource("jdbc:x://host/db", "org.example.Driver", "me", "hidden")


def test_jdbc_options_callers_win():
    got = jdbc.jdbc_options(SOURCE, "SELECT 1", {"fetchsize": 5, "user": "you"})
    assert got["dbtable"] == "(SELECT 1) q" and got["fetchsize"] == "5" and got["user"] == "you"
    by_query = jdbc.jdbc_options(SOURCE, None, {"query": "SELECT 2"})
    assert "dbtable" not in by_query and by_query["query"] == "SELECT 2"
    assert "hidden" not in repr(SOURCE)


def test_jdbc_slices():
    got = jdbc.jdbc_options(SOURCE, "SELECT * FROM scores", jdbc.percentile_slices())
    assert (got["partitionColumn"], got["lowerBound"], got["upperBound"]) == ("percentile", "0", "100")
    assert got["numPartitions"] == "100" and got["fetchsize"] == "10000"
    assert sinks.jdbc_overwrite_options()["truncate"] == "true"


def test_conform_casts_adds_and_drops(spark):
    df = spark.createDataFrame([("1", "0.5", "7", 1)], "account_id string, score string, percentile string, extra int")
    out = conform(df, SCORE)
    assert out.schema == SCORE
    row = out.first()
    assert (row["score"], row["percentile"], row["exclude"]) == (0.5, 7, None)


def test_conform_fails_on_values_that_do_not_cast(spark):
    df = spark.createDataFrame([("1", "x")], "account_id string, percentile string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, SCORE).collect()


@pytest.fixture
def scores(spark):
    """Two thirds of the rows belong to one product."""
    df = spark.range(900).selectExpr(
        "cast(id AS string) AS account_id", "'20240101' AS score_date", "id / 900.0D AS score",
        "CASE WHEN id % 3 < 2 THEN 'hot/1' ELSE concat('p', id % 7) END AS product_code",
    )
    return scratch.materialise(conform(df, SCORE), "scores")


def test_replacing_products_leaves_others_alone(spark, scores, rows):
    path = scratch.scratch_path(spark, "t")
    sinks.replace_partitions(scores, path)
    assert rows(readers.read_table(spark, path, SCORE)) == rows(scores)
    newer = scores.filter("product_code = 'p2'").limit(3).withColumn("score", F.lit(9.0))
    sinks.replace_partitions(newer, path)
    got = readers.read_table(spark, path, SCORE)
    assert got.filter("product_code = 'p2'").count() == 3
    rest = "product_code <> 'p2'"
    assert rows(got.filter(rest)) == rows(scores.filter(rest))


def test_codes_of_digits_stay_text(spark, scores, rows):
    path = scratch.scratch_path(spark, "digits")
    coded = scores.withColumn("product_code", F.expr("CASE WHEN percentile IS NULL AND account_id < '5' THEN '00123' ELSE '2024-01-01' END"))
    sinks.replace_partitions(coded, path)
    assert rows(readers.read_table(spark, path, SCORE)) == rows(coded)


def test_a_replaced_product_without_rows_is_emptied(spark, scores, rows):
    path = scratch.scratch_path(spark, "emptied")
    sinks.replace_partitions(scores, path)
    newer = scores.filter("product_code = 'p2'")
    sinks.replace_partitions(newer, path, values=["p2", "hot/1", "never there"])
    got = readers.read_table(spark, path, SCORE)
    assert rows(got) == rows(scores.filter("product_code <> 'hot/1'"))


def test_a_replacement_that_dies_before_it_is_published_changes_nothing(spark, scores, rows, monkeypatch):
    path = scratch.scratch_path(spark, "died")
    sinks.replace_partitions(scores, path)
    newer = scores.withColumn("score", F.lit(9.0))

    def dies(*args):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        patch.setattr(versions, "publish", dies)
        sinks.replace_partitions(newer, path)
    assert rows(readers.read_table(spark, path, SCORE)) == rows(scores)
    sinks.replace_partitions(newer, path)
    assert rows(readers.read_table(spark, path, SCORE)) == rows(newer)


def test_a_reader_keeps_its_version_and_old_ones_are_removed(spark, scores, rows):
    path = scratch.scratch_path(spark, "versions")
    for score in (1.0, 2.0, 3.0):
        sinks.replace_partitions(scores.filter("product_code = 'p2'").withColumn("score", F.lit(score)), path)
        if score == 2.0:
            reader = readers.read_table(spark, path, SCORE)
    versions.drop_old_versions(spark, path)
    assert {r["score"] for r in reader.collect()} == {2.0}
    assert {r["score"] for r in readers.read_table(spark, path, SCORE).collect()} == {3.0}
    assert len([n for n in versions.Files(spark, path).names() if n.startswith("version=")]) == 2
    sinks.replace_partitions(scores.filter("false"), path, values=["p2"])
    assert readers.read_table(spark, path, SCORE).isEmpty()


def test_of_two_writers_the_second_fails(spark, scores, rows):
    path = scratch.scratch_path(spark, "two")
    sinks.replace_partitions(scores, path)
    files = versions.Files(spark, path)
    number, content = versions.manifest(files)
    versions.publish(files, number + 1, content)
    with pytest.raises(RuntimeError, match="another writer"):
        versions.publish(files, number + 1, {})
    assert rows(readers.read_table(spark, path, SCORE)) == rows(scores)


def test_a_run_leaves_no_scratch_behind(spark):
    with pytest.raises(ValueError), scratch.run_scratch(spark):
        path = scratch.scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
        folder = path.rsplit("/", 1)[0]
        assert spark.read.parquet(path).count() == 3
        raise ValueError
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    assert not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    assert "/run-" not in scratch.scratch_path(spark, "y")


def test_writes_split_a_hot_product_and_keep_small_ones_together(spark, scores):
    spread = sinks.spread(scores, ["product_code"]).withColumn("task", F.spark_partition_id())
    tasks = spread.groupBy("product_code").agg(F.countDistinct("task").alias("n"))
    tasks = {r["product_code"]: r["n"] for r in tasks.collect()}
    assert tasks["hot/1"] > 1 and all(n == 1 for p, n in tasks.items() if p != "hot/1")


def test_append_overwrite_dated_and_recursive(spark, scores, rows):
    path = scratch.scratch_path(spark, "a")
    sinks.append(scores, path)
    sinks.append(scores, path)
    assert spark.read.parquet(path).count() == 1800
    sinks.overwrite(scores.limit(5), path, single_file=True)
    assert spark.read.parquet(path).count() == 5 and len(spark.read.parquet(path).inputFiles()) == 1

    dated = scratch.scratch_path(spark, "d")
    one = scores.withColumn("run_date", F.lit("20240815"))
    sinks.dated_copy(one, dated)
    sinks.dated_copy(one, dated)
    sinks.dated_copy(one.withColumn("run_date", F.lit("20240816")), dated)
    assert spark.read.schema(one.schema).parquet(dated).groupBy("run_date").count().filter("count = 900").count() == 2
    assert readers.read_recursive(spark, dated).count() == 1800


def test_scratch_needs_a_shared_folder(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://cluster:7077"

    with pytest.raises(RuntimeError):
        scratch.scratch_root(Session())
    Session.sparkContext.master = "local[2]"
    with pytest.raises(RuntimeError):
        scratch.scratch_root(Session())
    assert scratch.scratch_root(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_tasks_stay_small_however_many_the_session_has(spark, tmp_path):
    from catalogue import inputs as src

    spark.range(src.LINES_PER_TASK + 1).write.parquet(f"{tmp_path}/lineitem.parquet")
    names = ["spark.sql.shuffle.partitions", *src.TASK_BYTES]
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in src.TASK_BYTES:
            spark.conf.unset(n)
        spark.conf.set(names[0], "200")
        src.deal_by_size(spark, str(tmp_path))
        assert [spark.conf.get(n) for n in names] == ["200", "8MB", "8MB"]
        spark.conf.set(names[1], "3MB")  # the session's own
        src.deal_by_size(spark, str(tmp_path))
        assert spark.conf.get(names[1]) == "3MB"
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
