from dataclasses import replace
from datetime import date

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from leadlift.config import RunConfig
from leadlift.operators import dataset
from leadlift.operators.vectors import all_names, correlated, correlated_features, vector_table

CFG = RunConfig(as_of=date(2024, 8, 15))
REFERENCE = replace(CFG, spine="reference")
PRODUCTS = [("x", "LEVEL6"), ("y", "LEVEL6")]


@pytest.fixture
def accounts(spark):
    status = ["E0004", "E0001", None, "E0008"]
    target = ["C", "P", "T", "", None]
    return spark.createDataFrame(
        [(str(i), status[i % 4], target[i % 5]) for i in range(600)],
        "account_id string, activity_status string, target_class string",
    )


@pytest.fixture
def labels(spark):
    data = [(str(i), "LEVEL6", "xy"[i % 2], i % 8 + 1) for i in range(0, 600, 11)]
    data += [("3", "LEVEL6", "x", 1), ("3", "LEVEL6", "x", 2), ("900", "LEVEL6", "x", 1), ("3", "LEVEL5", "x", 4)]
    return spark.createDataFrame(data, "account_id string, level string, node_code string, period int").withColumn(
        "label", F.lit(1)
    )


def test_spine_forms(accounts, labels):
    full = dataset.labelled_spine(accounts, labels, PRODUCTS, CFG)
    assert full.count() == 600 * 8 * 2
    bought = labels.filter("level = 'LEVEL6' AND account_id <> '900'").distinct().count()
    assert full.filter("label = 1").count() == bought
    ref = dataset.labelled_spine(accounts, labels, PRODUCTS, REFERENCE)
    assert ref.filter("label = 1").count() == bought
    # Accounts that never bought the product have one row without a period.
    never = ref.filter("label = 0")
    assert never.filter(f"period <> {dataset.NO_PERIOD}").count() == 0
    buyers = labels.filter("level = 'LEVEL6' AND node_code = 'x'").select("account_id").distinct().count() - 1
    assert never.filter("product_key = 'LEVEL6|x'").count() == 600 - buyers


@pytest.mark.parametrize("config", [CFG, REFERENCE])
def test_one_pass_rows_equal_sampling_each_spine(accounts, labels, rows, config):
    spine = dataset.labelled_spine(accounts, labels, PRODUCTS, config)
    want = dataset.stratified_sample(spine, ["account_id", "period", "product_key"], config.seed)
    want = want.withColumn("product_code", F.substring_index("product_key", "|", -1))
    got = dataset.training_rows(accounts, labels, PRODUCTS, config)
    columns = ("product_code", "account_id", "period", "label")
    assert rows(got, *columns) == rows(want, *columns)
    assert {r["level"] for r in got.select("level").distinct().collect()} == {"LEVEL6"}


def test_sampling_rates_and_null_strata(spark):
    df = spark.range(40000).selectExpr(
        "cast(id AS string) AS account_id",
        "element_at(array('E0006', 'E0001', NULL), cast(id % 3 + 1 AS int)) AS activity_status",
        "element_at(array('O', 'P', 'T', NULL), cast(id % 4 + 1 AS int)) AS target_class",
        "if(id % 1000 = 0, 1, 0) AS label",
    )
    kept = dataset.stratified_sample(df, ["account_id"], 3)
    share = {
        (r["activity_status"], r["target_class"]): r["n"] / 3333
        for r in kept.filter("label = 0").groupBy("activity_status", "target_class").agg(F.count("*").alias("n")).collect()
    }
    want = {("E0006", "O"): 0.15, ("E0006", "P"): 0.05, ("E0006", "T"): 0.25,
            ("E0001", "O"): 0.075, ("E0001", "P"): 0.025, ("E0001", "T"): 0.125}
    assert share.keys() == want.keys()
    assert all(abs(share[k] - want[k]) < 0.02 for k in want)
    assert kept.filter("label = 1").count() == 40


def test_split_is_stable(spark):
    df = spark.range(10000).withColumn("k", F.col("id").cast("string"))
    split = dataset.hash_split(df, ["k"], 0.7, 1)
    assert abs(split.filter("is_train").count() / 10000 - 0.7) < 0.02
    drawn = dataset.stratified_sample(
        df.selectExpr("*", "'E0004' AS activity_status", "'C' AS target_class", "0 AS label"), ["k"], 1
    )
    # Sampling by the same keys and seed does not decide the split.
    assert abs(dataset.hash_split(drawn, ["k"], 0.7, 1).filter("is_train").count() / drawn.count() - 0.7) < 0.05
    again = dataset.hash_split(df.repartition(5).filter("id < 100"), ["k"], 0.7, 1)
    assert again.join(split, ["id", "is_train"]).count() == 100


def test_one_hot_and_category_guard(spark, rows):
    df = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", None)], "account_id string, c string")
    values = dataset.category_values(df, "c")
    assert values == ["A", "B"]
    assert rows(dataset.one_hot(df, "c", values), "account_id", "c_A", "c_B") == [("1", 1, 0), ("2", 0, 1), ("3", 0, 0)]
    many = spark.range(1500).selectExpr("cast(id AS string) AS c")
    assert len(dataset.category_values(many, "c")) == 1500


def test_vector_table(spark):
    base = spark.createDataFrame(
        [("1", 1, "A", "S"), ("2", 1, "B", None), ("3", 1, None, "S")],
        "account_id string, period int, master_code string, internal_segment string",
    )
    entries = spark.createDataFrame(
        [("1", "open_year_b", 1, 4), ("1", "open_quarter_a", 1, 2), ("1", "unknown", 1, 9), ("3", "open_year_b", 2, 7)],
        "account_id string, feature string, period int, value long",
    )
    names = ["open_quarter_a", "open_year_b"]
    categories = {"master_code": ["A", "B"], "internal_segment": ["S"]}
    table = vector_table(base, entries, names, categories)
    got = {r["account_id"]: list(r["v"]) for r in table.select("account_id", vector_to_array("features").alias("v")).collect()}
    assert got == {"1": [2, 4, 1, 0, 1], "2": [0, 0, 0, 1, 0], "3": [0, 0, 0, 0, 1]}
    assert all_names(names, categories)[2:] == ["master_code_A", "master_code_B", "internal_segment_S"]


def test_correlated_modes():
    matrix = np.array([[1, 0.9, 0.1, np.nan], [0.9, 1, 0.2, np.nan], [0.1, 0.2, 1, -0.7], [np.nan, np.nan, -0.7, np.nan]])
    assert correlated(matrix, 0.6, "drop_both") == [0, 1, 2, 3]
    assert correlated(matrix, 0.6, "keep_first") == [1, 3]
    assert correlated(matrix, 0.8, "keep_first") == [1]
    with pytest.raises(ValueError):
        correlated(matrix, 0.6, "other")


def test_constant_features_are_not_correlated(spark):
    from pyspark.ml.functions import array_to_vector

    df = spark.range(50).select(
        array_to_vector(F.array(*[c.cast("double") for c in (F.col("id"), F.lit(1), F.col("id") * 2, F.col("id") % 7)])).alias("features")
    )
    assert correlated_features(df) == [2]
    assert correlated_features(df, mode="drop_both") == [0, 2]


@pytest.mark.parametrize("mode", ["keep_first", "drop_both"])
def test_strong_pairs_equal_the_whole_matrix(spark, mode):
    """Sparse counts, copies, sums, complements that never meet, and columns of zeros."""
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.stat import Correlation

    draw = np.random.default_rng(5)
    x = draw.poisson(0.4, size=(150, 14)).astype(float)
    x[:, 3] = x[:, 1]
    x[:, 5] = x[:, 2] + x[:, 4]
    x[:, 6] = draw.random(150) < 0.6
    x[:, 7] = 1 - x[:, 6]
    x[:, 8] = 0
    x[:, 9] = -x[:, 0] * (draw.random(150) < 0.8)
    df = spark.createDataFrame([(Vectors.sparse(14, [(j, v) for j, v in enumerate(r) if v]),) for r in x], ["features"])
    matrix = Correlation.corr(df, "features").first()[0].toArray()
    for threshold in (0.25, 0.6, 0.9):
        assert correlated_features(df, "features", threshold, mode) == correlated(matrix, threshold, mode)


def test_thirty_thousand_features_need_no_matrix(spark):
    from pyspark.ml.linalg import Vectors

    draw = np.random.default_rng(6)
    rows = []
    for _ in range(300):
        at = sorted({int(i) for i in draw.integers(0, 14_000, 12)})
        rows.append((Vectors.sparse(30_000, [(i, 1.0) for i in at] + [(i + 15_000, 3.0) for i in at]),))
    got = correlated_features(spark.createDataFrame(rows, ["features"]), "features", 0.6)
    seen = {int(i) for r in rows for i in r[0].indices}
    assert {i for i in seen if i >= 15_000} <= set(got) <= seen


def test_fit_rows_are_bounded_and_keep_the_rare_class(spark):
    from leadlift.operators.training import fit_sample

    rows = spark.range(20000).selectExpr(
        "cast(id AS string) AS account_id", "1 AS period", "'p' AS product_code", "if(id % 50 = 0, 1, 0) AS label"
    )
    config = replace(CFG, fit_rows=2000)
    got = {r["label"]: r["count"] for r in fit_sample(rows, {0: 19600, 1: 400}, config).groupBy("label").count().collect()}
    assert 1700 < sum(got.values()) < 2300 and got[1] > 250
    again = fit_sample(rows.repartition(7), {0: 19600, 1: 400}, config)
    assert again.groupBy("label").count().orderBy("label").collect() == fit_sample(rows, {0: 19600, 1: 400}, config).groupBy("label").count().orderBy("label").collect()


def test_entries_are_not_shuffled_to_find_their_index(spark, monkeypatch):
    from leadlift.operators import vectors

    plans, written = [], vectors.materialise

    def seen(df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, *more)

    monkeypatch.setattr(vectors, "materialise", seen)
    base = spark.createDataFrame([("a", 1, "x")], "account_id string, period int, code string")
    entries = spark.createDataFrame([("a", "f1", 1, 2), ("a", "f0", 1, 3)], "account_id string, feature string, period int, value long")
    table = vector_table(base, entries, ["f0", "f1"], {"code": ["x"]})
    assert "hashpartitioning(feature" not in plans[0]
    assert table.first()["features"].toArray().tolist() == [3.0, 2.0, 1.0]


def test_entries_that_come_by_account_are_shuffled_once(spark, monkeypatch):
    from leadlift.operators import vectors

    plans, real = [], vectors.materialise

    def seen(df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *more)

    monkeypatch.setattr(vectors, "materialise", seen)
    base = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "x"), ("a", 2, "x"), ("b", 1, None), (None, 1, "x")], "account_id string, period int, code string"
    )
    entries = spark.createDataFrame(
        [("a", "f1", 1, 2), ("a", "f0", 1, 3), ("a", "f1", 2, 5), ("b", "f0", 2, 9), (None, "f0", 1, 8)],
        "account_id string, feature string, period int, value long",
    )
    table = vector_table(base, entries.repartition("account_id"), ["f0", "f1"], {"code": ["x"]})
    assert plans[0].count("Exchange hashpartitioning(account_id") == 2  # entries and base
    assert not [line for line in plans[0].splitlines() if "Exchange hashpartitioning" in line and "period" in line]
    got = sorted((r["account_id"] or "", r["period"], r["features"].toArray().tolist()) for r in table.collect())
    assert got == [("", 1, [0, 0, 1]), ("a", 1, [3, 2, 1]), ("a", 2, [0, 5, 1]), ("a", 2, [0, 5, 1]), ("b", 1, [0, 0, 0])]


def test_rows_with_vectors_are_not_broadcast(spark, accounts, labels, rows):
    base = accounts.select("account_id", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("period"))
    vectors = base.select("*", (F.col("account_id").cast("int") * 10 + F.col("period")).alias("features"))
    got = dataset.training_rows(accounts, labels, PRODUCTS, CFG, vectors)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin [account_id") >= 2  # negatives and buyers
    want = dataset.training_rows(accounts, labels, PRODUCTS, CFG).withColumn(
        "features", F.col("account_id").cast("int") * 10 + F.col("period")
    )
    assert rows(got) == rows(want)


def test_hashes_below_a_limit_are_the_draws_below_its_share(spark):
    from leadlift.functions.hashing import hash_below, hash_limit, hash_uniform

    keys = spark.range(3000).select(F.col("id").cast("string").alias("account_id"), F.when(F.col("id") % 7 > 0, F.col("id") % 8).alias("period"))
    drawn = keys.withColumn("u", hash_uniform("account_id", "period", F.lit("p|q"), seed=3))
    shares = [None, 0.0, -1.0, 1e-12, 0.15, 0.5, 1 - 2.0**-33, 1.0, 1.5] + [r["u"] for r in drawn.orderBy("u").limit(3).collect()]
    asked = drawn.crossJoin(spark.createDataFrame([(s,) for s in shares], "share double")).withColumn("limit", hash_limit(F.col("share")))
    head = F.concat_ws("|", "account_id", F.col("period").cast("string"))
    got = F.coalesce(hash_below(F.col("limit"), head, F.lit("p|q"), seed=3), F.lit(False))
    assert asked.filter(got != F.coalesce(F.col("u") < F.col("share"), F.lit(False))).isEmpty()
    assert asked.filter(got).count() > 3000


def test_what_is_asked_of_a_vector_is_computed_before_rows_unfold(spark):
    """Rows carry what stands next to a vector's keys; a spine row that no product can keep meets no vector."""
    accounts = spark.createDataFrame(
        [("a", "E0004", "C"), ("b", None, "C"), ("c", "E0004", "T")], "account_id string, activity_status string, target_class string"
    )
    labels = spark.createDataFrame([("b", "LEVEL6", "p1", 1, 1)], "account_id string, level string, node_code string, period int, label int")
    summary = spark.range(3).select(F.element_at(F.array(*[F.lit(c) for c in "abc"]), (F.col("id") + 1).cast("int")).alias("account_id"), F.explode(F.sequence(F.lit(1), F.lit(CFG.periods))).alias("period"))
    summary = summary.withColumn("total", F.sqrt(F.col("period").cast("double")))
    products = [(f"p{i}", "LEVEL6") for i in range(60)]
    got = dataset.training_rows(accounts, labels, products, CFG, summary)
    assert got.columns == ["level", "product_code", "account_id", "period", "label", "total"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("SQRT")
    assert "conv(" not in plan
    plain = dataset.training_rows(accounts, labels, products, CFG).withColumn("total", F.sqrt(F.col("period").cast("double")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.select(got.columns).collect()))
    assert {r["account_id"] for r in got.filter("label = 1").collect()} == {"b"}
