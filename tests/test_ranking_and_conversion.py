from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadlift.operators import conversion, ranking, rollup
from leadlift.sources.readers import conversion_history, existing_scores
from leadlift.sources.schemas import ROLLUP, SCORE, conform


@pytest.fixture
def scores(spark):
    """One product with three quarters of the rows, one with a single row, ties."""
    return spark.range(1200).selectExpr(
        "cast(id AS string) AS account_id",
        "'20240101' AS score_date",
        "(hash(id) % 40 + 40) / 80.0D AS score",
        "CASE WHEN id = 7 THEN 'single' WHEN id % 4 = 0 THEN 'LPR-small' ELSE 'LSV-large' END AS product_code",
    )


def test_percentiles_and_both_decile_forms(scores):
    frame = scores.toPandas().sort_values(["score", "account_id"])
    by_score = ranking.rank_scores(scores).toPandas().set_index(["product_code", "account_id"])
    by_pct = ranking.rank_scores(scores, decile_source="percentile").toPandas().set_index(["product_code", "account_id"])
    for product, part in frame.groupby("product_code"):
        if product == "single":
            assert by_score.loc[product, "percentile"].tolist() == [100]
            assert by_score.loc[product, "decile"].tolist() == [10]
            continue
        rank = pd.Series(range(1, len(part) + 1), index=part["account_id"]).astype(float)
        pct = 100 - pd.qcut(rank, 100, labels=False)
        got = by_score.loc[product, "percentile"].reindex(part["account_id"])
        assert (got - pct).abs().max() <= 1 and ((got - pct) != 0).sum() <= 2
        assert (by_score.loc[product, "decile"].reindex(rank.index) - (10 - pd.qcut(rank, 10, labels=False))).abs().sum() <= 2
        # The other form bins the percentile and inverts it again: the best get 10.
        order = pct.iloc[::-1].rank(method="first")
        again = 10 - pd.qcut(order, 10, labels=False)
        assert (by_pct.loc[product, "decile"].reindex(order.index) - again).abs().sum() <= 2
        best = part["account_id"].iloc[-1]
        assert by_score.loc[(product, best), "decile"] == 1 and by_pct.loc[(product, best), "decile"] == 10
    with pytest.raises(ValueError):
        ranking.rank_scores(scores, decile_source="other")


def test_rank_keeps_every_row_and_follows_scores(scores):
    ranked = ranking.rank_scores(scores)
    assert ranked.count() == scores.count()
    spans = ranked.groupBy("product_code", "percentile").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    wrong = spans.alias("a").join(
        spans.alias("b"), (F.col("a.product_code") == F.col("b.product_code")) & (F.col("a.percentile") < F.col("b.percentile"))
    ).filter("a.lo < b.hi")
    assert wrong.count() == 0
    assert ranked.agg(F.min("percentile"), F.max("percentile")).first()[:] == (1, 100)


def test_global_buckets_match_ntile(spark, rows):
    df = spark.range(777).selectExpr("cast(id AS string) AS a", "floor(hash(id) % 5) AS v")
    df.createOrReplaceTempView("means")
    want = spark.sql("SELECT a, ntile(100) OVER (ORDER BY v, a) AS bucket FROM means")
    assert rows(ranking.global_buckets(df, "v", "a"), "a", "bucket") == rows(want, "a", "bucket")


def test_damping(spark, rows):
    raw = spark.createDataFrame(
        [(a, 0.5, "p") for a in ("ok", "blank", "01", "nr", "na", "null", "unknown")],
        "account_id string, score double, product_code string",
    )
    accounts = spark.createDataFrame(
        [("ok", "02", "M"), ("blank", "", "M"), ("01", "01", "M"), ("nr", "02", "N/R"), ("na", "02", "N/A"), ("null", "02", None)],
        "account_id string, internal_segment string, market_segment string",
    )
    got = dict(rows(ranking.damp_scores(raw, accounts), "account_id", "score"))
    assert got == {"ok": 0.5, "null": 0.5, "blank": 0.005, "01": 0.005, "nr": 0.005, "na": 0.005}


def test_flags(spark, rows):
    df = spark.createDataFrame(
        [("1", "p", 0.9, 1), ("2", "p", 0.8, 1), ("3", "p", 0.95, 2), ("4", "q", 0.1, 3)],
        "account_id string, product_code string, score double, percentile int",
    )
    got = ranking.sweet_spot(df)
    assert rows(got, "account_id", "flag1", "flag2", "flag5") == [
        ("1", 1, None, None), ("2", 0, None, None), ("3", 1, None, None), ("4", 0, None, None),
    ]
    codes = spark.createDataFrame([("LPR1",), ("LSV",), ("XLPR",), ("lpr",)], "product_code string")
    assert rows(codes.select("product_code", ranking.logical_flag())) == [("LPR1", 1), ("LSV", 1), ("XLPR", 0), ("lpr", 0)]


def test_interest_bands(spark):
    df = spark.range(0, 102).select(F.col("id").alias("bucket"), ranking.interest_class().alias("c"))
    got = {r["bucket"]: r["c"] for r in df.collect()}
    assert got[0] is None and got[101] is None
    edges = {1: "1 Top High", 10: "1 Top High", 11: "2 High", 20: "2 High", 21: "3 Medium High",
             40: "3 Medium High", 41: "4 Medium Low", 60: "4 Medium Low", 61: "5 Low", 100: "5 Low"}
    assert {b: got[b] for b in edges} == edges


def test_last_refresh(spark, rows):
    df = spark.createDataFrame(
        [("two", "20240101"), ("two", "20240301"), ("one", "20240101")], "product_code string, score_date string"
    )
    products = spark.createDataFrame([("two",), ("one",), ("none",)], "product_code string")
    got = conversion.last_refresh(df, products, date(2024, 8, 15))
    assert rows(got) == [("none", 20240815), ("one", 20240815), ("two", 20240301)]


def test_conversions_and_exclusions(spark, rows):
    base = [(a, "20240301", 0.5, "p", None, 1, 5, 1) for a in ("new", "old", "undated", "both", "none")]
    scored = spark.createDataFrame(base + base[:1], SCORE)
    opens = conversion.new_opens(
        spark.createDataFrame(
            [(a, "p", 20240301) for a in ("new", "old", "undated", "both")] + [("none", "p", 20240229), ("new", "q", 20240401)],
            "account_id string, product_code string, first_open_ymd int",
        ),
        spark.createDataFrame([("p", 20240301)], "product_code string, refresh_ymd int"),
    )
    history = spark.createDataFrame(
        [("old", "p", "20240201"), ("undated", "p", None), ("both", "p", None), ("both", "p", "20240201"), ("new", "q", "x")],
        "account_id string, product_code string, conversion_date string",
    )
    got = conversion.new_conversions(scored, opens, history)
    assert rows(got, "account_id") == [("new",), ("undated",)]
    flags = conversion.exclude_flag(scored, opens)
    assert rows(flags, "account_id", "exclude") == [("both", 1), ("new", 1), ("none", None), ("old", 1), ("undated", 1)]


def test_existing_scores_modes(spark):
    scored = conform(spark.createDataFrame([("1", "p.2024", "20240101"), ("1", "q.2023", "20240101")],
                                           "account_id string, product_code string, score_date string"), SCORE)
    products = spark.createDataFrame([("p.2024",)], "product_code string")
    first = existing_scores(scored, products, "first")
    assert first.count() == 0 and first.schema.names == SCORE.names
    assert existing_scores(scored, products, "refresh").count() == 1
    assert conversion_history(scored, "2024").columns == ["account_id", "product_code", "conversion_date"]
    assert conversion_history(scored, "2024").count() == 1


def test_rollup_takes_the_best_score_and_last_date(spark, rows):
    joined = spark.createDataFrame(
        [("1", 0.2, "20240101", "x"), ("1", 0.9, "20231231", "x"), ("1", 0.1, "20240101", "y")],
        "account_id string, score double, score_date string, l3 string",
    )
    assert rows(rollup.rollup(joined), "product_code", "account_id", "score", "score_date") == [
        ("x", "1", 0.9, "20240101"), ("y", "1", 0.1, "20240101"),
    ]
    ranked = rollup.ranked_rollup(rollup.rollup(joined))
    assert ranked.columns == ROLLUP.fieldNames()


def test_export_rows_are_not_repeated_by_parents(spark, rows):
    ranked = conform(
        spark.createDataFrame([("1", "x", 5), ("1", "nameless", 5), ("2", "x", 50)], "account_id string, product_code string, percentile int"),
        ROLLUP,
    )
    names = spark.createDataFrame([("x", "X")], "model_id string, model_name string")
    classes = rollup.interest_classes(rollup.mean_percentile(ranked, date(2024, 8, 15)))
    out = rollup.interest_export(ranked, names, classes)
    assert rows(out) == [
        ("20240815", "1", "1 Top High", "X", "x", 5), ("20240815", "2", "1 Top High", "X", "x", 50),
    ]
    parents = spark.createDataFrame([("1", "p")], "account_id string, parent_id string")
    with_parent = rollup.interest_export(ranked, names, classes, parents)
    assert rows(with_parent, "account_id", "parent_id") == [("1", "p"), ("2", None)]
