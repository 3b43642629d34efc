"""Ranking, conversion, roll-up and sink queries over scores derived from the lines."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import inputs as src
from catalogue.inputs import AS_OF, CONFIG, VIEWS
from catalogue.registry import query
from catalogue.tree_and_accounts import history_lines, known_accounts
from leadlift.operators import candidates, conversion, ranking, rollup
from leadlift.operators.accounts import account_parents, eligible_accounts, one_parent
from leadlift.operators.activity import line_profile, node_profile, recent_lines
from leadlift.operators.features import labels_by_period
from leadlift.operators.hierarchy import full_paths, level_map, level_names, tree_nodes
from leadlift.operators.joins import dimension_join
from leadlift.plans.rollup import exported, rolled_up, run_rollup
from leadlift.plans.score import staged_scores
from leadlift.sources import readers, sinks
from leadlift.sources.schemas import HISTORY, SCORE, conform
from leadlift.sources.scratch import materialise, scratch_path

PRODUCT_LEVELS = ("LEVEL5", "LEVEL6")
YEAR = CONFIG.hierarchy_year
REFRESHED = 50  # the stalest products of a refresh

# Share of an account's lines on a node that were won; many ties.
VIEWS["node_dates"] = """
SELECT node_code AS product_code,
       CAST(coalesce(max(CASE WHEN status_ymd < 20010401 THEN status_ymd END), 20010101) AS VARCHAR) AS score_date
FROM activity WHERE level IN ('LEVEL5', 'LEVEL6') GROUP BY node_code"""
VIEWS["base_scores"] = """
SELECT a.account_id, any_value(d.score_date) AS score_date,
       CAST(sum(CASE WHEN a.status = 'F' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS score,
       a.node_code AS product_code, CAST(NULL AS INTEGER) AS exclude,
       CASE WHEN starts_with(a.node_code, 'LPR') OR starts_with(a.node_code, 'LSV') THEN 1 ELSE 0 END
         AS logical_product
FROM activity a JOIN node_dates d ON a.node_code = d.product_code
WHERE a.level IN ('LEVEL5', 'LEVEL6')
GROUP BY a.account_id, a.node_code"""


def base_scores(spark: SparkSession, sf: str) -> DataFrame:
    pairs = (
        recent_lines(src.lines(spark, sf), AS_OF, CONFIG.line_months)
        .groupBy("account_id", "product_id")
        .agg(
            F.count_if(F.col("status") == "F").alias("won"),
            F.count(F.lit(1)).alias("seen"),
            F.max(F.when(F.col("status_ymd") < 20010401, F.col("status_ymd"))).alias("last"),
        )
    )
    nodes = (
        tree_nodes(src.tree(spark, sf), PRODUCT_LEVELS)
        .filter(F.trim("node_code") != "")
        .select("product_id", F.col("node_code").alias("product_code"))
    )
    per_node = materialise(
        dimension_join(pairs, nodes, "product_id")
        .groupBy("account_id", "product_code")
        .agg(F.sum("won").alias("won"), F.sum("seen").alias("seen"), F.max("last").alias("last")),
        "node_scores",
    )
    dates = per_node.groupBy("product_code").agg(
        F.coalesce(F.max("last"), F.lit(20010101)).cast("string").alias("score_date")
    )
    scored = dimension_join(per_node, dates, "product_code").select(
        "account_id",
        "score_date",
        (F.col("won").cast("double") / F.col("seen")).alias("score"),
        "product_code",
        ranking.logical_flag().alias("logical_product"),
    )
    return conform(scored, SCORE).drop("percentile", "decile")


_BIN = "CASE WHEN n = 1 THEN 1 ELSE greatest(1, ((r - 1) * {q} + n - 2) // (n - 1)) END"
VIEWS["ranked_scores"] = f"""
SELECT account_id, score_date, score, product_code, exclude, logical_product,
       CAST(101 - {_BIN.format(q=100)} AS INTEGER) AS percentile,
       CAST(11 - {_BIN.format(q=10)} AS INTEGER) AS decile
FROM (SELECT *, row_number() OVER (PARTITION BY product_code ORDER BY score, account_id) AS r,
             count(*) OVER (PARTITION BY product_code) AS n FROM base_scores)"""


def ranked_scores(spark: SparkSession, sf: str) -> DataFrame:
    return conform(ranking.rank_scores(base_scores(spark, sf)), SCORE)


@query("SELECT account_id, product_code, score, percentile FROM ranked_scores")
def percentile_rank(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_scores(spark, sf).select("account_id", "product_code", "score", "percentile")


@query("SELECT account_id, product_code, score, decile FROM ranked_scores")
def decile_from_score(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_scores(spark, sf).select("account_id", "product_code", "score", "decile")


@query(
    f"""SELECT account_id, product_code, percentile, CAST(11 - {_BIN.format(q=10)} AS INTEGER) AS decile
FROM (SELECT *, row_number() OVER (PARTITION BY product_code
                                   ORDER BY percentile, score DESC, account_id DESC) AS r,
             count(*) OVER (PARTITION BY product_code) AS n FROM ranked_scores)"""
)
def decile_from_percentile(spark: SparkSession, sf: str) -> DataFrame:
    ranked = ranking.rank_scores(base_scores(spark, sf), decile_source="percentile")
    return ranked.select("account_id", "product_code", "percentile", "decile")


@query(
    """SELECT s.account_id, s.product_code,
       CASE WHEN e.internal_segment IN ('', '01') OR d.market_segment IN ('N/R', 'N/A')
            THEN s.score / 100 ELSE s.score END AS score
FROM base_scores s JOIN eligible e ON s.account_id = e.account_id
LEFT JOIN dim d ON d.account_id = s.account_id"""
)
def score_damping(spark: SparkSession, sf: str) -> DataFrame:
    accounts = eligible_accounts(src.master(spark, sf), src.roles(spark, sf), src.dim(spark, sf))
    damped = ranking.damp_scores(base_scores(spark, sf), accounts)
    return damped.select("account_id", "product_code", "score")


@query(
    """SELECT r.account_id, r.product_code, r.score, CASE WHEN r.score > f.lowest THEN 1 ELSE 0 END AS flag1,
       CAST(NULL AS INTEGER) AS flag2, CAST(NULL AS INTEGER) AS flag3, CAST(NULL AS INTEGER) AS flag4,
       CAST(NULL AS INTEGER) AS flag5
FROM ranked_scores r LEFT JOIN (
  SELECT product_code, min(score) AS lowest FROM ranked_scores WHERE percentile = 1 GROUP BY 1) f
  ON r.product_code = f.product_code"""
)
def sweet_spot(spark: SparkSession, sf: str) -> DataFrame:
    flagged = ranking.sweet_spot(ranked_scores(spark, sf))
    return flagged.select("account_id", "product_code", "score", *[f"flag{i}" for i in range(1, 6)])


@query(
    """SELECT DISTINCT node_code AS product_code,
       CASE WHEN regexp_matches(node_code, '^(LPR|LSV)') THEN 1 ELSE 0 END AS logical_product
FROM nodes WHERE trim(node_code) <> ''"""
)
def logical_flag(spark: SparkSession, sf: str) -> DataFrame:
    codes = tree_nodes(src.tree(spark, sf)).filter(F.trim("node_code") != "")
    return codes.select(
        F.col("node_code").alias("product_code"),
        ranking.logical_flag("node_code").alias("logical_product"),
    ).distinct()


# --- products due, earlier scores, conversions ---

VIEWS["available"] = """
SELECT DISTINCT node_code AS product_code FROM nodes
WHERE level IN ('LEVEL5', 'LEVEL6') AND trim(node_code) <> ''"""
VIEWS["refreshes"] = """
SELECT a.product_code,
       CASE WHEN count(s.score_date) > 1 THEN CAST(max(s.score_date) AS INTEGER) ELSE 20010815 END AS refresh_ymd
FROM available a LEFT JOIN year_scores s ON a.product_code = s.product_code GROUP BY a.product_code"""
VIEWS["year_scores"] = "SELECT * FROM ranked_scores WHERE product_code LIKE '%.2001'"
VIEWS["first_opens"] = """
SELECT account_id, node_code AS product_code, min(status_ymd) AS first_open_ymd
FROM activity WHERE status IN ('O', 'P') GROUP BY account_id, node_code"""
VIEWS["fresh_opens"] = """
SELECT DISTINCT o.account_id, o.product_code
FROM first_opens o JOIN refreshes r ON o.product_code = r.product_code
WHERE o.first_open_ymd >= r.refresh_ymd"""
VIEWS["past_conversions"] = """
SELECT account_id, node_code AS product_code,
       CASE WHEN count(*) = 1 THEN CAST(any_value(period) AS VARCHAR) END AS conversion_date
FROM (SELECT a.account_id, a.node_code, p.period FROM history_activity a
      JOIN periods p ON a.status_ymd >= p.start_ymd AND a.status_ymd < p.next_ymd
      WHERE a.status = 'F' AND a.level IN ('LEVEL5', 'LEVEL6') AND p.period = 1)
GROUP BY account_id, node_code"""


def available_products(spark: SparkSession, sf: str) -> DataFrame:
    nodes = tree_nodes(src.tree(spark, sf), PRODUCT_LEVELS).filter(F.trim("node_code") != "")
    return nodes.select(F.col("node_code").alias("product_code")).distinct()


def year_scores(spark: SparkSession, sf: str) -> DataFrame:
    return readers.with_suffix(ranked_scores(spark, sf), YEAR)


def first_opens(spark: SparkSession, sf: str) -> DataFrame:
    lines = recent_lines(src.lines(spark, sf), AS_OF, CONFIG.line_months)
    return conversion.first_open_by_node(
        lines, tree_nodes(src.tree(spark, sf)), known_accounts(spark, sf), CONFIG
    )


def past_conversions(spark: SparkSession, sf: str) -> DataFrame:
    """Wins of the last whole quarter; pairs with several wins have no date on record."""
    nodes = tree_nodes(src.tree(spark, sf), PRODUCT_LEVELS)
    profile = line_profile(history_lines(spark, sf), CONFIG, ("label",), periods=1)
    won = labels_by_period(node_profile(profile, nodes, known_accounts(spark, sf)))
    per_pair = won.groupBy("account_id", F.col("node_code").alias("product_code")).agg(
        F.sum("count").alias("n"), F.max("period").alias("p")
    )
    date = F.when(F.col("n") == 1, F.col("p").cast("string")).alias("conversion_date")
    return conform(per_pair.select("account_id", "product_code", date), HISTORY)


def fresh_opens(spark: SparkSession, sf: str, scores: DataFrame) -> DataFrame:
    refresh = conversion.last_refresh(scores, available_products(spark, sf), AS_OF)
    return conversion.new_opens(first_opens(spark, sf), refresh)


@query(
    """SELECT product_code, min(score_date) AS score_date FROM year_scores
GROUP BY product_code ORDER BY 2, 1 LIMIT 50"""
)
def stalest_products(spark: SparkSession, sf: str) -> DataFrame:
    return candidates.stalest_products(base_scores(spark, sf), YEAR, REFRESHED)


@query("SELECT product_code FROM available EXCEPT SELECT product_code FROM year_scores")
def unscored_products(spark: SparkSession, sf: str) -> DataFrame:
    done = readers.with_suffix(base_scores(spark, sf), YEAR)
    return candidates.unscored_products(available_products(spark, sf), done)


@query("SELECT * FROM ranked_scores WHERE 1 = 2")
def existing_scores_first_run(spark: SparkSession, sf: str) -> DataFrame:
    return readers.existing_scores(ranked_scores(spark, sf), available_products(spark, sf), "first")


_DUE = "SELECT product_code FROM year_scores GROUP BY product_code ORDER BY min(score_date), product_code LIMIT 50"


@query(f"SELECT * FROM ranked_scores WHERE product_code IN ({_DUE})")
def existing_scores_refresh(spark: SparkSession, sf: str) -> DataFrame:
    scores = ranked_scores(spark, sf)
    due = candidates.stalest_products(scores, YEAR, REFRESHED)
    return readers.existing_scores(scores, due, "refresh")


@query("SELECT account_id, product_code, score_date AS conversion_date FROM year_scores")
def conversion_history(spark: SparkSession, sf: str) -> DataFrame:
    return readers.conversion_history(base_scores(spark, sf), YEAR)


@query("SELECT * FROM refreshes")
def last_refresh(spark: SparkSession, sf: str) -> DataFrame:
    scores = readers.with_suffix(base_scores(spark, sf), YEAR)
    return conversion.last_refresh(scores, available_products(spark, sf), AS_OF)


@query("SELECT * FROM first_opens")
def first_open_by_node(spark: SparkSession, sf: str) -> DataFrame:
    return first_opens(spark, sf)


@query(
    """SELECT DISTINCT s.* FROM year_scores s
JOIN fresh_opens o ON s.account_id = o.account_id AND s.product_code = o.product_code
WHERE NOT EXISTS (SELECT 1 FROM past_conversions h WHERE h.account_id = s.account_id
                  AND h.product_code = s.product_code AND h.conversion_date IS NOT NULL)"""
)
def new_conversions(spark: SparkSession, sf: str) -> DataFrame:
    scores = year_scores(spark, sf)
    opens = fresh_opens(spark, sf, scores)
    return conversion.new_conversions(scores, opens, past_conversions(spark, sf))


@query(
    """SELECT DISTINCT s.account_id, s.product_code, s.score,
       CASE WHEN o.account_id IS NOT NULL THEN 1 END AS exclude
FROM year_scores s LEFT JOIN fresh_opens o
  ON s.account_id = o.account_id AND s.product_code = o.product_code"""
)
def exclude_flag(spark: SparkSession, sf: str) -> DataFrame:
    scores = readers.with_suffix(base_scores(spark, sf), YEAR)
    flagged = conversion.exclude_flag(scores, fresh_opens(spark, sf, scores))
    return flagged.select("account_id", "product_code", "score", "exclude")


@query(
    """SELECT y.account_id, y.score_date, y.score, y.product_code,
       CAST(CASE WHEN o.account_id IS NOT NULL THEN 1 END AS INTEGER) AS exclude, y.logical_product,
       y.percentile, y.decile, CASE WHEN y.score > f.lowest THEN 1 ELSE 0 END AS flag1,
       CAST(NULL AS INTEGER) AS flag2, CAST(NULL AS INTEGER) AS flag3, CAST(NULL AS INTEGER) AS flag4,
       CAST(NULL AS INTEGER) AS flag5
FROM year_scores y
LEFT JOIN fresh_opens o ON y.account_id = o.account_id AND y.product_code = o.product_code
LEFT JOIN (SELECT product_code, min(score) AS lowest FROM ranked_scores WHERE percentile = 1 GROUP BY 1) f
  ON y.product_code = f.product_code"""
)
def consulting_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The consulting score table: thirteen columns with exclusions, ranks and the sweet spot."""
    scores = readers.with_suffix(base_scores(spark, sf), YEAR)
    opens = fresh_opens(spark, sf, scores)
    accounts = eligible_accounts(src.master(spark, sf), src.roles(spark, sf))
    return staged_scores(scores, accounts, opens, replace(CONFIG, model_type="consulting"))


# --- roll-up and export ---

VIEWS["parent_scores"] = """
SELECT s.*, m.l3 FROM base_scores s JOIN leaf_map m ON s.product_code = m.product_code
WHERE s.logical_product = 1 AND s.product_code LIKE '%.2001'"""
VIEWS["rolled"] = """
SELECT l3 AS product_code, account_id, max(score) AS score, max(score_date) AS score_date
FROM parent_scores GROUP BY l3, account_id"""
VIEWS["rolled_ranked"] = f"""
SELECT 'Solution Area Level 3' AS scenario, account_id, score_date, score, product_code,
       CAST(NULL AS INTEGER) AS exclude, 0 AS logical_product,
       CAST(101 - {_BIN.format(q=100)} AS INTEGER) AS percentile,
       CAST(11 - {_BIN.format(q=10)} AS INTEGER) AS decile
FROM (SELECT *, row_number() OVER (PARTITION BY product_code ORDER BY score, account_id) AS r,
             count(*) OVER (PARTITION BY product_code) AS n FROM rolled)"""
VIEWS["means"] = """
SELECT account_id, round(avg(percentile), 0) AS raw_score, '20010815' AS calc_date
FROM rolled_ranked GROUP BY account_id"""
VIEWS["classes"] = """
SELECT calc_date, account_id, raw_score,
       CASE WHEN b <= 10 THEN '1 Top High' WHEN b <= 20 THEN '2 High' WHEN b <= 40 THEN '3 Medium High'
            WHEN b <= 60 THEN '4 Medium Low' ELSE '5 Low' END AS interest_class
FROM (SELECT *, ntile(100) OVER (ORDER BY raw_score, account_id) AS b FROM means)"""
VIEWS["export_rows"] = """
SELECT c.calc_date AS report_date, r.account_id, c.interest_class, n.model_name, n.model_id, r.percentile
FROM rolled_ranked r JOIN names n ON r.product_code = n.model_id
JOIN classes c ON r.account_id = c.account_id"""


def parent_scores(spark: SparkSession, sf: str) -> DataFrame:
    picked = rollup.rollup_inputs(base_scores(spark, sf), YEAR)
    return rollup.scores_with_parent(picked, level_map(full_paths(src.tree(spark, sf))))


def ranked_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return rolled_up(base_scores(spark, sf), src.tree(spark, sf), CONFIG)


@query("SELECT account_id, product_code, score, l3 FROM parent_scores")
def scores_with_parent(spark: SparkSession, sf: str) -> DataFrame:
    return parent_scores(spark, sf).select("account_id", "product_code", "score", "l3")


@query("SELECT * FROM rolled")
def rollup_level3(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.rollup(parent_scores(spark, sf))


@query("SELECT * FROM rolled_ranked")
def rollup_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_rollup(spark, sf)


@query("SELECT * FROM means")
def mean_percentile(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.mean_percentile(ranked_rollup(spark, sf), AS_OF)


@query("SELECT * FROM classes")
def interest_class(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.interest_classes(rollup.mean_percentile(ranked_rollup(spark, sf), AS_OF))


@query("SELECT * FROM export_rows")
def interest_export(spark: SparkSession, sf: str) -> DataFrame:
    ranked = materialise(ranked_rollup(spark, sf), "rollup")
    return exported(ranked, src.tree(spark, sf), None, CONFIG)


@query("SELECT e.*, p.parent_id FROM export_rows e LEFT JOIN parents p ON e.account_id = p.account_id")
def interest_export_parent(spark: SparkSession, sf: str) -> DataFrame:
    ranked = materialise(ranked_rollup(spark, sf), "rollup")
    classes = rollup.interest_classes(rollup.mean_percentile(ranked, AS_OF))
    parents = one_parent(account_parents(src.dim(spark, sf)))
    return rollup.interest_export(ranked, level_names(src.tree(spark, sf)), classes, parents)


@query("SELECT e.*, p.parent_id FROM export_rows e LEFT JOIN parents p ON e.account_id = p.account_id")
def rollup_run(spark: SparkSession, sf: str) -> DataFrame:
    """The whole roll-up run with parents: the export that it writes."""
    root = scratch_path(spark, "rollup-run")
    run_rollup(
        spark, base_scores(spark, sf), src.tree(spark, sf), CONFIG, f"{root}/rollup", f"{root}/export",
        dim=src.dim(spark, sf),
    )
    return spark.read.parquet(f"{root}/export")


@query(
    """SELECT account_id, product_code, score, l3 FROM parent_scores
ORDER BY CAST(('0x' || substr(md5(concat_ws('|', account_id, product_code, l3, '42')), 1, 8)) AS BIGINT),
         account_id, product_code, l3 LIMIT 1000"""
)
def small_sample(spark: SparkSession, sf: str) -> DataFrame:
    """A sample to look at: a top-n of all joined rows in hash order."""
    picked = rollup.small_sample(parent_scores(spark, sf), CONFIG.seed)
    return picked.select("account_id", "product_code", "score", "l3")


# --- sinks, read back ---


@query(
    """SELECT account_id, score_date, product_code, exclude, logical_product, percentile, decile,
       CASE WHEN logical_product = 1 THEN score + 1 ELSE score END AS score
FROM ranked_scores"""
)
def replace_product_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Replace the logical products of a score table; the others stay as they were."""
    scores = materialise(ranked_scores(spark, sf), "scores")
    path = scratch_path(spark, "replaced")
    sinks.replace_partitions(scores, path)
    newer = scores.filter(F.col("logical_product") == 1).withColumn("score", F.col("score") + 1)
    sinks.replace_partitions(newer, path)
    return readers.read_table(spark, path, SCORE)


@query(
    """SELECT account_id, score_date, '00' || CAST(decile AS VARCHAR) AS product_code, exclude, logical_product,
       percentile, decile, score
FROM ranked_scores"""
)
def numeric_codes_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Products named by digits with leading zeros, written as folders and read back."""
    scores = ranked_scores(spark, sf).withColumn("product_code", F.concat(F.lit("00"), F.col("decile").cast("string")))
    path = scratch_path(spark, "digits")
    sinks.replace_partitions(materialise(scores, "scores"), path)
    return readers.read_table(spark, path, SCORE)


@query("SELECT * FROM ranked_scores UNION ALL SELECT * FROM ranked_scores")
def append_history_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    scores = materialise(ranked_scores(spark, sf), "scores")
    path = scratch_path(spark, "appended")
    sinks.append(scores, path)
    sinks.append(scores, path)
    return readers.read_table(spark, path, SCORE)


@query("SELECT account_id, product_code, score, percentile, '20010815' AS run_date FROM ranked_scores")
def dated_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A second copy on the same day replaces the first."""
    scores = materialise(ranked_scores(spark, sf), "scores").withColumn("run_date", F.lit("20010815"))
    path = scratch_path(spark, "dated")
    sinks.dated_copy(scores, path)
    sinks.dated_copy(scores, path)
    columns = ["account_id", "product_code", "score", "percentile", "run_date"]
    return spark.read.schema(scores.schema).parquet(path).select(*columns)


@query("SELECT * FROM classes")
def overwrite_export_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    classes = interest_class(spark, sf)
    path = scratch_path(spark, "export")
    sinks.overwrite(classes.limit(0), path)
    sinks.overwrite(classes, path)
    return spark.read.parquet(path)


@query("SELECT account_id, score FROM ranked_scores UNION ALL SELECT account_id, score FROM ranked_scores")
def recursive_read(spark: SparkSession, sf: str) -> DataFrame:
    """Two dated folders read as one table."""
    scores = materialise(ranked_scores(spark, sf).select("account_id", "score"), "scores")
    path = scratch_path(spark, "nested")
    sinks.overwrite(scores, f"{path}/2001/08/14")
    sinks.overwrite(scores, f"{path}/2001/08/15")
    return readers.read_recursive(spark, path, scores.schema)
