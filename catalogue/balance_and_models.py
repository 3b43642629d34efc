"""Class balancing, metrics and model queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import inputs as src
from catalogue.features_and_sets import _INDEX, NAMES, training_set
from catalogue.inputs import CONFIG, VIEWS
from catalogue.registry import query
from leadlift.operators import balance, forest, metrics
from leadlift.operators.accounts import eligible_accounts
from leadlift.operators.neighbours import nearest_neighbours as knn
from leadlift.operators.scoring import registered_models
from leadlift.operators.scoring import score_products as apply_models
from leadlift.plans.score import run_score, scoring_behaviour, scoring_vectors
from leadlift.plans.train import run_train
from leadlift.sources.readers import read_table
from leadlift.sources.schemas import MODEL_METRICS, MODEL_REGISTRY, SCORE
from leadlift.sources.scratch import materialise, scratch_path

VIEWS["points"] = """
SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, CASE WHEN label = 0 THEN 1 ELSE 0 END AS label
FROM embeddings"""
VIEWS["nearest"] = """
SELECT id, neighbour, rank FROM (
  SELECT a.id, b.id AS neighbour,
         row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.vec, b.vec), b.id) AS rank
  FROM points a JOIN points b ON a.id <> b.id)
WHERE rank <= 5"""


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of one class against the rest."""
    return src.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("vec"),
        (F.col("label") == 0).cast("int").alias("label"),
    )


@query("SELECT id, neighbour, CAST(rank AS INTEGER) AS rank FROM nearest")
def nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return knn(points(spark, sf), balance.SMOTE_NEIGHBOURS).select("id", "neighbour", "rank")


@query(
    """SELECT a.id AS id_a, a.neighbour AS id_b, p.label AS label_a, q.label AS label_b
FROM nearest a JOIN nearest b ON a.neighbour = b.id AND b.neighbour = a.id
JOIN points p ON p.id = a.id JOIN points q ON q.id = a.neighbour
WHERE a.rank = 1 AND b.rank = 1 AND a.id < a.neighbour AND p.label <> q.label"""
)
def tomek_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return balance.tomek_links(points(spark, sf))


@query("SELECT label, count(*) AS n FROM points GROUP BY label")
def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.class_counts(points(spark, sf))


@query(
    """SELECT p.id, p.label, CAST(t.n AS DOUBLE) / (t.k * c.n) AS weight
FROM points p JOIN (SELECT label, count(*) AS n FROM points GROUP BY label) c ON p.label = c.label
CROSS JOIN (SELECT count(*) AS n, count(DISTINCT label) AS k FROM points) t"""
)
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return balance.class_weights(points(spark, sf)).select("id", "label", "weight")


@query(
    """SELECT label, CAST(max(n) OVER () AS BIGINT) AS n
FROM (SELECT label, count(*) AS n FROM points GROUP BY label)"""
)
def smote_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per class after over-sampling: both as many as the majority had."""
    return metrics.class_counts(balance.smote(points(spark, sf)))


def _draw(*parts: str) -> str:
    text = ", ".join((*parts, "'42'"))
    return f"CAST(('0x' || substr(md5(concat_ws('|', {text})), 1, 8)) AS BIGINT) / 4294967296.0"


VIEWS["class_sizes"] = """
SELECT arg_min(label, n * 10 - label) AS minor, min(n) AS size, max(n) - min(n) AS need
FROM (SELECT label, count(*) AS n FROM points GROUP BY label)"""
VIEWS["minority"] = f"""
SELECT id, vec, row_number() OVER (ORDER BY {_draw("id")}, id) AS position
FROM points WHERE label = (SELECT minor FROM class_sizes)"""
VIEWS["minority_near"] = """
SELECT id, list(other ORDER BY rank) AS near FROM (
  SELECT a.id, b.vec AS other,
         row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.vec, b.vec), b.id) AS rank
  FROM minority a JOIN minority b ON a.id <> b.id)
WHERE rank <= 5 GROUP BY id"""
VIEWS["smote_draws"] = f"""
SELECT m.id, m.vec, n.near, m.position * (c.need // c.size + 1) + s.s AS n,
       {_draw("m.id", "s.s", "'pick'")} AS pick, {_draw("m.id", "s.s", "'gap'")} AS gap
FROM minority m JOIN minority_near n ON m.id = n.id CROSS JOIN class_sizes c
JOIN (SELECT unnest(range(1, 1 + (SELECT need // size + 1 FROM class_sizes))) AS s) s
  ON s.s <= c.need // c.size + CASE WHEN m.position <= c.need % c.size THEN 1 ELSE 0 END"""
VIEWS["grown"] = """
SELECT id, vec, label, false AS synthetic FROM points
UNION ALL
SELECT -n, list_transform(list_zip(vec, near[CAST(floor(pick * len(near)) AS BIGINT) + 1]),
                          lambda p: p[1] + gap * (p[2] - p[1])),
       (SELECT minor FROM class_sizes), true
FROM smote_draws"""
VIEWS["grown_nearest"] = """
SELECT id, neighbour FROM (
  SELECT a.id, b.id AS neighbour,
         row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.vec, b.vec), b.id) AS rank
  FROM grown a JOIN grown b ON a.id <> b.id)
WHERE rank = 1"""


@query(
    """SELECT g.id, g.label, g.synthetic, round(g.vec[1], 6) AS first_value
FROM grown g WHERE g.id NOT IN (
  SELECT a.id FROM grown_nearest a JOIN grown_nearest b ON a.neighbour = b.id AND b.neighbour = a.id
  JOIN grown x ON x.id = a.id JOIN grown y ON y.id = a.neighbour WHERE x.label <> y.label)"""
)
def smote_balanced(spark: SparkSession, sf: str) -> DataFrame:
    """Over-sampled and cleaned rows; of the vectors the first value, rounded."""
    kept = balance.smote_tomek(points(spark, sf))
    return kept.select("id", "label", "synthetic", F.round(F.col("vec")[0], 6).alias("first_value"))


@query(
    """WITH rows_in AS (
  SELECT l.quality AS y, CASE WHEN d.n_chars >= 1000 THEN 1 ELSE 0 END AS z
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
c AS (
  SELECT CAST(y AS VARCHAR) AS class_label,
         coalesce(sum(CASE WHEN y = z THEN 1 ELSE 0 END) / nullif(any_value(p.predicted), 0), 0) AS precision,
         sum(CASE WHEN y = z THEN 1 ELSE 0 END) / count(*) AS recall,
         2 * sum(CASE WHEN y = z THEN 1 ELSE 0 END) / (any_value(p.predicted) + count(*)) AS f1,
         count(*) AS support
  FROM rows_in JOIN (SELECT z AS cls, count(*) AS predicted FROM rows_in GROUP BY z) p ON y = p.cls
  GROUP BY y),
every AS (
  SELECT * FROM c
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM c
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
                   sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM c)
SELECT class_label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
       CAST(support AS BIGINT) AS support,
       round((SELECT sum(CASE WHEN y = z THEN 1 ELSE 0 END) / count(*) FROM rows_in), 9) AS accuracy,
       round((SELECT avg(recall) FROM c), 9) AS auc_hard
FROM every"""
)
def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    """Labels against a length rule; ratios rounded to nine digits."""
    rows = src.table(spark, sf, "labels").join(src.table(spark, sf, "documents"), "doc_id")
    rows = rows.select(
        F.col("quality").alias("label"), (F.col("n_chars") >= 1000).cast("int").alias("prediction")
    )
    report = metrics.classification_report(rows)
    ratios = ("precision", "recall", "f1", "accuracy", "auc_hard")
    return report.select(
        "class_label", "support", *[F.round(r, 9).alias(r) for r in ratios]
    )


# The default search, folds and balancing, on all rows of each product.
MODEL_CONFIG = CONFIG
_trained: dict[tuple[str, str], str] = {}


def trained(spark: SparkSession, sf: str) -> str:
    """Folder of the models trained on ``sf`` in this application; trained on first use."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _trained:
        root = scratch_path(spark, "models")
        run_train(
            spark, src.inputs(spark, sf), MODEL_CONFIG, f"{root}/models", f"{root}/registry", f"{root}/metrics"
        )
        _trained[key] = root
    return _trained[key]


@query()
def train_products(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out metrics of one forest per candidate product."""
    return read_table(spark, f"{trained(spark, sf)}/metrics", MODEL_METRICS)


_HELD_OUT = f"""
SELECT split_part(product_key, '|', 2) AS product_code, label, {_draw("account_id", "period", "split_part(product_key, '|', 2)", "'split'")} < 0.7 AS is_train
FROM sampled_rows"""
_TRAINED = f"""
SELECT product_code FROM ({_HELD_OUT}) WHERE is_train GROUP BY product_code HAVING count(DISTINCT label) = 2"""


@query(
    f"""SELECT product_code, CAST(label AS VARCHAR) AS class_label, count(*) AS support
FROM ({_HELD_OUT}) WHERE NOT is_train AND product_code IN ({_TRAINED}) GROUP BY product_code, label"""
)
def held_out_support(spark: SparkSession, sf: str) -> DataFrame:
    """Of the trained models, the held-out rows of each class they were measured on."""
    lines = read_table(spark, f"{trained(spark, sf)}/metrics", MODEL_METRICS)
    return lines.filter(F.col("class_label").isin("0", "1")).select("product_code", "class_label", "support")


@query(f"SELECT product_code, 'LEVEL1' AS level, 'generic' AS model_type, '20010815' AS trained_on FROM ({_TRAINED})")
def registered_products(spark: SparkSession, sf: str) -> DataFrame:
    """The models that the default balancing trains: over-sampling, then link cleaning."""
    registry = read_table(spark, f"{trained(spark, sf)}/registry", MODEL_REGISTRY)
    balanced = registry.filter(F.col("settings")["balance"] == "smote_tomek")
    return balanced.select("product_code", "level", "model_type", "trained_on")


@query(f"SELECT e.account_id, t.product_code, '20010815' AS score_date FROM eligible e JOIN dim d ON e.account_id = d.account_id CROSS JOIN ({_TRAINED}) t")
def scored_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Which pairs the scoring run writes: every eligible account with every model, once."""
    return scoring_run(spark, sf).select("account_id", "product_code", "score_date")


@query()
def model_registry(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{trained(spark, sf)}/registry", MODEL_REGISTRY).select(
        "product_code", "level", "model_type", F.size("features").alias("n_features"), "trained_on"
    )


@query()
def score_products(spark: SparkSession, sf: str) -> DataFrame:
    """Every eligible account scored by every model."""
    registry = read_table(spark, f"{trained(spark, sf)}/registry", MODEL_REGISTRY)
    models = registered_models(registry, MODEL_CONFIG.model_type).collect()
    inputs = src.inputs(spark, sf)
    accounts = eligible_accounts(inputs.master, inputs.roles, inputs.dim)
    behaviour = scoring_behaviour(inputs, MODEL_CONFIG)
    vectors, names = scoring_vectors(accounts, behaviour, models)
    return apply_models(vectors, names, models, MODEL_CONFIG.as_of)


@query()
def scoring_run(spark: SparkSession, sf: str) -> DataFrame:
    """The whole scoring run on the trained models: the score table it writes."""
    root = scratch_path(spark, "scoring")
    run_score(
        spark,
        src.inputs(spark, sf),
        MODEL_CONFIG,
        f"{trained(spark, sf)}/registry",
        f"{root}/scores",
        f"{root}/history",
        f"{root}/copies",
    )
    return read_table(spark, f"{root}/scores", SCORE)


def _split_sql(source: str, by: str) -> str:
    """The best cut of each group by Gini, of equal ones the first feature and value."""
    return f"""
SELECT {by}, feature, idx, value AS threshold FROM (
  SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY round(gain, 6) DESC, idx, value) AS place FROM (
    SELECT *, (l0 * l0 + l1 * l1) / (l0 + l1) + ((t0 - l0) ** 2 + (t1 - l1) ** 2) / (t0 + t1 - l0 - l1)
              - (t0 * t0 + t1 * t1) / (t0 + t1) AS gain
    FROM (
      SELECT *, sum(zeros) OVER w AS l0, sum(ones) OVER w AS l1,
             sum(zeros) OVER (PARTITION BY {by}, idx) AS t0, sum(ones) OVER (PARTITION BY {by}, idx) AS t1
      FROM (SELECT {by}, feature, idx, value, CAST(count(*) FILTER (label = 0) AS DOUBLE) AS zeros,
                   CAST(count(*) FILTER (label = 1) AS DOUBLE) AS ones
            FROM {source} GROUP BY {by}, feature, idx, value)
      WINDOW w AS (PARTITION BY {by}, idx ORDER BY value))
    WHERE l0 + l1 < t0 + t1 AND t0 > 0 AND t1 > 0)
  WHERE gain > 1e-9 * (t0 + t1))
WHERE place = 1"""


VIEWS["long_rows"] = f"""
SELECT split_part(s.product_key, '|', 2) AS product_code, s.account_id, s.period, s.label, i.feature, i.idx,
       CAST(coalesce(b.value, 0) AS DOUBLE) AS value
FROM sampled_rows s CROSS JOIN (VALUES {_INDEX}) i(feature, idx)
LEFT JOIN behaviour_rows b ON b.account_id = s.account_id AND b.period = s.period AND b.feature = i.feature"""
VIEWS["root_split"] = _split_sql("long_rows", "product_code")
VIEWS["sided_rows"] = f"""
SELECT r.*, CASE WHEN s.idx IS NULL THEN -1 WHEN v.value <= s.threshold THEN 0 ELSE 1 END AS side
FROM long_rows r LEFT JOIN root_split s ON s.product_code = r.product_code
LEFT JOIN long_rows v ON v.product_code = r.product_code AND v.account_id = r.account_id AND v.period = r.period AND v.idx = s.idx"""
VIEWS["child_split"] = _split_sql("sided_rows", "product_code, side")
VIEWS["row_sides"] = f"""
SELECT r.product_code, r.account_id, r.period, r.label, r.side,
       CASE WHEN c.idx IS NULL THEN -1 WHEN r.value <= c.threshold THEN 0 ELSE 1 END AS inner_side
FROM sided_rows r LEFT JOIN child_split c ON c.product_code = r.product_code AND c.side = r.side
WHERE r.idx = coalesce(c.idx, 0)"""
#: One tree a product of two levels, on all rows, features and values: what SQL can grow too.
TREE = (1, 2, 1, "none")


def _tree_rows(spark: SparkSession, sf: str) -> DataFrame:
    wide_rows = materialise(training_set(spark, sf), "tree-rows")
    values = F.array(*[F.col(f"`{n}`").cast("double") for n in NAMES])
    entries = F.filter(F.transform(values, lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda e: e["v"] != 0)
    return wide_rows.select(
        F.col("product_code").alias("model"), F.xxhash64("account_id", "period").alias("row"), "account_id", "period", "label",
        F.lit(len(NAMES)).alias("size"), entries["i"].alias("indices"), entries["v"].alias("values"),
    )


def _trees(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    models = rows.select("model").distinct().select("model", *[F.lit(v).alias(n) for v, n in zip(TREE, ("numTrees", "maxDepth", "minInstancesPerNode", "weighting"))])
    return materialise(forest.grow(rows, models, CONFIG.seed, 1, bootstrap=False, subset=False, bins=None), "trees")


@query(
    """SELECT s.product_code, CAST(0 AS INTEGER) AS node, x.feature, x.threshold, round(avg(s.label), 9) AS probability
FROM row_sides s LEFT JOIN root_split x ON x.product_code = s.product_code GROUP BY ALL
UNION ALL
SELECT s.product_code, CAST(1 + s.side AS INTEGER), x.feature, x.threshold, round(avg(s.label), 9)
FROM row_sides s LEFT JOIN child_split x ON x.product_code = s.product_code AND x.side = s.side WHERE s.side >= 0 GROUP BY ALL"""
)
def tree_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Of one tree a product, the root and its children: where they cut and their share of buyers."""
    names = F.array(*[F.lit(n) for n in NAMES])
    return _trees(_tree_rows(spark, sf)).filter("depth < 2").select(
        F.col("model").alias("product_code"),
        "node",
        F.when(F.col("feature") >= 0, F.get(names, F.col("feature"))).alias("feature"),
        F.when(F.col("feature") >= 0, F.col("threshold")).alias("threshold"),
        F.round("probability", 9).alias("probability"),
    )


@query(
    """SELECT product_code, account_id, period,
       round(avg(label) OVER (PARTITION BY product_code, side, inner_side), 9) AS score FROM row_sides"""
)
def tree_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every training row scored by its product's tree, in several passes over the node table."""
    rows = _tree_rows(spark, sf)
    scored = forest.apply(rows, ["account_id", "period"], _trees(rows), per_pass=10, own=True)
    return scored.select(F.col("model").alias("product_code"), "account_id", "period", F.round("score", 9).alias("score"))
