"""Feature blocks, training and scoring sets."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import inputs as src
from catalogue.inputs import AS_OF, CONFIG, FEATURE_LEVEL, VIEWS
from catalogue.registry import query
from catalogue.tree_and_accounts import history_lines, known_accounts
from leadlift.config import RunConfig
from leadlift.operators import dataset
from leadlift.operators.accounts import eligible_accounts
from leadlift.operators.activity import line_profile, node_profile, recent_lines
from leadlift.operators.candidates import buyers_by_node, candidate_products
from leadlift.operators.features import (
    PREFIX,
    align,
    feature_rows,
    first_open_days as days_from,
    labels_by_period,
    open_counts,
    wide,
)
from leadlift.operators.forest import sparse
from leadlift.operators.hierarchy import branch_nodes, tree_nodes
from leadlift.operators.vectors import dropped, feature_names, strong_pairs, vector_table
from leadlift.plans.train import training_table
from leadlift.sources.scratch import materialise

KEYS = ["account_id", "period"]
BRANDS = sorted(f"Brand#{i}" for i in range(1, 26))
NAMES = [prefix + brand for prefix in PREFIX.values() for brand in BRANDS]

_OPEN = "a.level = 'LEVEL2' AND a.status IN ('O', 'P')"
VIEWS["quarter_rows"] = f"""
SELECT a.account_id, 'open_quarter_' || a.node_code AS feature, p.period, count(*) AS value
FROM history_activity a JOIN periods p ON a.status_ymd >= p.before_ymd AND a.status_ymd < p.start_ymd
WHERE {_OPEN} GROUP BY ALL"""
for _view, _lower in (("year_rows", "mixed_ymd"), ("rolling_rows", "rolling_ymd")):
    VIEWS[_view] = f"""
SELECT a.account_id, 'open_year_' || a.node_code AS feature, p.period, count(*) AS value
FROM history_activity a JOIN periods p ON a.status_ymd >= p.{_lower} AND a.status_ymd < p.start_ymd
WHERE {_OPEN} GROUP BY ALL"""
VIEWS["first_rows"] = f"""
SELECT a.account_id, 'first_open_' || a.node_code AS feature, p.period,
       CAST(date_diff('day', min(a.status_date), any_value(p.start_date)) AS BIGINT) AS value
FROM history_activity a JOIN periods p ON a.status_ymd > 19000101 AND a.status_ymd < p.start_ymd
WHERE {_OPEN} GROUP BY a.account_id, a.node_code, p.period"""
VIEWS["behaviour_rows"] = (
    "SELECT * FROM quarter_rows UNION ALL SELECT * FROM year_rows UNION ALL SELECT * FROM first_rows"
)


def _wide_sql(default: str = "NULL") -> str:
    return ", ".join(
        f"CAST(coalesce(sum(CASE WHEN feature = '{n}' THEN value END), {default}) AS BIGINT) AS \"{n}\""
        for n in NAMES
    )


def profile(
    spark: SparkSession, sf: str, families: tuple[str, ...] = tuple(PREFIX), config: RunConfig = CONFIG
) -> DataFrame:
    nodes = tree_nodes(src.tree(spark, sf), (FEATURE_LEVEL,))
    lines = line_profile(history_lines(spark, sf), config, families)
    return node_profile(lines, nodes, known_accounts(spark, sf))


@query("SELECT * FROM quarter_rows")
def open_quarter(spark: SparkSession, sf: str) -> DataFrame:
    return open_counts(profile(spark, sf, ("open_quarter",)), CONFIG, "open_quarter")


@query("SELECT * FROM year_rows")
def open_year_reference(spark: SparkSession, sf: str) -> DataFrame:
    return open_counts(profile(spark, sf, ("open_year",)), CONFIG, "open_year")


@query("SELECT * FROM rolling_rows")
def open_year_rolling12(spark: SparkSession, sf: str) -> DataFrame:
    rolling = replace(CONFIG, year_window="rolling12")
    return open_counts(profile(spark, sf, ("open_year",), rolling), rolling, "open_year")


@query("SELECT * FROM first_rows")
def first_open_days(spark: SparkSession, sf: str) -> DataFrame:
    return days_from(profile(spark, sf, ("first_open",)), CONFIG)


@query(f"SELECT account_id, period, {_wide_sql()} FROM behaviour_rows GROUP BY account_id, period")
def features_wide(spark: SparkSession, sf: str) -> DataFrame:
    names = feature_names(tree_nodes(src.tree(spark, sf)), FEATURE_LEVEL)
    return wide(feature_rows(profile(spark, sf), CONFIG), KEYS, names)


# Scoring-time features as the reference has them: period 1, all recent lines, and
# no date range on the quarter block.
VIEWS["serving_rows"] = f"""
SELECT a.account_id, 'open_quarter_' || a.node_code AS feature, count(*) AS value
FROM activity a WHERE {_OPEN} GROUP BY ALL
UNION ALL
SELECT a.account_id, 'open_year_' || a.node_code, count(*)
FROM activity a JOIN periods p ON p.period = 1 AND a.status_ymd >= p.mixed_ymd AND a.status_ymd < p.start_ymd
WHERE {_OPEN} GROUP BY ALL
UNION ALL
SELECT a.account_id, 'first_open_' || a.node_code,
       CAST(date_diff('day', min(a.status_date), any_value(p.start_date)) AS BIGINT)
FROM activity a JOIN periods p ON p.period = 1 AND a.status_ymd > 19000101 AND a.status_ymd < p.start_ymd
WHERE {_OPEN} GROUP BY a.account_id, a.node_code"""


def serving_features(spark: SparkSession, sf: str) -> DataFrame:
    lines = recent_lines(src.lines(spark, sf), AS_OF, CONFIG.line_months)
    nodes = tree_nodes(src.tree(spark, sf), (FEATURE_LEVEL,))
    served = node_profile(
        line_profile(lines, CONFIG, tuple(PREFIX), periods=1, serving=True),
        nodes,
        known_accounts(spark, sf),
    )
    return feature_rows(served, CONFIG)


@query("SELECT account_id, feature, value FROM serving_rows")
def apply_features(spark: SparkSession, sf: str) -> DataFrame:
    return serving_features(spark, sf).select("account_id", "feature", "value")


VIEWS["serving_wide"] = f"SELECT account_id, {_wide_sql()} FROM serving_rows GROUP BY account_id"
VIEWS["scoring_rows"] = (
    "SELECT e.*, "
    + ", ".join(f'coalesce(w."{n}", 0) AS "{n}"' for n in NAMES)
    + " FROM eligible e LEFT JOIN serving_wide w ON e.account_id = w.account_id"
)


def scoring_frame(spark: SparkSession, sf: str) -> DataFrame:
    rows = serving_features(spark, sf)
    names = feature_names(tree_nodes(src.tree(spark, sf)), FEATURE_LEVEL)
    accounts = eligible_accounts(src.master(spark, sf), src.roles(spark, sf))
    return dataset.join_blocks(accounts, [wide(rows, ["account_id"], names)], ["account_id"])


@query("SELECT * FROM scoring_rows")
def scoring_set(spark: SparkSession, sf: str) -> DataFrame:
    return scoring_frame(spark, sf)


# A model that reads two of the three families, and a node that is gone from the tree.
_ALIGNED = [n for n in NAMES if not n.startswith("open_quarter_")] + ["open_year_Brand#99"]


@query(
    "SELECT account_id, "
    + ", ".join(
        (f'CAST("{n}" AS DOUBLE)' if n in NAMES else "CAST(0 AS DOUBLE)") + f' AS "{n}"' for n in _ALIGNED
    )
    + " FROM scoring_rows"
)
def feature_align(spark: SparkSession, sf: str) -> DataFrame:
    """The scoring set cut to a model's features, one of which it does not have."""
    return align(scoring_frame(spark, sf), _ALIGNED, ["account_id"])


_CODES = {"master_code": "ABFH", "internal_segment": ("AU", "BU", "FU", "HO")}


@query(
    "SELECT account_id, "
    + ", ".join(
        f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{v}" for c, vs in _CODES.items() for v in vs
    )
    + " FROM eligible"
)
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    accounts = eligible_accounts(src.master(spark, sf), src.roles(spark, sf))
    out = accounts.select("account_id", *_CODES)
    for column in _CODES:
        out = dataset.one_hot(out, column, dataset.category_values(accounts, column))
    return out.drop(*_CODES)


def training_accounts(spark: SparkSession, sf: str, behaviour: DataFrame) -> DataFrame:
    accounts = eligible_accounts(src.master(spark, sf), src.roles(spark, sf))
    return dataset.active_accounts(accounts, open_counts(behaviour, CONFIG, "open_year"))


def top_labels(spark: SparkSession, sf: str) -> DataFrame:
    nodes = tree_nodes(src.tree(spark, sf), ("LEVEL1",))
    bought = line_profile(history_lines(spark, sf), CONFIG, ("label",))
    return labels_by_period(node_profile(bought, nodes, known_accounts(spark, sf)))


def candidates(spark: SparkSession, sf: str) -> list[tuple[str, str]]:
    lines = recent_lines(src.lines(spark, sf), AS_OF, CONFIG.line_months)
    nodes = tree_nodes(src.tree(spark, sf), ("LEVEL1",))
    buyers = buyers_by_node(lines, nodes, known_accounts(spark, sf), CONFIG)
    return [(r["node_code"], r["level"]) for r in candidate_products(buyers, CONFIG).collect()]


VIEWS["training_accounts"] = """
SELECT * FROM eligible WHERE account_id IN (SELECT account_id FROM year_rows)"""
VIEWS["top_products"] = (
    "SELECT 'LEVEL1|' || node_code AS product_key FROM buyers WHERE level = 'LEVEL1'"
)
VIEWS["top_bought"] = """
SELECT 'LEVEL1|' || node_code AS product_key, account_id, period FROM period_labels WHERE level = 'LEVEL1'"""
_ATTRIBUTES = (
    "account_id master_code industry_code crm_segment internal_segment owner_flag target_class "
    "partner_kind activity_status"
).split()
_A = ", ".join(f"a.{c}" for c in _ATTRIBUTES)
VIEWS["spine_rows"] = f"""
SELECT {_A}, t.product_key, p.period, CASE WHEN b.account_id IS NULL THEN 0 ELSE 1 END AS label
FROM training_accounts a CROSS JOIN top_products t CROSS JOIN periods p
LEFT JOIN top_bought b ON b.product_key = t.product_key AND b.account_id = a.account_id AND b.period = p.period"""
VIEWS["reference_rows"] = f"""
SELECT {_A}, t.product_key, coalesce(b.period, 0) AS period,
       CASE WHEN b.account_id IS NULL THEN 0 ELSE 1 END AS label
FROM training_accounts a CROSS JOIN top_products t
LEFT JOIN top_bought b ON b.product_key = t.product_key AND b.account_id = a.account_id"""
_REFERENCE = replace(CONFIG, spine="reference")


def _spine(spark: SparkSession, sf: str, config: RunConfig) -> DataFrame:
    accounts = training_accounts(spark, sf, profile(spark, sf, ("open_year",)))
    return dataset.labelled_spine(accounts, top_labels(spark, sf), candidates(spark, sf), config)


@query("SELECT account_id, product_key, period, label FROM spine_rows")
def training_spine(spark: SparkSession, sf: str) -> DataFrame:
    return _spine(spark, sf, CONFIG).select("account_id", "product_key", "period", "label")


@query("SELECT account_id, product_key, period, label FROM reference_rows")
def training_spine_reference(spark: SparkSession, sf: str) -> DataFrame:
    return _spine(spark, sf, _REFERENCE).select("account_id", "product_key", "period", "label")


def _sampled_sql(rows: str) -> str:
    draw = (
        "CAST(('0x' || substr(md5(concat_ws('|', account_id, period, product_key, '42')), 1, 8)) AS BIGINT)"
        " / 4294967296.0"
    )
    return f"""
SELECT account_id, product_key, period, label FROM (
  SELECT *, {draw} AS u, activity_status IN ('E0004', 'E0006', 'E0007', 'E0008') AS active FROM {rows})
WHERE label = 1
   OR (active AND target_class IN ('C', 'O', '') AND u < 0.15)
   OR (active AND target_class = 'P' AND u < 0.05)
   OR (active AND target_class NOT IN ('C', 'O', '', 'P') AND u < 0.25)
   OR (NOT active AND target_class IN ('C', 'O', '') AND u < 0.075)
   OR (NOT active AND target_class = 'P' AND u < 0.025)
   OR (NOT active AND target_class NOT IN ('C', 'O', '', 'P') AND u < 0.125)"""


VIEWS["sampled_rows"] = _sampled_sql("spine_rows")
VIEWS["sampled_reference"] = _sampled_sql("reference_rows")
_SAMPLE_KEYS = ["account_id", "period", "product_key"]


@query("SELECT * FROM sampled_rows")
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = dataset.stratified_sample(_spine(spark, sf, CONFIG), _SAMPLE_KEYS, CONFIG.seed)
    return rows.select("account_id", "product_key", "period", "label")


@query("SELECT * FROM sampled_reference")
def stratified_sample_reference(spark: SparkSession, sf: str) -> DataFrame:
    rows = dataset.stratified_sample(_spine(spark, sf, _REFERENCE), _SAMPLE_KEYS, CONFIG.seed)
    return rows.select("account_id", "product_key", "period", "label")


VIEWS["behaviour_wide"] = (
    f"SELECT account_id, period, {_wide_sql()} FROM behaviour_rows GROUP BY account_id, period"
)


@query(
    "SELECT split_part(s.product_key, '|', 2) AS product_code, s.account_id, s.period, s.label, "
    + ", ".join(f'coalesce(w."{n}", 0) AS "{n}"' for n in NAMES)
    + " FROM sampled_rows s LEFT JOIN behaviour_wide w"
    " ON w.account_id = s.account_id AND w.period = s.period"
)
def training_set(spark: SparkSession, sf: str) -> DataFrame:
    """All products' sampled rows in one pass, with the feature blocks."""
    behaviour = materialise(profile(spark, sf), "profile")
    accounts = training_accounts(spark, sf, behaviour)
    rows = dataset.training_rows(accounts, top_labels(spark, sf), candidates(spark, sf), CONFIG)
    names = feature_names(tree_nodes(src.tree(spark, sf)), FEATURE_LEVEL)
    blocks = wide(feature_rows(behaviour, CONFIG), KEYS, names)
    return dataset.join_blocks(rows.drop("level"), [blocks], KEYS)


@query(
    """SELECT account_id, product_key, period, label,
       CAST(('0x' || substr(md5(concat_ws('|', account_id, period, product_key, 'split', '42')), 1, 8)) AS BIGINT)
         / 4294967296.0 < 0.7 AS is_train
FROM spine_rows"""
)
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = training_spine(spark, sf)
    return dataset.hash_split(rows, _SAMPLE_KEYS, CONFIG.train_fraction, CONFIG.seed)


@query(
    """SELECT DISTINCT t.node_code AS product_code, x.prefix || n.l2 AS feature
FROM (SELECT DISTINCT node_code FROM nodes WHERE trim(node_code) <> '') t
JOIN (SELECT DISTINCT l1, l2, l3, l4, l5, l6 FROM tree) n
  ON t.node_code IN (n.l1, n.l2, n.l3, n.l4, n.l5, n.l6)
CROSS JOIN (VALUES ('open_quarter_'), ('open_year_'), ('first_open_')) x(prefix)"""
)
def leakage_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    """For a model of any node, the features of the node's own branch."""
    tree = src.tree(spark, sf)
    products = tree_nodes(tree).filter(F.trim("node_code") != "").select(
        F.col("node_code").alias("product_code")
    )
    branch = branch_nodes(tree, products.distinct(), FEATURE_LEVEL)
    return dataset.branch_features(branch, tuple(PREFIX.values()))


_INDEX = ", ".join(f"('{n}', {i})" for i, n in enumerate(NAMES))


@query(
    f"""
SELECT feature, bool_or(abs(r) > 0.25) AS drop_both, bool_or(abs(r) > 0.25 AND other < idx) AS keep_first
FROM (
  SELECT a.feature, a.idx, b.idx AS other, corr(a.value, b.value) AS r
  FROM dense a JOIN dense b ON a.account_id = b.account_id AND a.idx <> b.idx
  GROUP BY a.feature, a.idx, b.idx)
WHERE r IS NOT NULL AND NOT isnan(r)
GROUP BY feature"""
)
def correlated_features(spark: SparkSession, sf: str) -> DataFrame:
    """Which features each pruning mode drops from the scoring set at 0.25."""
    rows = serving_features(spark, sf)
    accounts = eligible_accounts(src.master(spark, sf), src.roles(spark, sf))
    base = accounts.select("account_id", F.lit(1).alias("period"))
    names = feature_names(tree_nodes(src.tree(spark, sf)), FEATURE_LEVEL)
    vectors = vector_table(base, rows, names, {})
    pairs = materialise(strong_pairs(vectors, "features", 0.25), "pairs")
    both, first = set(dropped(pairs, "drop_both")), set(dropped(pairs, "keep_first"))
    return spark.createDataFrame(
        [(n, i in both, i in first) for i, n in enumerate(names)],
        "feature string, drop_both boolean, keep_first boolean",
    )


VIEWS["dense"] = f"""
SELECT e.account_id, i.feature, i.idx, CAST(coalesce(s.value, 0) AS DOUBLE) AS value
FROM eligible e CROSS JOIN (VALUES {_INDEX}) i(feature, idx)
LEFT JOIN serving_rows s ON s.account_id = e.account_id AND s.feature = i.feature"""


# The training table at the levels that are trained on: features of every level-6 node.
for _view in ("quarter_rows", "year_rows", "first_rows"):
    VIEWS[f"fine_{_view}"] = VIEWS[_view].replace("'LEVEL2'", "'LEVEL6'")
VIEWS["fine_behaviour"] = """
SELECT account_id, period, count(CASE WHEN value <> 0 THEN 1 END) AS n, sum(value) AS total
FROM (SELECT * FROM fine_quarter_rows UNION ALL SELECT * FROM fine_year_rows UNION ALL SELECT * FROM fine_first_rows)
GROUP BY account_id, period"""
VIEWS["fine_accounts"] = "SELECT * FROM eligible WHERE account_id IN (SELECT account_id FROM fine_year_rows)"
VIEWS["fine_spine"] = f"""
SELECT {_A}, t.product_key, p.period, CASE WHEN b.account_id IS NULL THEN 0 ELSE 1 END AS label
FROM fine_accounts a
CROSS JOIN (SELECT level || '|' || node_code AS product_key FROM buyers WHERE level IN ('LEVEL5', 'LEVEL6')) t
CROSS JOIN periods p
LEFT JOIN (SELECT level || '|' || node_code AS product_key, account_id, period FROM period_labels) b
  ON b.product_key = t.product_key AND b.account_id = a.account_id AND b.period = p.period"""
VIEWS["fine_sampled"] = _sampled_sql("fine_spine")
_FINE = replace(CONFIG, feature_level="LEVEL6", candidate_levels=("LEVEL5", "LEVEL6"))


@query(
    """SELECT split_part(s.product_key, '|', 2) AS product_code, split_part(s.product_key, '|', 1) AS level,
       s.account_id, s.period, s.label, CAST(coalesce(b.n, 0) + o.ones AS BIGINT) AS n_features,
       CAST(coalesce(b.total, 0) + o.ones AS DOUBLE) AS total
FROM fine_sampled s
JOIN (SELECT account_id, CASE WHEN master_code IS NULL THEN 0 ELSE 1 END
                         + CASE WHEN internal_segment IS NULL THEN 0 ELSE 1 END AS ones FROM eligible) o
  ON o.account_id = s.account_id
LEFT JOIN fine_behaviour b ON b.account_id = s.account_id AND b.period = s.period"""
)
def fine_training_table(spark: SparkSession, sf: str) -> DataFrame:
    """Sampled rows of all level 5 and 6 products; of their vectors the size and the sum."""
    _, values = sparse("features")
    size, total = F.size(values).cast("long"), F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    of_vector = [size.alias("n_features"), total.alias("total")]
    table, _, _ = training_table(spark, src.inputs(spark, sf), _FINE, of_vector)
    return table.select("product_code", "level", "account_id", "period", "label", "n_features", "total")
