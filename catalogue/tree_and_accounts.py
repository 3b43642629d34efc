"""Tree, line, account and candidate queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import inputs as src
from catalogue.inputs import AS_OF, CONFIG, VIEWS
from catalogue.registry import query
from leadlift.sources.readers import product_tree
from leadlift.operators.accounts import account_parents, eligible_accounts as eligible
from leadlift.operators.activity import activity_lines as join_activity
from leadlift.operators.activity import consulting_lines as only_consulting
from leadlift.operators.activity import created_since, line_profile, node_profile, recent_lines
from leadlift.operators.candidates import buyers_by_node
from leadlift.operators.candidates import candidate_products as pick_candidates
from leadlift.operators.features import labels_by_period as labels_from
from leadlift.operators.hierarchy import combine_levels, full_paths, level_map
from leadlift.operators.hierarchy import level_names as names_of
from leadlift.operators.hierarchy import tree_nodes as nodes_of
from leadlift.sources.schemas import PRODUCT_TREE_ALT, conform

VIEWS["periods"] = """
SELECT CAST(p AS INTEGER) AS period,
       CAST(strftime(date_trunc('quarter', d - to_months(3 * p)), '%Y%m%d') AS INTEGER) AS start_ymd,
       CAST(date_trunc('quarter', d - to_months(3 * p)) AS DATE) AS start_date,
       CAST(strftime(date_trunc('quarter', d - to_months(3 * (p - 1))), '%Y%m%d') AS INTEGER) AS next_ymd,
       CAST(strftime(date_trunc('quarter', d - to_months(3 * (p + 1))), '%Y%m%d') AS INTEGER) AS before_ymd,
       CAST(strftime(date_trunc('quarter', d - to_months(3 * p + 12)), '%Y%m%d') AS INTEGER) AS rolling_ymd,
       CAST(year(d - to_months(3 * p + 12)) * 10000
            + (quarter(d - to_months(3 * (p + 1))) * 3 - 2) * 100 + 1 AS INTEGER) AS mixed_ymd
FROM (SELECT DATE '2001-08-15' AS d, CAST(unnest(range(1, 9)) AS INTEGER) AS p)"""
VIEWS["history_activity"] = "SELECT * FROM activity WHERE created_ts14 > 19980101000000"
VIEWS["period_labels"] = """
SELECT a.account_id, a.level, a.node_code, count(*) AS count, p.period, 1 AS label
FROM history_activity a JOIN periods p ON a.status_ymd >= p.start_ymd AND a.status_ymd < p.next_ymd
WHERE a.status = 'F'
GROUP BY ALL"""
VIEWS["buyers"] = """
SELECT node_code, level, count(DISTINCT account_id) AS buyers
FROM activity
WHERE created_ts14 > 19990101000000 AND status = 'F'
GROUP BY ALL HAVING count(DISTINCT account_id) > 49"""


def known_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return src.dim(spark, sf).select("account_id")


def history_lines(spark: SparkSession, sf: str) -> DataFrame:
    recent = recent_lines(src.lines(spark, sf), AS_OF, CONFIG.line_months)
    return created_since(recent, AS_OF, CONFIG.history_months)


@query("SELECT * FROM period_labels")
def labels_by_period(spark: SparkSession, sf: str) -> DataFrame:
    profile = line_profile(history_lines(spark, sf), CONFIG, ("label",))
    return labels_from(node_profile(profile, nodes_of(src.tree(spark, sf)), known_accounts(spark, sf)))


@query("SELECT product_id, node_code, node_text, level FROM nodes")
def tree_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return nodes_of(src.tree(spark, sf))


@query("SELECT * FROM paths")
def tree_full_paths(spark: SparkSession, sf: str) -> DataFrame:
    return full_paths(src.tree(spark, sf))


VIEWS["paths"] = """
SELECT DISTINCT l1, l2, l3, l4, l5, l6 FROM tree
WHERE l1 <> '' AND l2 <> '' AND l3 <> '' AND l4 <> '' AND l5 <> '' AND l6 <> ''"""
VIEWS["leaf_map"] = """
SELECT DISTINCT l5 AS product_code, l3 FROM paths
UNION SELECT DISTINCT l6, l3 FROM paths"""
VIEWS["names"] = "SELECT DISTINCT l3 AS model_id, l3_text AS model_name FROM tree WHERE l3 <> ''"


@query(
    "SELECT l1, l2, l3, l4, l5 AS l5_or_l6 FROM paths UNION ALL SELECT l1, l2, l3, l4, l6 FROM paths"
)
def tree_combined_levels(spark: SparkSession, sf: str) -> DataFrame:
    return combine_levels(full_paths(src.tree(spark, sf)))


@query("SELECT product_code, l3 FROM leaf_map")
def tree_level_map(spark: SparkSession, sf: str) -> DataFrame:
    return level_map(full_paths(src.tree(spark, sf)))


@query("SELECT model_id, model_name FROM names ORDER BY model_id")
def level_names(spark: SparkSession, sf: str) -> DataFrame:
    return names_of(src.tree(spark, sf)).orderBy("model_id")


_LINE = "account_id, opportunity_id, status, status_ymd, status_date, created_ts14, product_id, item_type"


@query(f"SELECT {_LINE}, node_code, level FROM activity")
def activity_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = recent_lines(src.lines(spark, sf), AS_OF, CONFIG.line_months)
    joined = join_activity(lines, nodes_of(src.tree(spark, sf)), known_accounts(spark, sf))
    return joined.select(*_LINE.split(", "), "node_code", "level")


@query(
    f"""SELECT {_LINE}, node_code, level FROM activity
WHERE opportunity_id IN (SELECT opportunity_id FROM lines WHERE item_type = 'R')"""
)
def consulting_lines(spark: SparkSession, sf: str) -> DataFrame:
    every = src.lines(spark, sf)
    lines = recent_lines(every, AS_OF, CONFIG.line_months)
    lines = only_consulting(lines, every, CONFIG.consulting_item_types)
    joined = join_activity(lines, nodes_of(src.tree(spark, sf)), known_accounts(spark, sf))
    return joined.select(*_LINE.split(", "), "node_code", "level")


VIEWS["alt_tree"] = """
SELECT CAST(p_partkey + 1 AS VARCHAR) AS tree_key, p_type AS l1, p_type || '/' || p_brand AS l2,
       p_name AS l3, '' AS l4, '' AS l5, '' AS l6
FROM part"""
VIEWS["alt_nodes"] = """
SELECT tree_key AS product_id, l1 AS node_code, 'LEVEL1' AS level FROM alt_tree
UNION ALL SELECT tree_key, l2, 'LEVEL2' FROM alt_tree
UNION ALL SELECT tree_key, l3, 'LEVEL3' FROM alt_tree
UNION ALL SELECT tree_key, l4, 'LEVEL4' FROM alt_tree
UNION ALL SELECT tree_key, l5, 'LEVEL5' FROM alt_tree
UNION ALL SELECT tree_key, l6, 'LEVEL6' FROM alt_tree"""
VIEWS["parents_trimmed"] = """
SELECT DISTINCT account_id,
       CASE WHEN parent_id = '' THEN trim(account_id) ELSE trim(parent_id) END AS parent_id
FROM dim"""
VIEWS["parents"] = """
SELECT DISTINCT account_id, CASE WHEN parent_id = '' THEN account_id ELSE parent_id END AS parent_id
FROM dim"""


@query(
    """
SELECT r.account_id, r.opportunity_id, r.status, r.status_date, n.node_code, n.level, p.parent_id
FROM recent r JOIN alt_nodes n ON r.product_id = n.product_id
JOIN parents_trimmed p ON r.account_id = p.account_id
WHERE trim(n.node_code) <> ''"""
)
def alternate_tree_lines(spark: SparkSession, sf: str) -> DataFrame:
    part = src.table(spark, sf, "part")
    codes = {
        "tree_key": (F.col("p_partkey") + 1).cast("string"),
        "l1": F.col("p_type"),
        "l2": F.concat_ws("/", "p_type", "p_brand"),
        "l3": F.col("p_name"),
        "l4": F.lit(""),
        "l5": F.lit(""),
        "l6": F.lit(""),
    }
    tree = conform(part.select(*[c.alias(n) for n, c in codes.items()]), PRODUCT_TREE_ALT)
    lines = recent_lines(src.lines(spark, sf), AS_OF, CONFIG.line_months)
    joined = join_activity(
        lines, nodes_of(tree, key="tree_key"), account_parents(src.dim(spark, sf), trimmed=True)
    )
    return joined.select(
        "account_id", "opportunity_id", "status", "status_date", "node_code", "level", "parent_id"
    )


@query("SELECT * FROM eligible")
def eligible_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return eligible(src.master(spark, sf), src.roles(spark, sf))


@query("SELECT e.*, d.market_segment FROM eligible e LEFT JOIN dim d ON e.account_id = d.account_id")
def eligible_accounts_segment(spark: SparkSession, sf: str) -> DataFrame:
    return eligible(src.master(spark, sf), src.roles(spark, sf), src.dim(spark, sf))


@query("SELECT e.*, m.parent_id FROM eligible e JOIN master m ON e.account_id = m.account_id")
def eligible_accounts_parent(spark: SparkSession, sf: str) -> DataFrame:
    return eligible(src.master(spark, sf), src.roles(spark, sf), with_parent=True)


@query("SELECT account_id, parent_id FROM parents")
def account_parent(spark: SparkSession, sf: str) -> DataFrame:
    return account_parents(src.dim(spark, sf))


@query("SELECT account_id, parent_id FROM parents_trimmed")
def account_parent_trimmed(spark: SparkSession, sf: str) -> DataFrame:
    return account_parents(src.dim(spark, sf), trimmed=True)


def _buyers(spark: SparkSession, sf: str) -> DataFrame:
    lines = recent_lines(src.lines(spark, sf), AS_OF, CONFIG.line_months)
    return buyers_by_node(lines, nodes_of(src.tree(spark, sf)), known_accounts(spark, sf), CONFIG)


@query("SELECT node_code, level, buyers FROM buyers")
def candidate_products(spark: SparkSession, sf: str) -> DataFrame:
    return _buyers(spark, sf).orderBy(F.desc("buyers"), "node_code")


@query("SELECT product_id, l5, l6 FROM tree WHERE l5 LIKE '%.2001'")
def tree_of_a_year(spark: SparkSession, sf: str) -> DataFrame:
    """The products of one version of the hierarchy."""
    picked = product_tree(src.raw_tree(spark, sf), version=F.col("l5").endswith(f".{CONFIG.hierarchy_year}"))
    return picked.select("product_id", "l5", "l6")


@query(
    """SELECT node_code, level, buyers FROM buyers
WHERE level IN ('LEVEL3', 'LEVEL4', 'LEVEL5', 'LEVEL6', 'LEVEL7') AND node_code IS NOT NULL
ORDER BY buyers DESC, node_code"""
)
def candidate_levels(spark: SparkSession, sf: str) -> DataFrame:
    wanted = ("LEVEL3", "LEVEL4", "LEVEL5", "LEVEL6", "LEVEL7")
    return pick_candidates(_buyers(spark, sf), replace(CONFIG, candidate_levels=wanted))
