"""The driver's tables seen as the engine's inputs, in Spark and in SQL.

Each Spark function here has a same-named SQL view in ``VIEWS``; the two are written
separately and must agree.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadlift.config import RunConfig
from leadlift.plans.inputs import Inputs
from leadlift.sources.readers import product_tree
from leadlift.sources.schemas import (
    ACCOUNT_DIM,
    ACCOUNT_MASTER,
    ACCOUNT_ROLE,
    ACTIVITY_LINE,
    PRODUCT_TREE,
    conform,
)

AS_OF = date(2001, 8, 15)
FEATURE_LEVEL = "LEVEL2"

CONFIG = RunConfig(
    as_of=AS_OF,
    hierarchy_year="2001",
    open_statuses=("O", "P"),
    won_statuses=("F",),
    consulting_item_types=("R",),
    feature_level=FEATURE_LEVEL,
    candidate_levels=("LEVEL1",),
)


_schemas: dict[str, StructType] = {}
_line_counts: dict[str, int] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file once."""
    path = f"{sf}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


#: Lines that one task of a shuffle gets about; adaptive execution joins tasks that turn out small.
LINES_PER_TASK = 250_000
_JOINED_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Bytes that a task reads, of shuffled rows that adaptive execution joins or of a written table,
#: where the session has Spark's own numbers. A task's tables take 50 times that or more.
TASK_BYTES = {
    _JOINED_SIZE: ("64MB", "67108864b"),
    "spark.sql.files.maxPartitionBytes": ("128MB", "134217728b"),
}


def deal_by_size(spark: SparkSession, sf: str) -> None:
    """Let shuffles and scans have as many tasks as the lines ask for, and never fewer than the session says.

    With a fixed number a task's memory would grow with the table. So it would with a large number
    of tasks of which adaptive execution joins many, as it does up to 64 MB of shuffled rows.
    """
    path = f"{sf}/lineitem.parquet"
    if path not in _line_counts:
        _line_counts[path] = table(spark, sf, "lineitem").count()  # from the file's footers
    tasks = -(-_line_counts[path] // LINES_PER_TASK)
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    if tasks > 1:
        for size, usual in TASK_BYTES.items():
            if spark.conf.get(size) in usual:
                spark.conf.set(size, "8MB")


def lines(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """Opportunity lines; ``more`` are columns of the driver's tables to carry along."""
    deal_by_size(spark, sf)
    day = F.to_date("o_orderdate")
    ymd = F.year(day) * 10000 + F.month(day) * 100 + F.day(day)
    joined = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    schema = StructType([*ACTIVITY_LINE.fields, *[joined.schema[c] for c in more]])
    return conform(
        joined.select(
            *more,
            F.col("o_custkey").cast("string").alias("account_id"),
            F.col("o_orderkey").cast("string").alias("opportunity_id"),
            ymd.alias("status_ymd"),
            F.col("o_orderstatus").alias("status"),
            day.alias("status_date"),
            (ymd.cast("long") * 1000000).alias("created_ts14"),
            (F.col("l_partkey") + 1).cast("string").alias("product_id"),
            F.col("l_returnflag").alias("item_type"),
            day.alias("created_date"),
        ),
        schema,
    )


def raw_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Six levels over parts; some paths stop early, with '' or a single blank."""
    brand_no = F.substring("p_brand", 7, 9).cast("int")
    group = F.concat(F.lit("G"), (F.floor((brand_no - 1) / 5) + 1).cast("string"))
    kind = F.concat_ws("-", "p_brand", "p_type")
    sized = F.concat_ws("-", kind, F.when(F.col("p_size") <= 25, "S").otherwise("L"))
    prefix = (
        F.when(F.col("p_type").isin("STANDARD", "SMALL", "MEDIUM"), "LPR-")
        .when(F.col("p_type") == "ECONOMY", "PRD-")
        .otherwise("LSV-")
    )
    year = F.when(F.col("p_size") > 45, ".2000").otherwise(".2001")
    priced = F.when(F.col("p_retailprice") < 950, "A").otherwise("B")
    noun = F.substring_index("p_name", " ", -1)
    codes = {
        "l1": group,
        "l2": F.col("p_brand"),
        "l3": kind,
        "l4": sized,
        "l5": F.concat(prefix, sized, year),
        "l6": F.when(noun == "gear", "")
        .when(noun == "bolt", " ")
        .otherwise(F.concat(prefix, sized, F.lit("-"), priced, year)),
    }
    return conform(
        table(spark, sf, "part").select(
            F.lpad((F.col("p_partkey") + 1).cast("string"), 12, "0").alias("product_id"),
            F.col("p_name").alias("product_text"),
            *[c.alias(n) for n, c in codes.items()],
            *[F.concat(F.lit("Text "), c).alias(f"{n}_text") for n, c in codes.items()],
        ),
        PRODUCT_TREE,
    )


def tree(spark: SparkSession, sf: str) -> DataFrame:
    return product_tree(raw_tree(spark, sf))


def master(spark: SparkSession, sf: str) -> DataFrame:
    bal, nation = F.col("c_acctbal"), F.col("c_nationkey")
    return conform(
        table(spark, sf, "customer").select(
            F.col("c_custkey").cast("string").alias("account_id"),
            F.substring("c_mktsegment", 1, 1).alias("master_code"),
            F.concat(F.lit("I"), nation).alias("industry_code"),
            F.substring("c_mktsegment", 2, 2).alias("crm_segment"),
            F.when(bal > 9500, "")
            .when(F.col("c_mktsegment") == "MACHINERY", "01")
            .otherwise(F.substring("c_mktsegment", 1, 2))
            .alias("internal_segment"),
            F.when(bal > 0, "Y").otherwise("N").alias("owner_flag"),
            F.when(bal < 0, F.lit(None).cast("string"))
            .when(bal < 2000, "C")
            .when(bal < 4000, "O")
            .when(bal < 5000, "")
            .when(bal < 7000, "P")
            .otherwise("T")
            .alias("target_class"),
            F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXY"), nation + 1, F.lit(1)).alias("partner_kind"),
            F.when(nation < 8, "E0004")
            .when(nation < 12, "E0006")
            .when(nation < 20, "E0001")
            .when(nation < 22, "E0008")
            .alias("activity_status"),
            F.concat(F.lit("N"), nation).alias("parent_id"),
            F.when(bal < -900, "X").otherwise("").alias("not_released"),
            F.when((bal >= -900) & (bal < -800), "X").otherwise("").alias("deleted"),
            F.when(bal > 9900, "X").otherwise("").alias("blocked"),
        ),
        ACCOUNT_MASTER,
    )


def roles(spark: SparkSession, sf: str) -> DataFrame:
    """No role for nation 7, the excluded one for nation 3, a second for high balances."""
    held = F.array_compact(
        F.array(
            F.when(F.col("c_nationkey") == 3, "BUP004").when(F.col("c_nationkey") != 7, "BUP001"),
            F.when(F.col("c_acctbal") > 5000, "BUP002"),
        )
    )
    return conform(
        table(spark, sf, "customer").select(
            F.col("c_custkey").cast("string").alias("account_id"), F.explode(held).alias("role")
        ),
        ACCOUNT_ROLE,
    )


def dim(spark: SparkSession, sf: str) -> DataFrame:
    bal = F.col("c_acctbal")
    return conform(
        table(spark, sf, "customer").select(
            F.col("c_custkey").cast("string").alias("account_id"),
            F.when(bal < 1000, "")
            .otherwise(F.concat(F.lit(" N"), "c_nationkey", F.lit(" ")))
            .alias("parent_id"),
            F.when(bal < 2000, "N/R")
            .when(bal < 3000, "N/A")
            .when(bal < 3500, F.lit(None).cast("string"))
            .otherwise(F.col("c_mktsegment"))
            .alias("market_segment"),
        ),
        ACCOUNT_DIM,
    )


def inputs(spark: SparkSession, sf: str) -> Inputs:
    return Inputs(lines(spark, sf), tree(spark, sf), master(spark, sf), roles(spark, sf), dim(spark, sf))


# --- the same in DuckDB SQL; each entry may use the ones before it ---

_TARGET = "p_type IN ('STANDARD', 'SMALL', 'MEDIUM')"
_PREFIX = f"CASE WHEN {_TARGET} THEN 'LPR-' WHEN p_type = 'ECONOMY' THEN 'PRD-' ELSE 'LSV-' END"
_L4 = "p_brand || '-' || p_type || '-' || CASE WHEN p_size <= 25 THEN 'S' ELSE 'L' END"
_YEAR = "CASE WHEN p_size > 45 THEN '.2000' ELSE '.2001' END"
_L6 = f"""CASE split_part(p_name, ' ', -1) WHEN 'gear' THEN '' WHEN 'bolt' THEN ' '
     ELSE {_PREFIX} || {_L4} || '-' || CASE WHEN p_retailprice < 950 THEN 'A' ELSE 'B' END || {_YEAR} END"""

VIEWS: dict[str, str] = {
    "lines": """
SELECT CAST(o_custkey AS VARCHAR) AS account_id, CAST(o_orderkey AS VARCHAR) AS opportunity_id,
       CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS status_ymd, o_orderstatus AS status,
       CAST(o_orderdate AS DATE) AS status_date,
       CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) * 1000000 AS created_ts14,
       CAST(l_partkey + 1 AS VARCHAR) AS product_id, l_returnflag AS item_type,
       CAST(o_orderdate AS DATE) AS created_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "tree": f"""
SELECT product_id, product_text, l1, l2, l3, l4, l5, l6,
       'Text ' || l1 AS l1_text, 'Text ' || l2 AS l2_text, 'Text ' || l3 AS l3_text,
       'Text ' || l4 AS l4_text, 'Text ' || l5 AS l5_text, 'Text ' || l6 AS l6_text
FROM (SELECT ltrim(lpad(CAST(p_partkey + 1 AS VARCHAR), 12, '0'), '0') AS product_id,
             p_name AS product_text,
             'G' || CAST((CAST(substr(p_brand, 7) AS INTEGER) - 1) // 5 + 1 AS VARCHAR) AS l1,
             p_brand AS l2, p_brand || '-' || p_type AS l3, {_L4} AS l4,
             {_PREFIX} || {_L4} || {_YEAR} AS l5, {_L6} AS l6
      FROM part)""",
    "nodes": """
SELECT product_id, l1 AS node_code, l1_text AS node_text, 'LEVEL1' AS level FROM tree
UNION ALL SELECT product_id, l2, l2_text, 'LEVEL2' FROM tree
UNION ALL SELECT product_id, l3, l3_text, 'LEVEL3' FROM tree
UNION ALL SELECT product_id, l4, l4_text, 'LEVEL4' FROM tree
UNION ALL SELECT product_id, l5, l5_text, 'LEVEL5' FROM tree
UNION ALL SELECT product_id, l6, l6_text, 'LEVEL6' FROM tree""",
    "master": """
SELECT CAST(c_custkey AS VARCHAR) AS account_id, substr(c_mktsegment, 1, 1) AS master_code,
       'I' || CAST(c_nationkey AS VARCHAR) AS industry_code, substr(c_mktsegment, 2, 2) AS crm_segment,
       CASE WHEN c_acctbal > 9500 THEN '' WHEN c_mktsegment = 'MACHINERY' THEN '01'
            ELSE substr(c_mktsegment, 1, 2) END AS internal_segment,
       CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS owner_flag,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 2000 THEN 'C' WHEN c_acctbal < 4000 THEN 'O'
            WHEN c_acctbal < 5000 THEN '' WHEN c_acctbal < 7000 THEN 'P' ELSE 'T' END AS target_class,
       chr(65 + c_nationkey) AS partner_kind,
       CASE WHEN c_nationkey < 8 THEN 'E0004' WHEN c_nationkey < 12 THEN 'E0006'
            WHEN c_nationkey < 20 THEN 'E0001' WHEN c_nationkey < 22 THEN 'E0008' END AS activity_status,
       'N' || CAST(c_nationkey AS VARCHAR) AS parent_id,
       CASE WHEN c_acctbal < -900 THEN 'X' ELSE '' END AS not_released,
       CASE WHEN c_acctbal >= -900 AND c_acctbal < -800 THEN 'X' ELSE '' END AS deleted,
       CASE WHEN c_acctbal > 9900 THEN 'X' ELSE '' END AS blocked
FROM customer""",
    "roles": """
SELECT CAST(c_custkey AS VARCHAR) AS account_id,
       CASE WHEN c_nationkey = 3 THEN 'BUP004' ELSE 'BUP001' END AS role
FROM customer WHERE c_nationkey <> 7
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), 'BUP002' FROM customer WHERE c_acctbal > 5000""",
    "dim": """
SELECT CAST(c_custkey AS VARCHAR) AS account_id,
       CASE WHEN c_acctbal < 1000 THEN '' ELSE ' N' || CAST(c_nationkey AS VARCHAR) || ' ' END AS parent_id,
       CASE WHEN c_acctbal < 2000 THEN 'N/R' WHEN c_acctbal < 3000 THEN 'N/A'
            WHEN c_acctbal < 3500 THEN NULL ELSE c_mktsegment END AS market_segment
FROM customer""",
    "eligible": """
SELECT DISTINCT m.account_id, m.master_code, m.industry_code, m.crm_segment, m.internal_segment,
       m.owner_flag, m.target_class, m.partner_kind, m.activity_status
FROM master m LEFT JOIN roles r ON m.account_id = r.account_id
WHERE m.partner_kind NOT IN ('A', 'L', 'U', 'X', 'Y') AND m.account_id <> ''
  AND m.internal_segment NOT IN ('01', '') AND m.not_released <> 'X' AND m.deleted <> 'X'
  AND m.blocked <> 'X' AND r.role <> 'BUP004'""",
    "recent": "SELECT * FROM lines WHERE status_date > DATE '1998-04-15'",
    "activity": """
SELECT r.*, n.node_code, n.node_text, n.level
FROM recent r JOIN nodes n ON r.product_id = n.product_id JOIN dim d ON r.account_id = d.account_id
WHERE trim(n.node_code) <> ''""",
}
