"""Declared schemas of inputs and outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_S, _I, _L, _D, _DATE = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.DateType(),
)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


ACTIVITY_LINE = _schema(
    account_id=_S,
    opportunity_id=_S,
    phase=_S,
    phase_since=_I,
    phase_text=_S,
    status_ymd=_I,
    status=_S,
    status_date=_DATE,
    created_ts14=_L,
    product_id=_S,
    item_type=_S,
    created_date=_DATE,
)

LEVEL_COLUMNS = ("l1", "l2", "l3", "l4", "l5", "l6")
_LEVELS = {c: _S for n in LEVEL_COLUMNS for c in (n, f"{n}_text")}
PRODUCT_TREE = _schema(product_id=_S, product_text=_S, **_LEVELS)
PRODUCT_TREE_ALT = _schema(tree_key=_S, tree_text=_S, **_LEVELS)

ACCOUNT_DIM = _schema(account_id=_S, parent_id=_S, market_segment=_S)
ACCOUNT_MASTER = _schema(
    account_id=_S,
    master_code=_S,
    industry_code=_S,
    crm_segment=_S,
    internal_segment=_S,
    owner_flag=_S,
    target_class=_S,
    partner_kind=_S,
    activity_status=_S,
    parent_id=_S,
    not_released=_S,
    deleted=_S,
    blocked=_S,
)
ACCOUNT_ROLE = _schema(account_id=_S, role=_S)

SCORE = _schema(
    account_id=_S,
    score_date=_S,
    score=_D,
    product_code=_S,
    exclude=_I,
    logical_product=_I,
    percentile=_I,
    decile=_I,
)
SCORE_CONSULTING = T.StructType(
    SCORE.fields + [T.StructField(f"flag{i}", _I) for i in range(1, 6)]
)
CONVERSION = SCORE
CONVERSION_CONSULTING = SCORE_CONSULTING
HISTORY = _schema(account_id=_S, product_code=_S, conversion_date=_S)

SCORE_STATE = _schema(account_id=_S, product_code=_S, path=_S, state_key=_S, score=_D)

ROLLUP = _schema(
    scenario=_S,
    account_id=_S,
    score_date=_S,
    score=_D,
    product_code=_S,
    exclude=_I,
    logical_product=_I,
    percentile=_I,
    decile=_I,
)
INTEREST_CLASS = _schema(calc_date=_S, account_id=_S, raw_score=_D, interest_class=_S)
INTEREST_EXPORT = _schema(
    report_date=_S,
    account_id=_S,
    interest_class=_S,
    model_name=_S,
    model_id=_S,
    percentile=_I,
)
MODEL_REGISTRY = _schema(
    product_code=_S,
    level=_S,
    model_type=_S,
    path=_S,
    features=T.ArrayType(_S),
    settings=T.MapType(_S, _S),
    trained_on=_S,
)
MODEL_METRICS = _schema(
    product_code=_S,
    level=_S,
    class_label=_S,
    precision=_D,
    recall=_D,
    f1=_D,
    support=_L,
    accuracy=_D,
    auc_hard=_D,
    auc=_D,
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema``; absent columns become typed NULLs, a value that does not cast fails."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(f: T.StructField) -> str:
        kind, name = f.dataType.simpleString(), f"`{f.name}`"
        if f.name not in have:
            return f"CAST(NULL AS {kind}) AS {name}"
        return name if have[f.name] == f.dataType else f"CAST({name} AS {kind}) AS {name}"

    return df.selectExpr(*[column(f) for f in schema.fields])
