"""Training and scoring sets: spine, sampling, encoding, splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlift import config as fixed
from leadlift.config import RunConfig
from leadlift.functions.hashing import hash_below, hash_limit, hash_uniform

NO_PERIOD = 0  # stands for the missing period of a non-buyer in the reference spine


def active_accounts(accounts: DataFrame, year_rows: DataFrame) -> DataFrame:
    """Accounts with open activity in any year window."""
    return accounts.join(year_rows.select("account_id").distinct(), "account_id", "left_semi")


def spine(accounts: DataFrame, config: RunConfig) -> DataFrame:
    """Rows that can carry a label, the same for every product.

    ``accounts_x_periods`` gives each account every period. ``reference`` gives it
    one row without a period, which is what an account that never bought gets.
    """
    if config.spine == "accounts_x_periods":
        periods = F.explode(F.sequence(F.lit(1), F.lit(config.periods)))
        return accounts.withColumn("period", periods)
    if config.spine == "reference":
        return accounts.withColumn("period", F.lit(NO_PERIOD))
    raise ValueError(f"unknown spine {config.spine!r}")


def product_keys(products: list[tuple[str, str]]) -> list[str]:
    """Level and code of each (code, level) pair in one key; codes may recur over levels."""
    return [f"{level}|{code}" for code, level in products]


def _product_key() -> Column:
    return F.concat_ws("|", "level", "node_code").alias("product_key")


def labelled_spine(
    accounts: DataFrame, labels: DataFrame, products: list[tuple[str, str]], config: RunConfig
) -> DataFrame:
    """The spine once per product with its label: buyers 1, the rest 0.

    In the reference spine a buyer has a row per buying period, and every other
    account one row without a period.
    """
    names = F.array(*[F.lit(n) for n in product_keys(products)])
    bought = labels.select(_product_key(), "account_id", "period", F.col("label").alias("_label"))
    if config.spine == "reference":
        base = accounts.withColumn("product_key", F.explode(names))
        joined = base.join(bought, ["product_key", "account_id"], "left")
        period = F.coalesce("period", F.lit(NO_PERIOD)).alias("period")
    else:
        base = spine(accounts, config).withColumn("product_key", F.explode(names))
        joined = base.join(bought, ["product_key", "account_id", "period"], "left")
        period = F.col("period")
    return joined.select(
        *accounts.columns, "product_key", period, F.coalesce("_label", F.lit(0)).alias("label")
    )


def keep_fraction() -> Column:
    """Share of negatives to keep for a row's stratum; NULL strata keep none."""
    status, target = F.col("activity_status"), F.col("target_class")
    active = status.isin(*fixed.ACTIVE_STATUSES)
    groups = {
        "C/O/blank": target.isin("C", "O", ""),
        "P": target == "P",
        "other": ~target.isin("C", "O", "", "P"),
    }
    out = None
    for (activity, target_group), share in fixed.SAMPLING_FRACTIONS.items():
        hit = (active if activity == "active" else ~active) & groups[target_group]
        out = F.when(hit, share) if out is None else out.when(hit, share)
    return out.otherwise(0.0)


def stratified_sample(rows: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Every positive, and negatives at the rate of their stratum."""
    draw = hash_uniform(*keys, seed=seed)
    return rows.filter((F.col("label") == 1) | (draw < keep_fraction()))


def training_rows(
    accounts: DataFrame,
    labels: DataFrame,
    products: list[tuple[str, str]],
    config: RunConfig,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """Sampled rows of all products at once: product_code, account_id, period, label.

    ``products`` are (code, level) pairs. Each spine row
    draws which products keep it as a negative, so rows that are sampled away are
    never built; buyers are taken out of the negatives and added in full.
    With ``vectors`` rows carry their feature vector, or what else stands there by account and period. Both joins come before a spine row is
    unfolded into its products: what is shuffled and written does not grow with their number, and neither does what is
    computed of a spine row or a vector. Of a product and a spine row one hash is made and compared.
    """
    names = product_keys(products)
    positives = labels.select(_product_key(), "level", F.col("node_code").alias("product_code"), "account_id", "period").filter(
        F.col("product_key").isin(*names)
    )
    positives = positives.join(accounts.select("account_id"), "account_id", "left_semi")
    at = ["account_id"] + (["period"] if config.spine != "reference" else [])
    # At most one entry per product.
    taken = positives.groupBy(*at).agg(F.collect_set("product_key").alias("_taken"))
    limit, head = hash_limit(keep_fraction()).alias("_limit"), F.concat_ws("|", "account_id", F.col("period").cast("string")).alias("_head")
    # What no product can keep is left out before it meets a vector.
    base = spine(accounts, config).select("account_id", "period", limit, head).filter("_limit IS NOT NULL")
    base = base.join(taken, at, "left")
    carried = []
    if vectors is not None:
        base, positives = attach_vectors(base, vectors), attach_vectors(positives, vectors)
        carried = [c for c in vectors.columns if c not in ("account_id", "period")]
    keyed = [F.struct(F.lit(n).alias("product_key"), F.lit(v).alias("level"), F.lit(c).alias("product_code")) for n, (c, v) in zip(names, products)]
    every = F.array(*keyed).cast("array<struct<product_key:string,level:string,product_code:string>>")  # there may be none
    drawn = base.withColumn("_p", F.explode(every)).filter(hash_below(F.col("_limit"), "_head", "_p.product_key", seed=config.seed))
    negatives = drawn.filter(~F.coalesce(F.array_contains("_taken", F.col("_p.product_key")), F.lit(False)))
    rows = ["level", "product_code", "account_id", "period", "label", *carried]
    negatives = negatives.withColumn("label", F.lit(0)).select("_p.level", "_p.product_code", *rows[2:])
    return negatives.unionByName(positives.withColumn("label", F.lit(1)).select(*rows))


def hash_split(rows: DataFrame, keys: list[str], fraction: float, seed: int) -> DataFrame:
    """Add ``is_train``; a key is always on the same side.

    The draw is not the one that sampling makes from the same keys and seed.
    """
    return rows.withColumn("is_train", hash_uniform(*keys, F.lit("split"), seed=seed) < fraction)


def join_blocks(base: DataFrame, blocks: list[DataFrame], keys: list[str]) -> DataFrame:
    """Left join wide feature blocks, missing numbers 0."""
    return reduce(lambda df, block: df.join(block, keys, "left"), blocks, base).na.fill(0)


def category_values(accounts: DataFrame, column: str) -> list[str]:
    """Sorted values of a code column, each of which becomes a feature."""
    return sorted(r[0] for r in accounts.select(column).filter(F.col(column).isNotNull()).distinct().collect())


def one_hot(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """A 0/1 column per value."""
    return df.select(
        "*",
        *[
            F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{column}_{v}")
            for v in values
        ],
    )


def branch_features(branch: DataFrame, prefixes: tuple[str, ...]) -> DataFrame:
    """(product_code, feature) pairs that a product's model must not see."""
    return branch.select(
        "product_code",
        F.explode(
            F.array(*[F.concat(F.lit(p), F.col("node_code")) for p in prefixes])
        ).alias("feature"),
    )


def attach_vectors(rows: DataFrame, vectors: DataFrame) -> DataFrame:
    """Rows with their feature vector; the vector does not depend on the product.

    Both sides have a row per account and period. Spark would guess the rows' size from the accounts'
    file, before periods are unfolded, and pass them whole through the driver.
    """
    return rows.join(vectors.hint("merge"), ["account_id", "period"], "inner")
