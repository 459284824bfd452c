"""Projections, filters and predicates on transaction rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsense.functions.exprs import (
    missing_to_null,
    month_start,
    not_in_keep_null,
    safe_ratio,
)

# Product codes the reference removes, and when.
ADMIN_CODES_PRE = ["B", "CRUK", "C2"]
ADMIN_CODES_POST = ["D", "S"]
# Integer-typed columns that are categorical by name.
CATEGORICAL_BY_NAME = ["is_registered", "is_return", "year", "year_month"]
NUMERIC_TYPES = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def normalize_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """B1: textual missing tokens -> NULL in string columns (trap K1)."""
    targets = columns or df.columns
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    exprs = {c: missing_to_null(c) for c in targets if c in strings}
    return df.withColumns(exprs) if exprs else df


def canonical_stockcode(df: DataFrame) -> DataFrame:
    """B2: code 'm' -> 'M'."""
    return df.withColumn("stockcode", F.when(F.col("stockcode") == "m", F.lit("M")).otherwise(F.col("stockcode")))


def drop_codes(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Drop listed product codes, keep NULL codes (trap K3)."""
    return df.where(not_in_keep_null("stockcode", codes))


def drop_admin_codes_pre(df: DataFrame) -> DataFrame:
    return drop_codes(df, ADMIN_CODES_PRE)


def drop_admin_codes_post(df: DataFrame) -> DataFrame:
    return drop_codes(df, ADMIN_CODES_POST)


def prune_columns(df: DataFrame, columns: Sequence[str] = ("description", "month_name")) -> DataFrame:
    """Drop helper/unused columns that are present."""
    return df.drop(*[c for c in columns if c in df.columns])


def calendar_features(df: DataFrame, ts_col: str = "invoicedate") -> DataFrame:
    """Timestamp (bad -> NULL), year, month period, month and weekday names."""
    ts = F.col(ts_col)
    dtype = df.schema[ts_col].dataType
    if isinstance(dtype, T.StringType):
        ts = F.try_to_timestamp(ts).cast("timestamp_ntz")
    else:
        ts = ts.cast("timestamp_ntz")
    return df.withColumn(ts_col, ts).withColumns(
        {
            "year": F.year(ts_col),
            "month": month_start(ts_col),
            "month_name": F.date_format(ts_col, "MMM"),
            "day_of_week": F.date_format(ts_col, "EEE"),
        }
    )


def positive_quantity(df: DataFrame) -> DataFrame:
    """Numeric coercion, NULL -> 0, keep quantity > 0."""
    q = F.coalesce(F.col("quantity").try_cast("double"), F.lit(0.0))
    return df.withColumn("quantity", q).where(F.col("quantity") > 0)


def price_ratio_features(df: DataFrame) -> DataFrame:
    """Price / all-time max and price / last-month quantity, 0 at a zero divisor."""
    return df.withColumns(
        {
            "unitprice_vs_max": safe_ratio("unitprice", "product_max_price_all_time"),
            "unitprice_to_avg": safe_ratio("unitprice", "product_avg_quantity_last_month"),
        }
    )


def price_shape_features(df: DataFrame) -> DataFrame:
    """Square and log1p of the (not yet imputed) price."""
    p = F.col("unitprice")
    return df.withColumns({"unitprice_squared": p * p, "unitprice_log": F.log1p(p)})


def log_target(df: DataFrame, col: str = "quantity") -> DataFrame:
    """log1p(quantity + 0)."""
    return df.withColumn(col, F.log1p(F.col(col) + F.lit(0.0)))


def registered_flag(df: DataFrame) -> DataFrame:
    """1 when a customer id is present; id NULL -> 'unknown'."""
    return df.withColumns(
        {
            "is_registered": F.col("customerid").isNotNull().cast("int"),
            "customerid": F.coalesce(F.col("customerid").cast("string"), F.lit("unknown")),
        }
    )


def fill_unknown_keys(df: DataFrame) -> DataFrame:
    """NULL keys -> 'unknown'."""
    return df.fillna("unknown", subset=[c for c in ("customerid", "stockcode", "invoiceno") if c in df.columns])


def filter_product(df: DataFrame, stockcode: str) -> DataFrame:
    """Equality filter on the stored code (pushed to the Parquet scan)."""
    return df.where(F.col("stockcode") == F.lit(stockcode))


def column_roles(df: DataFrame, target_col: str = "quantity", exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric / categorical roles from the schema (B14 rule)."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name == target_col or f.name in exclude:
            continue
        if isinstance(f.dataType, NUMERIC_TYPES):
            (cat if f.name in CATEGORICAL_BY_NAME else num).append(f.name)
        elif isinstance(f.dataType, T.StringType):
            cat.append(f.name)
    return num, cat


def column_profile(df: DataFrame, target_col: str = "quantity", exclude: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """One row per column: role and number of distinct values.

    Exact counts take one aggregate per column, each from a scan of that
    column alone (pass a stored table). ``approx=True`` uses HyperLogLog
    sketches of all columns in one pass (bounded memory at any scale).
    """
    num, cat = column_roles(df, target_col, exclude)
    roles = {c: "numeric" for c in num} | {c: "categorical" for c in cat}

    def row(c: str, n) -> list:
        return [F.lit(c).alias("column_name"), F.lit(roles[c]).alias("role"), n.cast("bigint").alias("n_distinct")]

    if approx:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in roles])
        return wide.select(F.explode(F.array(*[F.struct(*row(c, F.col(c))) for c in roles])).alias("r")).select("r.*")
    return reduce(DataFrame.unionByName, [df.agg(F.count_distinct(c).alias("n")).select(*row(c, F.col("n"))) for c in roles])


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric coercion, bad values -> NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def split_features_target(df: DataFrame, target_col: str = "quantity") -> tuple[DataFrame, DataFrame]:
    """X = every column but the target, y = the target (same frame, two projections)."""
    return df.drop(target_col), df.select(target_col)
