"""Per-product imputation tables for all products at once.

The reference loops over products in Python and filters the whole table
each time; here each table is one grouped aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsense.operators.ranking import exact_median, last_by, mode_by

DAY_SECONDS = 86400
LTM_DAYS = 365


def customer_activity(features: DataFrame) -> DataFrame:
    """K13 [choice]: per-row customer measures the reference expects but never
    builds: days since the customer's previous purchase day, spend and
    number of invoices over the last 365 days (this day included).

    Rows are pre-aggregated to one per (customer, day) before the window, so
    even the 'unknown' customer holds at most one row per calendar day.
    """
    day = F.floor(F.col("invoicedate") / DAY_SECONDS).cast("bigint")
    # quantity is log1p(units); units are whole numbers of items
    units = F.round(F.exp(F.col("quantity")) - F.lit(1.0), 0)
    # money is summed as DECIMAL: exact, so independent of summation order
    spend = (units * F.col("unitprice")).cast("decimal(38,8)")
    daily = (
        features.withColumn("day", day)
        .groupBy("customerid", "day")
        .agg(
            F.sum(spend).alias("_spend"),
            F.count_distinct("invoiceno").alias("_invoices"),
        )
    )
    by_day = Window.partitionBy("customerid").orderBy("day")
    ltm = by_day.rangeBetween(-(LTM_DAYS - 1), 0)
    measures = daily.select(
        "customerid",
        "day",
        (F.col("day") - F.lag("day", 1).over(by_day)).cast("double").alias("customer_recency_days"),
        F.sum("_spend").over(ltm).cast("double").alias("customer_total_spend_ltm"),
        F.sum("_invoices").over(ltm).alias("customer_freq_ltm"),
    )
    return features.withColumn("day", day).join(measures, ["customerid", "day"], "left").drop("day")


def product_price_stats(
    features: DataFrame,
    order_cols: Sequence[str],
    measure: str = "product_avg_quantity_last_month",
) -> DataFrame:
    """Per product: median, max, min price, modal country and the last
    value of ``measure`` under the total row order."""
    mm = features.groupBy("stockcode").agg(
        F.max("unitprice").alias("unitprice_max"),
        F.min("unitprice").alias("unitprice_min"),
    )
    med = exact_median(features, "unitprice", ["stockcode"], out="unitprice_median")
    mode = mode_by(features, ["stockcode"], "country", out="country")
    last = last_by(features, ["stockcode"], [measure], order_cols)
    return (
        mm.join(med, "stockcode", "left")
        .join(mode, "stockcode", "left")
        .join(last, "stockcode", "left")
        .select("stockcode", "unitprice_median", "unitprice_max", "unitprice_min", "country", measure)
    )


def customer_latest_by_product(activity: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """Per (product, customer) the last recency, spend and frequency."""
    last = last_by(
        activity,
        ["stockcode", "customerid"],
        ["customer_recency_days", "customer_total_spend_ltm", "customer_freq_ltm"],
        order_cols,
    )
    return last.select(
        "stockcode",
        "customerid",
        F.col("customer_recency_days").alias("customer_recency_days_latest"),
        F.col("customer_total_spend_ltm").alias("customer_total_spend_ltm_latest"),
        F.col("customer_freq_ltm").alias("customer_freq_ltm_latest"),
    )


def distinct_products(features: DataFrame) -> DataFrame:
    """The product keys that drove the reference's per-product loop."""
    return features.select("stockcode").distinct()


def cross_stats_customers(stats: DataFrame, latest: DataFrame) -> DataFrame:
    """C4: one stats row x the latest row of each customer, per product.

    The reference's per-product cross join becomes an equi-join on the
    product key: output size is the number of (product, customer) pairs
    that exist, never products x customers.
    """
    return stats.join(latest, "stockcode", "inner")


def last_value_per_group(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Last row values per group (``max_by`` over the total order)."""
    return last_by(df, group_cols, value_cols, order_cols)
