"""Ordered (unshuffled) train/validation/test splits.

The reference splits by file row order. Spark has no row order, so the
split uses the explicit total order of the rows (trap K7) and positions
from ``range_numbered`` (constant range bounds, no single-task window; the rows
cross one exchange with the columns that are asked for, and nothing is written).
Pass a stored table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsense.operators.ranking import range_numbered

# Fixed values of the reference split sizes.
GLOBAL_SPLIT_ROWS = 50000
PRODUCT_SPLIT_FRACTION = 0.2
PRODUCT_SPLIT_CAP = 500


def total_order(df: DataFrame, first: Sequence[str] = ("invoicedate", "invoiceno")) -> list[str]:
    """K7: time, invoice, then lineage keys when present, else every other column."""
    from tillsense.sources.retail import ORDER_KEYS

    lead = [c for c in first if c in df.columns]
    rest = [c for c in ORDER_KEYS if c in df.columns] or [c for c in df.columns if c not in lead]
    return lead + rest


def _n_test(n: Column, size: float | int) -> Column:
    if isinstance(size, float) and size < 1:
        return F.ceil(n * F.lit(size)).cast("bigint")
    return F.lit(int(size)).cast("bigint")


def ordered_split_global(
    df: DataFrame,
    order_cols: Sequence[str],
    test_size: float | int = GLOBAL_SPLIT_ROWS,
    val_size: float | int | None = None,
) -> DataFrame:
    """Last ``test_size`` rows -> test, the ``val_size`` rows before -> val,
    the rest -> train. Sizes are row counts (int) or fractions (float < 1,
    rounded up, the validation fraction taken of the remaining rows).
    Adds ``row_id`` (1-based position) and ``split``.
    """
    val_size = test_size if val_size is None else val_size
    ranked = range_numbered(df, [], order_cols, out="row_id", total_out="_n")
    n_test = _n_test(F.col("_n"), test_size)
    n_tv = F.col("_n") - n_test
    n_val = _n_test(n_tv, val_size)
    split = (
        F.when(F.col("row_id") > n_tv, F.lit("test"))
        .when(F.col("row_id") > n_tv - n_val, F.lit("val"))
        .otherwise(F.lit("train"))
    )
    return ranked.withColumn("split", split).drop("_n")


def ordered_split_by_product(
    df: DataFrame,
    order_cols: Sequence[str],
    fraction: float = PRODUCT_SPLIT_FRACTION,
    cap: int = PRODUCT_SPLIT_CAP,
) -> DataFrame:
    """Per product, size = int(min(fraction*n, cap)); the last ``size`` rows
    are test, the ``size`` before are val, the rest train. Adds ``pos``
    (1-based position inside the product) and ``split``."""
    ranked = range_numbered(df, ["stockcode"], order_cols, out="pos", total_out="_n")
    size = F.floor(F.least(F.col("_n") * F.lit(fraction), F.lit(float(cap)))).cast("bigint")
    split = (
        F.when(F.col("pos") > F.col("_n") - size, F.lit("test"))
        .when(F.col("pos") > F.col("_n") - 2 * size, F.lit("val"))
        .otherwise(F.lit("train"))
    )
    return ranked.withColumn("split", split).drop("_n")


def union_train_val(split: DataFrame) -> DataFrame:
    """Rows for the final refit (train and val); a filter, not a union."""
    return split.where(F.col("split").isin("train", "val"))
