"""Feature fitting and encoding, fit on train and applied to all rows.

Semantics of the reference's preprocessor: median imputation, standard
scaling with the *population* std (std 0 -> 1), binary encoding of
categories numbered by first appearance (trap K8). Spark's ``Imputer`` and
``StandardScaler`` differ (element median, sample std), so the statistics
are plain aggregates. Fitted parameters are a handful of numbers per column
and are brought to the driver, as any ``pyspark.ml`` fit does; category
tables stay distributed and are joined (AQE broadcasts the small ones).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsense.operators.ranking import exact_medians, running_total
from tillsense.sources.tables import materialize

#: Columns with more categories are joined with them.
MAP_LIMIT = 128
SEPARATOR = "\x01"


@dataclass
class ColumnTransformModel:
    num_cols: list[str]
    cat_cols: list[str]
    medians: dict[str, float | None] = field(default_factory=dict)
    means: dict[str, float | None] = field(default_factory=dict)
    stds: dict[str, float | None] = field(default_factory=dict)
    digits: dict[str, int] = field(default_factory=dict)
    ordinals: DataFrame | None = None  # column_name, category, ordinal
    small: dict[str, dict[str, int]] = field(default_factory=dict)  # columns with few categories

    def output_columns(self) -> list[str]:
        return [f"num__{c}" for c in self.num_cols] + [
            f"cat__{c}_{k}" for c in self.cat_cols for k in range(self.digits.get(c, 1))
        ]


def fit_medians(train: DataFrame, num_cols: Sequence[str]) -> DataFrame:
    """Exact median per numeric column (column_name, median)."""
    return exact_medians(train, num_cols, out="median")


def fit_scaling(train: DataFrame, num_cols: Sequence[str], medians: dict[str, float | None]) -> DataFrame:
    """Mean and population std of the imputed columns, one pass, one row
    per column (column_name, mean, std)."""
    imputed = [F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c))).alias(c) for c in num_cols]
    x = train.select(*imputed)
    aggs = []
    for c in num_cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    wide = x.agg(*aggs)
    return wide.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
                    for c in num_cols
                ]
            )
        ).alias("s")
    ).select("s.*")


def n_digits(n_categories: int) -> int:
    """Binary digits for n categories: ceil(log2(n)) + 1 (the encoder's rule),
    computed with integers."""
    if n_categories <= 0:
        return 1
    return (n_categories - 1).bit_length() + 1


def _first_positions(rows: DataFrame, cat_cols: Sequence[str], order_col: str) -> DataFrame:
    """(column_name, category, first_pos) of every category."""
    long = rows.select(order_col, *[F.col(c).cast("string").alias(c) for c in cat_cols]).unpivot(
        [order_col], list(cat_cols), "column_name", "category"
    )
    return long.where(F.col("category").isNotNull()).groupBy("column_name", "category").agg(F.min(order_col).alias("first_pos"))


def fit_ordinals(train: DataFrame, cat_cols: Sequence[str], order_col: str = "row_id") -> DataFrame:
    """Category -> ordinal 1..n in order of first appearance in ``train``,
    for every categorical column at once (column_name, category, ordinal,
    n_categories)."""
    first = _first_positions(train, cat_cols, order_col)
    return running_total(first, ["column_name"], [F.col("first_pos")], out="ordinal", total_out="n_categories").drop("first_pos")


def fit_column_transform(
    train: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], order_col: str = "row_id"
) -> ColumnTransformModel:
    """I4 fit: medians -> scaling statistics -> category ordinals."""
    m = ColumnTransformModel(list(num_cols), list(cat_cols))
    if num_cols:
        m.medians = {r["column_name"]: r["median"] for r in fit_medians(train, num_cols).collect()}
        for c in num_cols:
            m.medians.setdefault(c, None)
        for r in fit_scaling(train, num_cols, m.medians).collect():
            m.means[r["column_name"]] = r["mean"]
            m.stds[r["column_name"]] = r["std"]
    if cat_cols:
        ords = fit_ordinals(train, cat_cols, order_col)
        # written once, a folder for each column: every category join of the transform reads its own
        m.ordinals = materialize(ords, "category_ordinals", partition_cols=["column_name"])
        counts = {r["column_name"]: r["n"] for r in m.ordinals.groupBy("column_name").agg(F.max("n_categories").alias("n")).collect()}
        m.digits = {c: n_digits(counts.get(c, 0)) for c in cat_cols}
        m.small = _small_columns(m.ordinals, {c: counts.get(c, 0) for c in cat_cols})
    return m


def _small_columns(ordinals: DataFrame, counts: dict[str, int]) -> dict[str, dict[str, int]]:
    """The categories of the columns with ``MAP_LIMIT`` at most, on the driver."""
    few = [c for c, n in counts.items() if n <= MAP_LIMIT]
    out: dict[str, dict[str, int]] = {c: {} for c in few}
    for r in ordinals.where(F.col("column_name").isin(few)).select("column_name", "category", "ordinal").collect() if few else []:
        out[r["column_name"]][r["category"]] = r["ordinal"]
    return {c: v for c, v in out.items() if not any(SEPARATOR in k for k in v)}


def _mapped(col: str, categories: dict[str, int]) -> Column:
    """The ordinal of a value by a constant map (NULL: none)."""
    if not categories:
        return F.lit(None).cast("bigint")
    keys = F.split(F.lit(SEPARATOR.join(categories)), SEPARATOR)
    values = F.split(F.lit(SEPARATOR.join(map(str, categories.values()))), SEPARATOR).cast("array<bigint>")
    return F.try_element_at(F.map_from_arrays(keys, values), F.col(col).cast("string"))


def extend_dictionary(rows: DataFrame, cat_cols: Sequence[str], path: str, version: str, order_col: str = "row_id") -> DataFrame:
    """The dictionary stored at ``path`` (column_name, category, ordinal), extended
    by the categories of ``rows`` that it does not have: these are numbered on
    from its greatest ordinal, in order of first appearance, and appended as
    ``version`` (storing a version again replaces its part only)."""
    spark = rows.sparkSession
    known = spark.createDataFrame([], "column_name string, category string, ordinal bigint")
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(sc._jsc.hadoopConfiguration()).exists(folder):
        known = spark.read.parquet(path).where(F.col("version") != version).select("column_name", "category", "ordinal")
    first = _first_positions(rows, cat_cols, order_col).join(known, ["column_name", "category"], "left_anti")
    numbered = running_total(first, ["column_name"], [F.col("first_pos")], out="ordinal")
    start = known.groupBy("column_name").agg(F.max("ordinal").alias("_start"))
    fresh = numbered.join(start, "column_name", "left").select(
        "column_name", "category", (F.col("ordinal") + F.coalesce("_start", F.lit(0))).cast("bigint").alias("ordinal"), F.lit(version).alias("version")
    )
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path)
    return spark.read.parquet(path).select("column_name", "category", "ordinal")


def with_dictionary(m: ColumnTransformModel, dictionary: DataFrame) -> ColumnTransformModel:
    """The model with the ordinals of a stored dictionary (and as many digits as
    these need)."""
    counts = {r["column_name"]: r["n"] for r in dictionary.groupBy("column_name").agg(F.max("ordinal").alias("n")).collect()}
    own = {c: counts.get(c, 0) for c in m.cat_cols}
    return replace(m, ordinals=dictionary, digits={c: n_digits(n) for c, n in own.items()}, small=_small_columns(dictionary, own))


def scaled(col: str, mean: float | None, std: float | None, median: float | None):
    """(x - mean) / std with median imputation, std 0 -> divisor 1."""
    x = F.coalesce(F.col(col).cast("double"), F.lit(median))
    div = F.lit(1.0 if (std is None or std == 0.0) else std)
    return (x - F.lit(mean)) / div


def transform(df: DataFrame, m: ColumnTransformModel, keep: Sequence[str] = (), derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """I4 apply: ``num__x`` scaled columns, then ``cat__x_k`` binary digits
    (most significant first, unseen/missing -> all zeros), then ``keep``.
    ``derive`` adds columns that ``df`` does not have: after the joins with the large
    dictionaries, whose exchanges the rows cross without them."""
    out = df
    large = [c for c in m.cat_cols if c not in m.small]
    for c in [*(c for c in large if c in df.columns), None, *(c for c in large if c not in df.columns)]:
        if c is None:
            out = derive(out) if derive else out
            continue
        o = m.ordinals.where(F.col("column_name") == c).select(
            F.col("category").alias(f"_cat_{c}"), F.col("ordinal").alias(f"_ord_{c}")
        )
        out = out.withColumn(f"_key_{c}", F.col(c).cast("string")).join(
            o, F.col(f"_key_{c}") == F.col(f"_cat_{c}"), "left"
        )
    out = out.withColumns({f"_ord_{c}": _mapped(c, m.small[c]) for c in m.cat_cols if c in m.small})
    cols = [scaled(c, m.means.get(c), m.stds.get(c), m.medians.get(c)).alias(f"num__{c}") for c in m.num_cols]
    for c in m.cat_cols:
        d = m.digits[c]
        ordc = F.coalesce(F.col(f"_ord_{c}"), F.lit(0)).cast("bigint")
        for k in range(d):
            cols.append(F.shiftright(ordc, d - 1 - k).bitwiseAND(F.lit(1)).cast("double").alias(f"cat__{c}_{k}"))
    return out.select(*[F.col(k) for k in keep], *cols)


def impute_median(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """I1 apply: NULL -> learned median."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in medians.items()})


def standardize(df: DataFrame, means: dict, stds: dict) -> DataFrame:
    """I2 apply."""
    return df.withColumns({c: scaled(c, means[c], stds[c], None) for c in means})


def scale_target(split: DataFrame, target: str = "quantity") -> DataFrame:
    """Target standardised with train mean and population std; the two
    statistics are scalar subqueries of the train rows."""
    train = split.where(F.col("split") == "train")
    stats = train.agg(F.struct(F.avg(target).alias("m"), F.stddev_pop(target).alias("s")).alias("st")).scalar()
    sd = F.when((stats.getField("s").isNull()) | (stats.getField("s") == 0), F.lit(1.0)).otherwise(stats.getField("s"))
    return split.withColumn(f"{target}_scaled", (F.col(target) - stats.getField("m")) / sd)
