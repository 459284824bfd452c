"""Data drift between a reference and a current table, per product and
column (L1-L5, D16).

The reference delegates to a drift library and reads only the count and
share of drifted columns; the tests here follow that library's documented
tests [choice]: for numeric columns the two-sample KS test or the normed
Wasserstein distance, for categorical ones the chi-square test or the
Jensen-Shannon distance. Which of the two decides is a parameter, the same
for every group whatever its size; both are reported. Every statistic is a Spark plan:
distinct values with counts, running totals over the value order (range
partitioned, see ``ranking``), joins on keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsense.operators.ranking import HOT_ROWS, hot_groups, running_total, spread_by

# Fixed values of the drift tests.
KS_ALPHA_COEF = 1.3581  # sqrt(-ln(0.05/2)/2): asymptotic two-sample KS critical constant at alpha=0.05
CHI2_Z = 1.6448536  # standard normal 0.95 quantile: chi-square critical value at alpha=0.05 (Wilson-Hilferty)
WASSERSTEIN_THRESHOLD = 0.1
WASSERSTEIN_MIN_STD = 0.001
JS_THRESHOLD = 0.1


class DriftDetected(RuntimeError):
    pass


def _long(df: DataFrame, group: Sequence[str], cols: Sequence[str], cast: str) -> DataFrame:
    """(group..., column_name, value) rows; a column may also be a group key."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(cast).alias("value")) for c in cols])
    return df.select(*group, F.explode(pairs).alias("_p")).select(*group, "_p.column_name", "_p.value")


def _sides(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of both tables with what they count for either."""
    sides = [df.select(*columns, F.lit(ref).cast("bigint").alias("c_ref"), F.lit(1 - ref).cast("bigint").alias("c_cur")) for df, ref in ((reference, 1), (current, 0))]
    return sides[0].unionByName(sides[1])


def _numeric_counts(rows: DataFrame, group: Sequence[str], cols: Sequence[str]) -> DataFrame:
    long = _long(rows, [*group, "c_ref", "c_cur"], cols, "double").where(F.col("value").isNotNull() & ~F.isnan("value"))
    return long.groupBy(*group, "column_name", "value").agg(F.sum("c_ref").alias("c_ref"), F.sum("c_cur").alias("c_cur")).withColumn("one", F.lit(1).cast("bigint"))


_SUMS = {"c_ref": ("cum_ref", "n_ref"), "c_cur": ("cum_cur", "n_cur"), "one": ("rank", "n_values")}


def _spread_totals(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Running and whole sums of groups that stay spread over the tasks."""
    return running_total(
        counts, keys, [F.col("value")], out=[c for c, _ in _SUMS.values()], weight=list(_SUMS), total_out=[n for _, n in _SUMS.values()], next_of="value"
    ).drop(*_SUMS)


def _windowed_totals(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same by windows, where a group's rows are in one task."""
    whole = Window.partitionBy(*keys)
    ordered = whole.orderBy("value")
    before = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {name: F.sum(w).over(over) for w, names in _SUMS.items() for name, over in zip(names, (before, whole), strict=True)}
    return counts.withColumns({**sums, "next_value": F.lead("value", 1).over(ordered)}).drop(*_SUMS)


def _cdf(reference: DataFrame, current: DataFrame, group: Sequence[str], cols: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Distinct values of every (group, column) with the distribution functions of
    both sides and the next value. The rows of a group that is not hot cross one
    exchange, before they are taken apart by column; those of hot groups are
    counted where they are, and their values range-partitioned."""
    group = list(group)
    keys = [*group, "column_name"]
    rows = _sides(reference, current, dict.fromkeys([*group, *cols]))
    hot, n = hot_groups(rows, group, hot_rows) if group else (F.lit(True), 0)
    parts = []
    if group:
        cold = spread_by(rows if hot is None else rows.where(~hot), group, n * len(cols))
        parts.append(_windowed_totals(_numeric_counts(cold, group, cols), keys))
    if hot is not None:
        parts.append(_spread_totals(_numeric_counts(rows.where(hot), group, cols), keys).select(*(parts[0].columns if parts else ["*"])))
    return reduce(DataFrame.unionByName, parts).withColumns(
        {
            "F_ref": F.try_divide(F.col("cum_ref"), F.col("n_ref")),
            "F_cur": F.try_divide(F.col("cum_cur"), F.col("n_cur")),
        }
    )


def drift_numeric_ks(reference: DataFrame, current: DataFrame, num_cols: Sequence[str], group: Sequence[str] = ("stockcode",), cdf: DataFrame | None = None) -> DataFrame:
    """L1: two-sample KS statistic per (group, column) with the asymptotic
    critical value at alpha = 0.05."""
    group = list(group)
    cdf = cdf if cdf is not None else _cdf(reference, current, group, num_cols)
    ks = cdf.groupBy(*group, "column_name").agg(
        F.max(F.abs(F.col("F_ref") - F.col("F_cur"))).alias("ks_stat"),
        F.max("n_ref").alias("n_ref"),
        F.max("n_cur").alias("n_cur"),
    )
    crit = F.lit(KS_ALPHA_COEF) * F.sqrt((F.col("n_ref") + F.col("n_cur")) / (F.col("n_ref") * F.col("n_cur")))
    return ks.withColumn("ks_drift", F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0), F.col("ks_stat") > crit))


def drift_numeric_wasserstein(reference: DataFrame, current: DataFrame, num_cols: Sequence[str], group: Sequence[str] = ("stockcode",), cdf: DataFrame | None = None) -> DataFrame:
    """L2: W1 = sum |F_ref - F_cur| * (next value - value), divided by
    max(population std of the reference, 0.001); drift when >= 0.1.

    The next distinct value comes with the CDF (``running_total(next_of=)``),
    so no ordered window ever holds a whole group and no self-join is needed."""
    group = list(group)
    cdf = cdf if cdf is not None else _cdf(reference, current, group, num_cols)
    w1 = cdf.groupBy(*group, "column_name").agg(
        F.coalesce(F.sum(F.abs(F.col("F_ref") - F.col("F_cur")) * (F.col("next_value") - F.col("value"))), F.lit(0.0)).alias("w1"),
        F.max("n_ref").alias("n_ref"),
        F.max("n_cur").alias("n_cur"),
    )
    ref_std = (
        _long(reference, group, num_cols, "double")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*group, "column_name")
        .agg(F.stddev_pop("value").alias("ref_std"))
    )
    out = w1.join(ref_std, [*group, "column_name"], "left")
    valid = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    wn = F.when(valid, F.col("w1") / F.greatest(F.col("ref_std"), F.lit(WASSERSTEIN_MIN_STD)))
    return out.withColumn("w1_norm", wn).withColumn("w1_drift", F.col("w1_norm") >= F.lit(WASSERSTEIN_THRESHOLD))


def drift_categorical_js(reference: DataFrame, current: DataFrame, cat_cols: Sequence[str], group: Sequence[str] = ("stockcode",)) -> DataFrame:
    """L3: Jensen-Shannon distance (natural log) of the category shares, drift
    when >= 0.1; and the chi-square statistic of the counts with its critical
    value at alpha = 0.05."""
    group = list(group)

    def side(df, ref):
        long = _long(df, group, cat_cols, "string").where(F.col("value").isNotNull())
        return long.withColumns({"c_ref": F.lit(1 if ref else 0).cast("bigint"), "c_cur": F.lit(0 if ref else 1).cast("bigint")})

    counts = (
        side(reference, True)
        .unionByName(side(current, False))
        .groupBy(*group, "column_name", "value")
        .agg(F.sum("c_ref").alias("c_ref"), F.sum("c_cur").alias("c_cur"))
    )
    totals = counts.groupBy(*group, "column_name").agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"))
    j = counts.join(totals, [*group, "column_name"])
    p = F.col("c_ref") / F.col("n_ref")
    q = F.col("c_cur") / F.col("n_cur")
    m = (p + q) / 2
    c = F.col("c_ref") + F.col("c_cur")

    def rel(a):
        return F.when(a > 0, a * F.log(a / m)).otherwise(F.lit(0.0))

    js = j.where((F.col("n_ref") > 0) & (F.col("n_cur") > 0)).groupBy(*group, "column_name").agg(
        F.sqrt(F.greatest(F.sum(rel(p) + rel(q)) / 2, F.lit(0.0))).alias("js_distance"),
        F.sum(F.col("c_ref") * F.col("c_ref") / (F.col("n_ref") * c) + F.col("c_cur") * F.col("c_cur") / (F.col("n_cur") * c)).alias("_s"),
        (F.count("*") - 1).alias("_df"),
        F.max("n_ref").alias("n_ref"),
        F.max("n_cur").alias("n_cur"),
    )
    k = F.lit(2.0) / (F.col("_df") * 9)
    edge = 1 - k + F.lit(CHI2_Z) * F.sqrt(k)
    return (
        js.withColumn("js_drift", F.col("js_distance") >= F.lit(JS_THRESHOLD))
        .withColumn("chi2", F.greatest((F.col("n_ref") + F.col("n_cur")) * (F.col("_s") - 1), F.lit(0.0)))
        .withColumn("chi2_drift", F.when(F.col("_df") > 0, F.col("chi2") > F.col("_df") * edge * edge * edge).otherwise(F.lit(False)))
        .drop("_s", "_df")
    )


def _numeric_tests(reference: DataFrame, current: DataFrame, num_cols: Sequence[str], group: Sequence[str]) -> DataFrame:
    """KS and normed W1 of every (group, column) from one pass over one CDF."""
    cdf = _cdf(reference, current, group, num_cols)
    dF = F.abs(F.col("F_ref") - F.col("F_cur"))
    stats = cdf.groupBy(*group, "column_name").agg(
        F.max(dF).alias("ks_stat"),
        F.coalesce(F.sum(dF * (F.col("next_value") - F.col("value"))), F.lit(0.0)).alias("w1"),
        F.max("n_ref").alias("n_ref"),
        F.max("n_cur").alias("n_cur"),
    )
    ref_std = (
        _long(reference, group, num_cols, "double")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*group, "column_name")
        .agg(F.stddev_pop("value").alias("ref_std"))
    )
    crit = F.lit(KS_ALPHA_COEF) * F.sqrt((F.col("n_ref") + F.col("n_cur")) / (F.col("n_ref") * F.col("n_cur")))
    w1n = F.col("w1") / F.greatest(F.col("ref_std"), F.lit(WASSERSTEIN_MIN_STD))
    return (
        stats.where((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
        .join(ref_std, [*group, "column_name"], "left")
        .withColumns({"ks_drift": F.col("ks_stat") > crit, "w1_norm": w1n})
        .withColumn("w1_drift", F.col("w1_norm") >= F.lit(WASSERSTEIN_THRESHOLD))
    )


def drift_columns(
    reference: DataFrame,
    current: DataFrame,
    num_cols: Sequence[str],
    cat_cols: Sequence[str],
    group: Sequence[str] = ("stockcode",),
    numeric_test: str = "ks",
    categorical_test: str = "chi2",
) -> DataFrame:
    """Per (group, column): the statistic and flag of the deciding test
    (``numeric_test``: ks or wasserstein, ``categorical_test``: chi2 or
    jensenshannon) and, as ``other_statistic``, that of the other one."""
    group = list(group)
    tests = {"ks": ("ks_stat", "ks_drift"), "wasserstein": ("w1_norm", "w1_drift"), "chi2": ("chi2", "chi2_drift"), "jensenshannon": ("js_distance", "js_drift")}

    def part(df, role, chosen, other):
        stat, flag = tests[chosen]
        return df.select(
            *group, "column_name", F.lit(role).alias("role"), F.lit(chosen).alias("test"), F.col(stat).alias("statistic"),
            F.col(tests[other][0]).alias("other_statistic"), F.coalesce(F.col(flag), F.lit(False)).alias("drifted"),
        )

    parts = []
    if num_cols:
        other = {"ks": "wasserstein", "wasserstein": "ks"}[numeric_test]
        parts.append(part(_numeric_tests(reference, current, num_cols, group), "numeric", numeric_test, other))
    if cat_cols:
        other = {"chi2": "jensenshannon", "jensenshannon": "chi2"}[categorical_test]
        parts.append(part(drift_categorical_js(reference, current, cat_cols, group), "categorical", categorical_test, other))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_summary(columns: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], group: Sequence[str] = ("stockcode",)) -> DataFrame:
    """Number and share of drifted columns and the flag, per group."""
    group = list(group)
    s = columns.groupBy(*group).agg(
        F.count_if(F.col("drifted")).alias("num_drifts"),
        F.count(F.lit(1)).alias("n_columns"),
    )
    return s.select(
        *group,
        (F.col("num_drifts") > 0).alias("drift_detected"),
        "num_drifts",
        (F.col("num_drifts") / F.col("n_columns")).alias("shared_drifts"),
        "n_columns",
        F.lit(",".join(num_cols)).alias("num_cols"),
        F.lit(",".join(cat_cols)).alias("cat_cols"),
    )


def drift_gate(summary: DataFrame) -> None:
    """Stop the pipeline when any group drifted."""
    n = summary.agg(F.count_if(F.col("drift_detected")).alias("n")).first()["n"]
    if n:
        raise DriftDetected(f"data drift detected in {n} group(s)")
