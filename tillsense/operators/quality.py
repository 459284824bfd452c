"""Quality gates, regression metrics, fairness, attributions (D9-D15,
C6, C7, J13, F5, F6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsense.functions.exprs import is_nonfinite

# Fixed values of the reference's evaluation.
LOG_CLIP = 10.0
MOD_THRESHOLD = 0.1
PRIVILEGED_GROUP = 1


class QualityGateError(RuntimeError):
    pass


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing (NULL, or NaN for floats) count per column, one pass,
    one row per column."""
    cols = list(columns or df.columns)
    miss = [
        F.count_if(F.col(c).isNull() | (F.isnan(c) if _is_float(df, c) else F.lit(False))).alias(c)
        for c in cols
    ]
    wide = df.agg(*miss)
    return wide.unpivot([], cols, "column_name", "n_missing")


def quality_gate_nulls(df: DataFrame, target: str = "quantity", exclude: Sequence[str] = ()) -> DataFrame:
    """Missing counts of X and y with a per-column blocking flag."""
    cols = [c for c in df.columns if c not in exclude]
    prof = missing_profile(df, cols)
    return prof.select(
        "column_name",
        F.when(F.col("column_name") == target, F.lit("y")).otherwise(F.lit("X")).alias("part"),
        "n_missing",
        (F.col("n_missing") > 0).alias("is_blocking"),
    )


def assert_gate(report: DataFrame, flag: str = "is_blocking") -> None:
    """Raise when any row of a gate report is blocking (one tiny aggregate)."""
    bad = report.agg(F.count_if(F.col(flag)).alias("n")).first()["n"]
    if bad:
        raise QualityGateError(f"{bad} blocking finding(s)")


def quality_gate_nonfinite(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN and Inf counts per matrix column."""
    aggs = []
    for c in columns:
        aggs += [F.count_if(F.isnan(c)).alias(f"{c}__nan"), F.count_if(F.abs(F.col(c)) == float("inf")).alias(f"{c}__inf")]
    wide = matrix.agg(*aggs)
    return wide.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__nan").alias("n_nan"), F.col(f"{c}__inf").alias("n_inf")) for c in columns])
        ).alias("s")
    ).select("s.*")


def nonfinite_positions(matrix: DataFrame, columns: Sequence[str], row_col: str = "row_id", n: int = 5) -> DataFrame:
    """The first ``n`` cells of the matrix holding NaN/Inf: (row, col_pos,
    column_name) in the order of rows, then columns. Only rows with such a cell
    leave the scan, and each task keeps its first ``n`` of them."""
    cells = F.array(*[F.when(is_nonfinite(F.col(c).cast("double")), F.struct(F.lit(i).alias("col_pos"), F.lit(c).alias("column_name"))) for i, c in enumerate(columns)])
    bad = matrix.select(row_col, F.filter(cells, lambda x: x.isNotNull()).alias("_bad")).where(F.size("_bad") > 0)
    # a row's first cell decides its place: n rows hold the first n cells
    first = bad.orderBy(row_col).limit(n)
    return first.select(row_col, F.explode("_bad").alias("s")).select(row_col, "s.*").orderBy(row_col, "col_pos").limit(n)


def regression_metrics(pred: DataFrame, y: str = "y_true", p: str = "y_pred", group: Sequence[str] = ()) -> DataFrame:
    """MSE in log space; MAE and RMSLE of exp(min(v, 10))."""
    yt = F.exp(F.least(F.col(y), F.lit(LOG_CLIP)))
    yp = F.exp(F.least(F.col(p), F.lit(LOG_CLIP)))
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.pow(F.col(y) - F.col(p), 2)).alias("mse"),
        F.avg(F.abs(yt - yp)).alias("mae"),
        F.sqrt(F.avg(F.pow(F.log1p(yt) - F.log1p(yp), 2))).alias("rmsle"),
    ]
    return pred.groupBy(*group).agg(*aggs) if group else pred.agg(*aggs)


def fairness_group_metrics(pred: DataFrame, sensitive: str = "is_registered", y: str = "y_true", p: str = "y_pred", group: Sequence[str] = ()) -> DataFrame:
    """Per sensitive group: MSE, MAE, RMSLE (on the log-space values,
    NULL when a value is <= -1, trap K24) and mean prediction."""
    yt, yp = F.col(y), F.col(p)
    ok = F.min(F.least(yt, yp)) > -1
    return pred.groupBy(*group, sensitive).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.pow(yt - yp, 2)).alias("mse"),
        F.avg(F.abs(yt - yp)).alias("mae"),
        F.when(ok, F.sqrt(F.avg(F.pow(F.log1p(yt) - F.log1p(yp), 2)))).alias("rmsle"),
        F.avg(yp).alias("mean_prediction"),
    )


def fairness_gap(
    group_metrics: DataFrame,
    sensitive: str = "is_registered",
    privileged_group: int = PRIVILEGED_GROUP,
    mod_threshold: float = MOD_THRESHOLD,
    group: Sequence[str] = (),
) -> DataFrame:
    """Per-group metrics side by side, MAE difference, mean-outcome
    difference and the acceptance flag; an absent group counts as 0."""
    unpriv = 0 if privileged_group == 1 else 1
    g = F.col(sensitive)
    aggs = []
    for name, val in (("unprivileged", unpriv), ("privileged", privileged_group)):
        for m in ("mse", "mae", "rmsle", "mean_prediction"):
            aggs.append(F.max(F.when(g == val, F.col(m))).alias(f"{m}_{name}"))
    wide = group_metrics.groupBy(*group).agg(*aggs) if group else group_metrics.agg(*aggs)
    mae_diff = F.coalesce(F.col("mae_unprivileged"), F.lit(0.0)) - F.coalesce(F.col("mae_privileged"), F.lit(0.0))
    mod = F.coalesce(F.col("mean_prediction_unprivileged"), F.lit(0.0)) - F.coalesce(F.col("mean_prediction_privileged"), F.lit(0.0))
    return wide.select(
        "*",
        mae_diff.alias("mae_diff"),
        mod.alias("mean_outcome_difference"),
        (F.abs(mod) <= F.lit(mod_threshold)).cast("int").alias("is_mod_acceptable"),
        F.lit(sensitive).alias("sensitive_feature"),
        F.lit(privileged_group).alias("privileged_group"),
        F.lit(mod_threshold).alias("mod_threshold"),
    )


def linear_attribution(
    rows: DataFrame,
    background: DataFrame,
    weights: dict[str, float],
    keys: Sequence[str],
    group: Sequence[str] = (),
) -> DataFrame:
    """Additive attributions of a linear model under feature
    independence: w_j * (x_j - mean_j), mean over the background rows
    (per ``group`` when given). Wide: one ``shap_<feature>`` column each."""
    feats = list(weights)
    means = background.groupBy(*group).agg(*[F.avg(c).alias(f"_mean_{c}") for c in feats]) if group else None
    if group:
        x = rows.join(means, list(group), "left")
        mean_of = {c: F.col(f"_mean_{c}") for c in feats}
    else:
        st = background.agg(F.struct(*[F.avg(c).alias(c) for c in feats]).alias("m")).scalar()
        x = rows
        mean_of = {c: st.getField(c) for c in feats}
    return x.select(
        *keys, *feats,
        *[(F.lit(weights[c]) * (F.col(c) - mean_of[c])).alias(f"shap_{c}") for c in feats],
    )


def align_attributions(wide: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Long form (keys, feature_name, shap_value, feature_value): one
    ``stack`` instead of two melts glued together by position."""
    pairs = ", ".join(f"'{c}', shap_{c}, CAST({c} AS DOUBLE)" for c in features)
    return wide.selectExpr(*keys, f"stack({len(features)}, {pairs}) AS (feature_name, shap_value, feature_value)")


def mean_abs_attribution(long: DataFrame) -> DataFrame:
    """Mean |attribution| per feature, name kept with its value (trap K10)."""
    return long.groupBy("feature_name").agg(F.avg(F.abs("shap_value")).alias("mean_abs_shap"))


def rank_features(summary: DataFrame, k: int | None = None) -> DataFrame:
    """features by descending importance (top-k report when k is set)."""
    ordered = summary.orderBy(F.desc("mean_abs_shap"), F.asc("feature_name"))
    return ordered.limit(k) if k else ordered


def latest_metrics(history: DataFrame, key: str = "stockcode", ts: str = "timestamp") -> DataFrame:
    """newest record per key: ``max_by`` over the whole record (an
    aggregate with partial combine, not a per-key sort)."""
    cols = [c for c in history.columns if c != key]
    return history.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(ts)).alias("r")).select(key, "r.*")
