"""Scalar column expressions (H1-H8). All are built-in Catalyst expressions,
so they stay inside whole-stage codegen; no Python UDFs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "MISSING_TOKENS",
    "col_or_name",
    "missing_to_null",
    "not_in_keep_null",
    "epoch_seconds",
    "month_start",
    "safe_ratio",
    "linspace_point",
    "params_hash",
    "is_nonfinite",
    "nan_to_null",
    "round6",
    "demand_units",
]

# The missing-value tokens of the reference's cleaning step.
MISSING_TOKENS = ["", "nan", "N/A", "na", "None", "none"]

_EPOCH = "1970-01-01 00:00:00"


def col_or_name(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c) -> Column:
    """H1/B1: textual missing tokens -> NULL."""
    c = col_or_name(c)
    return F.when(c.isin(MISSING_TOKENS), F.lit(None)).otherwise(c)


def not_in_keep_null(c, values: Iterable[str]) -> Column:
    """``~isin`` with pandas semantics: NULL rows are kept (trap K3)."""
    return F.coalesce(~col_or_name(c).isin(list(values)), F.lit(True))


def epoch_seconds(c) -> Column:
    """H2: epoch seconds as DOUBLE, independent of the session time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), col_or_name(c).cast("timestamp_ntz")) / F.lit(1e6)


def month_start(c) -> Column:
    """H2: monthly period as the DATE of the month's first day."""
    return F.trunc(col_or_name(c).cast("date"), "month")


def safe_ratio(num, den) -> Column:
    """num/den, 0.0 where den == 0, NULL where either is NULL (trap K4)."""
    num, den = col_or_name(num), col_or_name(den)
    return F.when(den == 0, F.lit(0.0)).otherwise(F.try_divide(num, den))


def linspace_point(lo, hi, i, n) -> Column:
    """H5: the i-th of n evenly spaced points between lo and hi, ends inclusive
    (numpy.linspace: start + i*step, last point pinned to stop)."""
    lo, hi, i, n = (col_or_name(x) if not isinstance(x, int) else F.lit(x) for x in (lo, hi, i, n))
    step = (hi - lo) / (n - F.lit(1))
    return F.when(n == 1, lo).when(i == n - 1, hi).otherwise(i * step + lo)


def params_hash(params: dict[str, str]) -> Column:
    """H6: sha256 over the sorted (key, value) pairs of a request."""
    items = sorted(params.items())
    text = "[" + ", ".join(f"('{k}', '{v}')" for k, v in items) + "]"
    return F.sha2(F.lit(text), 256)


def is_nonfinite(c) -> Column:
    """H8: NaN or +-Inf."""
    c = col_or_name(c)
    return F.isnan(c) | (F.abs(c) == F.lit(float("inf")))


def nan_to_null(c) -> Column:
    """NaN is a value in Spark (trap K21); the engine keeps NULL only."""
    c = col_or_name(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


# From here on doubles are spaced wider than 1e-6: rounding changes nothing.
ROUND_LIMIT = 2.0**33


def round6(c, decimals: int = 6) -> Column:
    """Round to a fixed number of decimals, whatever the size of the value:
    floor(x * 10^decimals + 0.5) / 10^decimals. Only IEEE basic operations, so
    every engine gives the same bits for the same input. For checks only; no
    operator stores rounded values. Non-finite values are left as they are.
    """
    c = col_or_name(c)
    scale = F.lit(10.0**decimals)
    r = F.floor(c * scale + F.lit(0.5)).cast("double") / scale
    return F.when(F.abs(c) < F.lit(ROUND_LIMIT), r).otherwise(c)


def demand_units(log_pred) -> Column:
    """Predicted units per 100 from a log-space prediction: floor(exp(y)*100).

    A 1e-6 rounding before the floor keeps the result stable against
    last-bit differences of ``exp`` (the floor is discontinuous).
    """
    return F.floor(round6(F.exp(col_or_name(log_pred)) * F.lit(100.0)))
