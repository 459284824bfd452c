"""SQL text shared by the oracle queries (DuckDB dialect).

These are independent SQL formulations of the same semantics as the
DataFrame plans; the driver runs them on the same Parquet tables.
"""

from __future__ import annotations

from tillsense.operators.pricing import SAMPLE_PER_PRODUCT


def q6(expr: str, decimals: int = 6) -> str:
    """SQL twin of ``round6``."""
    scale = f"1e{decimals}"
    return f"(CASE WHEN abs({expr}) < {2.0**33:.0f} THEN floor(({expr}) * {scale} + 0.5) / {scale} ELSE ({expr}) END)"


ORDER_KEYS_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
# total row order (K7): time, invoice, then the lineage keys
TOTAL_ORDER_SQL = (
    "invoicedate ASC NULLS FIRST, invoiceno ASC NULLS FIRST, l_orderkey, l_linenumber, l_partkey, "
    "l_suppkey, l_quantity, l_extendedprice"
)

RETAIL = """
retail AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS invoiceno,
         CASE l.l_partkey WHEN 1 THEN 'm' WHEN 2 THEN 'M' WHEN 3 THEN 'B' WHEN 4 THEN 'D'
              WHEN 5 THEN NULL ELSE CAST(l.l_partkey AS VARCHAR) END AS stockcode,
         CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1 THEN -l.l_quantity ELSE l.l_quantity END AS quantity,
         o.o_orderdate AS invoicedate,
         CASE WHEN l.l_suppkey % 50 = 0 THEN NULL ELSE l.l_extendedprice / l.l_quantity END AS unitprice,
         CASE WHEN o.o_custkey % 10 = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS customerid,
         CASE WHEN l.l_orderkey % 20 = 0 THEN NULL ELSE n.n_name END AS country,
         l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

PHASE1 = """
p1a AS (
  SELECT * REPLACE (CASE WHEN stockcode = 'm' THEN 'M' ELSE stockcode END AS stockcode) FROM retail
),
p1b AS (
  SELECT *, CAST(year(invoicedate) AS INTEGER) AS year,
         CAST(date_trunc('month', invoicedate) AS DATE) AS month,
         strftime(invoicedate, '%b') AS month_name,
         strftime(invoicedate, '%a') AS day_of_week
  FROM p1a WHERE stockcode IS NULL OR stockcode NOT IN ('B', 'CRUK', 'C2')
),
monthly AS (
  SELECT stockcode, month, coalesce(sum(quantity), 0.0) AS prod_total_monthly_quantity,
         avg(unitprice) AS prod_ave_monthly_price
  FROM p1b WHERE stockcode IS NOT NULL AND month IS NOT NULL GROUP BY stockcode, month
),
lagged AS (
  SELECT stockcode, month,
         lag(prod_total_monthly_quantity) OVER (PARTITION BY stockcode ORDER BY month) AS lastq
  FROM monthly
),
maxp AS (
  SELECT stockcode, max(unitprice) AS product_max_price_all_time
  FROM p1b WHERE stockcode IS NOT NULL GROUP BY stockcode
),
p1c AS (
  SELECT p1b.*, coalesce(lagged.lastq, 0.0) AS product_avg_quantity_last_month,
         maxp.product_max_price_all_time
  FROM p1b
  LEFT JOIN lagged ON p1b.stockcode = lagged.stockcode AND p1b.month = lagged.month
  LEFT JOIN maxp ON p1b.stockcode = maxp.stockcode
),
p1 AS (
  SELECT * EXCLUDE (customerid),
    CASE WHEN product_max_price_all_time = 0 THEN 0.0 ELSE unitprice / product_max_price_all_time END AS unitprice_vs_max,
    CASE WHEN product_avg_quantity_last_month = 0 THEN 0.0 ELSE unitprice / product_avg_quantity_last_month END AS unitprice_to_avg,
    unitprice * unitprice AS unitprice_squared,
    ln(1 + unitprice) AS unitprice_log,
    CASE WHEN customerid IS NULL THEN 0 ELSE 1 END AS is_registered,
    coalesce(customerid, 'unknown') AS customerid
  FROM p1c
)"""

PHASE2 = """
p2a AS (
  SELECT * REPLACE (coalesce(TRY_CAST(quantity AS DOUBLE), 0.0) AS quantity)
  FROM p1 WHERE stockcode IS NULL OR stockcode NOT IN ('D', 'S')
),
p2 AS (
  SELECT * REPLACE (coalesce(stockcode, 'unknown') AS stockcode, coalesce(invoiceno, 'unknown') AS invoiceno)
  FROM p2a WHERE quantity > 0
),
country_counts AS (
  SELECT stockcode, country, count(*) AS n FROM p2 WHERE country IS NOT NULL GROUP BY stockcode, country
),
mode_country AS (
  SELECT stockcode, country AS imputed_country FROM (
    SELECT *, row_number() OVER (PARTITION BY stockcode ORDER BY n DESC, country ASC) AS rn FROM country_counts
  ) WHERE rn = 1
),
median_price AS (SELECT stockcode, median(unitprice) AS imputed_unitprice FROM p2 GROUP BY stockcode),
global_median AS (SELECT median(unitprice) AS global_median_price FROM p2),
features AS (
  SELECT p2.invoiceno, p2.stockcode, ln(1 + (p2.quantity + 0.0)) AS quantity,
         epoch(p2.invoicedate) AS invoicedate,
         coalesce(p2.unitprice, median_price.imputed_unitprice, global_median.global_median_price) AS unitprice,
         p2.customerid, coalesce(p2.country, mode_country.imputed_country, 'unknown') AS country,
         p2.year, CAST(month(p2.invoicedate) AS INTEGER) AS year_month, p2.day_of_week,
         p2.product_avg_quantity_last_month, p2.product_max_price_all_time, p2.unitprice_vs_max,
         p2.unitprice_to_avg, p2.unitprice_squared, p2.unitprice_log, p2.is_registered,
         p2.l_orderkey, p2.l_linenumber, p2.l_partkey, p2.l_suppkey, p2.l_quantity, p2.l_extendedprice
  FROM p2
  LEFT JOIN mode_country ON p2.stockcode = mode_country.stockcode
  LEFT JOIN median_price ON p2.stockcode = median_price.stockcode
  CROSS JOIN global_median
)"""

FEATURES = RETAIL + "," + PHASE1 + "," + PHASE2
# the stages up to a given CTE
PHASE1_ONLY = RETAIL + "," + PHASE1
PHASE2_ROWS = RETAIL + "," + PHASE1 + "," + PHASE2[: PHASE2.index("country_counts AS")].rstrip().rstrip(",")


def features_from(source_cte: str) -> str:
    """FEATURES computed from another raw CTE named ``source_cte``."""
    return PHASE1.replace("FROM retail", f"FROM {source_cte}") + "," + PHASE2

FEATURE_DOUBLES = [
    "quantity", "invoicedate", "unitprice", "product_avg_quantity_last_month",
    "product_max_price_all_time", "unitprice_vs_max", "unitprice_to_avg",
    "unitprice_squared", "unitprice_log",
]

# J1/J2/J3/J10/D8/F3 over all products (default request: no price params, 100 bins)
PRICING = """
stats AS (
  SELECT stockcode, max(unitprice) AS unitprice_max, min(unitprice) AS unitprice_min,
         median(unitprice) AS unitprice_median
  FROM features WHERE unitprice IS NOT NULL AND NOT isnan(unitprice) GROUP BY stockcode
),
b0 AS (
  SELECT stockcode,
         CASE WHEN unitprice_min IS NULL THEN 2.0
              WHEN unitprice_min < 0.1 THEN unitprice_median ELSE unitprice_min END AS lo0,
         coalesce(unitprice_max, 20.0) AS hi0
  FROM stats
),
b1 AS (
  SELECT stockcode,
         CASE WHEN lo0 = hi0 THEN greatest(2.0, lo0 * 0.9) WHEN lo0 > hi0 THEN hi0 ELSE lo0 END AS lo1,
         CASE WHEN lo0 = hi0 THEN hi0 * 1.5 + 0.1 WHEN lo0 > hi0 THEN lo0 ELSE hi0 END AS hi1
  FROM b0
),
b2 AS (
  SELECT stockcode, CASE WHEN lo1 > 1 THEN CAST(floor(lo1) AS DOUBLE) ELSE lo1 END AS price_lo, hi1 FROM b1
),
bounds AS (
  SELECT stockcode, price_lo, CASE WHEN hi1 - price_lo < 10.0 THEN hi1 * 5 ELSE hi1 END AS price_hi FROM b2
),
grid AS (
  SELECT stockcode, CAST(r.i AS INTEGER) AS bin,
         CASE WHEN r.i = 99 THEN price_hi ELSE r.i * ((price_hi - price_lo) / 99) + price_lo END AS unit_price
  FROM bounds, range(0, 100) AS r(i)
),
fit AS (
  SELECT stockcode, regr_slope(quantity, unitprice_log) AS slope, regr_intercept(quantity, unitprice_log) AS intercept,
         regr_count(quantity, unitprice_log) AS n_obs, regr_sxx(quantity, unitprice_log) AS sxx
  FROM features GROUP BY stockcode
),
gfit AS (
  SELECT regr_slope(quantity, unitprice_log) AS global_slope, regr_intercept(quantity, unitprice_log) AS global_intercept
  FROM features
),
model AS (
  SELECT stockcode,
         CASE WHEN n_obs >= 2 AND sxx > 0 THEN slope END AS slope,
         CASE WHEN n_obs >= 2 AND sxx > 0 THEN intercept END AS intercept,
         n_obs, global_slope, global_intercept, NOT (n_obs >= 2 AND sxx > 0) AS uses_global
  FROM fit CROSS JOIN gfit
),
mrows AS (
  SELECT stockcode, unitprice_log AS x, CASE WHEN unitprice_log IS NOT NULL THEN quantity END AS y,
         CASE WHEN unitprice_log IS NOT NULL THEN ln(1 + greatest(product_avg_quantity_last_month, 0.0)) END AS m
  FROM features
),
msums AS (
  SELECT stockcode, @@SUMS@@ FROM mrows GROUP BY stockcode
  UNION ALL SELECT '**all**', @@SUMS@@ FROM mrows
),
mdet AS (SELECT *, sxx * smm - sxm * sxm AS det FROM msums),
mcase AS (
  SELECT *, n >= 3 AND sxx > 1e-6 AND smm > 1e-6 AND det > 1e-6 * sxx * smm AS is_plane, n >= 2 AND sxx > 1e-6 AS is_line FROM mdet
),
mfit AS (
  SELECT *, CASE WHEN is_plane THEN (sxy * smm - smy * sxm) / det WHEN is_line THEN sxy / sxx END AS slope,
         CASE WHEN is_plane THEN (smy * sxx - sxy * sxm) / det WHEN is_line THEN 0.0 END AS mw
  FROM mcase
),
plane AS (SELECT stockcode, slope, mw, my - slope * mx - mw * mm AS intercept FROM mfit),
psample AS (
  SELECT stockcode, sample_no, ln(1 + greatest(product_avg_quantity_last_month, 0.0)) AS momentum FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY stockcode ORDER BY md5(invoiceno || '|42'), @@ORDER@@) AS INTEGER) AS sample_no FROM features
  ) WHERE sample_no <= @@SAMPLE@@
),
scored0 AS (
  SELECT g.stockcode, g.bin, g.unit_price, s.sample_no,
         p.intercept + p.slope * ln(1 + g.unit_price) + p.mw * s.momentum AS y_primary,
         o.intercept + o.slope * ln(1 + g.unit_price) + o.mw * s.momentum AS y_backup
  FROM grid g JOIN psample s ON g.stockcode = s.stockcode
  LEFT JOIN plane p ON g.stockcode = p.stockcode CROSS JOIN (SELECT * FROM plane WHERE stockcode = '**all**') o
),
flags AS (
  SELECT stockcode, bool_or(y_primary IS NULL OR isinf(exp(y_primary)) OR isnan(exp(y_primary)) OR exp(y_primary) = 0.0) AS use_backup
  FROM scored0 GROUP BY stockcode
),
scored AS (
  SELECT s.*, f.use_backup, CASE WHEN f.use_backup THEN s.y_backup ELSE s.y_primary END AS y_pred
  FROM scored0 s LEFT JOIN flags f ON s.stockcode = f.stockcode
),
units AS (
  SELECT *, floor(@@Q6EXP@@) AS q FROM scored
),
curve AS (
  SELECT stockcode, unit_price, avg(q) AS quantity_avg, min(q) AS quantity_min, max(q) AS quantity_max,
         avg(q) * unit_price AS sales
  FROM units GROUP BY stockcode, unit_price
),
best AS (
  SELECT stockcode, arg_max(unit_price, (sales, -unit_price)) AS optimal_unit_price, max(sales) AS max_predicted_sales
  FROM curve GROUP BY stockcode
)"""


PRICING = (
    PRICING.replace("@@Q6EXP@@", q6("exp(y_pred) * 100.0"))
    .replace("@@ORDER@@", TOTAL_ORDER_SQL)
    .replace("@@SAMPLE@@", str(SAMPLE_PER_PRODUCT))
    .replace(
        "@@SUMS@@",
        "count(x) AS n, avg(x) AS mx, avg(m) AS mm, avg(y) AS my, var_pop(x) AS sxx, var_pop(m) AS smm, "
        "covar_pop(x, m) AS sxm, covar_pop(x, y) AS sxy, covar_pop(m, y) AS smy",
    )
)


def with_ctes(ctes: str, select: str) -> str:
    return "WITH " + ctes.strip().lstrip(",") + "\n" + select


def round_cols(cols: list[str], doubles: list[str]) -> str:
    return ", ".join(f"{q6(c)} AS {c}" if c in doubles else c for c in cols)
