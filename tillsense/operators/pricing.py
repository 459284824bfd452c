"""Price grid scoring and the revenue-maximising price for every product
in one job (J1-J3, J10, J11, C5, D8, F2-F4).

The reference answers one product per request; here the request parameters
apply to all products at once and the result is the table T6.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsense.functions.exprs import demand_units, is_nonfinite, linspace_point
from tillsense.operators.ranking import HOT_ROWS, exact_median, hot_groups, spread_by
from tillsense.operators.splits import total_order

# Fixed values of the pricing request (defaults of the reference endpoint).
DEFAULT_MIN_PRICE = 2.0
DEFAULT_MAX_PRICE = 20.0
LOW_PRICE_CUTOFF = 0.1
DEFAULT_PRICE_BINS = 100
SAMPLE_SIZE = 1200
SAMPLE_SEED = 42
SAMPLE_PER_PRODUCT = 1200  # feature rows of each product that the all-products job scores, as in the reference's request
SAMPLE_SALTS = 64  # parts of a product that are ranked apart before the product is
PLANE_EPS = 1e-6  # below it a variance, or the share of it that is not collinear, counts as none


def price_stats(features: DataFrame) -> DataFrame:
    """Per-product price statistics used for the bounds: median, max, min."""
    mm = features.where(F.col("unitprice").isNotNull() & ~F.isnan("unitprice")).groupBy("stockcode").agg(
        F.max("unitprice").alias("unitprice_max"), F.min("unitprice").alias("unitprice_min")
    )
    med = exact_median(features, "unitprice", ["stockcode"], out="unitprice_median")
    return mm.join(med, "stockcode", "left")


def price_bounds(stats: DataFrame, unitprice_min: float | None = None, unitprice_max: float | None = None) -> DataFrame:
    """Price interval per product (rules of SURVEY §2.12).

    ``stats`` has stockcode, unitprice_min, unitprice_median, unitprice_max;
    NULL statistics mean "no stats" and fall back to the defaults.
    """
    p_lo = F.lit(float(unitprice_min or 0.0))
    p_hi = F.lit(float(unitprice_max or 0.0))
    has = F.col("unitprice_min").isNotNull()
    stat_lo = F.when(F.col("unitprice_min") < LOW_PRICE_CUTOFF, F.col("unitprice_median")).otherwise(F.col("unitprice_min"))
    lo0 = F.when(p_lo == 0.0, F.when(has, stat_lo).otherwise(F.lit(DEFAULT_MIN_PRICE))).otherwise(p_lo)
    hi0 = F.when(p_hi == 0.0, F.when(F.col("unitprice_max").isNotNull(), F.col("unitprice_max")).otherwise(F.lit(DEFAULT_MAX_PRICE))).otherwise(p_hi)
    b = stats.select("stockcode", lo0.alias("_lo0"), hi0.alias("_hi0"))
    eq = F.col("_lo0") == F.col("_hi0")
    swap = F.col("_lo0") > F.col("_hi0")
    lo1 = F.when(eq, F.greatest(F.lit(2.0), F.col("_lo0") * 0.9)).when(swap, F.col("_hi0")).otherwise(F.col("_lo0"))
    hi1 = F.when(eq, F.col("_hi0") * 1.5 + 0.1).when(swap, F.col("_lo0")).otherwise(F.col("_hi0"))
    b = b.select("stockcode", lo1.alias("_lo1"), hi1.alias("_hi1"))
    lo2 = F.when(F.col("_lo1") > 1, F.floor("_lo1").cast("double")).otherwise(F.col("_lo1"))
    b = b.select("stockcode", lo2.alias("price_lo"), F.col("_hi1"))
    widen = F.lit(unitprice_max is None) & ((F.col("_hi1") - F.col("price_lo")) < 10.0)
    return b.select("stockcode", "price_lo", F.when(widen, F.col("_hi1") * 5).otherwise(F.col("_hi1")).alias("price_hi"))


def price_grid(bounds: DataFrame, num_price_bins: int = DEFAULT_PRICE_BINS, carry: list[str] = ()) -> DataFrame:
    """``num_price_bins`` evenly spaced prices per product (generator, no
    join). ``carry`` passes product-level columns through to every grid row."""
    n = int(num_price_bins)
    g = bounds.select("stockcode", "price_lo", "price_hi", *carry, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("bin"))
    return g.select("stockcode", "bin", linspace_point("price_lo", "price_hi", F.col("bin"), n).alias("unit_price"), *carry)


def global_line(features: DataFrame, y: str = "quantity", x: str = "unitprice_log"):
    """The overall log-log line as one scalar-subquery struct (slope, intercept)."""
    return features.agg(
        F.struct(F.regr_slope(F.col(y), F.col(x)).alias("slope"), F.regr_intercept(F.col(y), F.col(x)).alias("intercept")).alias("g")
    ).scalar()


def demand_model_by_product(features: DataFrame, y: str = "quantity", x: str = "unitprice_log") -> DataFrame:
    """Log-log demand line per product, log1p(q) = a + b*log1p(p), fitted
    with regression aggregates (one pass, partial aggregation), plus the
    overall fit as fallback for products without a usable line.

    Columns: stockcode, slope, intercept, n_obs, global_slope,
    global_intercept, uses_global.
    """
    fit = [
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_count(F.col(y), F.col(x)).alias("n_obs"),
        F.regr_sxx(F.col(y), F.col(x)).alias("sxx"),
    ]
    per = features.groupBy("stockcode").agg(*fit)
    # the overall line is one value pair: a scalar subquery, no join
    glob = features.agg(*fit).select(F.struct("slope", "intercept").alias("g")).scalar()
    usable = (F.col("n_obs") >= 2) & (F.col("sxx") > 0)
    return (
        per.withColumns({"global_slope": glob.getField("slope"), "global_intercept": glob.getField("intercept")})
        .select(
            "stockcode",
            F.when(usable, F.col("slope")).alias("slope"),
            F.when(usable, F.col("intercept")).alias("intercept"),
            "n_obs",
            "global_slope",
            "global_intercept",
            (~usable).alias("uses_global"),
        )
    )


def momentum(c="product_avg_quantity_last_month"):
    """The row feature beside the price: log1p of last month's sales (returns count as none)."""
    return F.log1p(F.greatest(F.col(c), F.lit(0.0)))


def demand_plane_by_product(features: DataFrame) -> DataFrame:
    """The flagship's demand model, log1p(q) = a + b*log1p(p) + c*momentum, per
    product and overall, by least squares from one aggregate (variances and
    covariances, combined map-side). Where price and momentum are collinear the
    line on the price alone is used; without a usable line the slope is NULL."""
    x = F.col("unitprice_log")
    y, m = F.when(x.isNotNull(), F.col("quantity")), F.when(x.isNotNull(), momentum())
    sums = [
        F.count(x).alias("n"), F.avg(x).alias("mx"), F.avg(m).alias("mm"), F.avg(y).alias("my"),
        F.var_pop(x).alias("sxx"), F.var_pop(m).alias("smm"),
        F.covar_pop(x, m).alias("sxm"), F.covar_pop(x, y).alias("sxy"), F.covar_pop(m, y).alias("smy"),
    ]
    det = F.col("sxx") * F.col("smm") - F.col("sxm") * F.col("sxm")
    plane = (F.col("n") >= 3) & (F.col("sxx") > PLANE_EPS) & (F.col("smm") > PLANE_EPS) & (det > PLANE_EPS * F.col("sxx") * F.col("smm"))
    line = (F.col("n") >= 2) & (F.col("sxx") > PLANE_EPS)
    slope = F.when(plane, (F.col("sxy") * F.col("smm") - F.col("smy") * F.col("sxm")) / det).when(line, F.col("sxy") / F.col("sxx"))
    weight = F.when(plane, (F.col("smy") * F.col("sxx") - F.col("sxy") * F.col("sxm")) / det).when(line, F.lit(0.0))

    def fitted(df):
        df = df.withColumn("slope", slope).withColumn("momentum_weight", weight)
        return df.withColumn("intercept", F.col("my") - F.col("slope") * F.col("mx") - F.col("momentum_weight") * F.col("mm"))

    fit = ["slope", "momentum_weight", "intercept"]
    glob = fitted(features.agg(*sums)).select(F.struct(*fit).alias("g")).scalar()
    return fitted(features.groupBy("stockcode").agg(*sums)).select("stockcode", *fit, *[glob.getField(c).alias(f"global_{c}") for c in fit])


def product_sample(features: DataFrame, rows: int = SAMPLE_PER_PRODUCT, seed: int = SAMPLE_SEED, hot_rows: int | None = None) -> DataFrame:
    """At most ``rows`` feature rows of each product (all, where there are
    fewer), by a seeded hash of the invoice: (stockcode, sample_no, momentum).

    A product that is not hot is ranked in one task: its rows cross one exchange,
    with the columns of the order only. A hot one has more than ``rows`` rows (and a
    thousandth of all, up to ``HOT_ROWS``) and takes two bounded steps: the first
    ``rows`` of each (product, salt), then of each product, so the task that ranks
    it gets ``SAMPLE_SALTS * rows`` rows at most. Both rank filters are applied in
    every task before the shuffle, which Spark does up to a limit of 1,000 unless
    told otherwise.
    """
    limit, conf = "spark.sql.optimizer.windowGroupLimitThreshold", features.sparkSession.conf
    conf.set(limit, str(max(rows, int(conf.get(limit)))))
    keys = total_order(features)
    order = [F.col("_rank"), *[F.col(c).asc_nulls_first() for c in keys]]
    rank = F.md5(F.concat(F.col("invoiceno"), F.lit(f"|{seed}")))

    def first(df, *part):
        return df.withColumn("sample_no", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col("sample_no") <= rows)

    hot, n = hot_groups(features, ["stockcode"], max(rows, min(HOT_ROWS, features.count() // 1000)) if hot_rows is None else hot_rows)
    slim = features.select(*dict.fromkeys(["stockcode", "product_avg_quantity_last_month", "invoiceno", *keys]))
    cold = spread_by(slim if hot is None else slim.where(~hot), ["stockcode"], n)
    out = first(cold.withColumn("_rank", rank), "stockcode")
    if hot is not None:
        salted = slim.where(hot).withColumns({"_rank": rank, "_salt": F.pmod(F.xxhash64(*keys), F.lit(SAMPLE_SALTS))})
        out = out.unionByName(first(first(salted, "stockcode", "_salt"), "stockcode").drop("_salt"))
    return out.select("stockcode", "sample_no", momentum().alias("momentum"))


def cross_sample_prices(sample: DataFrame, grid: DataFrame) -> DataFrame:
    """Every sampled row of a product at every row of ``grid`` for it. An
    equi-join on the product, so the size is sum over products of (sample rows
    x bins), never all pairs."""
    return sample.join(grid, "stockcode")


def plane(price, at_momentum, g: str = ""):
    """The demand plane ``g`` at a price and a momentum."""
    return F.col(f"{g}intercept") + F.col(f"{g}slope") * F.log1p(price) + F.col(f"{g}momentum_weight") * at_momentum


def _predictions(df: DataFrame, *carry: str) -> DataFrame:
    price, m = F.col("unit_price"), F.col("momentum")
    return df.select("stockcode", "bin", "unit_price", "sample_no", plane(price, m).alias("y_primary"), plane(price, m, "global_").alias("y_backup"), *carry)


def unusable(y):
    """A prediction that is missing or whose exponential is Inf, NaN or 0."""
    return y.isNull() | is_nonfinite(F.exp(y)) | (F.exp(y) == 0.0)


def corner_failover(per: DataFrame, sample: DataFrame, num_price_bins: int = DEFAULT_PRICE_BINS) -> DataFrame:
    """J10 for planes: ``per`` (one row a product: price bounds and fits) with
    ``use_backup``. A plane is monotone in log price and in momentum, so over a
    product's grid and sample it is least and greatest at corners, which are
    scored rows themselves: some prediction is unusable if one of them is."""
    m = F.col("momentum")
    ends = sample.groupBy("stockcode").agg(F.min(m).alias("_m_lo"), F.max(m).alias("_m_hi"), F.bool_or(m.isNull() | F.isnan(m)).alias("_m_none"))
    prices = ["price_lo"] if num_price_bins == 1 else ["price_lo", "price_hi"]
    bad = F.col("_m_none")
    for p in prices:
        for at in ("_m_lo", "_m_hi"):
            bad = bad | unusable(plane(F.col(p), F.col(at)))
    return per.join(ends, "stockcode").withColumn("use_backup", bad).drop("_m_lo", "_m_hi", "_m_none")


def score_failover(scored: DataFrame, primary: str = "y_primary", backup: str = "y_backup", group: str = "stockcode") -> DataFrame:
    """When any exp(primary) of a product's batch is Inf or 0 (or the
    primary is missing), the whole batch uses the backup prediction.

    The per-product flag is an aggregate (bool_or, combined map-side) joined
    back on the key, so a hot product is not funnelled into one task. The flags, one
    row a product, are hashed by partition: a merge join would sort the scored rows.
    """
    flags = scored.groupBy(group).agg(F.bool_or(unusable(F.col(primary))).alias("use_backup"))
    return scored.join(flags.hint("shuffle_hash"), group, "left").withColumn(
        "y_pred", F.when(F.col("use_backup"), F.col(backup)).otherwise(F.col(primary))
    )


def score_grid(grid: DataFrame, model: DataFrame, sample: DataFrame) -> DataFrame:
    """Score the sampled rows at the grid prices with the product's plane
    (primary) and the overall one (backup), then apply J10."""
    # A product's prices travel as one row, so only the sampled rows and these
    # rows are exchanged; the scored rows are generated where the sample is and
    # scored in place, for the flags and for the result.
    prices = grid.groupBy("stockcode").agg(F.collect_list(F.struct("bin", "unit_price")).alias("_grid"))
    lines = cross_sample_prices(sample, prices.join(model, "stockcode", "left"))
    fitted = [c for c in model.columns if c != "stockcode"]
    crossed = lines.select("stockcode", "sample_no", "momentum", F.explode("_grid").alias("_g"), *fitted)
    return score_failover(_predictions(crossed.select("*", "_g.*")))


def price_curve(scored: DataFrame) -> DataFrame:
    """By (stockcode, unit_price): mean/min/max units and mean sales."""
    units = scored.withColumn("q", demand_units("y_pred")).groupBy("stockcode", "unit_price")
    curve = units.agg(F.avg("q").alias("quantity_avg"), F.min("q").alias("quantity_min"), F.max("q").alias("quantity_max"))
    # all rows of a curve point share the price, so mean sales are price x mean units
    return curve.withColumn("sales", F.col("quantity_avg") * F.col("unit_price"))


def optimal_price(curve: DataFrame) -> DataFrame:
    """the curve row with the greatest mean sales, lowest price on ties
    (trap K25) -- an aggregate over at most ``bins`` rows per product."""
    key = F.struct(F.col("sales"), (-F.col("unit_price")).alias("neg_price"))
    return curve.groupBy("stockcode").agg(
        F.max_by(F.col("unit_price"), key).alias("optimal_unit_price"),
        F.max("sales").alias("max_predicted_sales"),
    )


def price_recommendation(
    features: DataFrame,
    unitprice_min: float | None = None,
    unitprice_max: float | None = None,
    num_price_bins: int = DEFAULT_PRICE_BINS,
    sample_rows: int = SAMPLE_PER_PRODUCT,
) -> DataFrame:
    """J11 (flagship): T6 price curves and optimum for every product.

    features -> price stats -> bounds -> per-product demand plane with overall
    fallback -> sampled rows x grid -> failover -> units/sales -> curve
    (mean, min and max over the sampled rows) -> optimum.
    """
    stats = price_stats(features)
    bounds = price_bounds(stats, unitprice_min, unitprice_max)
    model = demand_plane_by_product(features)
    # Product-level joins first; the failover flag is known there, from four
    # corners, so the scored rows are only aggregated, by product and price. The
    # grid is generated from the joined sample and keeps its partitioning on
    # stockcode: no scored row is shuffled, and windows hold one curve (at most
    # ``num_price_bins`` rows) of a product.
    sample = product_sample(features, sample_rows)
    per = corner_failover(bounds.join(model, "stockcode", "left"), sample, num_price_bins).join(sample, "stockcode")
    fit = [f"{g}{c}" for g in ("", "global_") for c in ("slope", "momentum_weight", "intercept")]
    grid = price_grid(per, num_price_bins, carry=["sample_no", "momentum", "use_backup", *fit])
    scored = _predictions(grid, "use_backup").withColumn("y_pred", F.when(F.col("use_backup"), F.col("y_backup")).otherwise(F.col("y_primary")))
    by_product = Window.partitionBy("stockcode")
    curve = price_curve(scored)
    key = F.struct(F.col("sales"), (-F.col("unit_price")).alias("neg_price"))
    best = curve.withColumns(
        {
            "optimal_unit_price": F.max_by(F.col("unit_price"), key).over(by_product),
            "max_predicted_sales": F.max("sales").over(by_product),
        }
    )
    return best.select(
        "stockcode",
        "unit_price",
        F.col("quantity_avg").cast("bigint").alias("quantity"),
        F.col("quantity_min").cast("bigint").alias("quantity_min"),
        F.col("quantity_max").cast("bigint").alias("quantity_max"),
        F.col("sales").alias("predicted_sales"),
        "optimal_unit_price",
        "max_predicted_sales",
    )


def sort_price_curve(curve: DataFrame) -> DataFrame:
    """curve ordered by product, then ascending price."""
    return curve.orderBy("stockcode", "unit_price")


def sample_key(key_col: str, seed: int = SAMPLE_SEED):
    """arithmetic hash of an integer key that SQL engines compute alike."""
    return F.pmod(F.col(key_col) * F.lit(2654435761) + F.lit(seed), F.lit(2147483647))


def fixed_size_sample(df: DataFrame, key_col: str, n: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED) -> DataFrame:
    """exactly ``n`` rows chosen by a seeded hash of the key.

    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top ``n`` and the driver merges partitions x n rows, so the cost
    is bounded by ``n``, never by the table.
    """
    return df.orderBy(sample_key(key_col, seed), F.col(key_col)).limit(n)
