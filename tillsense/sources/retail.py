"""Transaction sources: CSV scan (A1), column-name normalisation (A2) and the
retail view over the TPC-H-like driver tables used for tests and benches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsense.functions.exprs import nan_to_null
from tillsense.sources.tables import materialize

# Date texts of the named data set, tried in order after ISO timestamps.
DATE_FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy", "yyyy-MM-dd H:mm")

# Texts that stand for a missing field.
MISSING_TEXTS = ("", "nan", "n/a", "na", "none")

# Lineage columns of the retail view. They give every row a total order
# (the reference relies on file row order, which Spark does not keep).
ORDER_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]

# T1 as read from CSV: fixed schema, no inference on a large input.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("invoiceno", T.StringType()),
        T.StructField("stockcode", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.StringType()),
        T.StructField("invoicedate", T.StringType()),
        T.StructField("unitprice", T.StringType()),
        T.StructField("customerid", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def normalize_columns(df: DataFrame) -> DataFrame:
    """A2: space -> '_', lower case, '__' -> '_'. Idempotent (trap K2)."""
    mapping = {}
    for c in df.columns:
        new = c.replace(" ", "_").lower().replace("__", "_")
        if new != c:
            mapping[c] = new
    return df.withColumnsRenamed(mapping) if mapping else df


def scan_transactions(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A1: header CSV scan with a declared schema, then typed columns.

    Bad numbers, NaN and bad dates become NULL (``try_cast`` /
    ``try_to_timestamp``) instead of failing the job under ANSI mode (traps K4,
    K21); dates may be ISO or any of ``DATE_FORMATS``.
    """
    raw = (
        spark.read.schema(schema or RAW_SCHEMA)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return typed_transactions(normalize_columns(raw))


def typed_transactions(df: DataFrame) -> DataFrame:
    """Text columns of transactions as numbers, ids and times."""
    out = df
    if "quantity" in df.columns:
        out = out.withColumn("quantity", nan_to_null(F.col("quantity").try_cast("double")))
    if "unitprice" in df.columns:
        out = out.withColumn("unitprice", nan_to_null(F.col("unitprice").try_cast("double")))
    if "customerid" in df.columns:
        # float ids such as '17850.0' -> '17850' (trap K5)
        out = out.withColumn(
            "customerid",
            F.coalesce(
                nan_to_null(F.col("customerid").try_cast("double")).try_cast("bigint").cast("string"),
                F.col("customerid"),
            ),
        )
    if "invoicedate" in df.columns:
        tried = [F.try_to_timestamp("invoicedate"), *[F.try_to_timestamp("invoicedate", F.lit(f)) for f in DATE_FORMATS]]
        out = out.withColumn("invoicedate", F.coalesce(*tried).cast("timestamp_ntz"))
    return out


CORRUPT = "_corrupt_record"
#: Texts of the fields that must be readable, and the reason when one is not.
CHECKED = {"quantity": "bad_quantity", "unitprice": "bad_unitprice", "invoicedate": "bad_date"}


def scan_transactions_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A1 with a quarantine: the typed rows of a header CSV, and what could not be
    read: (reason, line) of broken lines, whose rows are left out, and of fields
    that are there but unreadable, whose rows stay with a NULL.

    The lines are parsed once, under a schema with a corrupt-record column, and
    stored: a scan that reads some columns only would not notice broken lines."""
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    stored = materialize(parsed, "csv_lines")
    whole = stored.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    texts = {f"_{c}": F.col(c) for c in CHECKED}
    typed = typed_transactions(whole.withColumns(texts))
    missing = lambda c: F.col(c).isNull() | F.lower(F.trim(c)).isin(*MISSING_TEXTS)
    reasons = F.filter(F.array(*[F.when(F.col(c).isNull() & ~missing(f"_{c}"), F.lit(why)) for c, why in CHECKED.items()]), lambda r: r.isNotNull())
    line = F.concat_ws(",", *[F.col(f"_{c}") if c in CHECKED else F.col(c) for c in RAW_SCHEMA.names])
    unread = typed.select(F.explode(reasons).alias("reason"), line.alias("line"))
    broken = stored.where(F.col(CORRUPT).isNotNull()).select(F.lit("broken_line").alias("reason"), F.col(CORRUPT).alias("line"))
    return typed.drop(*texts), broken.unionByName(unread)


def retail_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail view T1 over the driver tables (FIXTURES.md §3).

    lineitem ⋈ orders ⋈ customer ⋈ nation. The two big sides shuffle on the
    order key and join by a sort-merge join, which may spill and whose skewed
    partitions AQE splits; customer and nation are left to AQE,
    which broadcasts them only when their measured size is below the
    broadcast threshold.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag",
    )
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
    )
    pk = F.col("l_partkey")
    stockcode = (
        F.when(pk == 1, F.lit("m"))
        .when(pk == 2, F.lit("M"))
        .when(pk == 3, F.lit("B"))
        .when(pk == 4, F.lit("D"))
        .when(pk == 5, F.lit(None).cast("string"))
        .otherwise(pk.cast("string"))
    )
    return j.select(
        F.col("l_orderkey").cast("string").alias("invoiceno"),
        stockcode.alias("stockcode"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), -F.col("l_quantity"))
        .otherwise(F.col("l_quantity"))
        .alias("quantity"),
        F.col("o_orderdate").alias("invoicedate"),
        F.when(F.col("l_suppkey") % 50 == 0, F.lit(None).cast("double"))
        .otherwise(nan_to_null(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))))
        .alias("unitprice"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customerid"),
        F.when(F.col("l_orderkey") % 20 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("n_name"))
        .alias("country"),
        *ORDER_KEYS,
    )
