"""Helpers shared by the training-data operators.

Everything a job stores on its way goes to the shared folder of
``spark.checkpoint.dir`` (``tillsense.sources.tables``), never to a local
folder of one machine.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillsense.sources.tables import materialize

#: A word is a maximal run of characters other than these (space, tab, LF,
#: VT, FF, CR): the same rule in Python, Spark (Java) and DuckDB (RE2).
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

#: Bits of the filter of :func:`id_filter`: 128 KB.
FILTER_BITS = 2**20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage)."""
    return materialize(df, f"llm-{name}")


#: Bytes of rows that a Python worker gets at a time.
BATCH_BYTES = 4 * 2**20


def small_batches(df: DataFrame) -> None:
    """Texts reach Python workers in batches of ``BATCH_BYTES`` (Spark's default
    is 64 MB; two workers of a small executor hold several copies of each)."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def texts_of(column) -> list[str]:
    """The texts of a pandas column, null as the empty text."""
    return [t if isinstance(t, str) else "" for t in column]


def n_words(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_batches(pdf, rows: int = 1000, chars: int = 500_000):
    """Slices of a pandas batch with a bounded number of rows and characters
    (one longer text is a slice of its own)."""
    sizes = [len(t) if isinstance(t, str) else 0 for t in pdf["text"]]
    start = total = 0
    for i, s in enumerate(sizes):
        if i > start and (i - start >= rows or total + s > chars):
            yield pdf.iloc[start:i]
            start, total = i, 0
        total += s
    if start < len(pdf):
        yield pdf.iloc[start:]


def hash_cells(n_rows: int) -> int:
    """Cells per group for :func:`cell_of`: the square root of the row count,
    so both a cell and the list of a group's cells stay small at any size."""
    return max(1, math.isqrt(max(0, n_rows - 1)) + 1)


def md5_key(col: Column, salt: str) -> Column:
    """Uniform hex key of a value (null: empty); the same in DuckDB."""
    return F.md5(F.concat(F.coalesce(col.cast("string"), F.lit("")), F.lit("|" + salt)))


def cell_of(key: Column, cells: int) -> Column:
    """Cell 0..cells-1 of a hex key, monotone in the key: keys are uniform, so
    equal-width cells are balanced without sampling range bounds."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(cells) / F.lit(2**32)).cast("int")


def prefix_sums(df: DataFrame, group: list[str], key: str, tie: list[str], weight: str | None, out: str, cells: int) -> DataFrame:
    """Exclusive prefix sums of ``weight`` (None: 1 each, i.e. row numbers from
    0) inside each ``group`` in the order of the uniform hex ``key``, ties by
    ``tie``; null groups are a group. Adds the column ``out``.

    A group is cut into ``cells`` key ranges; a cell is sorted by one task, a
    cell's start is the sum of the cells before it (one small row each). No
    group is ever in one task.
    """
    w = F.lit(1).cast("long") if weight is None else F.col(weight)
    gcols = [F.coalesce(F.concat(F.lit("="), F.col(g).cast("string")), F.lit("")) for g in group]
    d = df.withColumn("_g", F.concat_ws("\x00", *gcols)).withColumn("_c", cell_of(F.col(key), cells))
    inner = Window.partitionBy("_g", "_c").orderBy(key, *tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = d.withColumn("_in", F.sum(w).over(inner) - w)
    totals = d.groupBy("_g", "_c").agg(F.sum(w).alias("_t"))
    before = Window.partitionBy("_g").orderBy("_c").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = totals.select("_g", "_c", (F.sum("_t").over(before) - F.col("_t")).alias("_start"))
    return rows.join(starts, ["_g", "_c"]).withColumn(out, (F.col("_start") + F.col("_in")).cast("long")).drop("_g", "_c", "_in", "_start")


def constant(values) -> Column:
    """A constant array of whole numbers (parsed once, when the plan is made)."""
    return F.split(F.lit(",".join(str(int(v)) for v in values)), ",").cast("array<bigint>")


def id_filter(ids: DataFrame, column: str):
    """A condition on a column that is true for all of ``ids`` and, up to about a
    million of them, for few others: a constant of ``FILTER_BITS`` bits, tested
    in the JVM. (Beyond that Spark's own Bloom filter joins set in.)"""
    bit = F.pmod(F.xxhash64(F.col(column)), F.lit(FILTER_BITS))
    marked = ids.select(F.floor(bit / 64).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")).alias("m"))
    words = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for r in marked.groupBy("w").agg(F.bit_or("m").alias("m")).collect():  # FILTER_BITS / 64 numbers at most
        words[r["w"]] = r["m"]
    table = constant(words)

    def maybe(c: str) -> Column:
        at = F.pmod(F.xxhash64(F.col(c)), F.lit(FILTER_BITS))
        return F.call_function("bit_get", F.get(table, F.floor(at / 64).cast("int")), (at % 64).cast("int")) == 1

    return maybe
