"""Operator 3: mix sources to target weights.

Targets: a source of weight ``w`` gets ``share * w`` of all words, at most
``max_epochs`` times its own size; what the bound cuts off is shared again by
weight among the others. The fixed point is a water level ``L`` with
``target = min(max_epochs * size, L * w)``: sources sorted by
``max_epochs * size / w`` fill up in that order, so one prefix sum over the
table of sources finds it.

Selection: a document's key is the md5 of its id, uniform and stable, so
reruns agree. Inside each source documents are sorted by the key in ranges and
a distributed prefix sum of their words places each on the source's line. A
budget of ``b`` words takes the whole line ``b div size`` times, and then its
first ``b mod size`` words. A hot source is as many ranges as any other.

Defined cases: null text has 0 words; null source is a source of its own, the
last; null doc_id is the key of an empty id; repeated rows are separate rows;
sources without words take nothing; an empty table gives an empty result;
further columns of the input are kept by :func:`mix`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsense.llm.common import hash_cells, md5_key, n_words, prefix_sums, stored

SALT = "mix"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> with weight, target double and budget long.
    The table has one row for each source; sources are ordered by code point,
    null last, and their weights repeat in that order."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    t = sizes.withColumn("weight", pick).withColumn("_cap", F.col("source_size") * max_epochs)
    total, all_w = F.sum("source_size").over(Window.partitionBy()), F.sum("weight").over(Window.partitionBy())
    fill = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("_total", total).withColumn("_left", all_w - F.sum("weight").over(fill) + F.col("weight")).withColumn("_filled", F.sum("_cap").over(fill) - F.col("_cap"))
    # the level if all sources before this one are full and none after it
    t = t.withColumn("_level", (F.col("_total") - F.col("_filled")) / F.col("_left"))
    # levels only fall once a source that need not be full counts as full: the first is the largest
    level = F.max(F.when(F.col("_level") * F.col("weight") <= F.col("_cap"), F.col("_level"))).over(Window.partitionBy())
    t = t.withColumn("_l", level)
    cap = F.col("_cap").cast("double")
    target = F.when(F.col("_l").isNull(), cap).otherwise(F.least(cap, F.col("_l") * F.col("weight")))
    return t.withColumn("target", target).select("source", "source_size", "weight", "target", F.floor(target + 0.5).cast("long").alias("budget"))


def mix(sized: DataFrame, rows: DataFrame | None = None, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, tie: tuple[str, ...] = ()) -> DataFrame:
    """``sized`` has doc_id, source and size (words), and is read more than
    once: pass a stored table. ``rows``: the same rows with further columns to
    keep (default: ``sized`` itself). Adds source_size, target, epochs (times
    the whole document is taken), cut (words of it taken once more), taken."""
    # a row for each source, however many there are: joined by key, never broadcast by hint
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(per_source, weights, max_epochs)
    cells = hash_cells(sized.count())
    keyed = (sized if rows is None else rows).withColumn("_key", md5_key(F.col("doc_id"), SALT))
    placed = prefix_sums(keyed, ["source"], "_key", ["doc_id", "size", *tie], "size", "_before", cells)
    t = targets.withColumnRenamed("source", "_s")
    d = placed.join(t, F.col("source").eqNullSafe(F.col("_s")))
    some = F.col("source_size") > 0
    epochs = F.when(some, F.expr("budget div source_size")).otherwise(0).cast("long")
    d = d.withColumn("epochs", epochs)
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    d = d.withColumn("cut", F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before"))).cast("long"))
    return d.withColumn("taken", (F.col("epochs") * F.col("size") + F.col("cut")).cast("long")).drop("_s", "_key", "_before", "weight", "budget")


def mix_documents(docs: DataFrame) -> DataFrame:
    """The digest of the mix of a documents table."""
    sized = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sizes")
    return mix(sized).select("doc_id", "source", "size", "source_size", "target", "epochs", "taken")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The mixed corpus itself: each document as often as the mix takes it, with
    the columns of ``docs``. Documents stay whole here: the one at a source's
    cut is taken once more if at least half of it lies before the cut."""
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.struct("*").alias("_row"))  # whatever its columns are called
    d = mix(stored(rows.select("doc_id", "source", "size"), "mix-sizes"), rows, tie=("_row.text",))
    times = F.col("epochs") + F.when((F.col("cut") > 0) & (F.col("cut") * 2 >= F.col("size")), 1).otherwise(0)
    return d.withColumn("_n", times.cast("int")).filter("_n > 0").withColumn("_r", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_row.*")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size
  FROM {docs}),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS weight, source_size * 3 AS cap FROM src),
f AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total,
        CAST(sum(weight) OVER () - sum(weight) OVER o + weight AS BIGINT) AS lefts, CAST(sum(cap) OVER o - cap AS BIGINT) AS filled
      FROM w WINDOW o AS (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
lv AS (SELECT *, (total - filled)::DOUBLE / lefts AS lev FROM f),
l AS (SELECT *, max(CASE WHEN lev * weight <= cap THEN lev END) OVER () AS lvl FROM lv),
t AS (SELECT source, source_size, CASE WHEN lvl IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, lvl * weight) END AS target FROM l),
d AS (
  SELECT s.*, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
    CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(coalesce(CAST(s.doc_id AS VARCHAR), '') || '|mix'), s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - s.size AS before
  FROM sized s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM d)
SELECT doc_id, source, size, source_size, target, CAST(epochs AS BIGINT) AS epochs,
  CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS BIGINT) AS taken
FROM e
"""
