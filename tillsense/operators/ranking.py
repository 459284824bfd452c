"""Ordered ranking without a one-task group.

``Window.partitionBy(key)`` sends each group to a single task; with a key
that holds a third of the rows that task is the whole job. The helpers here
range-partition on (group, order) so a hot group is spread over many
partitions, compute the running total inside each partition, and add the
totals of the earlier partitions of the same group (a table with at most
``partitions`` rows per group).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsense.session import shuffle_partitions
from tillsense.sources.tables import materialize

_ALL = "_grp_all"


def _cols(names: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def running_total(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence,
    out: str | Sequence[str] = "rn",
    weight: str | Sequence[str] | None = None,
    partitions: int | None = None,
    total_out: str | Sequence[str] | None = None,
    next_of: str | None = None,
) -> DataFrame:
    """Add ``out`` = running sum of ``weight`` (1 when None) inside each group,
    in the given order (ROWS frame: unbounded preceding .. current row), and
    optionally ``total_out`` = the group's grand total.

    With weight=None and a total order ``out`` is ``row_number()`` and
    ``total_out`` is ``count(*)`` of the group. ``weight``/``out``/``total_out``
    may be lists to carry several running sums through one range shuffle.
    ``next_of`` adds ``next_<col>``: the column's value on the next row of the
    group in this order (NULL on the last row) -- ``lead`` across partitions.
    """
    if isinstance(weight, (list, tuple)):
        weights = list(weight)
        outs = list(out)
        totals_out = list(total_out) if total_out else [None] * len(weights)
    else:
        weights, outs, totals_out = [weight], [out], [total_out]
    group_cols = list(group_cols)
    added_all = False
    if not group_cols:
        df = df.withColumn(_ALL, F.lit(0))
        group_cols = [_ALL]
        added_all = True
    ws = {f"_w{j}": (F.lit(1).cast("bigint") if w is None else F.col(w)) for j, w in enumerate(weights)}
    order = _cols(order_cols)
    keys = [F.col(g) for g in group_cols] + order
    staged = df.withColumns(ws)
    # Without an explicit count AQE sizes the range partitions from the data
    # (it merges only small neighbours, so a hot group stays split); the
    # partition id is fixed by the write below.
    ranged = staged.repartitionByRange(partitions, *keys) if partitions else staged.repartitionByRange(*keys)
    keyed = ranged.withColumn("_pid", F.spark_partition_id())
    # The rows branch and the totals branch must see the same partitioning.
    # Column pruning gives each branch its own range exchange, i.e. its own
    # sampled bounds, which can differ when the input order is not fixed
    # (shuffle reads, AQE coalescing). Writing the keyed rows once (Parquet
    # in the shared checkpoint folder: survives executor loss) fixes
    # ``_pid``; the totals branch then reads only _pid, group and weights.
    keyed = materialize(keyed, "ranked_input")
    local_w = (
        Window.partitionBy("_pid", *group_cols)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = keyed.withColumns({f"_local{j}": F.sum(f"_w{j}").over(local_w) for j in range(len(weights))})
    part_aggs = [F.sum(f"_w{j}").alias(f"_ptot{j}") for j in range(len(weights))]
    if next_of:
        lead_w = Window.partitionBy("_pid", *group_cols).orderBy(*order)
        local = local.withColumn("_lead_local", F.lead(next_of, 1).over(lead_w))
        part_aggs.append(F.min_by(F.col(next_of), F.struct(*order)).alias("_pfirst"))
    totals = keyed.groupBy("_pid", *group_cols).agg(*part_aggs)
    # at most ``p`` rows per group here, so this window is never skewed
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group_cols)
    offsets = totals.select(
        F.col("_pid").alias("_opid"),
        *[F.col(g).alias(f"_og{i}") for i, g in enumerate(group_cols)],
        *[F.coalesce(F.sum(f"_ptot{j}").over(before), F.lit(0)).alias(f"_off{j}") for j in range(len(weights))],
        *[F.sum(f"_ptot{j}").over(whole).alias(f"_gtot{j}") for j in range(len(weights))],
        *([F.lead("_pfirst", 1).over(Window.partitionBy(*group_cols).orderBy("_pid")).alias("_next_part_first")] if next_of else []),
    )
    cond = F.col("_pid") == F.col("_opid")
    for i, g in enumerate(group_cols):
        cond = cond & F.col(g).eqNullSafe(F.col(f"_og{i}"))
    res = local.join(offsets, cond, "inner")
    res = res.withColumns({o: F.col(f"_off{j}") + F.col(f"_local{j}") for j, o in enumerate(outs)})
    if next_of:
        res = res.withColumn(f"next_{next_of}", F.coalesce(F.col("_lead_local"), F.col("_next_part_first"))).drop(
            "_lead_local", "_next_part_first"
        )
    for j, t in enumerate(totals_out):
        if t:
            res = res.withColumnRenamed(f"_gtot{j}", t)
    helper = ["_pid", "_opid"] + [f"{h}{j}" for j in range(len(weights)) for h in ("_w", "_local", "_off", "_gtot")]
    res = res.drop(*helper, *[f"_og{i}" for i in range(len(group_cols))])
    if added_all:
        res = res.drop(_ALL)
    return res


# ------------------------------------------------ numbering by constant bounds
SAMPLES_PER_CELL = 32
#: Rows of a cell that ``range_numbered`` aims at, and cells at most.
CELL_ROWS, MOST_CELLS = 500_000, 8192
_KINDS = ((T.StringType, "string", ""), (T.BooleanType, "bigint", 0), (T.IntegralType, "bigint", 0), (T.NumericType, "double", 0.0))


def _sort_fields(df: DataFrame, names: Sequence[str]) -> list[tuple[Column, str]]:
    """(value, type) pairs without NULLs that sort as the columns do, NULLs first.
    Equal values of other types than text and whole numbers may fall together."""
    out = []
    for n in names:
        kind = df.schema[n].dataType
        cast, empty = next(((k, e) for t, k, e in _KINDS if isinstance(kind, t)), ("string", ""))
        out += [(F.col(n).isNotNull().cast("bigint"), "bigint"), (F.coalesce(F.col(n).cast(cast), F.lit(empty).cast(cast)), cast)]
    return out


def range_cell(df: DataFrame, names: Sequence[str], cells: int, seed: int = 7) -> Column:
    """The range 0..cells-1 that a row falls in by the order of the columns
    ``names``. The bounds are taken from a sample and are constants of the plan:
    every use of the column, in whatever plan, gives a row the same range."""
    fields = _sort_fields(df, names)
    keys = [f"_k{i}" for i in range(len(fields))]
    n = df.count()
    wanted = cells * SAMPLES_PER_CELL
    slim = df.select(*[v.alias(k) for (v, _), k in zip(fields, keys, strict=True)])
    rows = slim.sample(min(1.0, wanted / n), seed).collect() if n and cells > 1 else []  # about ``wanted`` keys
    picked = sorted({tuple(r) for r in rows if not any(isinstance(v, float) and math.isnan(v) or isinstance(v, str) and "\x01" in v for v in r)})
    bounds = [picked[len(picked) * i // cells] for i in range(1, cells)] if len(picked) >= cells else picked
    if not bounds:
        return F.lit(0)
    # one text constant per field, parsed once when the plan is made
    text = lambda v: repr(v) if isinstance(v, float) else str(v)
    tables = [F.split(F.lit("\x01".join(text(b[i]) for b in bounds)), "\x01").cast(f"array<{kind}>") for i, (_, kind) in enumerate(fields)]
    key = F.struct(*[v.alias(k) for (v, _), k in zip(fields, keys, strict=True)])

    def reached(row: Column, at: Column) -> Column:
        """Bound ``at`` is not above the row: the first field that differs decides,
        and the fields after it are not looked at."""
        out = F.lit(True)
        for i, (_, kind) in reversed(list(enumerate(fields))):
            alike = len({b[i] for b in bounds}) == 1
            bound = F.lit(bounds[0][i]).cast(kind) if alike else F.get(tables[i], at)
            own = row.getField(keys[i])
            out = (bound < own) | ((bound == own) & out)
        return out

    def search(row: Column) -> Column:
        steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
        width = lambda low, w: F.when((low + w - 1 < len(bounds)) & reached(row, low + w - 1), w).otherwise(F.lit(0))
        return F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), lambda low, w: low + width(low, w))

    # the fields are read once a row; a range that cannot be NULL needs no filter
    # (with the search in it) where it is joined
    return F.coalesce(F.get(F.transform(F.array(key), search), 0), F.lit(0))


def range_numbered(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], out: str = "rn", total_out: str | None = None, cells: int | None = None) -> DataFrame:
    """``row_number()`` (and ``count(*)``) inside each group in the order of
    ``order_cols``, ascending with NULLs first, as ``running_total`` gives them,
    without writing the rows.

    The ranges come from constant bounds (``range_cell``), so the plan that counts
    the rows of each range and the one that numbers them agree. Counting reads
    only the key columns; the rows cross one exchange, to their range, with the
    columns that are asked for. ``df`` is read three times: pass a stored table."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    spark = df.sparkSession
    if cells is None:
        cells = min(MOST_CELLS, max(shuffle_partitions(spark), df.count() // CELL_ROWS))
    cell = range_cell(df, [*group_cols, *order_cols], cells)
    keyed = df.withColumn("_cell", cell)
    counts = keyed.groupBy("_cell", *group_cols).agg(F.count(F.lit(1)).alias("_c"))
    # at most one row for each range (and group) here
    whole = Window.partitionBy(*group_cols)
    before = whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    named = [F.col(g).alias(f"_og{i}") for i, g in enumerate(group_cols)]
    offsets = counts.select(
        F.col("_cell").alias("_ocell"), *named, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), F.sum("_c").over(whole).alias("_total"), F.count("_cell").over(whole).alias("_cells")
    )
    # a group inside one range is numbered there; a bound lies in one group, so the
    # others have two rows a range here at most, and the rows are not exchanged for them
    offsets = F.broadcast(offsets.where(F.col("_cells") > 1).drop("_cells"))
    inner = Window.partitionBy("_cell", *group_cols)
    cond = F.col("_cell") == F.col("_ocell")
    for i, g in enumerate(group_cols):
        cond = cond & F.col(g).eqNullSafe(F.col(f"_og{i}"))
    if cells > shuffle_partitions(spark):
        keyed = keyed.repartition(cells, "_cell")  # a task sorts a few ranges
    res = keyed.withColumn("_local", F.row_number().over(inner.orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])))
    if total_out:
        res = res.withColumn("_c", F.count(F.lit(1)).over(inner))
    res = res.join(offsets, cond, "left").withColumn(out, F.coalesce(F.col("_before"), F.lit(0)) + F.col("_local"))
    if total_out:
        res = res.withColumn(total_out, F.coalesce(F.col("_total"), F.col("_c")))
    return res.drop("_cell", "_ocell", "_local", "_before", "_total", "_c", *[f"_og{i}" for i in range(len(group_cols))])


#: Groups with about this many rows are hot: their rows stay spread over the tasks.
HOT_ROWS = 200_000
#: Sampled rows of a hot group that tell it.
HOT_SAMPLE = 200


def hot_groups(df: DataFrame, group_cols: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[Column | None, int]:
    """Whether a row's group has about ``hot_rows`` rows and more (total rows /
    ``hot_rows`` groups of them at most), never NULL, or None where no group has; and
    about how many rows there are. Told by a sample, and groups by a hash: some
    others may be taken for hot."""
    share = min(1.0, HOT_SAMPLE / hot_rows)
    key = F.xxhash64(*group_cols)
    counts = df.select(key.alias("_g")).sample(share, 7).groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    found = counts.agg(F.sum("_n").alias("n"), F.collect_list(F.when(F.col("_n") >= hot_rows * share, F.col("_g"))).alias("hot")).first()
    return key.isin(found["hot"]) if found["hot"] else None, int((found["n"] or 0) / share)


def spread_by(df: DataFrame, keys: Sequence, rows: int, task_rows: int = CELL_ROWS) -> DataFrame:
    """``df`` exchanged to its keys, with enough tasks for ``task_rows`` of its about
    ``rows`` rows each; a smaller table leaves their number to the session."""
    tasks = rows // task_rows
    return df.repartition(tasks, *keys) if tasks > shuffle_partitions(df.sparkSession) else df.repartition(*keys)


def _attach(df: DataFrame, small: DataFrame, group_cols: list[str]) -> DataFrame:
    """Columns of a one-row-per-group table on every row of ``df``: a join on
    the group, or a scalar subquery when there is no group."""
    if group_cols:
        return df.join(small, group_cols, "inner")
    cols = [c for c in small.columns]
    st = small.select(F.struct(*cols).alias("s")).scalar()
    return df.withColumns({c: st.getField(c) for c in cols})


def exact_median(
    df: DataFrame,
    value_col: str,
    group_cols: Sequence[str] = (),
    out: str = "median",
    partitions: int | None = None,
    accuracy: int = 10000,
) -> DataFrame:
    """Exact (interpolated) median per group: the two middle values a <= b
    give a + 0.5*(b-a). NULL and NaN are skipped; a group whose values are
    all missing gets no row (callers left-join and get NULL).

    Select, then rank: ``percentile_approx`` (bounded sketch, combined
    map-side) brackets the middle ranks; one counting pass checks, per group,
    that the bracket holds them (a failed group gets an unbounded bracket,
    so the result is always exact); only the values inside the bracket --
    about 4/accuracy of a large group -- are ranked exactly, as (value,
    count) pairs. No group is buffered in one task and the full table never
    crosses a range shuffle.
    """
    group_cols = list(group_cols)
    v = df.select(*[F.col(g) for g in group_cols], F.col(value_col).cast("double").alias("_v"))
    v = v.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    d = 2.0 / accuracy
    # percentages must lie in [0, 1]; a coarse sketch just widens the bracket
    sketch = [F.percentile_approx("_v", [max(0.0, 0.5 - d), min(1.0, 0.5 + d)], accuracy).alias("_q"), F.count(F.lit(1)).alias("_n")]
    br = v.groupBy(*group_cols).agg(*sketch) if group_cols else v.agg(*sketch)
    br = br.select(*group_cols, F.col("_q")[0].alias("_lo"), F.col("_q")[1].alias("_hi"), "_n")
    vb = _attach(v, br, group_cols)
    counts = [
        F.count_if(F.col("_v") < F.col("_lo")).alias("_below"),
        F.count_if(F.col("_v") <= F.col("_hi")).alias("_upto"),
        F.first("_lo").alias("_lo"),
        F.first("_hi").alias("_hi"),
        F.first("_n").alias("_n"),
    ]
    chk = vb.groupBy(*group_cols).agg(*counts) if group_cols else vb.agg(*counts)
    k_lo = F.floor((F.col("_n") + 1) / 2)
    k_hi = F.ceil((F.col("_n") + 1) / 2)
    covered = (F.col("_below") < k_lo) & (k_hi <= F.col("_upto"))
    final = chk.select(
        *group_cols,
        F.when(covered, F.col("_lo")).otherwise(F.lit(float("-inf"))).alias("_blo"),
        F.when(covered, F.col("_hi")).otherwise(F.lit(float("inf"))).alias("_bhi"),
        F.when(covered, F.col("_below")).otherwise(F.lit(0)).alias("_base"),
        k_lo.alias("_klo"),
        k_hi.alias("_khi"),
    )
    inside = _attach(v, final, group_cols).where((F.col("_v") >= F.col("_blo")) & (F.col("_v") <= F.col("_bhi")))
    keys = group_cols or []
    pairs = inside.groupBy(*keys, "_v", "_base", "_klo", "_khi").agg(F.count(F.lit(1)).alias("_c"))
    ranked = running_total(pairs, keys, [F.col("_v")], out="_cum", weight="_c", partitions=partitions)
    last = F.col("_base") + F.col("_cum")  # global rank of this value's last copy
    first = last - F.col("_c")

    def covers(r):
        return (first < r) & (r <= last)

    picked = ranked.where(covers(F.col("_klo")) | covers(F.col("_khi")))
    agg = [F.min("_v").alias("_a"), F.max("_v").alias("_b")]
    res = picked.groupBy(*keys).agg(*agg) if keys else picked.agg(*agg)
    return res.select(*keys, (F.col("_a") + F.lit(0.5) * (F.col("_b") - F.col("_a"))).alias(out))


def exact_medians(df: DataFrame, value_cols: Sequence[str], out: str = "median", partitions: int | None = None, accuracy: int = 10000) -> DataFrame:
    """Exact median of every column (column_name, ``out``), as ``exact_median``
    gives them; a column whose values are all missing gets no row.

    The brackets and the counting pass are aggregates of whole rows, a few numbers
    a column; a row is taken apart by column only for the values in a bracket."""
    v = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"_v{i}") for i, c in enumerate(value_cols)]
    x = df.select(*v)
    d = 2.0 / accuracy
    shares = [max(0.0, 0.5 - d), min(1.0, 0.5 + d)]
    sketch = x.agg(*[e for i in range(len(v)) for e in (F.percentile_approx(f"_v{i}", shares, accuracy).alias(f"q{i}"), F.count(f"_v{i}").alias(f"n{i}"))]).first()
    live = [i for i in range(len(v)) if sketch[f"n{i}"]]
    counts = x.agg(F.lit(0), *[e for i in live for e in (F.count_if(F.col(f"_v{i}") < sketch[f"q{i}"][0]).alias(f"b{i}"), F.count_if(F.col(f"_v{i}") <= sketch[f"q{i}"][1]).alias(f"u{i}"))]).first()
    entries = [F.lit(None).cast("struct<column_name:string,_v:double,_base:bigint,_klo:bigint,_khi:bigint>")]
    for i in live:
        n = sketch[f"n{i}"]
        k_lo, k_hi = (n + 1) // 2, n // 2 + 1
        covered = counts[f"b{i}"] < k_lo and k_hi <= counts[f"u{i}"]
        lo, hi, base = (*sketch[f"q{i}"], counts[f"b{i}"]) if covered else (-math.inf, math.inf, 0)
        ranks = [F.lit(k).cast("bigint").alias(name) for k, name in ((base, "_base"), (k_lo, "_klo"), (k_hi, "_khi"))]
        value = F.col(f"_v{i}")
        entries.append(F.when((value >= lo) & (value <= hi), F.struct(F.lit(value_cols[i]).alias("column_name"), value.alias("_v"), *ranks)))
    inside = x.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select("e.*")
    pairs = inside.groupBy("column_name", "_v", "_base", "_klo", "_khi").agg(F.count(F.lit(1)).alias("_c"))
    ranked = running_total(pairs, ["column_name"], [F.col("_v")], out="_cum", weight="_c", partitions=partitions)
    last = F.col("_base") + F.col("_cum")
    first = last - F.col("_c")
    picked = ranked.where(((first < F.col("_klo")) & (F.col("_klo") <= last)) | ((first < F.col("_khi")) & (F.col("_khi") <= last)))
    res = picked.groupBy("column_name").agg(F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    return res.select("column_name", (F.col("_a") + F.lit(0.5) * (F.col("_b") - F.col("_a"))).alias(out))


def mode_by(df: DataFrame, group_cols: Sequence[str], value_col: str, out: str = "mode") -> DataFrame:
    """Most frequent non-null value per group, smallest value on ties.

    Two aggregations (count per (group, value), then ``min_by`` over
    (-count, value)); both combine map-side, so a hot group never has to be
    gathered in one task.
    """
    counts = (
        df.where(F.col(value_col).isNotNull())
        .groupBy(*group_cols, value_col)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counts.groupBy(*group_cols).agg(
        F.min_by(F.col(value_col), F.struct((-F.col("_n")).alias("n"), F.col(value_col).alias("v"))).alias(out)
    )


def last_by(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Value of the last row per group under a total order (``max_by``,
    an aggregate with partial combine)."""
    key = F.struct(*[F.col(c) for c in order_cols])
    return df.groupBy(*group_cols).agg(*[F.max_by(F.col(v), key).alias(v) for v in value_cols])
