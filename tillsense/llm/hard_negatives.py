"""Operator 12: hard-negative mining by threshold joins with lowered thresholds.

A threshold join finds, for each query, all rows whose inner product reaches the
query's threshold. Rows and queries are cut into blocks, and a task joins one
block of rows with one of queries (a stated query set against all rows): inside it
an inverted index holds, for every chunk of dimensions, the rows that are posted
there. The dimensions are in one order for all, heaviest first. A row is not posted
in the last ones if the norm of that suffix, times the greatest norm of a query's
suffix, is below the least threshold: what is left out there cannot bring a pair
to it alone. Partial scores are accumulated from chunk to chunk; a pair whose
partial score plus the product of both remaining norms is below the threshold is
pruned, rows without a pair left are dropped from further chunks, and pairs that
stay get their exact score.

Top-k searches and windows are threshold joins in rounds. A round with a high
threshold prunes nearly everything; a query whose k best rows, or whose window,
is filled by rows above its threshold is done, because no other row scores
higher; only the others go on with a lower threshold, at last with one that cannot
miss a row. Of every block only a query's k best rows leave the task.

Scores are exact integers: sums in float32 or float64 only where all partial sums
are exactly representable, Python integers beyond.

Defined cases: rows with a null label, a null vector or null or non-finite
components take no part; vectors of different length never meet; a null vec_id is a
row like others, never an anchor, and comes first among ties; rows with equal vec_id
are rows of their own; an empty table gives an empty result; other columns are
ignored. A scaled component or a score beyond 64 bits is an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsense.llm.common import stored

SCALE = 256.0
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 30, 90
#: Thresholds of the rounds: shares of the product of the norms, then none at all;
#: for windows, shares of the way from its lower end to its upper one.
LEVELS = (0.5, 0.25)
WINDOW_LEVELS = (0.9, 0.6)
#: Rows of a block (at least, at most), queries of a block, and of a tile in a task.
ROWS, QUERIES, TILE = (4096, 65536), 8192, (256, 4096)
CHUNKS = 4
NO_ID = np.iinfo(np.int64).min
MOST = 2**63 - 1


def pack(vectors: list[np.ndarray]) -> list[bytes]:
    """Each integer vector in the narrowest of 2, 4 and 8 bytes a component."""
    out = []
    for v in vectors:
        most = max(abs(int(v.max())), abs(int(v.min()))) if len(v) else 0
        out.append(v.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.int64).tobytes())
    return out


def unpack(packed: list[bytes], dim: int) -> np.ndarray:
    """The packed vectors as rows of int64."""
    out = np.zeros((len(packed), dim), dtype=np.int64)
    if dim:
        width = np.array([len(b) // dim for b in packed], dtype=np.int64)
        for w in np.unique(width):
            at = np.nonzero(width == w)[0]
            out[at] = np.frombuffer(b"".join(packed[i] for i in at), dtype=f"<i{w}").reshape(len(at), dim)
    return out


def suffix_norms(v: np.ndarray, cuts: list[int]) -> np.ndarray:
    """norm[i, c]: of row i from dimension cuts[c] on, never too small."""
    squares = np.asarray(v, dtype=np.float64) ** 2
    tail = [np.sqrt(squares[:, c:].sum(axis=1)) for c in cuts]
    return np.stack(tail, axis=1) * (1 + 1e-9)


def exact_kind(a: np.ndarray, y: np.ndarray) -> type:
    """A type in which every partial inner product of rows of a and y is exact."""
    most = float(np.sqrt((a.astype(np.float64) ** 2).sum(axis=1)).max(initial=0) * np.sqrt((y.astype(np.float64) ** 2).sum(axis=1)).max(initial=0))
    return np.float32 if most < 2**23 else np.float64 if most < 2**52 else object


def posted(norms: np.ndarray, reach: np.ndarray, least: float) -> np.ndarray:
    """How many leading chunks each row is posted in: from there on, its suffix
    norm times the queries' greatest is below the least threshold."""
    covered = norms * reach < least
    return np.where(covered.any(axis=1), covered.argmax(axis=1), norms.shape[1] - 1)


def threshold_pairs(a: np.ndarray, t: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, score) of all pairs with ``a[i] . y[j] >= t[i]``; columns are in the
    order of the dimensions."""
    d = y.shape[1]
    cuts = sorted({round(d * c / CHUNKS) for c in range(CHUNKS + 1)})
    kind = exact_kind(a, y)
    a_norms, y_norms = suffix_norms(a, cuts), suffix_norms(y, cuts)
    a, y = a.astype(kind), y.astype(kind)
    for q in range(0, len(a), TILE[0]):
        qa, qt, qn = a[q : q + TILE[0]], t[q : q + TILE[0]], a_norms[q : q + TILE[0]]
        count = posted(y_norms, qn.max(axis=0), float(qt.min()))
        order = np.argsort(-count, kind="stable")  # postings of a chunk are a prefix
        for r in range(0, len(y), TILE[1]):
            rows = order[r : r + TILE[1]]
            rows = rows[count[rows] > 0] if qt.min() > 0 else rows
            score, alive = np.zeros((len(qa), len(rows)), dtype=kind), np.ones((len(qa), len(rows)), dtype=bool)
            for c in range(len(cuts) - 1):
                n = int((count[rows] > c).sum())
                if n:
                    score[:, :n] += qa[:, cuts[c] : cuts[c + 1]] @ y[rows[:n], cuts[c] : cuts[c + 1]].T
                at = np.minimum(count[rows], c + 1)
                alive = score + qn[:, at] * y_norms[rows, at] >= qt[:, None]
                some = alive.any(axis=0)
                if not some.all():
                    rows, score, alive = rows[some], score[:, some], alive[:, some]
                if not len(rows) or alive.mean() < 0.05:
                    break
            if not len(rows):
                continue
            if alive.mean() < 0.2:
                i, j = np.nonzero(alive)
                for lo in range(0, len(i), 200_000):
                    x, z = i[lo : lo + 200_000], rows[j[lo : lo + 200_000]]
                    s = (qa[x] * y[z]).sum(axis=1) if kind is object else np.einsum("ij,ij->i", qa[x], y[z], dtype=np.float64)
                    ok = s >= qt[x]
                    yield q + x[ok], z[ok], s[ok].astype(np.int64)
            else:
                whole = qa @ y[rows].T
                i, j = np.nonzero(whole >= qt[:, None])
                yield q + i, rows[j], whole[i, j].astype(np.int64)


def best(group: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group by higher score, then smaller tie."""
    order = np.lexsort((tie, -score, group))
    g = group[order]
    start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(g)) - np.repeat(start, np.diff(np.r_[start, len(g)]))
    return order[rank < k]


def _ids(column: pd.Series) -> np.ndarray:
    return column.astype("Int64").fillna(NO_ID).to_numpy(np.int64)


RESULT = "q long, w int, row long, vec_id long, score long"


def _found(k: int, same: bool, order: list[int] | None) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Of a block of rows, the k best for each window [lo, hi] of each query of a
    block, among rows of the query's label or of others."""

    def join(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"q": [], "w": [], "row": [], "vec_id": [], "score": []}).astype({"q": "int64", "w": "int32", "row": "int64", "vec_id": "Int64", "score": "int64"})
        if not len(rows) or not len(queries):
            return empty
        dim = int(rows["dim"].iloc[0])
        y, a = unpack(rows["vec"].tolist(), dim), unpack(queries["vec"].tolist(), dim)
        if order is not None and len(order) == dim:
            y, a = y[:, order], a[:, order]
        ids, row, label = _ids(rows["vec_id"]), rows["row"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
        q, q_label = queries["row"].to_numpy(np.int64), queries["label"].to_numpy(np.int64)
        most = max(len(v) for v in queries["windows"])
        w, lo, hi = (
            np.array([[x[name] for x in v] + [none] * (most - len(v)) for v in queries["windows"]], dtype=np.int64)
            for name, none in (("w", -1), ("lo", MOST), ("hi", -MOST))
        )
        keep = []
        for i, j, s in threshold_pairs(a, lo.min(axis=1), y):
            mine = ((label[j] == q_label[i]) == same) & (row[j] != q[i])
            i, j, s = i[mine], j[mine], s[mine]
            for n in range(w.shape[1]):
                inside = np.flatnonzero((s >= lo[i, n]) & (s <= hi[i, n]))
                x = inside[best(i[inside], s[inside], ids[j[inside]], k)]
                keep.append((i[x], np.full(len(x), n), j[x], s[x]))
        if not keep:
            return empty
        i, n, j, s = (np.concatenate(c) for c in zip(*keep, strict=True))
        x = best(i * w.shape[1] + n, s, ids[j], k)
        i, n, j, s = i[x], n[x], j[x], s[x]
        out_ids = pd.Series(ids[j], dtype="Int64").mask(ids[j] == NO_ID)
        return pd.DataFrame({"q": q[i], "w": w[i, n].astype(np.int32), "row": row[j], "vec_id": out_ids, "score": s})

    return join


def threshold_join(rows: DataFrame, queries: DataFrame, k: int, same: bool, blocks: int, order: list[int] | None) -> DataFrame:
    """(q, w, row, vec_id, score, rank): the k best rows (rank from 1) of each
    window of ``queries`` (row, label, dim, vec, windows: (w, lo, hi))."""
    q_blocks = max(1, math.ceil(queries.count() / QUERIES))
    left = rows.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    right = queries.withColumn("qb", F.pmod(F.xxhash64("row", F.lit("q")), F.lit(q_blocks)).cast("int")).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ["dim", "rb", "qb"]
    cells = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_found(k, same, order), RESULT)
    first = Window.partitionBy("q", "w").orderBy(F.desc("score"), "vec_id", "row")
    return cells.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def _window(w: Column, lo: Column, hi: Column) -> Column:
    return F.struct(w.cast("int").alias("w"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        vectors = [np.asarray(v, dtype=np.int64) for v in pdf["v"]]
        norm = [math.sqrt(float((v.astype(np.float64) ** 2).sum())) for v in vectors]
        yield pd.DataFrame({"vec_id": pdf["vec_id"].astype("Int64"), "label": pdf["label"], "dim": [len(v) for v in vectors], "norm": norm, "vec": pack(vectors)})


def _weights(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[int, np.ndarray] = {}
    for pdf in batches:
        for dim, part in pdf.groupby("dim"):
            s = (unpack(part["vec"].tolist(), int(dim)).astype(np.float64) ** 2).sum(axis=0)
            total[int(dim)] = total.get(int(dim), 0) + s
    for dim, s in total.items():
        yield pd.DataFrame({"dim": dim, "at": np.arange(dim), "s": s})


def prepared(vectors: DataFrame) -> tuple[DataFrame, int, list[int] | None, float]:
    """Of ``vectors`` (vec_id, embedding, label, anchor) the stored rows that take
    part (row, vec_id, label, anchor, dim, norm, vec, rb), the number of blocks, the
    order of the most common length's dimensions, and the greatest norm."""
    x = F.col("embedding")
    sound = F.coalesce(~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(False))
    scaled = F.transform(x, lambda c: F.floor(F.lit(SCALE) * c.cast("double")))
    usable = vectors.filter(F.col("label").isNotNull() & sound)
    whole = usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), scaled.alias("v"))
    packed = stored(whole.mapInPandas(_packed, "vec_id long, label long, dim int, norm double, vec binary"), "negatives-rows")
    about = packed.agg(F.count("*").alias("n"), F.max("norm").alias("most"), F.mode("dim").alias("dim")).first()
    n = about["n"]
    heavy = packed.mapInPandas(_weights, "dim int, at int, s double").groupBy("dim", "at").agg(F.sum("s").alias("s")).filter(F.col("dim") == F.lit(about["dim"] or 0))
    order = [r["at"] for r in heavy.orderBy(F.desc("s"), "at").collect()] or None  # one number a dimension
    size = max(ROWS[0], min(ROWS[1], n // 256))
    blocks = max(1, math.ceil(n / size))
    rows = packed.withColumn("row", F.monotonically_increasing_id())
    return stored(rows.withColumn("rb", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")), "negatives-blocks"), blocks, order, about["most"] or 0.0


def _united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def nearest(rows: DataFrame, anchors: DataFrame, k: int, blocks: int, order: list[int] | None, most: float) -> DataFrame:
    """(q, row, vec_id, score, rank): the k best other rows of each anchor's label."""
    todo, done = anchors.withColumn("w", F.lit(0)), []
    for level in [*LEVELS, None]:
        lo = F.lit(-MOST) if level is None else F.floor(F.col("norm") * F.lit(level * most))
        asked = todo.withColumn("windows", F.array(_window(F.lit(0), lo, F.lit(MOST))))
        found = stored(threshold_join(rows, asked.select("row", "label", "dim", "vec", "windows"), k, True, blocks, order), "negatives-near")
        if level is None:
            done.append(found)
            break
        full = found.groupBy("q").agg(F.count("*").alias("c")).filter(F.col("c") >= k).select("q")
        done.append(found.join(full, "q", "left_semi"))
        todo = stored(todo.join(full.withColumnRenamed("q", "row"), "row", "left_anti"), "negatives-todo")
        if todo.isEmpty():
            break
    return _united(done).select("q", "row", "vec_id", "score", "rank")


def in_windows(rows: DataFrame, anchors: DataFrame, windows: DataFrame, k: int, blocks: int, order: list[int] | None) -> DataFrame:
    """(q, w, vec_id, score, rank): the k best rows of other labels in each window of
    ``windows`` (q, w, lo, hi)."""
    todo, done = stored(windows.filter("lo <= hi"), "negatives-windows"), []
    for level in [*WINDOW_LEVELS, 0.0]:
        cut = todo.withColumn("lo", F.ceil(F.col("lo") + (F.col("hi") - F.col("lo")) * F.lit(level))) if level else todo
        asked = cut.groupBy("q").agg(F.collect_list(_window(F.col("w"), F.col("lo"), F.col("hi"))).alias("windows"))  # a few for each
        queries = anchors.join(asked.withColumnRenamed("q", "row"), "row").select("row", "label", "dim", "vec", "windows")
        found = stored(threshold_join(rows, queries, k, False, blocks, order), "negatives-found")
        if not level:
            done.append(found)
            break
        full = found.groupBy("q", "w").agg(F.count("*").alias("c")).filter(F.col("c") >= k).select("q", "w")
        done.append(found.join(full, ["q", "w"], "left_semi"))
        todo = stored(todo.join(full, ["q", "w"], "left_anti"), "negatives-windows")
        if todo.isEmpty():
            break
    return _united(done).select("q", "w", "vec_id", "score", "rank")


def percent(part: int) -> Column:
    """``score`` times ``part`` over 100, rounded down, in whole numbers."""
    return F.expr(f"cast(floor(cast(score as decimal(20, 0)) * {part} / 100) as bigint)")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """Hard negatives of the anchors among ``vectors`` (vec_id, embedding, label):
    for each anchor and each of its first ``positives`` rows of the same label, the
    first ``negatives`` rows of other labels that score between ``low`` and
    ``high`` percent of the positive's score."""
    rows, blocks, order, most = prepared(vectors)
    anchors = stored(rows.filter(F.coalesce(is_anchor, F.lit(False))).drop("rb"), "negatives-anchors")
    near = stored(nearest(rows, anchors, positives, blocks, order, most), "negatives-positives")
    windows = near.select("q", F.col("rank").alias("w"), (-percent(-low)).alias("lo"), percent(high).alias("hi"))
    found = in_windows(rows, anchors, windows, negatives, blocks, order)
    of_positive = near.select("q", F.col("rank").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = found.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(of_positive, ["q", "w"])
    return named.join(anchors.select(F.col("row").alias("q"), F.col("vec_id").alias("anchor_id")), "q").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """The query: rows whose vec_id is divisible by 7 get the next of ten labels,
    rows whose vec_id is divisible by 100 are anchors."""
    moved = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


NEGATIVES_SQL = f"""WITH e AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.rid AS q, a.vec_id AS anchor_id, b.rid AS rid, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.rid <> b.rid AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id NULLS FIRST, rid) <= {POSITIVES}
),
windows AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.q, p.rid ORDER BY n.score DESC, n.vec_id NULLS FIRST, n.rid) AS rank
  FROM positives p JOIN scored n ON p.q = n.q AND NOT n.same AND {LOW} * p.score <= 100 * n.score AND 100 * n.score <= {HIGH} * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= {NEGATIVES}"""
