"""Operator 11: a Merkle manifest of a dataset, with proofs by DAG descent.

A row's leaf is a digest of its columns. The leaves of a source, in order of
their id, are the lowest level of a tree: runs of ``FANOUT`` nodes become the
digest of their digests until one node, the subroot, is left; the subroots, in
order of their source, are the leaves of a second tree, whose top is the root.

The manifest is content-addressed: every level is stored as records (digest,
children). Proofs are found from the root downwards. A frontier of requested
nodes starts at the root; a join by digest finds a node's children, the digits
of the requested ranks pick those to go on with, and the children that are not
picked become a segment of the path. At the leaves the segments are in reverse
order. Nodes travel down once for all requests below them, so no digest is a
hot key, although every proof passes the root; only the last step has a row for
each request.

Ranks inside a source are distributed (range partitions and their totals), so a
source that holds most rows is not one task. The driver gets the root digest
and two tree heights.

Defined cases: a null in any column is ``-``, unlike an empty text (``0:``); a
null doc_id sorts first, null sources before all others; rows that share a
doc_id are ordered by their leaf, equal rows are interchangeable leaves of
their own; very long texts are hashed whole, in the JVM; a table with one row
has its leaf as root and an empty proof; an empty table has no root and gives
an empty result; other columns take no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsense.llm.common import stored
from tillsense.operators.ranking import running_total

FANOUT = 16
LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SEGMENT = "array<struct<left string, right string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A column's value as it enters a leaf: ``-`` or its bytes and their number."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*columns: Column) -> Column:
    return digest(*[field(c) for c in columns])


def joined(digests: Column) -> Column:
    return F.array_join(digests, "")


@dataclass
class Tree:
    """Levels 1, 2, ... of one or many trees: (grp, idx, digest, children, n),
    where n is the number of nodes of the tree on that level."""

    leaves: DataFrame
    levels: list[DataFrame]

    def tops(self) -> DataFrame:
        """(grp, depth, digest) of every tree."""
        parts = [t.filter("n = 1").select("grp", F.lit(i).alias("depth"), "digest") for i, t in enumerate([self.leaves, *self.levels])]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def records(self, level: int) -> DataFrame:
        """(digest, children) of a level, each digest once."""
        return self.levels[level - 1].select("digest", "children").dropDuplicates(["digest"])


def build(leaves: DataFrame, name: str) -> Tree:
    """The trees over stored ``leaves`` (grp, idx, digest, n): idx from 0
    inside each of its groups, n the group's number of leaves."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    below = leaves
    while most > 1:
        place = F.col("idx") % FANOUT
        runs = below.filter("n > 1").groupBy("grp", F.floor(F.col("idx") / FANOUT).alias("idx")).agg(
            F.array_sort(F.collect_list(F.struct(place.alias("at"), F.col("digest")))).alias("run"), F.first("n").alias("n")
        )
        nodes = runs.select("grp", "idx", F.col("run.digest").alias("children"), F.ceil(F.col("n") / FANOUT).alias("n"))
        below = stored(nodes.withColumn("digest", digest(joined(F.col("children")))), f"{name}-level")
        levels.append(below)
        most = -(-most // FANOUT)
    return Tree(leaves, levels)


def ranked(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with idx (from 0 in each group) and n (the group's size)."""
    out = running_total(rows, group, order, out="idx", total_out="n")
    return out.withColumn("idx", F.col("idx") - 1)


@dataclass
class Manifest:
    """The trees of all sources, the tree over them, and its root (None: no rows)."""

    sources: Tree
    top: Tree
    root: str | None


def manifest(leaves: DataFrame) -> Manifest:
    """The manifest of ``leaves`` (grp: the source's key, doc_id, leaf, ...);
    its ``sources.leaves`` are these rows with idx, digest and n."""
    tied = leaves.withColumn("_tie", F.rand(11))  # spreads equal rows over the ranges
    numbered = ranked(stored(tied, "merkle-leaves"), ["grp"], ["doc_id", "leaf", "_tie"]).drop("_tie")
    sources = build(stored(numbered.withColumn("digest", F.col("leaf")), "merkle-ranked"), "merkle")
    tops = stored(ranked(sources.tops().withColumnRenamed("grp", "source_key"), [], ["source_key"]).withColumn("grp", F.lit("")), "merkle-subroots")
    top = build(tops, "merkle-top")
    found = top.tops().first()
    return Manifest(sources, top, found["digest"] if found else None)


def _segment(children: Column, digit: Column) -> Column:
    return F.struct(
        joined(F.slice(children, F.lit(1), digit)).alias("left"),
        joined(F.slice(children, digit + 2, F.lit(FANOUT))).alias("right"),
    )


def _children(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """The children of the frontier's nodes, with a longer path."""
    kept = [c for c in frontier.columns if c not in ("idx", "digest", "path")]
    wide = frontier.join(records, "digest").select(*kept, "idx", "path", "children", F.posexplode("children").alias("digit", "child"))
    return wide.select(
        *kept,
        (F.col("idx") * FANOUT + F.col("digit")).alias("idx"),
        F.col("child").alias("digest"),
        F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"),
    )


def _wanted(frontier: DataFrame, requests: DataFrame | None, level: int) -> DataFrame:
    """The frontier's nodes above some requested leaf (grp, idx)."""
    if requests is None:
        return frontier
    above = requests.select("grp", F.floor(F.col("idx") / F.lit(FANOUT**level)).alias("idx")).distinct()
    return frontier.join(above, ["grp", "idx"], "left_semi")


def prove(m: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The requested leaves (grp, idx; None: all) with their ``subroot`` and
    their proof: ``path``, segments (left, right) of siblings from the leaf
    to the root."""
    leaves = m.sources.leaves if requests is None else m.sources.leaves.join(requests.select("grp", "idx").distinct(), ["grp", "idx"], "left_semi")
    # from the root to the subroots
    down = m.top.tops().select("digest", F.lit(0).cast("long").alias("idx"), F.array().cast(SEGMENT).alias("path"))
    for level in range(len(m.top.levels), 0, -1):
        down = _children(down, m.top.records(level))
    tops = m.top.leaves.select(F.col("idx"), F.col("source_key").alias("grp"), "depth", F.col("digest").alias("subroot"))
    starts = down.join(tops, "idx").select("grp", "depth", "subroot", F.col("subroot").alias("digest"), F.lit(0).cast("long").alias("idx"), "path")
    # from the subroots to the lowest nodes; a tree joins in at its own height
    frontier = None
    for level in range(len(m.sources.levels), 0, -1):
        here = starts.filter(F.col("depth") == level).drop("depth")
        frontier = here if frontier is None else here.unionByName(_children(frontier, m.sources.records(level + 1)))
        frontier = _wanted(frontier, requests, level)
    single = leaves.filter("n = 1").join(starts.filter("depth = 0").select("grp", "subroot", "path"), "grp")
    if frontier is None:
        return single.withColumn("path", F.reverse("path"))
    runs = frontier.join(m.sources.records(1), "digest").select("grp", F.col("idx").alias("_run"), "subroot", "path", "children")
    many = leaves.filter("n > 1").withColumn("_run", F.floor(F.col("idx") / FANOUT)).join(runs, ["grp", "_run"])
    last = _segment(F.col("children"), (F.col("idx") % FANOUT).cast("int"))
    many = many.withColumn("path", F.concat("path", F.array(last))).drop("_run", "children")
    return many.unionByName(single).withColumn("path", F.reverse("path"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(path, leaf, lambda d, s: digest(s["left"], d, s["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a proof, from leaf to root, left to right."""
    return digest(joined(F.transform(path, lambda s: F.concat(s["left"], s["right"]))))


def leaves_of(docs: DataFrame) -> DataFrame:
    """(grp, doc_id, leaf, tampered) of every row of ``docs``; ``tampered`` is
    the leaf of the row after the tampering of the check: where 5 divides the
    crc32 of the doc_id, A-Z of the text are lower-cased."""
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = leaf_of(*columns, F.col("text"))
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))  # null sorts first
    tampered = F.when(touched, leaf_of(*columns, F.translate("text", *LETTERS))).otherwise(leaf)
    return docs.select(key.alias("grp"), "doc_id", leaf.alias("leaf"), tampered.alias("tampered"))


def verify_documents(docs: DataFrame) -> DataFrame:
    """The digest of the manifest of a documents table, of all its proofs and of
    their check against tampered rows."""
    m = manifest(leaves_of(docs))
    folded = fold(F.col("tampered"), F.col("path"))
    out = prove(m).select("doc_id", "leaf", "subroot", F.lit(m.root).cast("string").alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: Levels that the SQL unrolls: enough for 16^5 rows a source and sources.
SQL_LEVELS = 5


def _tree_sql(leaves: str, name: str) -> str:
    """CTEs {name}0.. (grp, r, d, n) and {name}k1.. (grp, r, kids) over ``leaves``."""
    out = [f"{name}0 AS ({leaves})"]
    for i in range(SQL_LEVELS):
        out.append(f"{name}k{i + 1} AS (SELECT grp, r // 16 AS r, list(d ORDER BY r) AS kids, (any_value(n) + 15) // 16 AS n FROM {name}{i} WHERE n > 1 GROUP BY grp, r // 16)")
        out.append(f"{name}{i + 1} AS (SELECT grp, r, sha256(array_to_string(kids, '')) AS d, n FROM {name}k{i + 1})")
    tops = " UNION ALL ".join(f"SELECT grp, d FROM {name}{i} WHERE n = 1" for i in range(SQL_LEVELS + 1))
    return ",\n".join([*out, f"{name}_top AS ({tops})"])


def _fold_sql(name: str, start: str) -> str:
    """CTEs that fold through the tree ``name`` from CTE ``start`` (grp, r, p, f, *)."""
    out = []
    for i in range(1, SQL_LEVELS + 1):
        before = start if i == 1 else f"{name}f{i - 1}"
        left, right = "array_to_string(kids[1 : r % 16], '')", "array_to_string(kids[r % 16 + 2 :], '')"
        out.append(
            f"{name}f{i} AS (SELECT x.* EXCLUDE (r, p, f, kids), x.r // 16 AS r, CASE WHEN kids IS NULL THEN p ELSE p || {left} || {right} END AS p, "
            f"CASE WHEN kids IS NULL THEN f ELSE sha256({left} || f || {right}) END AS f "
            f"FROM (SELECT b.*, k.kids FROM {before} b LEFT JOIN {name}k{i} k ON b.grp = k.grp AND b.r // 16 = k.r) x)"
        )
    return ",\n".join(out)


def _field_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c} END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_CRC_SQL = (
    "xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
    "lambda a, b: xor(xor(a, b) >> 1, 3988292384::UBIGINT * (xor(a, b) & 1))), 4294967295::UBIGINT)"
)

MANIFEST_SQL = f"""WITH docs AS (
  SELECT coalesce('=' || source, '') AS grp, doc_id, {_leaf_sql("text")} AS leaf,
         CASE WHEN {_CRC_SQL} % 5 = 0 THEN {_leaf_sql(f"translate(text, '{LETTERS[0]}', '{LETTERS[1]}')")} ELSE {_leaf_sql("text")} END AS tampered
  FROM documents
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY grp) AS n FROM docs
),
{_tree_sql("SELECT grp, r, leaf AS d, n FROM numbered", "s")},
sub AS (SELECT grp AS src, d, row_number() OVER (ORDER BY grp) - 1 AS r, count(*) OVER () AS n FROM s_top),
{_tree_sql("SELECT 'all' AS grp, r, d, n FROM sub", "t")},
start AS (SELECT doc_id, leaf, grp, r, '' AS p, tampered AS f FROM numbered),
{_fold_sql("s", "start")},
middle AS (SELECT doc_id, leaf, sub.d AS subroot, 'all' AS grp, sub.r AS r, p, f FROM sf{SQL_LEVELS} JOIN sub ON sub.src = sf{SQL_LEVELS}.grp),
{_fold_sql("t", "middle")}
SELECT doc_id, leaf, subroot, (SELECT d FROM t_top) AS root, sha256(p) AS proof_sha256, f AS folded_root, f = (SELECT d FROM t_top) AS verified
FROM tf{SQL_LEVELS}"""
