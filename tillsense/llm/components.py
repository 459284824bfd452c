"""Distributed union-find: connected components of an edge table.

Each partition first shrinks its edges to a spanning forest of stars (a small
union-find over what one task reads). Then alternating star rounds join what
is left: in a *large-star* round every node links its larger neighbours to the
smallest node it knows, in a *small-star* round its smaller neighbours and
itself. The rounds end when every node has one edge, to a node that has none:
its component's smallest node. Each round's edges are written to the shared
folder, so a lost executor costs one round at most. Nodes with very many edges
are aggregated before the shuffle (minimum) and joined by a join that may be
split; no node's edges are ever collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsense.llm.common import stored

MAX_ROUNDS = 60


def union(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of all nodes of the edges a-b; the root is the component's
    smallest node."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        high = np.maximum(root[x], root[y])
        if (low == high).all():
            return nodes, nodes[root]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    a = b = np.zeros(0, dtype=np.int64)
    for pdf in batches:
        a, b = np.concatenate([a, pdf["a"].to_numpy(np.int64)]), np.concatenate([b, pdf["b"].to_numpy(np.int64)])
        if len(a):
            node, root = union(a, b)
            own = node != root
            a, b = node[own], root[own]
    if len(a):
        yield pd.DataFrame({"u": a, "v": b})


def _hooked(edges: DataFrame, large: bool) -> DataFrame:
    """One star round over directed edges u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("_m")).withColumn("_m", F.least("u", "_m"))
    linked = both.join(least, "u")
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("_m").alias("v")).unionByName(least.select("u", F.col("_m").alias("v")))
    return out.filter("u != v").distinct()


def _is_flat(stars: DataFrame) -> bool:
    """Every node has one edge, to a node that has none."""
    repeated = stars.groupBy("u").agg(F.count("*").alias("c")).filter("c > 1")
    if not repeated.isEmpty():
        return False
    return stars.join(stars.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected ``edges`` (a, b: long):
    the component is its smallest node. No edges: no rows."""
    stars = stored(edges.select("a", "b").filter("a != b").mapInPandas(_forest, "u long, v long").distinct(), "components")
    for _ in range(MAX_ROUNDS):
        if _is_flat(stars):
            break
        stars = stored(_hooked(_hooked(stars, True), False), "components")
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    roots = stars.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def index_entries(entries: DataFrame) -> DataFrame:
    """From (key, id, n, at) the stored rows whose key has other ids, with the
    row of the key's smallest id as ``p``. A row may come more than once."""
    key = Window.partitionBy("key")
    grouped = entries.withColumn("_last", F.max("id").over(key)).withColumn("p", F.min(F.struct("id", "n", "at")).over(key))
    return stored(grouped.filter("_last != p.id").select("key", "id", "n", "at", "p"), "index")


def _possible(n: str, at: str, m: str, bt: str) -> Column:
    """Sets of n and m values have a similarity of 4/5 if 9 o >= 4 (n + m) for
    their overlap o. From the positions (not -1) of their first common value on
    in a common order, at most the shorter rest is common."""
    rest = F.when((F.col(at) < 0) | (F.col(bt) < 0), F.least(n, m)).otherwise(F.least(F.col(n) - F.col(at), F.col(m) - F.col(bt)))
    return rest * 9 >= (F.col(n) + F.col(m)) * 4


def linked_components(index: DataFrame, verified: Callable[[DataFrame], DataFrame], possible: Callable[..., Column] | None = None) -> DataFrame:
    """(node, component) over the ids linked by ``verified`` (of candidates
    a, b, those that are similar), where all similar pairs share a key and are
    ``possible`` by their n and at.

    Pairs within a key are never all emitted. A key's pivot is its smallest id.
    First every id meets the one pivot that it shares most keys with; then the
    pivots of its keys that are still in other components; at last, ids of a key
    that are still in different components meet each other. Links inside a
    component cannot change it, and no other link is lost.
    """

    possible = possible or _possible

    def placed(pairs: DataFrame, one: DataFrame, columns: tuple[str, str]) -> DataFrame:
        """The pairs whose ids are in different components."""
        for c in columns:
            pairs = pairs.join(one.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")), c, "left").withColumn(f"_{c}", F.coalesce(f"_{c}", c))
        a, b = (f"_{c}" for c in columns)
        return pairs.filter(F.col(a) != F.col(b)).drop(a, b)

    stars = index.select("id", "n", "at", F.col("p.id").alias("pid"), F.col("p.n").alias("pn"), F.col("p.at").alias("pat")).filter("id != pid")
    pairs = stored(stars.filter(possible("n", "at", "pn", "pat")).groupBy(F.col("pid").alias("a"), F.col("id").alias("b")).agg(F.count("*").alias("keys")), "pairs")
    best = stored(pairs.groupBy("b").agg(F.max_by("a", F.struct("keys", -F.col("a"))).alias("a")).select("a", "b"), "pairs")
    links = stored(verified(best), "links")
    one = components(links)
    rest = stored(placed(pairs.select("a", "b").join(best, ["a", "b"], "left_anti"), one, ("a", "b")), "pairs")
    links = links.unionByName(stored(verified(rest), "links"))
    one = components(links)

    rows = index.join(one.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")).select("key", "id", "n", "at", "component")
    mixed = rows.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).filter("_lo != _hi").select("key")
    left = stored(rows.join(mixed, "key", "left_semi"), "mixed-keys")
    other = left.select("key", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "at", "component")])
    cross = left.join(other, "key").filter((F.col("id") < F.col("id2")) & (F.col("component") != F.col("component2")) & possible("n", "at", "n2", "at2"))
    more = stored(cross.select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
    return components(links.unionByName(stored(verified(more), "links")))
