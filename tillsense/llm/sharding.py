"""Operator 2: consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``vnodes`` points on a 32-bit ring. A document's key (its
``doc_id``) hashes to the ring and belongs to the next point clockwise, its
home. Loads are bounded: a shard holds at most ``floor(n / shards)`` documents,
the first ``n mod shards`` shards one more, so counts differ by at most one
(law ``rows``). A shard whose home load exceeds its bound keeps its share of
every arc, in key order; the documents over it continue clockwise to the next
points of shards that have room.

Only the document count of each arc (``shards * vnodes`` numbers, whatever the
input) reaches the driver. It yields a short list of ranges "ranks lo..hi of
arc a go to shard s, from slot k", constants of the plan with a size bound of the
same kind; documents find their range by their rank in the arc, a distributed
prefix sum, and a binary search in the JVM. Copies of a text have keys of their own and spread over shards.

Defined cases: null text is no bytes (size 16, crc of nothing); a null doc_id
is a key like any other; repeated rows are separate rows that share a home and
get different slots; an empty table gives an empty result; other columns are
ignored by the query and kept by :func:`shard`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsense.llm.common import constant, hash_cells, md5_key, prefix_sums, stored

RING = 2**32
SALT = "ring"


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all virtual nodes in ring order, and their shards."""
    from hashlib import md5

    points = sorted((int(md5(f"shard {s} node {v}".encode()).hexdigest()[:8], 16), s, v) for s in range(shards) for v in range(vnodes))
    return np.array([p[0] for p in points], dtype=np.int64), np.array([p[1] for p in points], dtype=np.int64)


def bounded_ranges(loads: np.ndarray, owner: np.ndarray, shards: int) -> pd.DataFrame:
    """Place ``loads[a]`` documents of each arc ``a`` (home shard ``owner[a]``)
    under the bounds; returns the ranges (arc, lo, shard, slot), sorted."""
    total = int(loads.sum())
    bound = np.full(shards, total // shards, dtype=np.int64)
    bound[: total % shards] += 1
    home = np.bincount(owner, weights=loads, minlength=shards).astype(np.int64)
    keep = loads.copy()
    for s in np.nonzero(home > bound)[0]:
        arcs = np.nonzero(owner == s)[0]
        exact = loads[arcs] * (bound[s] / home[s])
        part = np.floor(exact).astype(np.int64)
        short = int(bound[s] - part.sum())
        order = np.argsort(-(exact - part), kind="stable")
        for i in order:  # largest remainders first, never above the arc's load
            if short and part[i] < loads[arcs[i]]:
                part[i] += 1
                short -= 1
        keep[arcs] = part
    held = np.bincount(owner, weights=keep, minlength=shards).astype(np.int64)
    room = bound - held
    used = np.zeros(shards, dtype=np.int64)
    out: list[tuple[int, int, int, int]] = []

    def put(arc: int, lo: int, n: int, s: int) -> None:
        out.append((arc, lo, s, int(used[s])))
        used[s] += n

    for a in np.nonzero(keep)[0]:
        put(int(a), 0, int(keep[a]), int(owner[a]))
    n_arcs = len(loads)
    for a in np.nonzero(loads > keep)[0]:
        lo, rest, at = int(keep[a]), int(loads[a] - keep[a]), int(a)
        while rest:
            at = (at + 1) % n_arcs
            s = int(owner[at])
            n = min(rest, int(room[s]))
            if n:
                put(int(a), lo, n, s)
                room[s] -= n
                lo, rest = lo + n, rest - n
    return pd.DataFrame(sorted(out), columns=["arc", "lo", "shard", "slot"])


def count_below(values: np.ndarray, x: Column) -> Column:
    """How many of the sorted ``values`` are below ``x``: a binary search in the JVM."""
    table = constant(values)
    steps = [1 << k for k in reversed(range(len(values).bit_length()))]

    def step(low: Column, width: Column) -> Column:
        return low + F.when(F.coalesce(F.get(table, low + width - 1) < x, F.lit(False)), width).otherwise(F.lit(0))

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def shard(docs: DataFrame, shards: int = 40, vnodes: int = 64) -> DataFrame:
    """Every row of ``docs`` (doc_id, ...) with its ``home_shard``, ``shard``
    and ``slot`` (0, 1, ... without gaps inside the shard)."""
    position, owner = ring(shards, vnodes)
    keyed = docs.withColumn("_key", md5_key(F.col("doc_id"), SALT))
    at = F.conv(F.substring("_key", 9, 8), 16, 10).cast("long")
    keyed = keyed.withColumn("_arc", F.pmod(count_below(position, at), F.lit(len(position))))
    loads = np.zeros(len(position), dtype=np.int64)
    for r in keyed.groupBy("_arc").count().collect():  # one number for each arc
        loads[r["_arc"]] = r["count"]
    ranges = bounded_ranges(loads, owner, shards)
    starts = (ranges["arc"].to_numpy(np.int64) << 44) + ranges["lo"].to_numpy(np.int64)
    lo, to, slot = (constant(ranges[c].to_numpy(np.int64)) for c in ("lo", "shard", "slot"))
    tie = [c for c in ("doc_id", "text_crc32", "size") if c in docs.columns]
    ranked = prefix_sums(keyed, ["_arc"], "_key", tie, None, "_rank", hash_cells(int(loads.sum() // len(loads)) + 1))
    where = F.shiftleft(F.col("_arc").cast("long"), 44) + F.col("_rank")
    placed = ranked.withColumn("_at", count_below(starts, where + 1) - 1)
    return placed.select(
        *docs.columns,
        F.get(constant(owner), F.col("_arc")).cast("int").alias("home_shard"),
        F.get(to, F.col("_at")).cast("int").alias("shard"),
        (F.get(slot, F.col("_at")) + F.col("_rank") - F.get(lo, F.col("_at"))).alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int = 40, vnodes: int = 64) -> DataFrame:
    """The digest of the sharding of a documents table."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = stored(docs.select("doc_id", (F.octet_length(text) + F.lit(16)).cast("long").alias("size"), F.crc32(text).alias("text_crc32")), "shard-keys")
    return shard(slim, shards, vnodes).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard"
    )
