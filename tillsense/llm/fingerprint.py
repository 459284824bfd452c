"""Operator 5: homomorphic multiset fingerprints, in DataFrame functions only.

A text is the multiset of its paragraphs (its lines). Each paragraph is hashed
to a wide vector, and the text's fingerprint is the sum of these vectors modulo
powers of two, so the order of paragraphs does not matter, equal multisets have
equal fingerprints, and a paragraph is inserted or deleted by adding or
subtracting its vector. A paragraph's vector has three parts:

* its number of words, modulo 2^32;
* four lanes of 32 bits of two hashes of the whole paragraph (equality);
* 64 lanes of 16 bits, each the number of the paragraph's word pairs (a word
  and the one before it) whose hash has the lane's bit set (likeness).

Likeness of two fingerprints: the bit counts of the 64 lanes, centred, are
random projections of the multisets of word pairs, so their cosine estimates
the cosine of the multisets; it is held to 0..1. Equal fingerprints have
likeness 1, and a text without words is unlike all others.

Texts are shuffled once, by id (both joins of :func:`fingerprint_documents`
read the same exchange); a document asks the next one for as many characters
as it needs, so only those travel on.

Defined cases: null text is the empty text (one empty paragraph); a null
doc_id sorts after all others; if rows share a doc_id, the next document of
that id is the one with the least text hash; repeated rows give repeated
results; the only document of a table is its own next; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsense.llm.common import stored

PAIRS = 32  # packed longs, of two lanes each
LOW = 0xFFFFFFFF
BLANKS = r"[\x20\x09\x0B-\x0D]+"


def vector_sums(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """The summed paragraph vectors of each group of ``keys``: words, eq0..eq3
    and lanes (array of packed lane pairs). Rows with equal keys must be
    copies; ``copies`` is their number and the sums are those of one."""
    lines = texts.select(*keys, F.posexplode(F.split(F.col(text), "\n")).alias("_at", "_line"))
    words = F.filter(F.split(F.col("_line"), BLANKS), lambda w: w != "")
    units = lines.withColumn("_words", words).select(*keys, "_at", "_line", F.posexplode_outer(_pairs(F.col("_words"))).alias("_no", "_unit"))
    first = F.coalesce(F.col("_no"), F.lit(0)) == 0
    one, two = F.xxhash64("_line"), F.xxhash64(F.lit(1), F.col("_line"))

    def lane_pair(k: int) -> Column:
        return F.sum(F.shiftrightunsigned("_unit", k).bitwiseAND(F.lit(0x100000001))).alias(f"_l{k}")

    halves = [h for x in (one, two) for h in (x.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(x, 32))]
    sums = units.groupBy(*keys).agg(
        F.count_if(first & (F.col("_at") == 0)).alias("copies"),
        F.count("_unit").alias("_n"),
        *[F.sum(F.when(first, h)).alias(f"_e{i}") for i, h in enumerate(halves)],
        *[lane_pair(k) for k in range(PAIRS)],
    )
    m = F.col("copies")
    per_copy = lambda c: F.expr(f"coalesce({c}, 0L) div copies")
    return sums.select(
        *keys, m, per_copy("_n").alias("words"), *[(per_copy(f"_e{i}") % (LOW + 1)).alias(f"eq{i}") for i in range(4)],
        F.array(*[_unpacked(F.coalesce(F.col(f"_l{k}"), F.lit(0)), m) for k in range(PAIRS)]).alias("lanes"),
    )


def _pairs(words: Column) -> Column:
    """Hashes of all words with the word before them."""
    return F.transform(words, lambda w, i: F.xxhash64(F.get(words, i - 1), w))


def _unpacked(packed: Column, copies: Column) -> Column:
    """Lane pair of one copy from the pair's sum over all copies."""
    low, high = packed.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(packed, 32)
    return F.struct((low / copies).cast("int").alias("a"), (high / copies).cast("int").alias("b"))


def fingerprint_of(row: str) -> Column:
    """The fingerprint string of a struct of vector sums."""
    def f(name: str) -> Column:
        return F.col(f"{row}.{name}")
    def wide(c: Column) -> Column:
        return F.lower(F.lpad(F.hex(c), 8, "0"))
    lanes = F.transform(f("lanes"), lambda p: wide(F.shiftleft((p["a"] % 65536).cast("long"), 16) + p["b"] % 65536))
    return F.concat(wide(f("words") % (LOW + 1)), *[wide(f(f"eq{i}")) for i in range(4)], F.array_join(lanes, ""))


def likeness(x: str, y: str) -> Column:
    """0..1 from two structs of vector sums."""
    n, m = F.col(f"{x}.words"), F.col(f"{y}.words")
    equal = reduce(lambda a, b: a & b, [F.col(f"{x}.{c}") == F.col(f"{y}.{c}") for c in ("words", "eq0", "eq1", "eq2", "eq3")])

    def dot(a: str, an: Column, b: str, bn: Column) -> Column:
        prod = F.zip_with(
            F.col(f"{a}.lanes"), F.col(f"{b}.lanes"), lambda p, q: (p["a"] * 2.0 - an) * (q["a"] * 2.0 - bn) + (p["b"] * 2.0 - an) * (q["b"] * 2.0 - bn)
        )
        return F.aggregate(prod, F.lit(0.0), lambda s, v: s + v)

    norm = F.sqrt(dot(x, n, x, n) * dot(y, m, y, m))
    cosine = F.when(norm > 0, dot(x, n, y, m) / norm).otherwise(0.0)
    return F.when(equal, 1.0).when((n == 0) | (m == 0), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def next_ids(ids: DataFrame) -> DataFrame:
    """(id, next_id) over the distinct ids, descending, null last, the last
    followed by the first. Ranges are stored once, so every reader sees the
    same; a range's last id is followed by the head of the next range."""
    order = F.col("id").desc_nulls_last()
    ranged = ids.select("id").distinct().repartitionByRange(order)
    r = stored(ranged.withColumn("_p", F.spark_partition_id()), "fingerprint-ids")
    heads = r.groupBy("_p").agg(F.max("id").alias("_head"))  # one row for each range
    by_range = Window.orderBy("_p")
    around = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.row_number().over(Window.orderBy(F.col("_p").desc())) == 1
    heads = heads.withColumn("_follow", F.when(last, F.first("_head").over(around)).otherwise(F.lead("_head").over(by_range))).select("_p", "_follow")
    inside = Window.partitionBy("_p").orderBy(order)
    tail = F.row_number().over(Window.partitionBy("_p").orderBy(F.col("id").asc_nulls_first())) == 1
    r = r.withColumn("_lead", F.lead("id").over(inside)).withColumn("_tail", tail)
    return r.join(heads, "_p").select("id", F.when(F.col("_tail"), F.col("_follow")).otherwise(F.col("_lead")).alias("next_id"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """The digest of fingerprints over a documents table."""
    kind = docs.schema["doc_id"].dataType
    text = F.coalesce(F.col("text"), F.lit(""))

    def key(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    sizes = stored(docs.select(F.col("doc_id").alias("id"), F.char_length(text).alias("n")), "fingerprint-sizes")
    follow = next_ids(sizes).select(key("id").alias("ask_key"), key("next_id").alias("next_key"))
    asks = sizes.select(key("id").alias("ask_key"), "n").distinct().join(follow, "ask_key").withColumnRenamed("n", "ask_n")
    single = sizes.agg((F.count("*") == F.count_distinct(key("id"))).alias("s")).first()["s"]

    # the same two columns in both joins: one exchange of the texts
    by_id = docs.select(key("doc_id").alias("_k"), text.alias("text"))
    pieces = asks.join(by_id, F.col("next_key") == F.col("_k")).select(
        "ask_key", "ask_n", "next_key", F.substring("text", F.lit(1), F.floor(F.col("ask_n") / 3).cast("int")).alias("piece"), F.xxhash64("text").alias("_nh")
    )
    if not single:  # ids with several texts: the least hash answers
        pieces = pieces.groupBy("ask_key", "ask_n", "next_key").agg(F.min_by("piece", "_nh").alias("piece"), F.min("_nh").alias("_nh"))
    both = by_id.join(pieces, F.col("_k") == F.col("ask_key")).withColumn("n", F.char_length("text")).filter("n - ask_n = 0")
    own = F.substring("text", F.lit(1), (F.col("n") - F.floor(F.col("n") / 3)).cast("int"))
    both = both.withColumn("edited", F.concat(own, "piece")).withColumn("_h", F.xxhash64("text")).withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["_k", "_h", "n", "next_key", "edited_sha256"]
    sides = both.select(*keys, F.posexplode(F.array("text", "edited")).alias("_side", "_text"))
    sums = vector_sums(sides, [*keys, "_side"], "_text")
    vec = F.struct("words", "eq0", "eq1", "eq2", "eq3", "lanes")
    fp = sums.groupBy(*keys).agg(
        F.max("copies").alias("copies"), F.max(F.when(F.col("_side") == 0, vec)).alias("v"), F.max(F.when(F.col("_side") == 1, vec)).alias("e")
    )
    fp = stored(fp, "fingerprints")
    heads = fp.select(F.col("_k").alias("_nk"), F.col("v").alias("nv"), F.col("_h").alias("_nh"))
    if not single:
        heads = heads.groupBy("_nk").agg(F.min_by("nv", "_nh").alias("nv"))
    else:
        heads = heads.drop("_nh")
    out = fp.join(heads, F.col("next_key") == F.col("_nk"))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        F.when(F.col("_k") == "", F.lit(None)).otherwise(F.col("_k")).cast(kind).alias("doc_id"),
        F.col("n").cast("long").alias("n_chars"),
        "edited_sha256",
        fingerprint_of("v").alias("fingerprint"),
        fingerprint_of("e").alias("edited_fingerprint"),
        likeness("v", "e").alias("near_edited"),
        likeness("v", "nv").alias("near_next"),
    )
