"""Operator 13: benchmark decontamination by winnowing.

Of a text's ``k``-grams of words, the least hash of every ``w`` consecutive ones
is kept. Two texts that share ``w + k - 1`` words in a row share the ``k``-grams
of one such window, hence its least hash: no shared span of that length is
missed, whatever surrounds it. With windows of 10 words, ``k = 5`` and ``w = 6``.
An item of fewer words is one window of its own length ``L``, and
``k = (L + 1) // 2``, ``w = L - k + 1`` give the same guarantee for it.

The fingerprints of the benchmark make an index (hash, window) -> items. A
document's fingerprints that pass a bit table of the index's hashes (of fixed
size; it can only let too many through) are joined with it by their hash and
extended to the whole window, compared word by word. So only rows of likely hits
leave the scan of the documents, and a text is read once. Everything is
DataFrame functions.

Windows, not items, are joined with documents: a window that many items share is
one row of the index. Spans are united inside a document, and items are listed
for each document after its (document, window) pairs are distinct.

Defined cases: null text has no words and no hits, as a text without words; a
null doc_id and repeated rows are rows of their own; very long texts are one row
of arrays of their words; items without words are never hit; rows with equal
item_id are one item; a null item_id is an item whose id is empty; an empty
table of documents gives an empty result, an empty benchmark no hits; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsense.llm.common import stored

#: Words are separated by runs of these; A-Z are lower-cased before.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
#: Words of 64 bits in the bit table: 128 KB, whatever the benchmark.
TABLE_WORDS = 2**14


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text (null: none)."""
    parts = F.split(F.translate(text, UPPER, LOWER), SEPARATORS)
    return F.coalesce(F.filter(parts, lambda w: w != ""), F.array().cast("array<string>"))


def gram_words(length: int) -> int:
    """Words of the grams that find shared spans of ``length`` words."""
    return (length + 1) // 2


def window_fingerprints(ids: Column, length: int) -> Column:
    """For every window of ``length`` words, from 0: its least gram hash. ``ids``
    are the hashes of the words; a shorter text has no windows."""
    k = gram_words(length)
    w = length - k + 1

    def minima(grams: Column) -> Column:
        heads = F.slice(grams, F.lit(1), F.greatest(F.size(grams) - (w - 1), F.lit(0)))
        at = [lambda x, i, j=j: x if j == 0 else F.get(grams, i + j) for j in range(w)]
        return F.transform(heads, lambda x, i: F.least(*[f(x, i) for f in at]) if w > 1 else x)

    heads = F.slice(ids, F.lit(1), F.greatest(F.size(ids) - (k - 1), F.lit(0)))
    grams = F.transform(heads, lambda x, i: F.xxhash64(F.lit(length), x, *[F.get(ids, i + j) for j in range(1, k)]))
    return let(grams, minima)


def window_text(words: Column, start: Column, length: int) -> Column:
    return F.array_join(F.slice(words, start + 1, F.lit(length)), " ")


def windows(words: Column, ids: Column, length: int, keep: Callable[[Column], Column] | None = None) -> Column:
    """Structs (h, s, length, words) of the windows of ``length`` words, of those
    whose fingerprint h is to be kept."""
    marked = F.transform(window_fingerprints(ids, length), lambda h, s: F.struct(h.alias("h"), s.alias("s")))
    if keep is not None:
        marked = F.filter(marked, lambda x: keep(x["h"]))
    return F.transform(
        marked, lambda x: F.struct(x["h"].alias("h"), x["s"].alias("s"), F.lit(length).alias("length"), window_text(words, x["s"], length).alias("words"))
    )


def word_ids(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def benchmark_index(items: DataFrame, length: int = WINDOW) -> DataFrame:
    """The stored windows (item, h, length, words) of all ``items`` (item_id, text)."""
    told = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("w"))
    told = stored(told.filter("size(w) > 0"), "benchmark-words")
    ids = word_ids(F.col("w"))
    n = F.size("w")
    own = F.when(n >= length, windows(F.col("w"), ids, length))
    for short in range(1, length):
        own = own.when(n == short, windows(F.col("w"), ids, short))
    rows = told.select("item", F.explode(own).alias("x")).select("item", "x.h", "x.length", "x.words")
    return stored(rows.distinct(), "benchmark-windows")


def bit_table(index: DataFrame) -> Column:
    """The bits of the index's fingerprints: a constant of ``TABLE_WORDS`` numbers."""
    bit = F.pmod(F.col("h"), F.lit(TABLE_WORDS * 64))
    marked = index.select(F.floor(bit / 64).alias("i"), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int")).alias("m"))
    words = [0] * TABLE_WORDS
    for r in marked.groupBy("i").agg(F.bit_or("m").alias("m")).collect():  # at most TABLE_WORDS rows
        words[r["i"]] = r["m"]
    # one string, which is parsed once when the plan is made
    return F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")


def _in_table(bits: Column, h: Column) -> Column:
    at = F.pmod(h, F.lit(TABLE_WORDS * 64))
    cell = F.get(bits, F.shiftright(at, 6).cast("int"))
    return F.call_function("bit_get", cell, at.bitwiseAND(F.lit(63)).cast("int")) == 1


def scan(docs: DataFrame, index: DataFrame, lengths: list[int]) -> DataFrame:
    """The stored rows of ``docs`` (doc_id, text) with a row number, their number of
    words, and the windows that may be of the index."""
    bits = bit_table(index)

    def found(words: Column) -> Column:
        def of_ids(ids: Column) -> Column:
            def of_bits(table: Column) -> Column:
                parts = [windows(words, ids, n, lambda h: _in_table(table, h)) for n in lengths]
                return F.concat(*parts) if len(parts) > 1 else parts[0]

            return let(bits, of_bits)

        maybe = let(word_ids(words), of_ids) if lengths else F.array().cast("array<struct<h:bigint,s:int,length:int,words:string>>")
        return F.struct(F.size(words).cast("long").alias("n_words"), maybe.alias("maybe"))

    rows = docs.select("doc_id", let(words_of(F.col("text")), found).alias("x"))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "x.n_words", "x.maybe"), "decontamination-scan")


def united(spans: Column) -> Column:
    """Sorted spans (s, e), those that meet or overlap as one."""
    kind = "array<struct<s:int,e:int>>"

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        fresh = F.concat(done, F.array(F.struct(x["s"].alias("s"), x["e"].alias("e"))))
        longer = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["e"] >= x["s"]), longer).otherwise(fresh).cast(kind)

    return F.aggregate(spans, F.array().cast(kind), add)


def contaminated_spans(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) as doc_id, n_words, ``spans`` (hit
    words [s, e), sorted, apart) and ``items`` (ids, sorted as strings)."""
    index = benchmark_index(items, length)
    lengths = sorted(r[0] for r in index.select("length").distinct().collect())  # at most ``length`` numbers
    rows = scan(docs, index, lengths)
    of_index = stored(index.groupBy("h", "length", "words").agg(F.min("item").alias("first")).withColumn("window", F.monotonically_increasing_id()), "benchmark-index")
    maybe = rows.filter("size(maybe) > 0").select("row", F.explode("maybe").alias("x")).select("row", "x.h", "x.length", "x.words", "x.s")
    hits = stored(maybe.join(of_index, ["h", "length", "words"]).select("row", "s", "length", "window"), "decontamination-hits")
    spans = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("s", (F.col("s") + F.col("length")).alias("e")))).alias("spans"))
    windows_of = of_index.select("h", "length", "words", "window").join(index, ["h", "length", "words"]).select("window", "item")
    named = hits.select("row", "window").distinct().join(windows_of, "window").groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = rows.select("row", "doc_id", "n_words").join(spans.select("row", united(F.col("spans")).alias("spans")), "row", "left").join(named, "row", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("spans", F.array().cast("array<struct<s:int,e:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def decontaminate_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest of the contaminated spans of a documents table."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return contaminated_spans(docs.select("doc_id", "text"), items).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


_WORDS_SQL = f"coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"

DECONTAMINATION_SQL = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS_SQL} AS w FROM benchmark),
item_starts AS (SELECT item, w, least(len(w), {WINDOW}) AS size, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS s FROM b WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item, size, array_to_string(w[s : s + size - 1], ' ') AS win FROM item_starts),
doc_starts AS (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d CROSS JOIN (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size),
doc_windows AS (SELECT rid, size, s, array_to_string(w[s : s + size - 1], ' ') AS win FROM doc_starts),
hits AS (SELECT DISTINCT rid, s, doc_windows.size AS size, item FROM doc_windows JOIN item_windows ON doc_windows.win = item_windows.win AND doc_windows.size = item_windows.size),
covered AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(s, s + size)) AS place FROM (SELECT DISTINCT rid, s, size FROM hits)) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS ids FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(ids, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)"""
