"""Winnowing against a plain search of every window."""

import hashlib
import random
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tillsense.llm import decontamination as D

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(D.UPPER, D.LOWER)


def words(text):
    return WORDS.findall(text.translate(LOWER)) if text is not None else []


def brute(docs, items, length=10):
    index = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), length)
        for s in range(len(w) - n + 1 if n else 0):
            index.setdefault(tuple(w[s : s + n]), set()).add("" if item is None else str(item))
    sizes = {len(k) for k in index}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (of := index.get(tuple(w[s : s + n]))) is not None:
                    hit.update(range(s, s + n))
                    found |= of
        ids = sorted(found)
        out.append((str(doc), len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def got(docs, items):
    rows = D.decontaminate_documents(docs, items).collect()
    return sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows)


def bench(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, words string").repartition(3)


@pytest.mark.parametrize("vocabulary", [2, 3, 40])
def test_every_shared_window_is_found(spark, docs_of, vocabulary):
    r = random.Random(vocabulary)
    text = lambda n: " ".join(r.choice(["a", "bb", "c9", "é", "D"]) * r.randint(1, vocabulary // 2 + 1) for _ in range(n))
    items = [(i, text(r.choice([0, 1, 4, 6, 9, 10, 11, 25]))) for i in range(12)]
    docs = [(i, text(r.choice([0, 3, 9, 10, 30, 200])) + " " + r.choice(items)[1].upper()[: r.randint(0, 90)] + ", " + text(r.randint(0, 20)), "en", "s") for i in range(60)]
    plain = [(i, t) for i, t, _, _ in docs]
    assert got(docs_of(docs), bench(spark, items)) == brute(plain, items)


def test_spans_and_items_of_a_document(spark, docs_of):
    item = "one two three four five six seven eight nine ten eleven"
    docs = docs_of([(1, f"zero {item} x One-two THREE four five six seven eight nine ten y", "en", "s")])
    r = D.contaminated_spans(docs, bench(spark, [(7, item), (10, item)])).first()
    assert [(x["s"], x["e"]) for x in r["spans"]] == [(1, 12), (13, 23)] and r["items"] == ["10", "7"]


def test_odd_rows(odd, none, spark):
    items = [(1, None), (2, ""), (3, "..."), (None, "the dog"), (5, "der hund und die katze sind hier im haus"), (5, "12345"), (6, "wort " * 40)]
    plain = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert got(odd, bench(spark, items)) == brute(plain, items)
    assert got(odd, bench(spark, [])) == brute(plain, [])
    assert got(none, bench(spark, items)) == []


def test_a_passage_in_a_third_of_the_rows(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(30))
    rows = [(None if i % 3 else i, (f"{i} {item} {i}" if i % 3 == 1 else f"word {i} " * 8), "en", "s") for i in range(300)]
    items = [(k, item) for k in range(5)]
    assert got(docs_of(rows), bench(spark, items)) == brute([(i, t) for i, t, _, _ in rows], items)


def test_main_path_has_no_python(spark, docs_of):
    docs = docs_of([(1, "a b c", "en", "s")])
    plan = D.decontaminate_documents(docs, bench(spark, [(1, "a b c")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_fingerprints_are_window_minima(spark):
    r = random.Random(1)
    ids = [r.getrandbits(62) for _ in range(40)]
    df = spark.createDataFrame([(ids,)], "ids array<long>").select(D.window_fingerprints(F.col("ids"), 10).alias("f"), D.window_fingerprints(F.slice("ids", 1, 9), 10).alias("short"))
    row = df.first()
    assert len(row["f"]) == 31 and row["short"] == []
    assert len(set(row["f"])) < 31 and crc32(b"") == 0
