"""Language ID, fingerprints, secret scan and toxicity."""

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillsense.llm import automaton, fingerprint, gru, hashing, langid, secrets, toxicity

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.identify_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert len(out) == 1000 and all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_scores_match_plain_naive_bayes(spark, docs_of):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate([("aab ab", "x"), ("bba b", "y"), ("abab", "x"), ("bb b", "y")])]
    langs, logp = langid.train(docs_of(rows))
    assert langs == ["x", "y"]
    counts = np.zeros((langid.BUCKETS, 2))
    for _, t, lang, _ in rows:
        for slot in langid.hashed_ngrams([t], langid.BUCKETS)[0]:
            counts[slot, langs.index(lang)] += 1
    expected = np.log((counts + langid.SMOOTHING) / (counts + langid.SMOOTHING).sum(axis=0))
    assert np.allclose(logp, expected, atol=1e-5)
    # n-grams do not cross texts: a batch gives what single texts give
    both = langid.score_batch(["aab", "bb bb"], logp)
    assert np.allclose(both, np.vstack([langid.score_batch([t], logp) for t in ("aab", "bb bb")]))
    framed = " aab "
    assert len(langid.hashed_ngrams(["AAB"], 64)[0]) == sum(len(framed) - n + 1 for n in langid.ORDERS)


def test_language_of_odd_rows(odd, none, docs_of):
    out = langid.identify_documents(odd).collect()
    assert len(out) == 11
    for r in out:
        if r["doc_id"] in (2, 3, 4, 7):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert langid.identify_documents(none).count() == 0
    assert {r["lang_pred"] for r in langid.identify_documents(docs_of([(1, "abc", None, None)])).collect()} == {"und"}
    kept = langid.identified(odd)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} >= {1, 5, 8, 9}


def test_number_signs_are_no_letters(docs_of):
    rows = [(i, "the cat and the dog", "en", "a") for i in range(10)] + [(20, "²½ ①", "en", "a"), (21, "_ 5 é", "en", "a"), (22, "٣ Ⅷ", "en", "a")]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify_documents(docs_of(rows)).collect()}
    assert (got[20], got[21], got[22]) == ("und", "en", "und")


def brute_edited(rows):
    out = {}
    order = sorted(rows, key=lambda r: -r[0])
    for (i, t), (_, u) in zip(order, [*order[1:], order[0]], strict=True):
        k = len(t) // 3
        out[i] = t[: len(t) - k] + u[:k]
    return out


def test_fingerprints(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    edited = brute_edited(rows)
    out = fingerprint.fingerprint_documents(docs).collect()
    assert len(out) == len(rows)
    by_text = {}
    for r in out:
        text = dict(rows)[r["doc_id"]]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited[r["doc_id"]].encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_text.setdefault(text, set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values()) and len({min(v) for v in by_text.values()}) == len(by_text)
    long = [r for r in out if r["n_chars"] > 200]
    assert np.mean([r["near_edited"] > r["near_next"] for r in long]) > 0.98


def sums_of(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    v = fingerprint.vector_sums(d, ["k"], "t")
    row = F.struct("words", "eq0", "eq1", "eq2", "eq3", "lanes")
    return {r["k"]: r for r in v.withColumn("v", row).withColumn("fp", fingerprint.fingerprint_of("v")).collect()}


def test_fingerprints_are_sums_of_paragraphs(spark):
    a, b, c = "one two three", "four five", "one two three"
    s = sums_of(spark, ["\n".join(x) for x in ([a, b, c], [c, b, a], [a, b], [a], [b], [a, a, b], [])])
    assert s[0]["fp"] == s[1]["fp"] == s[5]["fp"] != s[2]["fp"]
    for col in ("words", "eq0", "eq1", "eq2", "eq3"):
        mod = 2**32
        assert s[2][col] % mod == (s[3][col] + s[4][col]) % mod
        assert (s[0][col] - s[2][col]) % mod == s[3][col] % mod  # deletion
    assert [(p["a"], p["b"]) for p in s[2]["lanes"]] == [(p["a"] + q["a"], p["b"] + q["b"]) for p, q in zip(s[3]["lanes"], s[4]["lanes"], strict=True)]


def test_fingerprints_of_odd_rows(odd, none, docs_of):
    out = fingerprint.fingerprint_documents(odd).collect()
    assert len(out) == 11 and sum(r["doc_id"] is None for r in out) == 2
    assert len({r["fingerprint"] for r in out if r["doc_id"] in (1, 9)}) == 1
    assert fingerprint.fingerprint_documents(none).count() == 0
    only = fingerprint.fingerprint_documents(docs_of([(4, "a b c d e f", None, None)])).first()
    assert only["edited_sha256"] == hashlib.sha256(b"a b c d ea b c"[:11]).hexdigest() or only["near_next"] == 1.0


PATTERNS = ["ab+c", "(x|yz){2,3}", "[a-c]x?[^a]", "q(w|e)*r", r"\x41B{2}"]


def test_automaton_finds_what_regular_expressions_find():
    auto = automaton.compile_rules(PATTERNS)
    r = random.Random(5)
    for lane in (8, 1024):
        text = "".join(r.choice("abcxyzqwerAB\n.") for _ in range(4000))
        ends, bits = automaton.scan(auto, np.frombuffer(text.encode(), dtype=np.uint8), lane)
        found = {(int(e), i) for e, b in zip(ends, bits, strict=True) for i in range(len(PATTERNS)) if b >> i & 1}
        expected = {(e, i) for i, p in enumerate(PATTERNS) for e in range(1, len(text) + 1) if re.compile(f"(?s:.*)(?:{p})").fullmatch(text[max(0, e - 40) : e])}
        assert {f for f in found if f[1] != 3} == {x for x in expected if x[1] != 3}
        assert {e for e, i in found if i == 3} >= {e for e, i in expected if i == 3}


def test_minimal_automaton_has_no_equal_states():
    auto = automaton.compile_rules(["(a|b)c", "ac|bc"])
    assert auto.states == 3


def brute_spans(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    folded = "".join(c.lower() if c.isascii() else c for c in text)
    out = []
    for m in assign.finditer(folded):
        out.append((m.start(), 0, m.end(), "assign", m.end(2) - m.start(2) >= 8))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        out.append((m.start(), 1, m.end(), "access", len(m[0]) >= 16))
    for m in re.finditer("[0-9a-f]+", text):
        out.append((m.start(), 2, m.end(), "hex", len(m[0]) >= 32))
    return [f"{k}:{s}:{e}" for s, _, e, k, ok in sorted(out) if ok]


def test_secret_spans_match_brute_force(spark, docs_of):
    r = random.Random(11)
    parts = ["PassWord", "passwd", "secret", "api_key", "APIKEY", "token", ": ", "=", " = '", '"', "AKIA", "ABCD1234EFGH5678", "abc", "0123456789abcdef" * 2,
             "é", "ß ", "\n", " ", "hunter2hunter2", "x.y-z", "ſecret=abcdefghijk", "toKen:abcdefgh"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(300)]
    out = {x["doc_id"]: x for x in secrets.scan_documents(docs_of([(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        want = brute_spans(t)
        assert out[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert (out[i]["n_assign"], out[i]["n_access"], out[i]["n_hex"]) == tuple(sum(w.startswith(k) for w in want) for k in secrets.KINDS)
        assert set(want) <= set(out[i]["spans"].split(",")) or not want


def test_secret_scan_of_odd_rows(odd, none, docs_of):
    out = secrets.scan_documents(odd).collect()
    assert len(out) == 11 and {r["spans"] for r in out} == {""}
    assert secrets.scan_documents(none).count() == 0
    key = docs_of([(1, "-----BEGIN RSA PRIVATE KEY-----", None, None)])
    assert secrets.scan_documents(key).first()["spans"] == "private_key:0:31"


def test_gradients_are_right():
    texts = ["a bad wolf came, und der", "hello", "x y z w v u t s", ""]
    v = gru.read_words(texts)
    grid, owner = gru.window_grid(v, 4, 2)
    r = np.random.default_rng(0)
    p = {k: a.astype(np.float64) + 0.05 * r.standard_normal(a.shape) for k, a in gru.start_params(1).items()}
    c = r.standard_normal(len(grid))
    ones = np.ones((len(v.word_rows), 1))
    logit, kept = gru.forward(p, gru.word_inputs(p, v), grid, keep=True)
    g = gru.gradients(p, v, gru.word_inputs(p, v), grid, kept, c, ones)
    for k in p:
        rows, d = g[k] if isinstance(g[k], tuple) else (np.arange(len(p[k])), g[k])
        i = np.unravel_index(np.abs(d).argmax(), d.shape)
        at = (rows[i[0]], *i[1:])
        ends = []
        for e in (1e-3, -1e-3):
            q = {**p, k: p[k].copy()}
            q[k][at] += e
            ends.append(float((gru.forward(q, gru.word_inputs(q, v), grid) * c).sum()))
        assert d[i] == pytest.approx((ends[0] - ends[1]) / 2e-3, rel=1e-2, abs=1e-4), k


def test_windows_cover_the_whole_text():
    for n in range(0, 90):
        seen = {w for s in gru.windows(n, 32, 24) for w in range(s, min(n, s + 32))}
        assert seen == set(range(n))


def planted(n, seed=2):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(r.choice("abdeghiklmnoprstu") for _ in range(r.randint(2, 8))) for _ in range(r.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            words[r.randrange(len(words))] = r.choice(["vilezot", "vilezon", "vilezar"])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_finds_planted_words_in_held_out_documents(spark):
    rows = planted(900)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxicity.score_documents(docs, labels).collect()}
    assert len(out) == len(rows)
    held = [(i, y) for i, _, y in rows if out[i]["held_out"]]
    assert all(out[i]["held_out"] == (crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    hits = sum(out[i]["predicted"] for i, y in held if y)
    wrong = sum(out[i]["predicted"] for i, y in held if not y)
    assert hits >= 0.9 * sum(y for _, y in held) and wrong <= 0.1 * len(held)


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (5, 0), (8, 0), (9, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    out = toxicity.score_documents(odd, labels).collect()
    assert len(out) == 11 and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score_documents(none, labels).count() == 0
    assert {r["score"] for r in toxicity.score_documents(odd, labels.filter("toxic is null")).collect()} == {0.0}


def test_span_hashes_tell_spans_apart():
    data = np.frombuffer(b"abcabc ab abcab", dtype=np.uint8)
    h = hashing.span_hashes(data, np.array([0, 3, 7, 10, 13]), np.array([3, 6, 9, 13, 15]))
    assert h[0] == h[1] == h[3] and h[2] == h[4] != h[0]


def test_shingles_match_brute_force():
    texts = ["A b c d e f", "a B c d e", "one two", "One  two\n", "", " ", "a b c d e f g a b c d e"]
    sets = hashing.shingle_sets(texts)
    words = [t.lower().split() for t in texts]
    plain = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set() for w in words]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for x, p in zip(sets, plain, strict=True):
        for y, q in zip(sets, plain, strict=True):
            assert hashing.overlap(x, y) == len(p & q)
    assert isinstance(pd.Series(sets[0]).iloc[0], np.uint64)
