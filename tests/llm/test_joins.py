"""Similarity joins, line dedup, union-find and the pipeline, against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tillsense.llm import embedding_join, line_dedup, ngram_join
from tillsense.llm.components import components, union


def brute_components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def test_components_of_random_graphs(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(300, 340)] + [(350, 351 + i) for i in range(40)]
    want = brute_components(400, edges)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert all(got.get(i, i) == want[i] for i in range(400))
    nodes, roots = union(*(np.array(x) for x in zip(*edges, strict=True)))
    assert all(want[a] == b for a, b in zip(nodes, roots, strict=True))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def similar(x, y):
    return bool(x and y) and 100 * len(x & y) >= 80 * len(x | y)


def family(r, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def corpus(seed=6):
    """Families of near copies, exact copies, a passage that many share, short texts."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(3000)}"
    texts = []
    for n in (60, 12, 5, 3):
        texts += family(r, [word() for _ in range(r.randint(60, 140))], n, 5)
    passage = " ".join(word() for _ in range(30))
    texts += [" ".join(word() for _ in range(r.randint(3, 40))) + " " + passage for _ in range(50)]
    texts += ["same text here with some words in it"] * 5 + ["a b c", "a b c", "a B  c\n", "", " ", None, "a b c d e", "a b c d e f"]
    texts += [" ".join(word() for _ in range(50)) for _ in range(30)]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("least", [16, 0])
def test_ngram_join_matches_brute_force(docs_of, monkeypatch, least):
    monkeypatch.setattr(ngram_join, "LEAST", least)  # 0: most shared tokens are frequent, combinations find the pairs
    texts = corpus()
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if similar(sets[a], sets[b])]
    want = brute_components(len(texts), links)
    rows = ngram_join.similar_components(docs_of([(i, t, None, None) for i, t in enumerate(texts)], 5)).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts) and len(links) > 100
    for i in range(len(texts)):
        assert (got[i]["n_shingles"], got[i]["component_id"]) == (len(sets[i]), want[i])


def test_prefixes_share_a_key():
    """Any two similar sets have a common key, whichever tokens are frequent."""
    r = np.random.default_rng(7)
    for _ in range(400):
        n = int(r.integers(4, 120))
        base = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        a, b = int(r.integers(0, max(1, n // 9) + 1)), int(r.integers(0, max(1, n // 9) + 1))
        x = np.unique(np.concatenate([base, r.integers(0, 2**63, a).astype(np.uint64)]))
        y = np.unique(np.concatenate([base, r.integers(0, 2**63, b).astype(np.uint64)]))
        if 100 * len(base) < 80 * (len(x) + len(y) - len(base)) or len(x) == len(y) == len(base):
            continue
        frequent = (r.random(ngram_join.SKETCH) < r.choice([0.0, 0.5, 0.9, 0.98, 1.0])) * r.integers(1, 9, ngram_join.SKETCH)
        kx, ky = ngram_join.index_keys(x, frequent)[0], ngram_join.index_keys(y, frequent)[0]
        assert len(np.intersect1d(kx, ky)), (len(x), len(y), len(base))


def test_ngram_join_of_odd_rows(odd, none):
    rows = ngram_join.similar_components(odd).collect()
    assert len(rows) == 11
    by = {r["doc_id"]: r for r in rows}
    assert by[9]["component_id"] == 1 and by[2]["n_shingles"] == 0 and by[3]["component_id"] == 3
    assert sum(r["doc_id"] is None and r["component_id"] is None for r in rows) == 2
    assert ngram_join.similar_components(none).count() == 0
    kept = ngram_join.one_of_each(odd)
    assert kept.columns == odd.columns
    # the row without doc_id that has words is a copy of document 1
    assert Counter(r["doc_id"] for r in kept.collect()) == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 1, 8: 1, None: 1}


def test_rows_that_share_a_doc_id_or_have_none_are_told_by_their_texts(docs_of):
    a, b, c = ("one two three four five six seven", "a b c d e f g h", "k l m n o p q r s")
    rows = [(1, a, "en", "s"), (1, b, "en", "s"), (1, b, "en", "s"), (None, b, "en", "s"), (None, c, "en", "s"), (None, c, "en", "t"), (4, c, "en", "s")]
    kept = ngram_join.one_of_each(docs_of(rows)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted([("1", a), ("1", b), ("4", c)])


def char_set(line):
    return {line[i : i + 5] for i in range(len(line) - 4)} if len(line) >= 5 else {line}


def brute_lines(rows):
    """Texts after fuzzy line dedup; rows are (doc_id, text), ids distinct."""
    seen = [(i, k, x) for i, t in sorted(rows) if t is not None for k, x in enumerate(t.split("\n")) if x.strip()]
    lines = sorted({x for _, _, x in seen})
    sets = [char_set(x) for x in lines]
    links = [(a, b) for a in range(len(lines)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    group = dict(zip(lines, brute_components(len(lines), links), strict=True))
    first = {}
    for i, k, x in seen:
        first.setdefault(group[x], (i, k))
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if not x.strip() or first[group[x]] == (i, k)) for i, t in rows}


def lined_corpus(seed=9):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8)))
    pool = [" ".join(word() for _ in range(r.randint(8, 30))) for _ in range(25)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(r.randint(0, 6)):
            line = r.choice(pool) if r.random() < 0.4 else " ".join(word() for _ in range(r.randint(1, 25)))
            if r.random() < 0.3:  # one character differs
                k = r.randrange(len(line))
                line = line[:k] + "Z" + line[k + 1 :]
            lines.append(line)
        rows.append((i, "\n".join(lines)))
    return [*rows, (120, None), (121, ""), (122, "\n \n"), (123, "ab"), (124, "ab"), (125, "é" * 3000)]


def test_line_dedup_matches_brute_force(docs_of):
    rows = lined_corpus()
    want = brute_lines(rows)
    out = line_dedup.dedup_documents(docs_of([(i, t, None, None) for i, t in rows], 4)).collect()
    wrong = [r["doc_id"] for r in out if r["text"] != want[r["doc_id"]]]
    assert len(out) == len(rows) and len(wrong) <= 2, wrong  # banding may miss a pair near 0.8
    assert sum(r["n_dropped"] for r in out) > 50


def test_line_dedup_of_odd_rows(odd, none):
    out = line_dedup.without_repeated_lines(odd)
    assert out.columns[: len(odd.columns)] == odd.columns
    by = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert (1, "the cat sat on the mat and saw the dog") in by and (9, "") in by and (None, "") in by and (2, None) in by
    assert all(r["n_chars"] == len(r["text"]) for k, r in by.items() if k[1] is not None)
    assert out.count() == 11
    assert line_dedup.dedup_documents(none).count() == 0


def test_line_dedup_takes_each_row_as_a_document(docs_of):
    """Rows without a doc_id, or with a repeated one, are not merged: exact copies lose their lines, and no array
    of dropped lines is longer than a text."""
    same = "a line that many rows have\nand one more line of them"
    rows = [(None, same)] * 6 + [(5, same)] * 3 + [(None, f"{same}\n{i} {'xyz'[i % 3] * 9} {i * 7919}") for i in range(30)] + [(5, "quite another text"), (None, None)]
    docs = docs_of([(i, t, None, None) for i, t in rows], 4)
    out = line_dedup.without_repeated_lines(docs).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(i) for i, _ in rows)
    left = Counter(x for r in out if r["text"] is not None for x in r["text"].split("\n"))
    assert all(left[x] == 1 for x in same.split("\n"))
    assert sorted(r["text"] for r in out if r["doc_id"] == 5) == ["", "", same, "quite another text"]
    assert all(r[line_dedup.N_DROPPED] == 2 for r in out if r["doc_id"] is None and r["text"] is not None)
    gone = line_dedup.repeated_lines(line_dedup.keyed_rows(docs)).collect()
    assert len(gone) == 31 and all(len(r["dropped"]) == 2 for r in gone)


def vectors(seed=1, n=700, d=32):
    r = np.random.default_rng(seed)
    v = r.standard_normal((n, d))
    for i in range(200, 500):  # near others, some at the threshold
        v[i] = v[r.integers(0, 200)] + r.choice([0.05, 0.2, 0.33, 0.45]) * r.standard_normal(d)
    v[500:540] = v[500]
    return v.astype(np.float32)


@pytest.mark.parametrize("group", [256, 20])
def test_embedding_links(spark, monkeypatch, group):
    v = vectors()
    k, tables = embedding_join.tables_for(len(v)) if group == 256 else (5, 13)
    monkeypatch.setattr(embedding_join, "tables_for", lambda n: (k, tables))
    frame = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int").repartition(4)
    out = {r["vec_id"]: r for r in embedding_join.near_vectors(frame).collect()}
    u = embedding_join.units(list(v))
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    true = near.sum()
    found = sum(r["n_links"] for r in out.values())
    assert found >= 0.95 * true and all(out[i]["n_links"] <= near[i].sum() for i in out)
    want = brute_components(len(v), np.argwhere(near).tolist())
    assert np.mean([out[i]["component_id"] == want[i] for i in out]) > 0.95
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out.values())


def test_odd_embeddings(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 1), (3, None, 0), (4, [0.0, 0.0], 0), (5, [float("nan"), 1.0], 0), (6, [float("inf"), 1.0], 0), (7, [None, 1.0], 0), (8, [], 0),
            (9, [2.0, 0.0], None), (10, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0), (11, [-1.0, 0.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_join.near_vectors(frame).collect()}
    assert len(out) == 12
    assert out[1] == out[2] == out[9] == (2, 1)
    assert all(out[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 10, 11)) and out[None] == (0, None)
    assert embedding_join.near_vectors(frame.filter("vec_id < 0")).count() == 0


def test_pipeline_stages(spark, odd, none):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "mixing", "packing"]
    first = corpus_pipeline.language_stage(spark, docs, sf)
    assert first.columns == docs.columns and first.count() == docs.count()  # every document there has a language
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = {i: t for i, t in brute_lines(rows).items() if t and t.strip()}
    second = corpus_pipeline.line_stage(spark, docs, sf)
    assert second.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in second.collect()} == kept
    ids = sorted(kept)
    sets = [shingles(kept[i]) for i in ids]
    links = [(a, b) for a in range(len(ids)) for b in range(a + 1, len(ids)) if similar(sets[a], sets[b])]
    root = brute_components(len(ids), links)
    third = corpus_pipeline.near_duplicate_stage(spark, second, sf)
    assert sorted(r["doc_id"] for r in third.collect()) == [i for k, i in enumerate(ids) if root[k] == k]
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and {"doc_id", "bucket", "batch", "batch_slot"} <= set(out.columns)
    assert {r["doc_id"] for r in out.collect()} <= set(ids)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (odd, none):
            got = stage(spark, table, sf)
            assert got.columns == table.columns, name
            got.count()
