"""The Merkle manifest against a plain tree built in Python."""

import hashlib
from collections import defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tillsense.llm import merkle

LOWER = str.maketrans(*merkle.LETTERS)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])


def climb(level):
    """(top, for each leaf the siblings (left, right) by level) of one tree."""
    paths = [[] for _ in level]
    members = [[i] for i in range(len(level))]
    while len(level) > 1:
        up, ups = [], []
        for lo in range(0, len(level), 16):
            run = level[lo : lo + 16]
            for j in range(len(run)):
                for i in members[lo + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(h(*run))
            ups.append([i for m in members[lo : lo + 16] for i in m])
        level, members = up, ups
    return level[0], paths


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        by["" if r["source"] is None else "=" + r["source"]].append(r)
    names = sorted(by, key=lambda s: s.encode())
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = climb([leaf(r, r["text"]) for r in by[s]])
    root, ups = climb([trees[s][0] for s in names])
    out = []
    for s, up in zip(names, ups, strict=True):
        for r, path in zip(by[s], trees[s][1], strict=True):
            text = r["text"]
            if text is not None and r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 5 == 0:
                text = text.translate(LOWER)
            folded = leaf(r, text)
            for a, b in path + up:
                folded = h(a, folded, b)
            proof = h(*[x for p in path + up for x in p])
            out.append((str(r["doc_id"]), leaf(r, r["text"]), trees[s][0], root, proof, folded, folded == root))
    return sorted(out)


def spark_rows(df):
    return sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in df.collect())


def test_manifest_equals_plain_trees(docs_of):
    rows = [(i, f"Text {i} Of É", "en", "hot" if i % 3 else f"s{i % 60:02d}") for i in range(700)]
    docs = docs_of(rows)
    got = spark_rows(merkle.verify_documents(docs))
    assert got == brute(docs.collect()) and {r[-1] for r in got} == {True, False}


def test_manifest_of_odd_rows(odd, none, docs_of):
    assert spark_rows(merkle.verify_documents(odd)) == brute(odd.collect())
    assert merkle.verify_documents(none).collect() == []
    one = docs_of([(1, None, None, None)])
    r = merkle.verify_documents(one).first()
    assert r["leaf"] == r["subroot"] == r["root"] == r["folded_root"] and r["proof_sha256"] == h("")


def test_equal_rows_are_leaves_of_their_own(docs_of):
    rows = [(None, "Same", "en", "a")] * 300 + [(5, "Same", "en", "a")] * 40 + [(i, "x", None, None) for i in range(17)]
    docs = docs_of(rows)
    assert spark_rows(merkle.verify_documents(docs)) == brute(docs.collect())


@pytest.mark.parametrize("size", [16, 17, 257])
def test_chosen_requests_get_the_proofs_of_all(docs_of, size):
    m = merkle.manifest(merkle.leaves_of(docs_of([(i, f"t{i}", "en", "a" if i % 2 else "b") for i in range(size)])))
    every = {(r["grp"], r["idx"]): r["path"] for r in merkle.prove(m).collect()}
    asked = m.sources.leaves.filter("idx % 7 = 3")
    some = merkle.prove(m, asked).withColumn("top", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    assert len(every) == size and len(some) == asked.count() > 0
    assert all(every[r["grp"], r["idx"]] == r["path"] and r["top"] == m.root for r in some)
