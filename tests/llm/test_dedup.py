"""Near duplicates and repeated passages against brute force."""

import hashlib
import re

import numpy as np
from helpers_llm import rows_of

from sievewright.llm import minhash, substrings
from sievewright.llm.components import components


def brute_components(rows, percent=85):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_minhash_equals_brute_force(spark, edge_docs):
    got = minhash.near_duplicates(edge_docs, block=4).collect()
    want = brute_components(rows_of(edge_docs))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len(got) == edge_docs.count()


def test_minhash_of_nothing(no_docs):
    assert minhash.near_duplicates(no_docs).collect() == []


def test_shared_counts_are_exact():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (0, 1, 50, 7000, 8000)]
    got = minhash.shared_counts(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = np.intersect1d(a, b)
            # Elements in one set only are not counted, also on the diagonal.
            assert i == j or got[i, j] == len(both)


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(0, k) for k in range(1, 30)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(101, 141)}, **{k: 0 for k in range(1, 30)}}


def brute_passages(rows, length=50):
    seen = {}
    texts = sorted((i, (t or "").encode()) for i, t in rows)
    for i, b in texts:
        for k in range(len(b) - length + 1):
            seen.setdefault(b[k : k + length], i)
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] < i:
                gone[k : k + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out)


def test_passages_equal_brute_force(edge_docs, monkeypatch):
    rows = [(i, t) for i, t in rows_of(edge_docs) if i != 6] + [(95, "ab" * 200), (96, "x" + "ab" * 100 + "y"), (97, "ab" * 30)]
    docs = edge_docs.sparkSession.createDataFrame(rows, "doc_id long, text string").repartition(3)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = brute_passages(rows)
    got = substrings.repeated_passages(docs).select(names).collect()
    assert sorted(map(tuple, got)) == want


def test_hot_anchors_go_by_window(edge_docs):
    """An anchor of 1,000 documents is split into windows; the result stays that of brute force."""
    rows = [(k, f"{k:05d} " * 3 + "a passage that every document of this group shares, word by word" + f" {k * 7919:09d}") for k in range(1100)]
    docs = edge_docs.sparkSession.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = substrings.repeated_passages(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == brute_passages(rows)


def test_passages_carry_columns_and_text(edge_docs, no_docs):
    got = substrings.repeated_passages(edge_docs, with_text=True, carry=["lang", "score"]).where("doc_id in (7, 8, 90)").collect()
    assert {r["doc_id"]: r["kept"] == "" for r in got} == {7: False, 8: True, 90: False}
    assert all(r["score"] == 9.0 for r in got)
    assert substrings.repeated_passages(no_docs).collect() == []


def test_rows_without_id_stay_whole(spark):
    text = "a passage that is long enough to be fifty bytes and more, surely"
    rows = [(1, text), (None, text), (2, text), (None, None)]
    got = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"], r["kept"]) for r in got) == [("1", 0, text), ("2", len(text), ""), ("None", 0, ""), ("None", 0, text)]
