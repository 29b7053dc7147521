"""Language ID, toxicity, LM scoring, quality classifier and rules: edges and brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import prose, rows_of
from pyspark.sql import functions as F

from sievewright.llm import decision_list, langid, neighbours, quality_queries, rule_ensemble, suffix_tree, textstats

WORD = r"[^\x20\x09-\x0D]+"


def test_langid_learns_and_knows_und(spark, no_docs):
    rows = [(k, ("le chat est grand " if k % 2 else "the dog was big ") * (1 + k % 4), "fr" if k % 2 else "en") for k in range(80)]
    rows += [(100, None, "en"), (101, "", "fr"), (102, "12 34!", "en"), (103, "the dog", None), (104, "the big dog " * 20_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = langid.train(docs, F.lit(True))
    got = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    assert len(got) == len(rows)
    assert [got[k]["lang_pred"] for k in (100, 101, 102)] == ["und"] * 3 and got[103]["lang_pred"] == "en" and got[104]["lang_pred"] == "en"
    assert np.mean([got[k]["lang_pred"] == r[2] for k, r in enumerate(rows[:80])]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.train(no_docs, F.lit(True)) is None and langid.predict(no_docs, None).collect() == []
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}


def test_temperature_of_sure_and_unsure_logits():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400)
    logits = np.zeros((400, 2))
    logits[np.arange(400), np.where(rng.random(400) < 0.7, y, 1 - y)] = 10
    t = langid.temperature(logits, y)
    assert abs(10 / t - math.log(0.7 / 0.3)) < 0.4
    assert langid.temperature(np.zeros((0, 2)), np.zeros(0, int)) == 1.0


def test_block_max_search_is_exact():
    rng = np.random.default_rng(3)
    examples = [(np.unique(rng.integers(0, 40, rng.integers(0, 9))), None) for _ in range(500)]
    examples = [(t, rng.integers(1, 4, len(t))) for t, _ in examples]
    index = neighbours.Index(np.arange(40).astype(np.uint64), rng.random(40) + 0.1, np.arange(500), rng.integers(0, 2, 500), np.ones(2), 0.5, examples)
    dense = np.zeros((500, 40))
    for k, (t, c) in enumerate(examples):
        if len(t):
            dense[k, t] = index.weigh(t, c)
    for t, c in examples[:60]:
        if not len(t):
            continue
        q = np.zeros(40)
        q[t] = index.weigh(t, c)
        want = sorted(((-round(float(s), 9), k) for k, s in enumerate(dense @ q) if round(float(s), 9) > 0))[: neighbours.NEAREST]
        got = [(-s, k) for s, k in index.nearest(t, c)]
        assert np.allclose([s for s, _ in got], [s for s, _ in want], atol=1e-8)
        assert {k for s, k in got if s < want[-1][0] - 1e-8} == {k for s, k in want if s < want[-1][0] - 1e-8}


def test_toxicity_edges(spark, no_docs):
    rows = [(k, f"plain words number{k} here " + ("vile rotten " if k % 3 == 0 else "")) for k in range(120)] + [(200, None), (201, ""), (202, "VILE!"), (203, "nothing known"), (203, "nothing known")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("evidence", F.lit(1)).withColumn("y", F.lit(2))
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(120)] + [(None, 1), (5000, None)], "doc_id long, toxic int")
    index = neighbours.train(docs, labels, F.lit(True))
    got = neighbours.score(docs, index).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and by[202]["score"] > 0.5 > by[200]["score"] and by[200]["score"] == by[201]["score"] == by[203]["score"]
    assert by[202]["evidence"][0]["toxic"] == 1 and by[200]["evidence"] == []
    blank = neighbours.train(no_docs, labels, F.lit(True))
    assert neighbours.score(no_docs, blank).collect() == [] and 0 <= neighbours.score(docs, blank).first()["score"] <= 1


def brute_base(rows, mod, held):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [(i, re.findall(WORD, (t or "").translate(low)) + [None]) for i, t in rows]
    c = Counter(w for i, ws in tokens if zlib.crc32(str(i).encode()) % mod != held for w in ws)
    n, v = sum(c.values()), len(c)
    return sorted((i, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens)


def test_lm_base_equals_brute_force(edge_docs, no_docs):
    got = suffix_tree.score(edge_docs).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == brute_base(rows_of(edge_docs), 7, 2)
    assert all(r["score"] <= 1e-9 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in got)
    assert suffix_tree.score(no_docs).collect() == []


class BruteTree:
    """The suffix tree by its definition, with dictionaries."""

    def __init__(self, texts, learned, divergence=10.0, least=2, pull=1.0):
        low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        self.pull = pull
        self.tokens = [re.findall(WORD, (t or "").translate(low)) + [None] for t in texts]
        train = [ws for ws, use in zip(self.tokens, learned) if use]
        self.c = Counter(w for ws in train for w in ws)
        self.n, self.v = sum(self.c.values()), len(self.c)
        once = sum(x == 1 for x in self.c.values())
        self.unseen = max(1, once) / (self.n + 1) if self.n else 1.0
        self.states, looked, depth, kept = {(): None}, {()}, 1, True
        while kept:
            grams = Counter(tuple(ws[i - depth : i + 1]) for ws in train for i in range(depth, len(ws)))
            contexts, kept = Counter(), False
            for g, n in grams.items():
                contexts[g[:-1]] += n
            looked = {s for s, n in contexts.items() if n >= least and s[1:] in self.states and s[:-1] in looked}
            found = {}
            for g, n in grams.items():
                s, w = g[:-1], g[-1]
                if s in looked and n >= least:
                    steps = 8 << max(0, contexts[s].bit_length() - 4)
                    expected = round(steps * math.log2(contexts[s] * self.p(w, s[1:]))) / steps * math.log(2)
                    if n * (math.log(n) - expected) >= divergence:
                        found.setdefault(s, (contexts[s], {}))[1][w] = n
            self.states |= found
            kept, depth = bool(found), depth + 1

    def p(self, w, s):
        if not s:
            return (1 - self.unseen) * self.c[w] / max(1, self.n) if self.c[w] else self.unseen / (self.v + 1)
        n, keeps = self.states[s]
        return keeps.get(w, 0) / (n + self.pull) + (1 - sum(keeps.values()) / (n + self.pull)) * self.p(w, s[1:])

    def score(self, ws):
        total = 0.0
        for i, w in enumerate(ws):
            s = ()
            while len(s) < i and tuple(ws[i - len(s) - 1 : i]) in self.states:
                s = tuple(ws[i - len(s) - 1 : i])
            total += math.log10(self.p(w, s))
        return total


def learned(i):
    return zlib.crc32(str(i).encode()) % 7 != 2


@pytest.mark.parametrize("block, shard", [(1 << 20, 4096), (300, 3)])
def test_lm_score_equals_a_brute_force_tree(spark, edge_docs, block, shard):
    """Small blocks and shards: contexts of many shards meet the same counts."""
    phrases = ["alpha beta gamma delta epsilon", "the cat sat on the mat", "beta gamma zeta", "on the way to the mat", "a b c x", "a b d y", "q b c z", "q b d w", "r c v"]
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice(phrases) + f" n{(k * j) % 23}" for j in range(12))) for k in range(100, 160)]
    rows += [(i, t) for i, t in rows_of(edge_docs) if i != 6]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tree = BruteTree([t for _, t in rows], [learned(i) for i, _ in rows])
    assert max(map(len, tree.states)) >= 3
    want = sorted((i, round(tree.score(ws), 6)) for (i, _), ws in zip(rows, tree.tokens))
    got = sorted((r["doc_id"], round(r["score"], 6)) for r in suffix_tree.score(docs, block=block, shard=shard).collect())
    assert got == want
    for s in list(tree.states)[:: max(1, len(tree.states) // 50)]:
        assert abs(sum(tree.p(w, s) for w in tree.c) + (tree.v + 1) * tree.p("a word that is not there", s) - 1) < 1e-9


def test_lm_tree_ends_on_one_repeated_word(spark):
    """A word that is predicted already diverges nowhere, however often it is repeated."""
    rows = [(k, "again " * 900) for k in range(6)] + [(10 + k, prose(k, 40)) for k in range(20)]
    tree = BruteTree([t for _, t in rows], [learned(i) for i, _ in rows])
    assert max(map(len, tree.states)) <= 4
    got = sorted((r["doc_id"], round(r["score"], 6)) for r in suffix_tree.score(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted((i, round(tree.score(ws), 6)) for (i, _), ws in zip(rows, tree.tokens))


def test_lm_prefers_prose_and_copies_to_gibberish(spark):
    text = lambda k: " ".join(f"{w}{(k * 37 + j * j * 11) % 40}" for j, w in enumerate(prose(k, 150).split(" ")))
    rows = [(k, text(k)) for k in range(200)] + [(next(i for i in range(1100, 1200) if learned(i)), text(3)), (1001, text(9999))]
    assert learned(3) and learned(4)
    gibberish = " ".join("".join(chr(97 + (k * k * 31 + j * 17 + k) % 26) for j in range(8)) + str(k) for k in range(150))
    held = next(i for i in range(5000, 6000) if not learned(i))
    rows += [(held, gibberish), (held + 10**6, None)]
    got = {r["doc_id"]: r for r in suffix_tree.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held]["score"] < 1.5 * got[1001]["score"] and got[held]["n_known"] == 1
    assert got[3]["score"] > 0.6 * got[4]["score"]


def test_lm_rows_without_id_are_scored_and_not_learned_from(spark):
    rows = [(k, "one two three four") for k in range(20)] + [(None, "never seen words"), (None, None)]
    got = suffix_tree.score(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id is null").collect()
    assert sorted((r["held_out"], r["n_tokens"], r["n_known"]) for r in got) == [(None, 1, 1), (None, 4, 1)]


def brute_counts(t):
    words = re.findall(WORD, t or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k + d for k, w in enumerate(windows) if often[w] > 1 for d in range(3)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark, edge_docs):
    rows = rows_of(edge_docs) + [(500, "a b c a b c a b"), (501, "x\nx\n \n\ny\nx"), (502, "# | <b> 😀 a b"), (503, "w " * 300), (504, "a b c d a b c\va b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = textstats.with_counts(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert sorted(map(tuple, got)) == sorted((i, *brute_counts(t)) for i, t in rows)


def test_decision_list_and_column_agree(spark):
    rng = np.random.default_rng(5)
    x = rng.random((900, len(textstats.FEATURES)))
    bad = (x[:, 2] > 0.7) | ((x[:, 4] > 0.5) & (x[:, 1] < 0.3))
    rules = decision_list.learn(x, bad)
    assert rules and np.mean([any(r.holds(x[k : k + 1])[0] for r in rules) == bad[k] for k in range(900)]) > 0.95
    assert decision_list.learn(x, np.zeros(900, bool)) == [] and decision_list.learn(x[:0], bad[:0]) == []


def test_rule_ensemble_learns(spark):
    rng = np.random.default_rng(6)
    x = rng.random((800, len(textstats.FEATURES)))
    y = ((x[:, 2] < 0.6) & (x[:, 5] < 0.8)).astype(float)
    model = rule_ensemble.fit(x, y)
    assert ((model.predict(x) > 0.5) == y).mean() > 0.95 and len(model.rules) < 120
    assert rule_ensemble.fit(x[:0], y[:0]).rules == () and 0.9 < rule_ensemble.fit(x, np.ones(800)).predict(x[:1])[0]


@pytest.mark.parametrize("query", ["op9_rule_ensemble", "op10_decision_list"])
def test_quality_queries_on_edges(spark, edge_docs, no_docs, tmp_path, query):
    edge_docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, k % 2, 0) for k in range(60)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = quality_queries.QUERIES[query](spark, str(tmp_path)).collect()
    assert len(got) == edge_docs.count()
    if query.startswith("op10"):
        assert all(r["base_failed"] and not r["kept"] for r in got if r["n_words"] < 50)
    else:
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    no_docs.write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert quality_queries.QUERIES[query](spark, f"{tmp_path}/none").collect() == []


def test_buckets_do_not_depend_on_the_order_of_their_rows():
    """Blocks that ask for the same contexts get the same answers whichever comes first."""
    corpus = suffix_tree.Corpus(7, 2, 4, n=1000)

    def rows(block, counts):
        n = len(counts)
        level = suffix_tree.Level(np.arange(n), np.array([0, 0, 1]), np.array([5, 9]), np.array([40, 40]), np.array([1, 2, 1]), np.array([0, 7, 8]), np.ones(n, bool), np.full(n, 0.01), np.array(counts) > 0)
        return suffix_tree.Asked(level, corpus).send(block, 1).to_pylist()

    sent = rows(0, [1, 1, 0]) + rows(1, [1, 0, 1]) + rows(2, [0, 1, 1])
    for b in {r["bucket"] for r in sent}:
        mine = [r for r in sent if r["bucket"] == b]
        schema = suffix_tree.chunked.sent([]).schema
        said = [sorted(map(str, suffix_tree._grow(corpus)(pa.Table.from_pylist(x, schema)).to_pylist())) for x in (mine, mine[::-1], mine[1:] + mine[:1])]
        assert said[0] == said[1] == said[2]


def test_contexts_that_stay_in_their_bucket_have_no_numbers():
    """Rarer contexts are named by their places, frequent ones by numbers, and both ways give the same tree."""
    rng, buckets, n = np.random.default_rng(3), 4, 900
    corpus = suffix_tree.Corpus(7, 2, buckets, divergence=1.0, shard=12, n=2 * n)
    texts = [rng.zipf(1.4, n) % 40 for _ in range(2)]
    c = np.bincount(np.concatenate(texts), minlength=40)
    schema, sizes, scores, after = suffix_tree.chunked.sent([]).schema, [], [], []
    for stays in (False, True):
        at, rows, size, deeper = [], [], 0, []
        for t in texts:
            pos = np.arange(1, n)
            at.append(suffix_tree.Level(pos, t[pos - 1], np.arange(40), c, t[pos], np.arange(40), c[t[pos]] > 1, c[t[pos]] / (2 * n), np.ones(n - 1, bool)))
        for k in (1, 2, 3):
            stay = corpus.dealt if stays and k < 3 else 0
            asked = [suffix_tree.Asked(x, corpus) for x in at]
            new = [r for b, x in enumerate(asked) for r in x.send(b, k).to_pylist()]
            size += sum(len(r["keys"]) for r in new if k > 1)
            rows = rows + new if stays else new
            told = [r for b in range(buckets) if (mine := [r for r in rows if r["bucket"] == b]) for r in suffix_tree._grow(corpus, k if stays else None, stay)(pa.Table.from_pylist(mine, schema)).to_pylist()]
            answers = suffix_tree.chunked.answers([]).schema
            size += sum(len(r["answer"]) for r in told if k < 3)
            old, at = at, [x.hear(suffix_tree.chunked.gathered(pa.Table.from_pylist([r for r in told if r["chunk"] == b], answers), k), stay) for b, x in enumerate(asked)]
            deeper.append([np.unique(x.contexts < 0) for x in at])
            scores.append([x.p for x in old])
            after.append([(x.pos, x.n[x.context]) for x in at])
        sizes.append(size)
        assert all(len(x) == 2 for x in deeper[0]) == stays  # numbers and places side by side
        assert not any(x.any() for x in deeper[2])
    assert all(np.array_equal(a, b) for x, y in zip(scores[:3], scores[3:]) for a, b in zip(x, y)) and len(after[1][0][0])
    assert all(np.array_equal(a, b) for x, y in zip(after[:3], after[3:]) for i, j in zip(x, y) for a, b in zip(i, j))
    assert sizes[1] < 0.95 * sizes[0]


def test_langid_learns_a_rare_language(spark):
    """Twelve rows of a language among a thousand, which a sample over all languages would all but miss."""
    rows = [(k, f"the dog was big number{k % 7} here", "en") for k in range(1000)] + [(2000 + k, f"le chat est grand ici{k % 3} encore", "fr") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = langid.train(docs, F.lit(True), max_each=20)
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, model).collect()}
    assert model.languages == ("en", "fr") and all(got[i] == lang for i, _, lang in rows)


def test_compiled_rules_equal_numpy(spark):
    """The Column of a rule ensemble and that of a decision list say what the rules say of the same numbers."""
    rng = np.random.default_rng(8)
    texts = [(k, " ".join(rng.choice(["alpha", "b#ta", "GAMMA", "d1lta,", "x"], rng.integers(0, 90))) + "\nsame line\nsame line" * int(rng.integers(0, 2))) for k in range(150)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = textstats.with_counts(docs).select("doc_id", *[c.alias(n) for n, c in textstats.feature_columns().items()]).orderBy("doc_id").collect()
    x = np.array([r[1:] for r in rows], float)
    y = (x[:, 2] < np.median(x[:, 2])).astype(float)
    model = rule_ensemble.fit(x, y)
    got = {r["doc_id"]: r["score"] for r in rule_ensemble.score(docs, model).collect()}
    assert model.rules and np.allclose([got[k] for k in range(150)], model.predict(x))
    rules = decision_list.learn(x, y < 0.5, min_precision=0.5)
    verdicts = {r["doc_id"]: r for r in decision_list.quality_rules(docs, rules).collect()}
    want = [next((n for n, rule in enumerate(rules, 1) if rule.holds(x[k : k + 1])[0]), 0) for k in range(150)]
    assert rules and [verdicts[k]["rule"] for k in range(150)] == want
    assert all(v["kept"] == (not v["base_failed"] and v["rule"] == 0) for v in verdicts.values())
