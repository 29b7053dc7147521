"""Stages of the pipeline against brute force."""

from helpers_llm import edited, prose, rows_of
from test_dedup import brute_components, brute_passages

import corpus_pipeline

CLASH = "doc_id long, text string, lang string, source string, n_chars bigint, score double, lang_pred string, kept boolean, n_bytes int, _letter string, row string"


def clashing(spark, rows):
    """Documents whose other columns have the names that the operators use."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), -7.0, "mine", True, 5, "x", "r") for i, t in rows], CLASH).repartition(3)


def untouched(df):
    rows = df.collect()
    assert df.columns == [c.split()[0] for c in CLASH.split(", ")]
    assert all((r["score"], r["lang_pred"], r["kept"], r["n_bytes"], r["_letter"], r["row"]) == (-7.0, "mine", True, 5, "x", "r") for r in rows)
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=str)


def test_language_id_drops_texts_without_a_language(spark):
    rows = [(k, prose(k, 30)) for k in range(40)] + [(50, None), (51, ""), (52, "123 456"), (None, prose(1, 9)), (60, prose(60, 20_000)), (0, prose(0, 30))]
    got = untouched(corpus_pipeline.language_id(spark, clashing(spark, rows), ""))
    assert got == sorted(((i, t) for i, t in rows if i not in (50, 51, 52)), key=str)
    assert untouched(corpus_pipeline.language_id(spark, clashing(spark, []), "")) == []


def test_near_dedup_on_edges(spark):
    base = prose(1, 120)
    rows = [(5, base), (3, base), (9, f"{base} zz"), (7, None), (8, ""), (4, prose(2, 50)), (4, prose(2, 50)), (None, prose(3, 50))]
    got = untouched(corpus_pipeline.near_dedup(spark, clashing(spark, rows), ""))
    assert [i for i, _ in got] == [3, 4, 4, 7, 8]
    assert untouched(corpus_pipeline.near_dedup(spark, clashing(spark, []), "")) == []


def test_passage_dedup_equals_brute_force(spark):
    passage = prose(1, 20)
    rows = [(1, f"{prose(2, 9)} {passage}"), (2, f"{passage} {prose(3, 9)}"), (3, passage), (4, None), (5, ""), (6, prose(6, 9)), (6, prose(6, 9)), (None, passage), (7, "é" * 60), (8, "xé" + "é" * 60)]
    df = corpus_pipeline.passage_dedup(spark, clashing(spark, rows), "")
    got = untouched(df)
    want = {i: (n, gone) for i, n, gone, _, _ in brute_passages([r for r in rows if r[0] is not None])}
    assert [i for i, _ in got if i is not None] == sorted(i for i, t in rows if i is not None and (want[i][0] == 0 or want[i][1] < want[i][0]))
    assert (None, passage) in got and all(r["n_chars"] == len(r["text"]) for r in df.collect())
    assert untouched(corpus_pipeline.passage_dedup(spark, clashing(spark, []), "")) == []


def test_decontaminated_and_packed_on_edges(spark, tmp_path):
    item = prose(900, 40)
    spark.createDataFrame([(1, item), (None, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, f"{prose(1, 30)} {item}"), (2, f"{prose(2, 30)} {edited(item, 1, 0.1)}"), (3, prose(3, 60)), (3, prose(3, 60)), (4, None), (5, ""), (None, prose(5, 60))]
    got = untouched(corpus_pipeline.decontaminated(spark, clashing(spark, rows), str(tmp_path)))
    assert [i for i, _ in got] == [3, 3, 4, 5, None]
    packed = corpus_pipeline.packed(spark, clashing(spark, rows), "").collect()
    assert sorted(str(r["doc_id"]) for r in packed) == sorted(str(i) for i, _ in rows)
    assert corpus_pipeline.packed(spark, clashing(spark, []), "").collect() == []


def test_whole_run_keeps_clean_documents_once(spark, tmp_path):
    item, passage = prose(900, 40), prose(901, 30)
    rows = [(k, prose(k, 80)) for k in range(60)] + [(100 + k, prose(k, 80)) for k in range(10)] + [(200, f"{prose(200, 30)} {item}"), (201, None)]
    rows += [(210, f"{prose(210, 60)} {passage}"), (211, f"{prose(211, 60)} {passage}")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(got) == [*range(60), 210, 211] and got[210] == 90 and 60 <= got[211] < 70


def test_near_dedup_links_from_four_fifths(spark):
    """Pairs with one word replaced: 44 shingles are just below 0.8 alike, 45 exactly 0.8, and up to 55 below 0.85."""
    rows = []
    for k in range(48):
        words = prose(5000 + k, 4 + 44 + k % 12).split(" ")
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:20], f"z{k}", *words[21:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(i for i, _ in rows_of(corpus_pipeline.near_dedup(spark, docs, "")))
    assert kept == sorted({c for _, c in brute_components(rows, 80).values()})
    assert kept == sorted([2 * k for k in range(48)] + [2 * k + 1 for k in range(0, 48, 12)])
