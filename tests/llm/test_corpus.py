"""WARC, packing and decontamination: round trips, optima and brute force."""

import hashlib
import itertools
import random

import pytest
from helpers_llm import edited, prose
from pyspark.sql import functions as F

from sievewright.llm import decontaminate, packing, warc, warc_queries
from sievewright.llm import textbytes as tb

PAGES = "page_id long, url string, html string, digest string"


def test_warc_round_trip(spark, tmp_path):
    long, big = "<p>équal</p>" * 20, "x" * 3_000_000
    rows = [(3, "http://a.b/3", long), (1, "http://a.b/1?q=ü v", long), (2, None, long), (4, "http://a.b/4", None), (5, "http://a.b/5", ""), (6, "u", "short"), (7, "u", "short"), (8, "http://a.b/8\r\nX: y", "a\r\n\r\nb" * 40), (9, "http://a.b/9", big)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], PAGES)
    warc.write_archives(pages.repartition(3), f"file://{tmp_path}/w")
    records = warc.read_records(spark, f"file://{tmp_path}/w")
    assert records.count() == 3 * len(rows) and records.where("digest_ok = false").count() == 0
    got = {}
    for r in warc.assemble(records).collect():
        fields = {f["key"]: f["value"] for f in r["metadata"]["fields"]}
        got[int(fields["page_id"])] = r
    assert sorted(got) == list(range(1, 10))
    for i, _, html in rows:
        data, r = (html or "").encode(), got[i]["response"]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        revisit = i in (2, 3)
        assert r["record_type"] == ("revisit" if revisit else "response")
        assert r["payload"] is None if revisit else bytes(r["payload"]) == data
        assert r["refers_to"] == (got[1]["capture_id"] if revisit else None)
        assert bytes(got[i]["request"]["payload"]).startswith(b"GET ")


def test_warc_members_are_gzip(spark, tmp_path):
    import glob
    import gzip

    warc.write_archives(spark.createDataFrame([(1, "http://a.b/", "hi", "")], PAGES), f"file://{tmp_path}/w")
    text = b"".join(gzip.open(f).read() for f in glob.glob(f"{tmp_path}/w/part-*"))
    assert text.count(b"WARC/1.1\r\n") == 3 and text.endswith(b"\r\n\r\n")


LONG = "<p>equal</p>" * 20


@pytest.mark.parametrize("rows", [[], [(1, "u", None), (1, "u", None)], [(2, "u", LONG), (2, "u", LONG), (1, "v", LONG), (1, "v", LONG), (1, "w", LONG), (None, "u", LONG), (None, None, LONG), (None, None, LONG), (3, None, "short"), (3, None, "short")]])
def test_warc_query_on_edges(spark, tmp_path, rows):
    """Repeated rows make a record each, and rows without an id are responses, as the SQL has it."""
    spark.createDataFrame([(*r, "") for r in rows], PAGES).repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = warc_queries.op2_warc(spark, str(tmp_path)).collect()
    assert sorted(str(r["page_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    if rows:
        import glob

        import duckdb

        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet({glob.glob(f'{tmp_path}/pages.parquet/*.parquet')})")
        want = con.execute(warc_queries.ORACLE["op2_warc"]).fetchall()
        names = [d[0] for d in con.description]
        assert sorted(str(tuple(r[c] for c in names)) for r in got) == sorted(map(str, want))


def test_boundaries_are_optimal():
    rng = random.Random(7)
    for _ in range(200):
        h = {rng.randint(0, 40): rng.randint(1, 9) for _ in range(rng.randint(1, 9))}
        k, lengths = rng.randint(1, 4), sorted(h)

        def cost(edges, h=h):
            return sum(c * (min(e for e in edges if e >= x) - x) for x, c in h.items())

        best = min(cost((*c, lengths[-1])) for r in range(min(k, len(lengths))) for c in itertools.combinations(lengths[:-1], r))
        got = packing.boundaries(h, k)
        assert len(got) <= k and cost(got) == best
    assert packing.boundaries({}, 3) == []


def test_batches_hold_every_row_once(spark, edge_docs, no_docs):
    got = packing.pack(edge_docs, packing.word_count(F.col("text")), buckets=4, budget=600, rows_a_shard=5).toPandas()
    assert len(got) == edge_docs.count() and sorted(got.doc_id) == sorted(r["doc_id"] for r in edge_docs.collect())
    assert ((got.padding >= 0) & (got.n_tokens + got.padding == got.boundary)).all()
    for _, g in got.groupby("batch_id"):
        assert g.bucket.nunique() == 1 and sorted(g.place) == list(range(len(g)))
        assert len(g) == 1 or g.boundary.iloc[0] * len(g) <= 600 or g.boundary.iloc[0] == 0
    for _, g in got.groupby("bucket"):
        sizes = g.groupby("batch_id").size().tolist()
        assert sizes[:-1] == [max(1, 600 // max(1, g.boundary.iloc[0]))] * (len(sizes) - 1)
    assert packing.pack(no_docs, packing.word_count(F.col("text"))).collect() == []


def hashes(text):
    import pyarrow as pa

    data, offsets = tb.buffers(pa.array([text]))
    return tb.words(data, offsets, tb.NOT_ALNUM)[2]


def brute_align(a, b):
    h = [[0] * (len(a) + 1) for _ in range(len(b) + 1)]
    for i in range(1, len(b) + 1):
        for j in range(1, len(a) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[j - 1] == b[i - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment_equals_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        a = [rng.choice("abcd") for _ in range(rng.randint(1, 30))]
        b = [rng.choice("abcd") for _ in range(rng.randint(1, 12))]
        score, start, end = decontaminate.align(hashes(" ".join(a)), hashes(" ".join(b)))
        assert score == brute_align(a, b)
        assert score == 0 or brute_align(a[start:end], b) == score


def test_decontamination_finds_copies_and_edits(spark, edge_docs, no_docs):
    item = prose(900, 40)
    words = item.split(" ")
    gaps = " ".join(w for k, w in enumerate(words) if k % 9)
    rows = [(1, f"{prose(1, 300)} {item} {prose(2, 50)}"), (2, item.upper().replace(" ", " , ")), (3, f"{prose(3, 90)} {edited(item, 1, 0.12)}"), (4, f"{gaps} {prose(4, 20)}"), (5, prose(5, 400)), (6, None), (7, ""), (8, "short one"), (9, prose(6, 30_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([(10, item), (11, "short one"), (12, None), (13, ""), (None, item)], "item_id long, text string").withColumn("doc_id", F.lit(3))
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == {(1, 10), (2, 10), (3, 10), (4, 10), (8, 11)}
    assert got[1, 10]["similarity"] == 1.0 and got[1, 10]["passage"] == item and got[2, 10]["similarity"] == 1.0 and got[3, 10]["similarity"] < 1
    assert decontaminate.contaminated(no_docs, bench).collect() == [] and decontaminate.contaminated(docs, bench.limit(0)).collect() == []
