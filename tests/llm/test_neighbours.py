"""The vector space of the nearest examples."""

from helpers_llm import edited, prose
from pyspark.sql import functions as F

from sievewright.llm import neighbours


def test_rare_terms_of_toxic_examples_count(spark):
    """Thirteen groups of six toxic texts share three words that no other text has: a chi-squared of 24 each."""
    toxic = [(k, prose(k, 30) + "".join(f" vile{k // 6}x{j}" for j in range(3))) for k in range(78)]
    clean = [(k, prose(k, 33)) for k in range(78, 400)]
    queries = [(1000, edited(toxic[0][1], 5, 0.1)), (1001, "vile4x0 vile4x1 vile4x2"), (1002, prose(1002, 33))]
    docs = spark.createDataFrame(toxic + clean + queries, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, int(k < 78)) for k in range(400)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in neighbours.score(docs, neighbours.train(docs, labels, F.lit(True))).where("doc_id >= 1000").collect()}
    assert got[1000]["evidence"][0]["doc_id"] == 0 and got[1000]["evidence"][0]["similarity"] > 0.5
    assert {e["doc_id"] // 6 for e in got[1001]["evidence"]} == {4}
    assert got[1000]["score"] > 0.5 and got[1001]["score"] > 0.5 > got[1002]["score"]
