"""The choice of a payload's object: in one pass, with the rules of its docstring."""

import json

from pyspark.sql import functions as F

from sievewright.operators import products

ROWS = [
    ({"a": {"name": "one", "brand": "b"}, "b": [{"name": "two", "brand": "b"}]}, "", "", (2, "one")),  # the first of a tie
    ({"a": {"name": "n", "brand": "b", "price": 1}, "b": {"@type": "PRODUCT", "name": "typed"}}, "", "", (41, "typed")),
    ({"x": {"name": "seed", "Catalog-Number": " ab-1 "}, "y": {"@type": "Product", "name": "t"}}, "AB1", None, (102, "seed")),
    ({"x": {"name": "id", "itemId": 7, "sku": ""}, "y": {"sku": "7", "name": "t"}}, None, "7", (103, "id")),
    ({"x": {"title": "anchor"}}, "q", "q", (1, None)), ({"x": {"odd": 1}}, "q", "", None), ("{bad", "q", "", None), (None, "q", "", None),
]


def test_best_mapping(spark):
    rows = [(n, b if b is None or isinstance(b, str) else json.dumps(b), sku, own) for n, (b, sku, own, _) in enumerate(ROWS)]
    df = spark.createDataFrame(rows, "n int, body string, sku string, own string")
    found = df.select("n", products.best_mapping(F.col("body"), F.col("sku"), F.col("own")).alias("b")).select("n", "b.score", F.get_json_object("b.text", "$.name").alias("name"))
    assert {r["n"]: None if r["score"] is None else (r["score"], r["name"]) for r in found.collect()} == {n: want for n, (*_, want) in enumerate(ROWS)}
    assert "lambda" not in found._jdf.queryExecution().executedPlan().toString()  # judged once, not again for each field
