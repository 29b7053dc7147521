import pytest
from helpers_llm import edited, prose

EXTRA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept boolean, chunk int, bucket int, token string, node bigint, n_tokens bigint, component string"


def edge_rows():
    """(doc_id, text): nulls, empties, a long text, exact and near copies, a shared passage, a repeated row."""
    base, passage = prose(1, 120), prose(2, 40)
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "One two three"), (5, "one two three"), (6, prose(3, 30_000)), (7, base), (8, base), (9, base.upper())]
    rows += [(10 + k, edited(base, k, 0.01)) for k in range(12)] + [(30 + k, edited(base, 90 + k, 0.1)) for k in range(6)]
    rows += [(50 + k, prose(100 + k, 60) + " " + passage + " " + prose(200 + k, 30)) for k in range(8)]
    rows += [(70 + k, prose(300 + k, 80)) for k in range(12)] + [(90, "Ünïcödé 🙂 wörds — ‘quoted’"), (90, "Ünïcödé 🙂 wörds — ‘quoted’")]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The edge rows with columns whose names the operators use themselves."""
    rows = [(i, t, "en" if i % 2 else "fr", "s", 1, 9.0, True, 7, 7, "x", 5, 3, "c") for i, t in edge_rows()]
    return spark.createDataFrame(rows, EXTRA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EXTRA)
