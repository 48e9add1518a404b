import pytest


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text[, lang[, source]]) with clashing extra columns."""

    def make(rows):
        rows = [(*r, *(None,) * (4 - len(r)), "x", 1, 2.0) for r in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, id string, fp int, score double")

    return make


EDGE = [(1, None), (2, ""), (3, " \t\n"), (None, "alpha beta gamma delta"), (5, "alpha beta gamma delta"), (5, "alpha beta gamma delta"), (7, "word " * 30000), (8, "É ß 漢字 😀\nnew\x0bline\x00zero")]


@pytest.fixture(scope="session")
def edge(make_docs):
    return make_docs(EDGE)
