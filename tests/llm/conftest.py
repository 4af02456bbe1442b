import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, root string, size string, toxicity string, rejected string, uid string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with further columns whose names clash with those that operators use inside."""

    def make(rows):
        full = [(i, t, l, "s", len(t or ""), "x", "x", "x", "x", "x", "x") for i, t, l in (r if len(r) == 3 else (*r, "en") for r in rows)]
        return spark.createDataFrame(full, COLUMNS)

    return make


LONG = "lorem ipsum dolor sit amet, consectetur " * 4000
ODD = [(1, "Hello, world!"), (2, None), (3, ""), (4, "Hello, world!"), (4, "Hello, world!"), (5, "  \n\t "), (6, LONG), (7, "x<|endoftext|>y  z"), (8, "ßé 漢字 🙂 \x1c á İ Σς"), (9, "don't we'll 123 &&&, a_b.c"), (None, "a text without an id"), (None, "Hello, world!"), (None, None)]


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ODD)
