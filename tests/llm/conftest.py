import pytest

from llm_samples import prose

# Nulls in every column, empty and white-space texts, repeated rows and ids, and a column that clashes with names inside.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, g string, copies string"


@pytest.fixture
def corpus(spark):
    def make(rows, sources=None):
        data = [(i, t, None, sources[k] if sources else "s", None, "clash", None) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(data, SCHEMA)
    return make


@pytest.fixture
def odd_rows():
    """Rows that any operator must take: no id, no text, blanks only, a repeated row, a repeated id and a very long text."""
    same = prose(1, 120)
    return [(1, same), (2, same), (2, same), (3, None), (4, ""), (5, " \n\t "), (None, "no id here"), (None, None), (6, "one"),
            (7, prose(2, 30_000)), (8, same + " tail"), (8, "another text"), (9, "the the the " * 200)]
