import pytest

SMALL = "/root/testdata/sf0.001"

ODD_TEXTS = [None, "", "   \n\t ", "one", "ONE", "a b c d", "A B c d e", "a b c d e", "a b c d e f",
             "x\x1cy z\x85w é ü　\U0001d538", "<|endoftext|> end <|startoftext|>", "İ ſ Σς ﬁ"]


@pytest.fixture(scope="session")
def frame(spark):
    """(rows) -> documents with a null, an extra and a clashing column."""
    def make(rows):
        rows = [(i, t, None, "s", len(t or ""), "x", i) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                           "sig string, k bigint")
    return make


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small):
    return [(r.doc_id, r.text) for r in small.collect()]
