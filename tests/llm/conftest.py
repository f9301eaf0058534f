import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from ``(doc_id, text)`` rows, with columns whose names clash with inner ones."""

    def make(rows, extra=False):
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
        if not extra:
            return df
        clash = ("node", "size", "key", "length", "bucket", "_n", "shard", "held", "row_key", "component", "statistics")
        return df.selectExpr("*", *[f"'x' as {c}" for c in clash])

    return make


ODD = [
    (0, None),
    (1, ""),
    (2, " \n\t "),
    (3, "one"),
    (4, "ééé 中文 ſ K \u00a0x\u2028y z\x00 <|endoftext|>"),
    (5, "word " * 30_000),
    (6, "a b c d e f g"),
    (6, "a b c d e f g"),
    (None, "no id here at all"),
]


@pytest.fixture(scope="session")
def odd_rows():
    return ODD
