"""Rows that every operator must bear, and frames of documents with clashing extra columns."""

SF = "/root/testdata/sf0.001"
#: null and empty texts, white space only, one word, ties and repeats, a very long text, odd characters.
DOCS = [
    (1, "One plain sentence with enough words to count as some prose, more or less, and then a few more words here."),
    (2, "One plain sentence with enough words to count as some prose, more or less, and then a few more words here."),
    (2, "One plain sentence with enough words to count as some prose, more or less, and then a few more words here."),
    (3, None),
    (4, ""),
    (5, " \t\r\n\x0b\f"),
    (6, "word"),
    (7, "Ünï\u00a0cödé \U0001f600 x\u0085y " * 40),
    (8, "long " * 200_000),
    (None, "a row without an id"),
    (None, None),
]


def docs_frame(spark, docs):
    """documents with columns whose names operators might use inside."""
    rows = [(i, t, "src0" if i is None or i % 2 else None, "en", len(t or ""), 7, "x", 0.5, "y") for i, t in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, id int, key string, score double, row string")
