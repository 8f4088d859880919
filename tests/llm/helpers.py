"""Small document tables for the operators' tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, text_2 string"


def docs(spark, rows):
    """rows: (doc_id, text[, lang[, source]]); more columns are filled in."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, *[None] * (4 - len(r)))
        full.append((doc_id, text, lang, source, None if text is None else len(text), "x"))
    return spark.createDataFrame(full, DOCS)


def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, "one", "en", "a"),
        (4, "word " * 30000, "en", "a"),
        (5, "x" * 100000, "fr", None),
        (6, "one", "en", "a"),
        (6, "one", "en", "a"),
        (None, "no id here at all", "en", "b"),
        (7, " \n\t ", "de", "b"),
        (8, "é漢字 \x1c\x85 ünïcode text", "xx", "b"),
    ]
