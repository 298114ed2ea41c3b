from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, lang="en", source="s"):
    """One document per text, numbered from 0."""
    rows = [
        (i, text, lang, source, None if text is None else len(text))
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


# Nulls, empty and blank texts, repeats, no letters, a long text, a word without spaces.
ODD_TEXTS = [
    None, "", " \n\t ", "same words here", "same words here", "12 34 !?", "a" * 400,
    "long text of words " * 3000, "ünïcödé ▁ \x00 \U0001f600 end",
]


def odd_docs(spark):
    """ODD_TEXTS with a repeated row, a null key, null columns and columns whose names the
    operators use inside."""
    rows = [(i, text, "en", "s", None) for i, text in enumerate(ODD_TEXTS)]
    rows += [rows[3], (None, "no key at all", None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    return docs.selectExpr(
        "*", "1 as row", "2 as share", "'x' as word", "3 as fp", "4 as score", "5 as id",
        "6 as `range`", "7 as label", "8 as tokens", "9 as copies", "10 as line",
    )
