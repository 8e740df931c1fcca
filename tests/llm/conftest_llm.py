"""Helpers that the tests of this folder import by name."""

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("_id", "_turn", "_text_sha", "_copy", "_copies", "_size", "_c0", "_gone", "id", "salt", "size", "keep_id", "score", "a.b")


def docs_frame(spark, texts, extra=()):
    """Documents with ids 0, 1, ...; a text may be a (doc_id, text) pair; extra column names clash on purpose."""
    rows = []
    for i, t in enumerate(texts):
        key, text = t if isinstance(t, tuple) else (i, t)
        rows.append((key, text, "en", f"s{i % 2}", len(text or ""), *[i] * len(extra)))
    schema = COLUMNS + "".join(f", `{c}` int" for c in extra)
    return spark.createDataFrame(rows, schema)
