import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, label int, prefix string"
#: Columns of users whose names operators have used, or use, for themselves.
TAKEN = ["__hash", "__nth", "__key", "__score", "key", "nth", "hash", "row", "others", "cut_hex", "strong", "weak", "component", "kept_id", "d", "w"]
DOC_SCHEMA += "".join(f", `{name}` string" for name in TAKEN)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty and long texts, repeated rows, and columns whose
    names operators use themselves."""
    words = [f"word{i % 97}x{i % 31}" for i in range(30_000)]
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t ", None, "b"),
        (4, "One two THREE four five six seven", "en", None),
        (5, "one two three Four five six seven", "en", "b"),
        (5, "one two three Four five six seven", "en", "b"),
        (None, "lone words without an id here now", "fr", "c"),
        (6, " ".join(words), "de", "a"),
        (7, " ".join(words[:-40] + ["changed"] * 40), "de", "b"),
        (8, "x" * 200_000, "es", "a"),
        (9, "two words", None, "c"),
        (9, "other text of the same id", "en", "c"),
        (10, "\U0001f600 éé token = \"abcdefghijklmnop\" AKIA12345678901234", "en", "a"),
    ]
    full = [(i, t, lang, s, None if t is None else len(t), 0.5, 1, "p", *[f"{name} {i}" for name in TAKEN]) for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
