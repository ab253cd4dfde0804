import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Small documents with every awkward case the operators define."""
    base = " ".join(f"w{i % 37}x{i % 11}" for i in range(120))
    near = base.replace("w5x5", "changed", 1)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [
        (0, base, "en", "a"), (1, base, "en", "a"), (2, near, "en", "b"),
        (3, "alpha " + passage + " omega", "fr", None), (4, passage + " tail words here", "fr", "b"),
        (5, None, None, "a"), (6, "", "en", ""), (7, " \t\r\n\x0b\x0c ", "de", "b"),
        (8, "one", "de", "c"), (9, "ONE", "de", "c"), (10, "two words", "en", "c"),
        (11, "<|im_end|> \\ éàü 漢字 🙂 12345 !!! ???", "en", "c"),
        (12, "x" * 5000, "en", "c"), (12, "y " * 40, "en", "c"), (13, base, "en", "a"),
        (13, base, "en", "a"), (None, "row without an id " + passage, "en", None),
        (14, "1234 5678 ... ---", "en", "a"), (15, "a\x1cb c\x85d e f", "en", "a"),
        (100, "stupid idiot you are pathetic scum " * 3, "en", "a"),
    ]
    return spark.createDataFrame(
        [(i, t, g, s, None if t is None else len(t), "x", 1) for i, t, g, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long, "
        "node string, Text_ID int")


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.where("1 = 0")
