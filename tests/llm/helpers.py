"""A small documents table with everything that goes wrong, and rows as plain values."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, m string, key string, node string, block string"


def odd_documents(spark, texts=()):
    """Null and repeated ids, null and empty texts, equal rows, a long text, and columns with clashing names."""
    prose = "one fine day the quick brown fox jumps over a lazy dog near the river bank while birds sing"
    found = [
        (1, prose, "en"),
        (2, None, "en"),
        (3, "", None),
        (4, prose, "en"),
        (4, prose, "en"),
        (None, " \n\t ", "fr"),
        (None, "été à la plage, ça va très bien aujourd'hui", "fr"),
        (5, "x" * 5000 + " " + "word " * 3000, "en"),
        *((100 + i, text, "en") for i, text in enumerate(texts)),
    ]
    rows = [(doc, text, lang, "src", 0 if text is None else len(text), "m", "k", "n", "b") for doc, text, lang in found]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def prose(seed, n):
    """Words of a small language, the same for the same seed."""
    import random

    rng = random.Random(seed)
    parts = "ba ce di fo gu ha le mi no pu ra se ti vo".split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))
