"""Small document tables shared by the tests of the llm operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in ("ta", "re", "mi", "so", "né", "ku") for b in ("lor", "ven", "dis", "Pa", "gu", "ß")]


def prose(seed, n):
    r = random.Random(seed)
    out = []
    while len(out) < n:
        k = min(n - len(out), r.randint(3, 12))
        out += [r.choice(WORDS) + r.choice(WORDS) for _ in range(k)]
        out[-1] += r.choice([".", ".\n", ",", " \t"])
    return " ".join(out)


def odd_rows():
    """Nulls in every column, empty and blank texts, a very long text, ties and repeated rows."""
    long = prose(1, 30_000)
    base = prose(2, 300)
    rows = [
        (1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \n\t ", "en", None, 4),
        (4, long, "en", "a", len(long)), (5, base, "en", "a", len(base)), (6, base, "fr", "b", len(base)),
        (7, base, None, None, None), (7, base, None, None, None), (None, prose(3, 120), "en", "b", 1),
        (None, None, None, None, None), (8, "one", "de", "b", 3), (9, "né " * 50, "fr", "c", 150),
        (10, base.replace("ta", "ti", 2), "en", "c", len(base)), (11, "\n".join([prose(4, 30)] * 6), "en", "c", 1),
        (12, "x y   z 　 日本語 テキスト 'tis they're we'll 123 ٣", "en", "c", 1),
        (13, prose(5, 80) + "\n" + base + "\n" + prose(6, 80), "en", "d", 1),
    ]
    return rows


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """The same table with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ("n_words", "kept", "k1", "k2", "_id", "_text", "_row", "_kept", "class_id", "sequence_id",
             "line", "site", "topic", "tokens", "weight", "score", "start", "length", "bands", "h")
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(names)))
