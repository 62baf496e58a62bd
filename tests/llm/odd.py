"""Rows that every operator has to live with."""
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_lines long, kept boolean, h long"


def odd_docs(spark, extra=()):
    """Nulls in any column, empty, blank and very long texts, repeated rows, names that clash."""
    random.seed(2)
    long = " ".join(random.choice(["alpha", "beta", "gamma", "delta"]) + str(i % 977) for i in range(30_000))
    rows = [(None, "a text without a key but with a few words in it", "en", None, None),
            (1, None, None, "s", 3), (2, "", "en", "s", 0), (3, " \t\n\r\x0b\x0c ", "en", "s", 7), (4, "Word", None, None, None),
            (5, long, "en", "s", len(long)), (6, "same words in two rows, word for word the same", "en", "s", 1),
            (6, "same words in two rows, word for word the same", "en", "s", 1), (7, "1234 5678 !!! ...", "de", "s", 2),
            (8, "\U0001f600 émoji à ça <|endoftext|> ΣΑΣ", "fr", "s", 3), (6, "another text under a key seen before", "en", "t", 9)]
    rows = [r + (0.5, 7, True, 1) for r in rows] + [tuple(r) + ("en", "s", 0, 0.5, 7, True, 1) for r in extra]
    return spark.createDataFrame(rows, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
