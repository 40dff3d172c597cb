import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __src_pos string, name string, rid string"


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, rows that repeat, odd characters."""
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "naïve", "東京", "🙂", "x"]
    long_text = " ".join(rnd.choice(words) + str(rnd.randrange(50)) for _ in range(9000))
    rows = [(1, "a b  c", "en", "s1"), (2, "ab\tc", "en", "s1"), (3, "abc", "de", "s2"), (3, "abc", "de", "s2"),
            (4, None, None, None), (5, "", "en", "s2"), (6, " \n\x0b\x0c\r\t ", "en", None), (None, "a  b c", None, "s3"),
            (None, None, None, None), (7, long_text, "en", "s1"), (8, long_text + " ", "en", "s1"), (9, long_text + " y", "en", "s10"),
            (10, "a b c", "fr", "s2"), (11, "\x00\x1c\x1f\x85 z", "fr", "é"), (12, "🙂 東京 🙂", "ja", "\U0001f600"), (13, "🙂東京🙂", "ja", "￮")]
    rows += [(100 + i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 40))), "en", f"s{i % 4}") for i in range(60)]
    return [(a, b, c, d, None if b is None else len(b), "clash", "clash", None) for a, b, c, d in rows]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
