import random

import pytest

WORDS = "the of and to in red stone river house light paper green table window garden".split()

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # columns that operators use for their own results or inside
    "score double, kept boolean, slot bigint, block int, n_tokens int, fingerprint string, "
    "_code bigint, _n int, _text string, n_words int"
)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ly", "er"]) for _ in range(n))


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text or ""), 7.0, False, 9, 9, 9, "x", 9, 9, "y", 9)


def odd_rows():
    rng = random.Random(4)
    long = prose(rng, 30_000)
    same = prose(rng, 80)
    return [
        row(1, None), row(2, ""), row(3, " \t\n\r\x0b\x0c "), row(4, long), row(5, "w" * 120_000),
        row(None, prose(rng, 60)), row(6, prose(rng, 60), None, None), row(7, same), row(7, same),
        row(8, same, "de", "b"), row(9, "日本語 テキスト 🙂 é\x1c\x85z"), row(10, "12 34 !!"),
        row(None, None, None, None), row(11, "a b"), row(12, "<|endoftext|> x <|endof"),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
