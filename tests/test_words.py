"""Tokens against a plain Python reading of the rule."""

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyfield.operators import text
from tallyfield.sources import local_rows


def brute(value: str) -> list[str]:
    words = []
    for piece in re.split(r"[ \-_.,:|\t\r\n]", value):
        word = piece.strip(text.PUNCTUATION).strip(text.DIGITS).replace("'", "").lower()
        if word:
            words.append(word)
    return words


SAMPLES = [
    "", " ", "...", "Hello, hello -- HELLO!", "it's 5'5 o'clock", "'tis (the) \"end\"", "a1b2 12ab34",
    "don't--stop_now|tab\there", "line one\nline two\r\nthree", "é ÉTÉ ça-va", "!!!9!!! 9!a!9", "x'",
]


def counted(spark, values):
    df = local_rows(spark, [[v] for v in values], "body STRING")
    return Counter(r.token for r in text.tokens(df, "body").collect())


def test_tokens_of_samples(spark):
    assert counted(spark, SAMPLES) == Counter(w for s in SAMPLES for w in brute(s))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aB9' -_.,:|!\t\n(é", max_size=40), min_size=1, max_size=20))
def test_tokens_of_generated_texts(spark, values):
    assert counted(spark, values) == Counter(w for s in values for w in brute(s))


def test_statistics(spark):
    df = local_rows(spark, [[1, "b bb aa a"], [2, "bb the the the"]], "id INT, body STRING")
    words = text.tokens(df, "body")
    counts = text.word_counts(words)
    assert tuple(text.word_totals(counts).first()) == (8, 5)
    assert tuple(text.longest_word(words).first()) == ("the", 3)
    assert [r.token for r in text.longest_words(words, 3).collect()] == ["the", "aa", "bb"]
    stop = local_rows(spark, [["the"], ["the"], ["zz"]], "token STRING")
    assert {r.token: r.n for r in text.without_words(counts, stop).collect()} == {
        "b": 1, "bb": 2, "aa": 1, "a": 1}


def test_equal_lengths_give_the_smallest_word(spark):
    df = local_rows(spark, [["pear plum kiwi"]], "body STRING")
    assert text.longest_word(text.tokens(df, "body")).first().token == "kiwi"


def test_no_words(spark):
    df = local_rows(spark, [["... --"]], "body STRING")
    words = text.tokens(df, "body")
    assert tuple(text.word_totals(text.word_counts(words)).first()) == (0, 0)
    assert text.longest_word(words).first().token is None
