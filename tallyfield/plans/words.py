"""Word statistics over whole document texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfield.operators import text
from tallyfield.operators.aggregates import top_k
from tallyfield.sources import load_table, local_rows, spread


def words(spark, sf):
    return text.tokens(spread(load_table(spark, sf, "documents").select("text")), "text")


def stop_words(spark):
    return local_rows(spark, [[w] for w in text.STOP_WORDS], "token STRING")


def tokenise_counts(spark, sf):
    return text.word_totals(text.word_counts(words(spark, sf)))


def longest_word(spark, sf):
    return text.longest_word(words(spark, sf))


def longest_words_topk(spark, sf):
    return text.longest_words(words(spark, sf), 20)


def _most_frequent(counts):
    return top_k(counts, [F.col("n").desc(), "token"], 20)


def word_frequency_topk(spark, sf):
    return _most_frequent(text.word_counts(words(spark, sf)))


def stopword_removal(spark, sf):
    counts = text.word_counts(words(spark, sf))
    return _most_frequent(text.without_words(counts, stop_words(spark)))


def stopword_distinct(spark, sf):
    counts = text.word_counts(words(spark, sf))
    return text.word_totals(text.without_words(counts, stop_words(spark)))


QUERIES = {
    "tokenise_counts": tokenise_counts,
    "longest_word": longest_word,
    "longest_words_topk": longest_words_topk,
    "word_frequency_topk": word_frequency_topk,
    "stopword_removal": stopword_removal,
    "stopword_distinct": stopword_distinct,
}


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_WORDS = f"""
WITH w AS (
  SELECT lower(replace(trim(trim(t, {_quoted(text.PUNCTUATION)}), '0123456789'), '''', '')) AS token
  FROM (SELECT unnest(regexp_split_to_array(text, '[ \\-_.,:|\\t\\r\\n]')) AS t FROM documents)
), words AS (SELECT token FROM w WHERE token <> '')
"""
_LISTED = ", ".join(_quoted(w) for w in text.STOP_WORDS)

ORACLE = {
    "tokenise_counts": f"""{_WORDS}
        SELECT count(*) AS n_words, count(DISTINCT token) AS n_distinct FROM words""",
    "longest_word": f"""{_WORDS}
        SELECT token, CAST(length(token) AS INT) AS n_chars FROM words
        ORDER BY length(token) DESC, token LIMIT 1""",
    "longest_words_topk": f"""{_WORDS}
        SELECT DISTINCT token, CAST(length(token) AS INT) AS n_chars FROM words
        ORDER BY n_chars DESC, token LIMIT 20""",
    "word_frequency_topk": f"""{_WORDS}
        SELECT token, count(*) AS n FROM words GROUP BY 1 ORDER BY n DESC, token LIMIT 20""",
    "stopword_removal": f"""{_WORDS}
        SELECT token, count(*) AS n FROM words WHERE token NOT IN ({_LISTED})
        GROUP BY 1 ORDER BY n DESC, token LIMIT 20""",
    "stopword_distinct": f"""{_WORDS}
        SELECT count(*) AS n_words, count(DISTINCT token) AS n_distinct
        FROM words WHERE token NOT IN ({_LISTED})""",
}
