"""Tokens and word statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Characters that separate tokens (line ends included), the punctuation and the
# digits stripped from token ends, and the character removed inside tokens.
SEPARATORS = " -_.,:|\t\r\n"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
DIGITS = "0123456789"
REMOVED = "'"

# Common English function words.
STOP_WORDS = (
    "a", "about", "after", "all", "also", "am", "an", "and", "any", "are", "as", "at", "be",
    "because", "been", "before", "being", "but", "by", "can", "could", "did", "do", "does",
    "for", "from", "had", "has", "have", "he", "her", "here", "him", "his", "how", "i", "if",
    "in", "into", "is", "it", "its", "just", "may", "me", "more", "most", "must", "my", "no",
    "nor", "not", "of", "on", "only", "or", "other", "our", "out", "over", "own", "shall",
    "she", "should", "so", "some", "such", "than", "that", "the", "their", "them", "then",
    "there", "these", "they", "this", "those", "to", "too", "under", "up", "upon", "us",
    "very", "was", "we", "were", "what", "when", "where", "which", "while", "who", "whom",
    "why", "will", "with", "would", "you", "your",
)


def tokens(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per non-empty token of the whole text: (keep..., token).

    Runs of separators split once: the empty tokens between them would be dropped anyway.
    """
    escaped = "".join("\\" + c if c in "-.|" else c for c in SEPARATORS)
    raw = df.select(*keep, F.explode(F.split(F.col(text), f"[{escaped}]+")).alias("token"))
    bare = F.btrim(F.btrim(F.col("token"), F.lit(PUNCTUATION)), F.lit(DIGITS))
    cleaned = F.lower(F.replace(bare, F.lit(REMOVED), F.lit("")))
    # A filter on the cleaned token would clean every token a second time. A token with any
    # character that is never stripped stays for certain, so only the others need the full test.
    never_stripped = "[^" + "".join("\\" + c for c in PUNCTUATION) + DIGITS + "]"
    stays = F.col("token").rlike(never_stripped) | (cleaned != "")
    return raw.filter(stays).select(*keep, cleaned.alias("token"))


def word_counts(words: DataFrame, token: str = "token") -> DataFrame:
    """(token, n); combined before the shuffle, so frequent words cost one row per task."""
    return words.groupBy(token).agg(F.count("*").alias("n"))


def word_totals(counts: DataFrame) -> DataFrame:
    """(n_words, n_distinct) from word counts."""
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_words"), F.count("*").alias("n_distinct")
    )


def without_words(counts: DataFrame, listed: DataFrame, token: str = "token") -> DataFrame:
    """Drop the listed words. Apply it to word counts: one row per word takes part in the join."""
    return counts.join(listed, token, "left_anti")


def longest_word(words: DataFrame, token: str = "token") -> DataFrame:
    """The longest token, the smallest of equals: one partial row per task."""
    best = F.min(F.struct((-F.length(token)).alias("rank"), F.col(token).alias("token")))
    return words.agg(best.alias("best")).select(
        F.col("best.token").alias("token"), (-F.col("best.rank")).alias("n_chars")
    )


def longest_words(words: DataFrame, k: int, token: str = "token") -> DataFrame:
    """The ``k`` longest distinct tokens."""
    sized = words.select(F.col(token).alias("token")).distinct().withColumn("n_chars", F.length("token"))
    return sized.orderBy(F.col("n_chars").desc(), "token").limit(k)
