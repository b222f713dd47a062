"""Samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.uniform import keyed_uniform


def bernoulli_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Keep each row with probability ``fraction``, without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def keyed_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 0) -> DataFrame:
    """Keep each row key with probability ``fraction``: the same rows under any partitioning and in any engine."""
    return df.filter(keyed_uniform(keys, seed) < F.lit(float(fraction)))


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Random split by row position: the same seed gives other rows once partitioning changes."""
    return df.randomSplit(list(weights), seed=seed)


def hash_bucket(keys: Sequence[str], buckets: int, seed: int = 0) -> Column:
    """Bucket number of a row key. It depends on the key alone, not on where the row lies."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(buckets)).cast("int")


def hash_sample(keys: Sequence[str], rows: int, total: int, seed: int = 0) -> Column:
    """Whether a row key is among about ``rows`` of ``total`` keys. The threshold has 64 bits, so it
    stays exact for any total."""
    if rows >= total:
        return F.lit(True)
    return F.xxhash64(F.lit(seed), *keys) < F.lit(rows * 2**64 // total - 2**63)


def portable_bucket(keys: Sequence[str], buckets: int, seed: int = 0) -> Column:
    """Bucket number from the MD5 of seed and keys joined by ``|``, as any engine can compute it."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def keyed_split(
    df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 0, portable: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(first, rest) by row key: repeatable under any partitioning and after lost executors.

    ``portable`` picks the bucket that other engines compute alike; the other one is faster.
    """
    bucket = (portable_bucket if portable else hash_bucket)(keys, 10_000, seed)
    cut = round(fraction * 10_000)
    return df.filter(bucket < cut), df.filter(bucket >= cut)
