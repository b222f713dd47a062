"""Random numbers that follow from a seed and a row key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_uniform(keys: Sequence[str], seed: int = 0) -> Column:
    """A value in [0, 1) with 32 random bits, from the MD5 of seed and keys joined by ``|``.

    It depends on neither partitioning nor the order of rows, and any engine with MD5 gets the same.
    Rows with equal keys get equal values; NULL keys are left out of the joined text.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
