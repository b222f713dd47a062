"""Lookups, set membership, cohorts and rates.

No join here carries a broadcast hint: Spark broadcasts a side only when its measured size is
under the session threshold and otherwise shuffles both sides, where adaptive execution splits
skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.rounding import ratio


def _keys(on: str | Sequence[str]) -> list[str]:
    names = [on] if isinstance(on, str) else list(on)
    if not names:
        raise ValueError("a join needs at least one key; without one it is a cross product")
    return names


def lookup(df: DataFrame, dimension: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left outer equi-join: every row of ``df`` stays."""
    return df.join(dimension, _keys(on), "left")


def match(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner equi-join."""
    return df.join(other, _keys(on), "inner")


def full_match(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Full outer equi-join with one coalesced key column.

    Neither side of it can be split, so aggregate both sides by the key first.
    """
    return df.join(other, _keys(on), "full_outer")


def keep_in(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``; duplicates there do not multiply rows.

    The key side of a semi or anti join cannot be split, so it is reduced to distinct keys first:
    a key that fills a third of it becomes one row per task before the shuffle, and the join then
    uses the partitioning that the reduction made.
    """
    names = _keys(on)
    return df.join(keys.select(names).distinct(), names, "left_semi")


def drop_in(df: DataFrame, on: str | Sequence[str], *key_sets: DataFrame) -> DataFrame:
    """Rows whose key occurs in none of the key sets."""
    names = _keys(on)
    return reduce(
        lambda kept, keys: kept.join(keys.select(names).distinct(), names, "left_anti"), key_sets, df)


def top_with_lookup(
    measures: DataFrame, dimension: DataFrame, on: str, order: Sequence[Column], k: int
) -> DataFrame:
    """The first ``k`` rows of ``measures`` looked up in ``dimension`` and ordered.

    Each measure row yields at least one joined row, so the first ``k`` joined rows come from the
    first ``k`` measure rows. Cutting first makes one side of the join ``k`` rows, and the
    dimension is reduced to their keys before it takes part in the outer join.
    """
    best = measures.orderBy(*order).limit(k)
    wanted = dimension.join(best.select(on), on, "left_semi")
    return lookup(best, wanted, on).orderBy(*order).limit(k)


def with_status(flagged: DataFrame, exits: Sequence[str]) -> DataFrame:
    """Add is_current and is_former to rows with ``enrolled`` and one flag per exit set."""
    left = reduce(lambda a, b: a | b, [F.col(name) for name in exits])
    return flagged.withColumns({
        "is_current": F.col("enrolled") & ~left,
        "is_former": F.col("enrolled") & left,
    })


def cohort_flags(
    members: DataFrame, key: str, activity: DataFrame, exits: Mapping[str, DataFrame]
) -> DataFrame:
    """``members`` with BOOLEAN columns: enrolled, one per exit set, is_current and is_former.

    Each key set is reduced to distinct keys before its join, and all joins share the key, so
    ``members`` is shuffled once and no hot key survives into a join.
    """
    flagged = members
    for name, frame in {"enrolled": activity, **exits}.items():
        keys = frame.select(key).distinct().withColumn(name, F.lit(True))
        flagged = lookup(flagged, keys, key).withColumn(name, F.coalesce(name, F.lit(False)))
    return with_status(flagged, list(exits))


def cohort_flags_from_events(
    members: DataFrame, key: str, events: DataFrame, conditions: Mapping[str, Column]
) -> DataFrame:
    """The same flags where all key sets are conditions on one event table.

    ``conditions`` maps 'enrolled' and each exit to its condition. The events are read once and
    combined per key, instead of once per key set.
    """
    relevant = reduce(lambda a, b: a | b, conditions.values())
    per_key = events.filter(relevant).groupBy(key).agg(
        *[F.bool_or(condition).alias(name) for name, condition in conditions.items()])
    flags = {name: F.coalesce(name, F.lit(False)) for name in conditions}
    flagged = lookup(members, per_key, key).withColumns(flags)
    return with_status(flagged, [name for name in conditions if name != "enrolled"])


def cohort_sizes(
    members: DataFrame, key: str, activity: DataFrame, exits: Mapping[str, DataFrame]
) -> DataFrame:
    """(cohort, n): accepted, enrolled, current, former, and the size of each exit set."""
    flags = cohort_flags(members, key, activity, exits)
    sizes = flags.agg(
        F.count("*").alias("accepted"),
        F.count_if("enrolled").alias("enrolled"),
        F.count_if("is_current").alias("current"),
        F.count_if("is_former").alias("former"),
    ).unpivot([], ["accepted", "enrolled", "current", "former"], "cohort", "n")
    for name, frame in exits.items():
        sizes = sizes.unionAll(frame.agg(F.count("*").alias("n")).select(F.lit(name), "n"))
    return sizes


def cohort_sizes_from_events(
    members: DataFrame, key: str, events: DataFrame, conditions: Mapping[str, Column]
) -> DataFrame:
    """The same sizes where all key sets are conditions on one event table, read once.

    Keys of events that are no members count in the size of an exit set, as they do there.
    """
    exits = [name for name in conditions if name != "enrolled"]
    relevant = reduce(lambda a, b: a | b, conditions.values())
    per_key = events.filter(relevant).groupBy(key).agg(
        *[F.bool_or(condition).alias(name) for name, condition in conditions.items()])
    both = full_match(members.select(key, F.lit(True).alias("accepted")), per_key, key).withColumns(
        {name: F.coalesce(name, F.lit(False)) for name in ["accepted", *conditions]})
    flagged = with_status(both.withColumn("enrolled", F.col("enrolled") & F.col("accepted")), exits)
    return flagged.agg(
        *[F.count_if(name).alias(name) for name in ("accepted", "enrolled")],
        F.count_if("is_current").alias("current"), F.count_if("is_former").alias("former"),
        *[F.count_if(name).alias(name) for name in exits],
    ).unpivot([], ["accepted", "enrolled", "current", "former", *exits], "cohort", "n")


def outer_rate(
    part: DataFrame, whole: DataFrame, on: str, part_name: str, whole_name: str, digits: int = 4,
    name: str = "rate",
) -> DataFrame:
    """part / whole per key; a key missing on either side stays, with a NULL rate."""
    return full_match(part, whole, on).withColumn(
        name, ratio(F.col(part_name), F.col(whole_name), digits)
    )


def first_period_rows(
    sums: DataFrame, members: DataFrame, entity: str, period: str, first_period: str
) -> DataFrame:
    """Rows of ``sums`` that fall into their member's first period: a two-key equi-join."""
    starts = members.select(entity, F.col(first_period).alias(period))
    return match(sums, starts, [entity, period])


def rate_per_bin(
    flagged: DataFrame, bin_name: str, part_flag: str, whole_flag: str, part_name: str,
    whole_name: str, digits: int = 4, name: str = "rate",
) -> DataFrame:
    """part / whole per bin from row flags, in one aggregate.

    A bin is listed when both counts are positive; rows without a bin are left out.
    """
    counts = flagged.filter(F.col(bin_name).isNotNull()).groupBy(bin_name).agg(
        F.count_if(part_flag).alias(part_name), F.count_if(whole_flag).alias(whole_name)
    )
    both = (F.col(part_name) > 0) & (F.col(whole_name) > 0)
    return counts.filter(both).withColumn(
        name, ratio(F.col(part_name), F.col(whole_name), digits)
    )
