"""Diamonds: (carat, cut, color, clarity, depth, table, price, x, y, z)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import ordinal_rank, presets, ratio
from tallyfield.operators.aggregates import counts_per_bin, grouped_means, means_per_bin, top_k
from tallyfield.operators.lines import parse_records
from tallyfield.sources.schemas import SCHEMAS, SEPARATORS


def cut_summary(diamonds: DataFrame) -> DataFrame:
    """Count and mean price, carat, depth and table per cut, worst cut first."""
    means = {f"avg_{name}": name for name in ("price", "carat", "depth", "table")}
    summary = grouped_means(diamonds, ["cut"], means, count_name="n_diamonds")
    return summary.orderBy(ordinal_rank("cut", presets.CUT_ORDER, default=len(presets.CUT_ORDER)), "cut")


def carat_counts(diamonds: DataFrame) -> DataFrame:
    return counts_per_bin(diamonds, "carat", presets.CARAT_BINS, "carat_bin").orderBy("carat_bin")


def carat_summary(diamonds: DataFrame) -> DataFrame:
    summary = means_per_bin(
        diamonds, "carat", presets.CARAT_BINS, {"avg_price": "price"}, name="carat_bin")
    return summary.withColumnRenamed("n", "n_diamonds").orderBy("carat_bin")


def by_unit_price(diamonds: DataFrame, k: int = 5, highest: bool = True) -> DataFrame:
    priced = diamonds.withColumn("price_per_carat", ratio(F.col("price"), F.col("carat"), 2))
    unit = F.col("price_per_carat")
    return top_k(priced, [unit.desc() if highest else unit.asc(), *diamonds.columns], k)


def cut_means_of_lines(lines: DataFrame, header: str) -> DataFrame:
    """(cut, n, mean_carat, mean_price) from the raw text lines."""
    rows = parse_records(lines, SCHEMAS["diamonds"], SEPARATORS["diamonds"], header)
    return grouped_means(rows, ["cut"], {"mean_carat": "carat", "mean_price": "price"})
