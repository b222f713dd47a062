"""Scalar and aggregate functions, row by row over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfield.functions import ratio, round_half_even, round_stable
from tallyfield.sources import load_table


def scalar_string_functions(spark, sf):
    name, brand = F.col("p_name"), F.col("p_brand")
    words = F.split(name, " ")
    return load_table(spark, sf, "part").select(
        "p_partkey",
        F.get(words, 0).alias("first_word"),
        F.element_at(words, -1).alias("last_word"),
        F.size(words).alias("n_words"),
        F.btrim(brand, F.lit("0123456789")).alias("no_digits"),
        F.btrim(F.btrim(brand, F.lit("0123456789")), F.lit("#")).alias("bare"),
        F.replace(name, F.lit(" "), F.lit("_")).alias("joined"),
        F.translate(name, "i", "").alias("without_i"),
        F.lower("p_type").alias("lowered"),
        F.length(name).alias("n_chars"),
        name.contains("ring").alias("has_ring"),
        F.substring(name, 2, 2).alias("second_and_third"),
    )


def scalar_numeric_functions(spark, sf):
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return load_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        ratio(price, quantity, 2).alias("unit_price"),
        round_half_even(quantity / 8, 2).alias("even_rounded"),
        quantity.cast("int").alias("whole_quantity"),
        price.cast("bigint").alias("truncated"),
        quantity.cast("int").cast("string").alias("as_text"),
        F.round(F.log(price), 6).alias("log_price"),
        F.pow(quantity, F.lit(2)).alias("squared"),
        round_stable(quantity * 2 + F.col("l_tax") - F.col("l_discount"), 2).alias("mixed"),
        F.when(quantity >= 40, "large").when(quantity >= 20, "medium").otherwise("small").alias("size"),
        ((F.col("l_returnflag") == "R") | ((quantity != 1) & (F.col("l_linestatus") == "O")))
        .alias("is_open_or_returned"),
    )


def scalar_aggregates(spark, sf):
    """The aggregate names as SQL expression strings."""
    return load_table(spark, sf, "events").groupBy("event_type").agg(
        F.expr("COUNT(*) AS n"),
        F.expr("COUNT(DISTINCT user_id) AS n_users"),
        F.expr("ROUND(CAST(SUM(CAST(value AS DECIMAL(28,4))) AS DOUBLE), 2) AS total"),
        round_stable(F.expr("AVG(value)"), 2).alias("mean"),
        F.expr("MIN(value) AS lowest"),
        F.expr("MAX(value) AS highest"),
    )


QUERIES = {
    "scalar_string_functions": scalar_string_functions,
    "scalar_numeric_functions": scalar_numeric_functions,
    "scalar_aggregates": scalar_aggregates,
}

ORACLE = {
    "scalar_string_functions": """
        SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word,
               string_split(p_name, ' ')[-1] AS last_word,
               CAST(len(string_split(p_name, ' ')) AS INT) AS n_words,
               trim(p_brand, '0123456789') AS no_digits,
               trim(trim(p_brand, '0123456789'), '#') AS bare,
               replace(p_name, ' ', '_') AS joined, replace(p_name, 'i', '') AS without_i,
               lower(p_type) AS lowered, CAST(length(p_name) AS INT) AS n_chars,
               contains(p_name, 'ring') AS has_ring,
               substring(p_name, 2, 2) AS second_and_third
        FROM part""",
    "scalar_numeric_functions": """
        SELECT l_orderkey, l_linenumber,
               round(l_extendedprice / l_quantity + 1e-9, 2) AS unit_price,
               round_even(l_quantity / 8, 2) AS even_rounded,
               CAST(l_quantity AS INT) AS whole_quantity,
               CAST(trunc(l_extendedprice) AS BIGINT) AS truncated,
               CAST(CAST(l_quantity AS INT) AS VARCHAR) AS as_text,
               round(ln(l_extendedprice), 6) AS log_price,
               pow(l_quantity, 2) AS squared,
               round(l_quantity * 2 + l_tax - l_discount + 1e-9, 2) AS mixed,
               CASE WHEN l_quantity >= 40 THEN 'large' WHEN l_quantity >= 20 THEN 'medium'
                    ELSE 'small' END AS size,
               (l_returnflag = 'R' OR (l_quantity <> 1 AND l_linestatus = 'O')) AS is_open_or_returned
        FROM lineitem""",
    "scalar_aggregates": """
        SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_users,
               round(sum(CAST(value AS DECIMAL(28,4)))::DOUBLE, 2) AS total, round(avg(value) + 1e-9, 2) AS mean,
               min(value) AS lowest, max(value) AS highest
        FROM events GROUP BY 1""",
}
