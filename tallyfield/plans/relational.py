"""Filters, bins, category scores, joins, grouped reports and top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfield.functions import Bins, bin_label, exact_sum, map_category, ordinal_rank, ratio
from tallyfield.functions.categories import mapping_sql
from tallyfield.functions.registry import register_sql_function
from tallyfield.operators.aggregates import (
    class_share, conditional_shares, count_by, counts_per_bin, distinct_count_frequency,
    grouped_means, means_per_bin, share_of_total, supported_extremes, top_k, weighted_mean_by,
)
from tallyfield.operators.joins import keep_in, lookup, match, top_with_lookup
from tallyfield.sources import load_table

QUANTITY_BINS = Bins(edges=(0.0, 10.0, 20.0, 30.0, 40.0, 50.0), closed="right")
TYPE_ORDER = ("ECONOMY", "SMALL", "STANDARD", "MEDIUM", "LARGE")
PRIORITY_SCORE = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "5-LOW": 0}
SHIPPED_FROM = "2001-01-01"


def suppliers(spark, sf):
    """(l_suppkey, s_name): the lookup table of line item suppliers."""
    return load_table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")


def type_rank():
    return ordinal_rank("p_type", TYPE_ORDER, default=len(TYPE_ORDER) + 1)


def range_bin_counts(spark, sf):
    return counts_per_bin(load_table(spark, sf, "lineitem"), "l_quantity", QUANTITY_BINS).orderBy("bin")


def binned_agg(spark, sf):
    items = load_table(spark, sf, "lineitem")
    return means_per_bin(items, "l_quantity", QUANTITY_BINS, {"avg_price": "l_extendedprice"}).orderBy("bin")


def ordinal_rank_map(spark, sf):
    return count_by(load_table(spark, sf, "part"), "p_type", type_rank().alias("type_rank"))


def category_score_map(spark, sf):
    score = map_category("o_orderpriority", PRIORITY_SCORE).alias("score")
    return count_by(load_table(spark, sf, "orders"), "o_orderpriority", score)


def ranked_group_summary(spark, sf):
    means = {"avg_price": "p_retailprice", "avg_size": "p_size"}
    summary = grouped_means(load_table(spark, sf, "part"), ["p_type"], means)
    return summary.withColumn("type_rank", type_rank()).orderBy("type_rank", "p_type")


def sql_function_call(spark, sf):
    body = mapping_sql("x", PRIORITY_SCORE)
    register_sql_function(spark, "priority_score", "x STRING", "INT", body)
    return spark.sql(
        "SELECT priority_score(o_orderpriority) AS score, count(*) AS n FROM {orders} "
        "WHERE priority_score(o_orderpriority) IS NOT NULL GROUP BY 1 ORDER BY 1",
        orders=load_table(spark, sf, "orders"))


def unit_price_topk(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    priced = load_table(spark, sf, "lineitem").select(
        *keys, ratio(F.col("l_extendedprice"), F.col("l_quantity"), 2).alias("unit_price"))
    return top_k(priced, [F.col("unit_price").desc(), *keys], 5)


def unit_price_lowest(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    priced = load_table(spark, sf, "lineitem").select(
        *keys, ratio(F.col("l_extendedprice"), F.col("l_quantity"), 2).alias("unit_price"))
    return top_k(priced, [F.col("unit_price").asc(), *keys], 5)


def ring_parts(spark, sf):
    return load_table(spark, sf, "part").filter("p_name LIKE '%ring%'")


def like_filter_count(spark, sf):
    return ring_parts(spark, sf).agg(F.count("*").alias("n"))


def appearances_by_person(spark, sf):
    items = load_table(spark, sf, "lineitem").filter(F.col("l_returnflag").isin("A", "R"))
    counts = count_by(items, "l_suppkey", name="appearances")
    order = [F.col("appearances").desc(), F.col("l_suppkey")]
    return top_with_lookup(counts, suppliers(spark, sf), "l_suppkey", order, 16)


def semi_join_count(spark, sf):
    items = load_table(spark, sf, "lineitem").filter(F.col("l_returnflag").isin("A", "R"))
    wanted = ring_parts(spark, sf).select(F.col("p_partkey").alias("l_partkey"))
    counts = count_by(keep_in(items, wanted, "l_partkey"), "l_suppkey", name="n_lines")
    order = [F.col("n_lines").desc(), F.col("l_suppkey")]
    return top_with_lookup(counts, suppliers(spark, sf), "l_suppkey", order, 16)


def having_filters(spark, sf):
    """Per supplier: returned lines, order totals and their mean, kept by two post filters.

    The order lookup joins two fact tables; a hot order splits by adaptive execution.
    """
    items = (load_table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
             .select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey"))
    totals = load_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    measures = lookup(items, totals, "o_orderkey").groupBy("l_suppkey").agg(
        F.count("o_orderkey").alias("n_lines"),
        F.round(exact_sum("o_totalprice"), 2).alias("total_value"),
        ratio(exact_sum("o_totalprice"), F.count("o_totalprice"), 2).alias("avg_value"),
    ).filter("total_value >= 45000000").filter("n_lines >= 190")
    order = [F.col("avg_value").desc(), F.col("l_suppkey")]
    return top_with_lookup(measures, suppliers(spark, sf), "l_suppkey", order, 16)


def segment_share(spark, sf):
    return class_share(load_table(spark, sf, "customer"), "c_mktsegment").orderBy(
        F.col("share").desc(), "c_mktsegment")


def share_by_dept(spark, sf):
    """Lines of one period per brand. Lines are counted per part before the lookup, so a part
    with a large share of all lines is one row there. The total is taken before the lookup."""
    items = load_table(spark, sf, "lineitem").filter(F.col("l_shipdate") >= SHIPPED_FROM)
    per_part = count_by(items, F.col("l_partkey").alias("p_partkey"), name="n_part")
    brands = load_table(spark, sf, "part").select("p_partkey", "p_brand")
    counts = lookup(per_part, brands, "p_partkey").groupBy("p_brand").agg(F.sum("n_part").alias("n"))
    total = per_part.agg(F.sum("n_part"))
    return share_of_total(counts, total).orderBy(F.col("n").desc(), "p_brand")


def distinct_years(spark, sf):
    orders = load_table(spark, sf, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("order_year"))
    return distinct_count_frequency(
        orders, "o_custkey", "order_year", "n_years", "n_customers").orderBy("n_years")


def order_scores(spark, sf):
    """(o_custkey, order_year, score, weight) per order: the priority score, weighted by the
    ordered quantity. Quantities are added up per order before the join."""
    weights = load_table(spark, sf, "lineitem").groupBy(
        F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("weight"))
    orders = load_table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"),
        map_category("o_orderpriority", PRIORITY_SCORE).alias("score"))
    return match(orders, weights, "o_orderkey")


def weighted_mean_by_entity(spark, sf):
    return weighted_mean_by(order_scores(spark, sf), ["o_custkey"], "score", "weight")


def weighted_mean_graded_only(spark, sf):
    return weighted_mean_by(
        order_scores(spark, sf), ["o_custkey"], "score", "weight", ungraded="exclude")


def flag_shares(spark, sf):
    values = {"share_a": "A", "share_n": "N", "share_r": "R"}
    shares = conditional_shares(
        load_table(spark, sf, "lineitem"), ["l_suppkey"], "l_returnflag", values)
    return match(shares, suppliers(spark, sf), "l_suppkey")


def min_support_topk(spark, sf):
    return supported_extremes(flag_shares(spark, sf), "n", 600, "share_a", "l_suppkey", 10)


QUERIES = {
    "range_bin_counts": range_bin_counts,
    "binned_agg": binned_agg,
    "ordinal_rank_map": ordinal_rank_map,
    "category_score_map": category_score_map,
    "ranked_group_summary": ranked_group_summary,
    "sql_function_call": sql_function_call,
    "unit_price_topk": unit_price_topk,
    "unit_price_lowest": unit_price_lowest,
    "like_filter_count": like_filter_count,
    "appearances_by_person": appearances_by_person,
    "semi_join_count": semi_join_count,
    "having_filters": having_filters,
    "class_share": segment_share,
    "share_by_dept": share_by_dept,
    "distinct_count_frequency": distinct_years,
    "weighted_mean_by_entity": weighted_mean_by_entity,
    "weighted_mean_graded_only": weighted_mean_graded_only,
    "conditional_share_matrix": flag_shares,
    "min_support_topk": min_support_topk,
}

_BIN = """CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN '(0,10]'
               WHEN l_quantity > 10 AND l_quantity <= 20 THEN '(10,20]'
               WHEN l_quantity > 20 AND l_quantity <= 30 THEN '(20,30]'
               WHEN l_quantity > 30 AND l_quantity <= 40 THEN '(30,40]'
               WHEN l_quantity > 40 AND l_quantity <= 50 THEN '(40,50]' END"""
_RANK = """CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'STANDARD' THEN 3
               WHEN 'MEDIUM' THEN 4 WHEN 'LARGE' THEN 5 ELSE 6 END"""
SCORE_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3
               WHEN '3-MEDIUM' THEN 2 WHEN '5-LOW' THEN 0 END"""
_SHARES = """
    SELECT l_suppkey, count(l_returnflag) AS n,
           round(sum(CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END)::DOUBLE
                 / count(l_returnflag) + 1e-9, 2) AS share_a,
           round(sum(CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0.0 END)::DOUBLE
                 / count(l_returnflag) + 1e-9, 2) AS share_n,
           round(sum(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)::DOUBLE
                 / count(l_returnflag) + 1e-9, 2) AS share_r,
           s_name
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY l_suppkey, s_name
"""


def _unit_price_sql(direction: str) -> str:
    return f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               round(l_extendedprice / l_quantity + 1e-9, 2) AS unit_price
        FROM lineitem ORDER BY unit_price {direction}, 1, 2, 3, 4 LIMIT 5"""


ORACLE = {
    "range_bin_counts": f"SELECT {_BIN} AS bin, count(*) AS n FROM lineitem GROUP BY 1",
    "binned_agg": f"""
        SELECT {_BIN} AS bin, count(*) AS n, round(avg(l_extendedprice) + 1e-9, 2) AS avg_price
        FROM lineitem GROUP BY 1""",
    "ordinal_rank_map": f"SELECT p_type, {_RANK} AS type_rank, count(*) AS n FROM part GROUP BY 1, 2",
    "category_score_map": f"""
        SELECT o_orderpriority, {SCORE_SQL} AS score, count(*) AS n FROM orders GROUP BY 1, 2""",
    "ranked_group_summary": f"""
        SELECT p_type, count(*) AS n, round(avg(p_retailprice) + 1e-9, 2) AS avg_price,
               round(avg(p_size) + 1e-9, 2) AS avg_size, {_RANK} AS type_rank
        FROM part GROUP BY p_type ORDER BY type_rank, p_type""",
    "sql_function_call": f"""
        SELECT score, count(*) AS n FROM (SELECT {SCORE_SQL} AS score FROM orders) t
        WHERE score IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "unit_price_topk": _unit_price_sql("DESC"),
    "unit_price_lowest": _unit_price_sql("ASC"),
    "like_filter_count": "SELECT count(*) AS n FROM part WHERE p_name LIKE '%ring%'",
    "appearances_by_person": """
        SELECT l_suppkey, appearances, s_name
        FROM (SELECT l_suppkey, count(*) AS appearances FROM lineitem
              WHERE l_returnflag = 'A' OR l_returnflag = 'R' GROUP BY 1) c
        LEFT JOIN supplier ON s_suppkey = l_suppkey
        ORDER BY appearances DESC, l_suppkey LIMIT 16""",
    "semi_join_count": """
        SELECT l_suppkey, n_lines, s_name
        FROM (SELECT l_suppkey, count(*) AS n_lines FROM lineitem
              WHERE l_returnflag IN ('A', 'R')
                AND l_partkey IN (SELECT p_partkey FROM part WHERE p_name LIKE '%ring%')
              GROUP BY 1) c
        LEFT JOIN supplier ON s_suppkey = l_suppkey
        ORDER BY n_lines DESC, l_suppkey LIMIT 16""",
    "having_filters": """
        SELECT l_suppkey, n_lines, total_value, avg_value, s_name
        FROM (SELECT l_suppkey, count(l_orderkey) AS n_lines,
                     round(sum(CAST(o_totalprice AS DECIMAL(28,4)))::DOUBLE, 2) AS total_value,
                     round(sum(CAST(o_totalprice AS DECIMAL(28,4)))::DOUBLE / count(o_totalprice) + 1e-9, 2) AS avg_value
              FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
              WHERE l_returnflag = 'R' GROUP BY 1
              HAVING round(sum(CAST(o_totalprice AS DECIMAL(28,4)))::DOUBLE, 2) >= 45000000 AND count(l_orderkey) >= 190) m
        LEFT JOIN supplier ON s_suppkey = l_suppkey
        ORDER BY avg_value DESC, l_suppkey LIMIT 16""",
    "class_share": """
        SELECT c_mktsegment, count(*) AS n,
               round(count(*)::DOUBLE / (SELECT count(*) FROM customer) + 1e-9, 4) AS share
        FROM customer GROUP BY 1""",
    "share_by_dept": f"""
        SELECT p_brand, count(*) AS n,
               round(count(*)::DOUBLE / (SELECT count(*) FROM lineitem
                                         WHERE l_shipdate >= TIMESTAMP '{SHIPPED_FROM}') + 1e-9, 4) AS share
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
        WHERE l_shipdate >= TIMESTAMP '{SHIPPED_FROM}' GROUP BY 1""",
    "distinct_count_frequency": """
        SELECT n_years, count(*) AS n_customers
        FROM (SELECT o_custkey, count(DISTINCT year(o_orderdate)) AS n_years FROM orders GROUP BY 1) t
        GROUP BY 1""",
    "weighted_mean_by_entity": f"""
        SELECT o_custkey, round(sum({SCORE_SQL} * l_quantity) / sum(l_quantity) + 1e-9, 2) AS mean
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
    "weighted_mean_graded_only": f"""
        SELECT o_custkey,
               round(sum({SCORE_SQL} * l_quantity)
                     / sum(CASE WHEN ({SCORE_SQL}) IS NOT NULL THEN l_quantity END) + 1e-9, 2) AS mean
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
    "conditional_share_matrix": _SHARES,
    "min_support_topk": f"""
        WITH s AS ({_SHARES}), kept AS (SELECT * FROM s WHERE n >= 600)
        SELECT * FROM (SELECT *, 'lowest' AS side FROM kept ORDER BY share_a, l_suppkey LIMIT 10) a
        UNION ALL
        SELECT * FROM (SELECT *, 'highest' AS side FROM kept ORDER BY share_a DESC, l_suppkey LIMIT 10) b
        """,
}
