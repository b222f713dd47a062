"""Sources, table counts, previews, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfield.functions import round_stable
from tallyfield.operators.aggregates import count_by, grouped_means
from tallyfield.operators.joins import match
from tallyfield.operators.sampling import keyed_sample, keyed_split
from tallyfield.sources import (
    head_rows, load_table, local_rows, partition_sizes, read_delimited, read_delimited_inferred,
    row_counts, scratch_dir, with_uniform, write_delimited,
)

COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
           "embeddings", "pages", "benchmark", "labels", "conversations")
ITEM_KEY = ("l_orderkey", "l_linenumber")
# The value of ``keyed_uniform`` with seed 1 over that key.
UNIFORM_SQL = ("CAST('0x' || substr(md5(concat_ws('|', '1', l_orderkey, l_linenumber)), 1, 8) AS BIGINT)::DOUBLE"
               " / 4294967296::DOUBLE")


def _part_file(spark, sf):
    return write_delimited(load_table(spark, sf, "part"), scratch_dir(spark, "part"), sep="\t")


def _price_by_type(parts):
    return grouped_means(parts, ["p_type"], {"avg_price": "p_retailprice"})


def csv_scan_fixed_schema(spark, sf):
    return _price_by_type(read_delimited(spark, _part_file(spark, sf), "part"))


def csv_scan_inferred(spark, sf):
    parts = read_delimited_inferred(spark, _part_file(spark, sf), sep="\t")
    # Inference picks the narrowest type that fits, so a key column is widened explicitly.
    return parts.groupBy("p_type").agg(
        F.count("*").alias("n"),
        F.max(F.col("p_partkey").cast("bigint")).alias("max_key"),
        round_stable(F.avg("p_retailprice"), 2).alias("avg_price"),
    )


def local_rows_scan(spark, sf):
    """A literal table of priority names, used as a dimension of the orders table."""
    names = local_rows(
        spark,
        [["1-URGENT", "now"], ["2-HIGH", "soon"], ["3-MEDIUM", "later"], ["5-LOW", "whenever"]],
        "o_orderpriority STRING, wording STRING",
    )
    counts = count_by(load_table(spark, sf, "orders"), "o_orderpriority")
    return match(names, counts, "o_orderpriority")


def table_row_counts(spark, sf):
    return row_counts({name: load_table(spark, sf, name) for name in COUNTED})


def partition_layout(spark, sf):
    return partition_sizes(load_table(spark, sf, "lineitem"))


def orders_head(spark, sf):
    return head_rows(load_table(spark, sf, "orders"), ["o_orderkey"], 10)


def uniform_sample_stats(spark, sf):
    """Statistics of one generated value per line item; the values follow from its key."""
    items = load_table(spark, sf, "lineitem").select(*ITEM_KEY)
    return with_uniform(items, seed=1, keys=ITEM_KEY).agg(
        F.count("x").alias("n"),
        F.round(F.avg("x"), 6).alias("mean"),
        F.round(F.stddev_pop("x"), 6).alias("stdev"),
        F.min("x").alias("minimum"),
        F.max("x").alias("maximum"),
    )


def sample_rows(spark, sf):
    """About a quarter of the line items, picked by their key."""
    items = load_table(spark, sf, "lineitem").select(*ITEM_KEY, "l_quantity", "l_extendedprice")
    return keyed_sample(items, ITEM_KEY, 0.25, seed=1).select("l_quantity", "l_extendedprice")


def hash_split_counts(spark, sf):
    """Training and test rows of the keyed split, by a hash that other engines have too."""
    first, rest = keyed_split(load_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 0.8, portable=True)
    return row_counts({"train": first, "test": rest}).withColumnRenamed("table_name", "side")


QUERIES = {
    "csv_scan_fixed_schema": csv_scan_fixed_schema,
    "csv_scan_inferred": csv_scan_inferred,
    "local_rows_scan": local_rows_scan,
    "table_row_counts": table_row_counts,
    "partition_sizes": partition_layout,
    "head_rows": orders_head,
    "uniform_sample_stats": uniform_sample_stats,
    "sample_rows": sample_rows,
    "hash_split_counts": hash_split_counts,
}

ORACLE = {
    "csv_scan_fixed_schema": """
        SELECT p_type, count(*) AS n, round(avg(p_retailprice) + 1e-9, 2) AS avg_price
        FROM part GROUP BY 1""",
    "csv_scan_inferred": """
        SELECT p_type, count(*) AS n, max(p_partkey) AS max_key,
               round(avg(p_retailprice) + 1e-9, 2) AS avg_price
        FROM part GROUP BY 1""",
    "local_rows_scan": """
        SELECT o_orderpriority, wording, count(*) AS n
        FROM orders JOIN (VALUES ('1-URGENT', 'now'), ('2-HIGH', 'soon'), ('3-MEDIUM', 'later'),
                                 ('5-LOW', 'whenever')) AS names(o_orderpriority, wording)
             USING (o_orderpriority)
        GROUP BY 1, 2""",
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}" for name in COUNTED),
    "head_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10",
    "uniform_sample_stats": f"""
        SELECT count(*) AS n, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS stdev,
               min(x) AS minimum, max(x) AS maximum
        FROM (SELECT {UNIFORM_SQL} AS x FROM lineitem)""",
    "sample_rows": f"SELECT l_quantity, l_extendedprice FROM lineitem WHERE {UNIFORM_SQL} < 0.25",
    "hash_split_counts": """
        WITH b AS (SELECT CAST('0x' || substr(md5(concat_ws('|', '0', l_orderkey, l_linenumber)), 1, 8) AS BIGINT)
                          % 10000 AS bucket FROM lineitem)
        SELECT 'train' AS side, count(*) FILTER (bucket < 8000) AS n FROM b
        UNION ALL SELECT 'test', count(*) FILTER (bucket >= 8000) FROM b""",
}
