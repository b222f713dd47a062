"""Feature preparation for classifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.sources.scratch import scratch_dir

def feature_columns(
    columns: Sequence[str], label: str, numeric: Sequence[str] = (), categorical: Sequence[str] = ()
) -> tuple[list[str], list[str]]:
    """(numeric, categorical): all columns but the label, divided by whichever list is given."""
    if bool(numeric) == bool(categorical):
        raise ValueError("name either the numeric or the categorical columns")
    inputs = [c for c in columns if c != label]
    if numeric:
        return [c for c in inputs if c in numeric], [c for c in inputs if c not in numeric]
    return [c for c in inputs if c not in categorical], [c for c in inputs if c in categorical]


def feature_stages(
    numeric: Sequence[str], categorical: Sequence[str], one_hot: str | None = None,
    indexed: str | None = None, handle_invalid: str = "error",
) -> Pipeline:
    """Unfitted stages: string indices, and up to two assembled vectors.

    ``one_hot`` names the vector with one slot per category (for linear models), ``indexed`` the
    one with the category index itself (for trees). ``handle_invalid`` says what NULLs and, when
    scoring, unseen categories do: 'error', 'skip' or 'keep'.
    """
    if not (one_hot or indexed):
        raise ValueError("name at least one output vector")
    index_names = [f"{c}_ix" for c in categorical]
    slot_names = [f"{c}_vec" for c in categorical]
    stages = []
    if categorical:
        stages.append(StringIndexer(
            inputCols=list(categorical), outputCols=index_names, handleInvalid=handle_invalid))
    if one_hot:
        if categorical:
            stages.append(OneHotEncoder(
                inputCols=index_names, outputCols=slot_names, dropLast=False))
        stages.append(VectorAssembler(
            inputCols=[*numeric, *slot_names], outputCol=one_hot, handleInvalid=handle_invalid))
    if indexed:
        stages.append(VectorAssembler(
            inputCols=[*numeric, *index_names], outputCol=indexed, handleInvalid=handle_invalid))
    return Pipeline(stages=stages)


def require_few_categories(df: DataFrame, columns: Sequence[str], limit: int | None) -> None:
    """Refuse columns with more distinct values than the driver should hold.

    An index model keeps every category on the driver and ships it to each task, so its size must
    not grow with the rows. Callers who want that checked name a limit; one pass over the columns
    then estimates their distinct values. Without a limit nothing is read or refused.
    """
    if not columns or limit is None:
        return
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first().asDict()
    large = {name: n for name, n in sizes.items() if n > limit}
    if large:
        raise ValueError(f"too many categories to index: {large}; the limit is {limit}")


def fit_features(
    df: DataFrame, stages: Pipeline, categorical: Sequence[str], limit: int | None = None
) -> PipelineModel:
    """Fit the stages, after checking the number of categories if there is a limit."""
    require_few_categories(df, categorical, limit)
    return stages.fit(df)


def fit_string_index(
    df: DataFrame, column: str, output: str, limit: int | None = None
) -> StringIndexerModel:
    """Index the values of a column by falling frequency, equal frequencies alphabetically."""
    require_few_categories(df, [column], limit)
    return StringIndexer(inputCol=column, outputCol=output).fit(df)


def index_map(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """(value, value_index, n) for the values of a column: by falling count, then by value.

    Any number of values: the counts are sorted by range over the cluster and written once, and a
    value's index is its place in its range after the ranges before it. NULL has no index.
    """
    require_few_categories(df, [column], limit)
    spark = df.sparkSession
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    folder = scratch_dir(spark, "index-map")
    numbered = counts.orderBy(F.col("n").desc(), "value").withColumn("at", F.monotonically_increasing_id())
    numbered.write.parquet(folder)
    numbered = spark.read.schema(numbered.schema).parquet(folder).withColumn("part", F.shiftright("at", 33))
    sizes = numbered.groupBy("part").agg(F.count("*").alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.join(before, "part").select("value", (inside + F.col("before")).cast("int").alias("value_index"), "n")


def slots(df: DataFrame, keys: Sequence[str], vector: str, zeros: bool = False) -> DataFrame:
    """(keys..., slot, value): a vector column in long form, by default without zero slots."""
    long = df.select(*keys, F.posexplode(vector_to_array(vector)).alias("slot", "value"))
    return long if zeros else long.filter(F.col("value") != 0)
