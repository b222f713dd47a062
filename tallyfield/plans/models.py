"""Features, classification metrics and classifiers.

Metric queries use predictions by rule, so that SQL can state them. Model queries learn a label
that is planted by a rule on line item columns, with every tenth row (by key hash) mislabelled.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyfield.functions import dense_form, majority, sparse_form
from tallyfield.operators import metrics, models, searches
from tallyfield.operators.features import feature_stages, fit_features, index_map, slots
from tallyfield.operators.joins import match
from tallyfield.operators.sampling import hash_bucket, keyed_split
from tallyfield.sources import load_table, spread

# ---- features ---------------------------------------------------------------------------------


def string_index_map(spark, sf):
    return index_map(load_table(spark, sf, "part"), "p_type")


def one_hot_features(spark, sf):
    part = load_table(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    names = ["p_type", "p_brand"]
    stages = fit_features(part, feature_stages([], names, one_hot="features"), names)
    return slots(stages.transform(part), ["p_partkey"], "features")


def assembled_features(spark, sf):
    part = load_table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    stages = fit_features(
        part, feature_stages(["p_size", "p_retailprice"], ["p_type"], indexed="features"), ["p_type"])
    return slots(stages.transform(part), ["p_partkey"], "features", zeros=True)


def sparse_dense_roundtrip(spark, sf):
    part = load_table(spark, sf, "part").select("p_partkey", "p_size", "p_type")
    stages = fit_features(part, feature_stages(["p_size"], ["p_type"], one_hot="features"), ["p_type"])

    def text(array):
        return F.array_join(F.transform(array, lambda x: x.cast("int").cast("string")), ",")

    dense = stages.transform(part).select("p_partkey", vector_to_array("features").alias("dense"))
    sparse = dense.select("p_partkey", "dense", sparse_form(F.col("dense")).alias("sparse"))
    size, indices, values = (F.col(f"sparse.{name}") for name in ("size", "indices", "values"))
    return sparse.select(
        "p_partkey", size.alias("size"), text(indices).alias("indices"),
        text(values).alias("values"), text(dense_form(size, indices, values)).alias("rebuilt"),
        (dense_form(size, indices, values) == F.col("dense")).alias("is_equal"),
    )


# ---- metrics over predictions by rule ---------------------------------------------------------


def rule_predictions(spark, sf):
    """(doc_id, quality, n_chars, prediction) for the labelled documents."""
    documents = load_table(spark, sf, "documents").select("doc_id", "n_chars")
    labels = load_table(spark, sf, "labels").select("doc_id", "quality")
    rule = F.when(F.col("n_chars") >= 1000, 1).otherwise(0)
    return match(labels, documents, "doc_id").withColumn("prediction", rule)


def class_accuracy(spark, sf):
    scored = metrics.accuracy(rule_predictions(spark, sf), "quality", "prediction")
    return scored.withColumn("accuracy", F.round("accuracy", 6))


def dense_confusion(spark, sf):
    return metrics.confusion_matrix(
        rule_predictions(spark, sf), "quality", "prediction", labels=[0, 1]).orderBy("actual")


def label_precision_recall(spark, sf):
    return metrics.precision_recall(rule_predictions(spark, sf), "quality", "prediction").select(
        "label", "n_actual", "n_predicted", F.round("precision", 6).alias("precision"),
        F.round("recall", 6).alias("recall")).orderBy("label")


def _with_probability(spark, sf):
    share = F.col("n_chars") / (F.col("n_chars") + 1000)
    return rule_predictions(spark, sf).withColumn("probability", F.round(share, 6))


def misclassified_rows(spark, sf):
    wrong = metrics.misclassified(_with_probability(spark, sf), "quality", "prediction")
    return wrong.select("doc_id", "quality", "prediction", "probability")


def misclassified_extremes(spark, sf):
    return metrics.misclassified_range(
        _with_probability(spark, sf), "quality", "prediction", "probability")


def majority_vote(spark, sf):
    """Three rules vote on every labelled document; the votes are columns, so no row moves."""
    rules = rule_predictions(spark, sf).select(
        "doc_id",
        F.col("prediction").alias("vote_1"),
        F.when(F.col("n_chars") % 3 == 0, 1).otherwise(0).alias("vote_2"),
        F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0).alias("vote_3"),
    )
    return rules.select("doc_id", majority(["vote_1", "vote_2", "vote_3"]).alias("vote"))


# ---- fitted models ----------------------------------------------------------------------------

LABEL = "label"
ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
NUMERIC = ["l_quantity", "l_discount", "l_tax"]
CATEGORICAL = ["l_returnflag", "l_linestatus"]


def planted_rows(spark, sf):
    """Line items with a label 0, 1 or 2 that follows quantity, flag and status."""
    items = spread(load_table(spark, sf, "lineitem").select(*ROW_KEY, *NUMERIC, *CATEGORICAL))
    level = (
        F.col("l_quantity") / 50
        + F.when(F.col("l_returnflag") == "R", 0.5).otherwise(0.0)
        - F.when(F.col("l_linestatus") == "O", 0.3).otherwise(0.0)
    )
    true_label = F.when(level < 0.35, 0).when(level < 0.8, 1).otherwise(2)
    mislabelled = hash_bucket(ROW_KEY, 10, seed=7) == 0
    return items.withColumn(
        LABEL, F.when(mislabelled, (true_label + 1) % 3).otherwise(true_label).cast("double"))


def prepared(spark, sf):
    """(training rows, held-out rows) with both feature vectors; the stages know the training rows only."""
    stages = feature_stages(NUMERIC, CATEGORICAL, one_hot="features_lr", indexed="features_dt", handle_invalid="keep")
    train, new = keyed_split(planted_rows(spark, sf), ROW_KEY, 0.8, seed=3)
    fitted = fit_features(train, stages, CATEGORICAL)
    return tuple(fitted.transform(rows).select(*ROW_KEY, LABEL, "features_lr", "features_dt") for rows in (train, new))


def lr_search(rows):
    return searches.logistic_path(rows, LABEL, "features_lr", ROW_KEY, models.MULTI_REG, models.ELASTIC_NET)


def dt_search(rows):
    return searches.tree_grid(
        rows, LABEL, "features_dt", ROW_KEY, models.MULTI_DEPTH, models.MULTI_MIN_INSTANCES, maxBins=models.MULTI_MAX_BINS)


def lr_cv_summary(spark, sf):
    train, _ = prepared(spark, sf)
    return searches.search_summary(spark, lr_search(train))


def dt_cv_summary(spark, sf):
    train, _ = prepared(spark, sf)
    return searches.search_summary(spark, dt_search(train))


def cv_best(spark, sf):
    train, _ = prepared(spark, sf)
    return searches.best_setting(spark, dt_search(train))


def fitted_tree(train):
    (tree, _) = models.tree_search(LABEL, "features_dt", maxBins=64)
    return models.fit(train, tree.setMaxDepth(6))


def score_new_rows(spark, sf):
    """Probabilities of the held-out rows."""
    train, held_out = prepared(spark, sf)
    (lr, _) = models.logistic_search(LABEL, "features_lr")
    return models.score(models.fit(train, lr.setRegParam(0.001)), held_out, ROW_KEY, digits=6)


def feature_importance(spark, sf):
    train, _ = prepared(spark, sf)
    return models.importances(spark, fitted_tree(train), [*NUMERIC, *CATEGORICAL])


def tree_leaf_scores(spark, sf):
    train, held_out = prepared(spark, sf)
    return models.leaf_counts(fitted_tree(train), held_out)


def model_selection(spark, sf):
    """Search both model families, then judge the better one on the held-out rows."""
    train, held_out = prepared(spark, sf)
    found = {"logistic": lr_search(train), "tree": dt_search(train)}
    winner = searches.choose_search(found)
    scored = models.score(found[winner].best_model(), held_out, [LABEL])
    return metrics.accuracy(scored, LABEL, "prediction").select(
        F.lit(winner).alias("model"), F.lit(max(found[winner].accuracies)).alias("cv_accuracy"),
        "n", "accuracy")


QUERIES = {
    "string_index_map": string_index_map,
    "one_hot_features": one_hot_features,
    "assembled_features": assembled_features,
    "sparse_dense_roundtrip": sparse_dense_roundtrip,
    "classification_accuracy": class_accuracy,
    "confusion_matrix": dense_confusion,
    "precision_recall_by_label": label_precision_recall,
    "misclassified_rows": misclassified_rows,
    "misclassified_extremes": misclassified_extremes,
    "majority_vote": majority_vote,
    "lr_cv_summary": lr_cv_summary,
    "dt_cv_summary": dt_cv_summary,
    "cv_best": cv_best,
    "score_new_rows": score_new_rows,
    "feature_importance": feature_importance,
    "tree_leaf_scores": tree_leaf_scores,
    "model_selection": model_selection,
}


def _index_sql(column: str) -> str:
    return f"""(SELECT {column}, n, row_number() OVER (ORDER BY n DESC, {column}) - 1 AS ix
                FROM (SELECT {column}, count(*) AS n FROM part GROUP BY 1))"""


_SCORED = """
WITH scored AS (
  SELECT doc_id, quality, n_chars, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS prediction,
         round(n_chars / (n_chars + 1000.0), 6)::DOUBLE AS probability
  FROM labels JOIN documents USING (doc_id))
"""

ORACLE = {
    "string_index_map": f"""
        SELECT p_type AS value, CAST(ix AS INT) AS value_index, n FROM {_index_sql('p_type')}""",
    "one_hot_features": f"""
        WITH t AS {_index_sql('p_type')}, b AS {_index_sql('p_brand')}
        SELECT p_partkey, CAST(ix AS INT) AS slot, 1.0::DOUBLE AS value FROM part JOIN t USING (p_type)
        UNION ALL
        SELECT p_partkey, CAST((SELECT count(*) FROM t) + ix AS INT), 1.0::DOUBLE
        FROM part JOIN b USING (p_brand)""",
    "assembled_features": f"""
        WITH t AS {_index_sql('p_type')}
        SELECT p_partkey, 0 AS slot, p_size::DOUBLE AS value FROM part
        UNION ALL SELECT p_partkey, 1, p_retailprice FROM part
        UNION ALL SELECT p_partkey, 2, ix::DOUBLE FROM part JOIN t USING (p_type)""",
    "sparse_dense_roundtrip": f"""
        WITH t AS {_index_sql('p_type')},
        wide AS (SELECT p_partkey, p_size, ix, (SELECT count(*) FROM t) AS k
                 FROM part JOIN t USING (p_type))
        SELECT p_partkey, CAST(k + 1 AS INT) AS size, '0,' || (ix + 1) AS indices,
               p_size || ',1' AS values,
               p_size || ',' || (SELECT string_agg(CASE WHEN j = ix THEN '1' ELSE '0' END, ',' ORDER BY j)
                                 FROM generate_series(0, k - 1) AS g(j)) AS rebuilt,
               true AS is_equal
        FROM wide""",
    "classification_accuracy": f"""{_SCORED}
        SELECT count(*) AS n, CAST(sum(CASE WHEN quality = prediction THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
               round(avg(CASE WHEN quality = prediction THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS accuracy
        FROM scored""",
    "confusion_matrix": f"""{_SCORED}
        SELECT CAST(actual AS INT) AS actual,
               CAST(coalesce(sum(CASE WHEN prediction = 0 THEN 1 END), 0) AS BIGINT) AS predicted_0,
               CAST(coalesce(sum(CASE WHEN prediction = 1 THEN 1 END), 0) AS BIGINT) AS predicted_1
        FROM (VALUES (0), (1)) AS l(actual) LEFT JOIN scored ON quality = actual
        GROUP BY 1""",
    "precision_recall_by_label": f"""{_SCORED},
        l AS (SELECT quality AS label FROM scored UNION SELECT prediction FROM scored),
        c AS (SELECT label,
                     (SELECT count(*) FROM scored WHERE quality = label) AS n_actual,
                     (SELECT count(*) FROM scored WHERE prediction = label) AS n_predicted,
                     (SELECT count(*) FROM scored WHERE quality = label AND prediction = label) AS n_hit
              FROM l)
        SELECT label::DOUBLE AS label, n_actual, n_predicted,
               round(CASE WHEN n_predicted = 0 THEN 0.0::DOUBLE ELSE n_hit::DOUBLE / n_predicted END, 6) AS precision,
               round(CASE WHEN n_actual = 0 THEN NULL ELSE n_hit::DOUBLE / n_actual END, 6) AS recall
        FROM c""",
    "misclassified_rows": f"""{_SCORED}
        SELECT doc_id, quality, prediction, probability FROM scored WHERE quality <> prediction""",
    "misclassified_extremes": f"""{_SCORED}
        SELECT count(*) AS n, max(probability) AS highest, min(probability) AS lowest
        FROM scored WHERE quality <> prediction""",
    "majority_vote": f"""{_SCORED}
        SELECT doc_id, CASE WHEN prediction + (CASE WHEN n_chars % 3 = 0 THEN 1 ELSE 0 END)
                                 + (CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END) >= 2
                            THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS vote
        FROM scored""",
}
