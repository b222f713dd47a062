"""Language identification: edge rows, a plain recount of the model, held-out accuracy."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from tallyfield.llm import language_id as li
from tallyfield.llm import queries
from tallyfield.sources.tables import load_table

SMALL = li.Settings(orders=(1, 2), buckets=1 << 12)
SCHEMA = "doc_id long, text string, lang string, lang_pred string, part int"
ROWS = [
    (1, "aa ab", "x", "?", 0), (2, "bb bb!", "y", "?", 1), (3, None, "x", "?", 2), (4, " 12 -", None, None, 3),
    (5, "ba" * 40_000, None, None, 4), (2, "bb bb!", "y", "?", 1), (6, "", None, None, 5),
]


def test_grams_do_not_cross_texts_and_collapse_other_characters():
    together, ends = li.grams(["a1!b", None, "c"], SMALL)
    for i, text in enumerate(["a1!b", None, "c"]):
        alone, _ = li.grams([text], SMALL)
        assert sorted(together[ends[i]:ends[i + 1]]) == sorted(alone)
    assert sorted(li.grams(["A  b"], SMALL)[0]) == sorted(li.grams(["a-b"], SMALL)[0])
    assert len(li.grams(["a b"], SMALL)[0]) == 3 + 2


def test_model_equals_a_plain_count(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    model = li.fit(docs, F.lit(True), SMALL)
    assert model.languages == ("x", "y")
    for k, lang in enumerate(model.languages):
        seen = Counter(b for r in ROWS if r[2] == lang for b in li.grams([r[1]], SMALL)[0].tolist())
        whole = sum(seen.values()) + SMALL.buckets * SMALL.smoothing
        for bucket, n in seen.items():
            assert math.isclose(model.weights[bucket, k], math.log((n + SMALL.smoothing) / whole), rel_tol=1e-5)
    assert np.allclose(np.exp(model.prior), [2 / 4, 2 / 4])


def test_edge_rows_and_clashing_names(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    found = li.predict(docs, li.fit(docs, F.lit(True), SMALL))
    assert sorted(found.columns) == sorted([*docs.columns, "score"])
    rows = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(ROWS)
    assert rows[3].lang_pred == rows[4].lang_pred == rows[6].lang_pred == "und" and rows[4].score == 0
    assert rows[1].lang_pred == "x" and rows[2].lang_pred == "y" and 0 < rows[5].score <= 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    model = li.fit(none, F.lit(True), SMALL)
    assert li.predict(none, model).count() == 0
    assert {r.lang_pred for r in li.predict(spark.createDataFrame(ROWS, SCHEMA), model).collect()} == {"und"}


def test_query_on_held_out_documents(spark, sf):
    found = queries.op1_language_id(spark, sf)
    docs = load_table(spark, sf, "documents").select("doc_id", "lang")
    held = found.filter("held_out").join(docs, "doc_id").select("lang", "lang_pred").collect()
    assert found.count() == docs.count()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
