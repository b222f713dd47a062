"""The pipeline: every stage against what its operator decides, and all of them against a plain version."""

from collections import Counter

import corpus_pipeline as cp
import numpy as np
import pytest
from brute import smallest_ids
from pyspark.sql import functions as F
from tallyfield.llm import mixing, simhash, toxicity
from tallyfield.sources.tables import load_table
from test_decontaminate import plain as plain_windows
from test_simhash import plain_fingerprint
from test_token_files import expected as plain_tokens


@pytest.fixture(scope="module")
def docs(spark, small_sf):
    return load_table(spark, small_sf, "documents")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stage_names():
    assert [name for name, _ in cp.STAGES] == ["toxicity", "simhash", "decontaminate", "mixing", "token_files"]


def test_toxic_documents_go(spark, small_sf, docs):
    found = cp.without_toxic(spark, docs, small_sf)
    assert found.columns == docs.columns
    model = toxicity.fit(docs, load_table(spark, small_sf, "labels"), F.lit(True))
    judged = toxicity.predict(docs, model)
    assert rows(found) == rows(judged.filter("predicted = 0").select(docs.columns))
    assert 0 < docs.count() - found.count() < 0.2 * docs.count()


def test_one_of_each_group_stays(spark, small_sf, docs):
    found = cp.without_copies(spark, docs, small_sf)
    all_ = docs.collect()
    prints = [plain_fingerprint(r.text) for r in all_]
    linked = [(i, j) for i in range(len(all_)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    ids = smallest_ids([r.doc_id for r in all_], linked)
    assert found.columns == docs.columns
    assert rows(found) == sorted((tuple(r) for r, i in zip(all_, ids, strict=True) if r.doc_id == i), key=repr)


def test_benchmark_passages_go(spark, small_sf, docs):
    items = [tuple(r) for r in load_table(spark, small_sf, "benchmark").select("item_id", "text").collect()]
    bad = {r[0] for r in plain_windows([(r.doc_id, r.text) for r in docs.collect()], items) if r[-1]}
    found = cp.without_benchmark(spark, docs, small_sf)
    assert found.columns == docs.columns and bad
    assert rows(found) == rows(docs.filter(~F.col("doc_id").isin(bad)))


def test_run_equals_the_stages_over_plain_lists(spark, small_sf, docs):
    model = toxicity.fit(docs, load_table(spark, small_sf, "labels"), F.lit(True))
    kept = toxicity.predict(docs, model).filter("predicted = 0").select(docs.columns).collect()
    prints = [plain_fingerprint(r.text) for r in kept]
    linked = [(i, j) for i in range(len(kept)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    kept = [r for r, i in zip(kept, smallest_ids([r.doc_id for r in kept], linked), strict=True) if r.doc_id == i]
    items = [tuple(r) for r in load_table(spark, small_sf, "benchmark").select("item_id", "text").collect()]
    bad = {r[0] for r in plain_windows([(r.doc_id, r.text) for r in kept], items) if r[-1]}
    kept = [r for r in kept if r.doc_id not in bad]
    mix = mixing.mixed(spark.createDataFrame(kept, docs.schema)).select("doc_id", "text").collect()
    found = cp.run(spark, small_sf).orderBy("start").collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == sorted(plain_tokens([tuple(r) for r in mix]))
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, fp string, n_hit string"


def test_stages_take_edge_rows_and_clashing_columns(spark, small_sf):
    data = [(1, None, "en", None, 0, "s", "f", "h"), (2, "", None, "a", None, "", "", ""), (2, "", None, "a", None, "", "", ""),
            (None, "no id here at all", "en", "a", 1, "", "", ""), (3, "many words " * 20_000, "en", "b", 1, "", "", "")]
    table = spark.createDataFrame(data, SCHEMA)
    for frame, full in ((table, True), (table.limit(0), False)):
        for _, stage in cp.STAGES[:-1]:
            frame = stage(spark, frame, small_sf)
            assert frame.columns == table.columns
        last = cp.tokens(spark, frame, small_sf).collect()
        assert bool(last) == full and Counter(r.doc_id for r in last).keys() <= {1, 2, 3, None}


def test_dedup_keeps_a_row_without_id_only_if_no_other_has_one(spark):
    table = spark.createDataFrame([(None, "same text", 1), (7, "same text", 2), (None, "lonely", 3)], "doc_id long, text string, row int")
    assert rows(simhash.deduplicated(table)) == [(7, "same text", 2), (None, "lonely", 3)]
