"""Toxicity: the composed machine, learned stems, edge rows, held-out accuracy."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tallyfield.llm import queries
from tallyfield.llm import toxicity as tox
from tallyfield.sources.tables import load_table

SEEDS = tox.Grammar(tox.SEED_STEMS)


def tags(text):
    found = SEEDS.evidence(text)
    return {tag: found[i] for tag, i in tox.COLUMN.items() if found[i]}


def test_clauses_are_told_apart():
    assert tags("You are an idiot.") == {("I", 0, 0, 1): 3.0}
    assert tags("The idiot") == {("I", 0, 0, 0): 3.0}
    assert tags("You are not an idiot") == {("I", 1, 0, 1): 3.0}
    assert tags("She said he was an idiot") == {("I", 0, 1, 1): 3.0}
    assert tags("I will kill you") == {("T", 0, 0, 1): 1.0}
    assert tags("not here. An idiot, you moron") == {("I", 0, 0, 1): 6.0}
    assert tags("not one of these men was an idiot")[("I", 0, 0, 0)] == 3.0
    assert tags("unstupid anti idiocy") == {}


@settings(deadline=None, max_examples=60)
@given(st.lists(st.sampled_from(tox.SYMBOLS), max_size=12))
def test_composition_equals_one_after_the_other(symbols):
    _, a = tox.negation().read(symbols)
    _, b = tox.reported().read(a)
    end, c = tox.targeted().read(b)
    (_, last), out = tox.CLAUSE.read(symbols)
    assert out == c and last == end


@settings(deadline=None, max_examples=60)
@given(st.sets(st.text("ab.é", min_size=1, max_size=4), min_size=1), st.text("ab.é", max_size=8))
def test_prefix_pattern_takes_the_longest_stem(stems, word):
    hit = re.match(tox.prefix_pattern(sorted(stems)), word)
    longest = max((s for s in stems if word.startswith(s)), key=len, default=None)
    assert (hit.group() if hit else None) == longest


def test_stems_are_whole_and_not_nested():
    counts = [("lowe", 30, 0), ("lowei", 30, 0), ("loweit", 12, 0), ("the", 40, 300), ("rare", 2, 0)]
    learned = tox.pick_stems(counts, 40, 300, tox.Settings())
    assert set(learned) - set(tox.INSULTS) == {"lowei"}


def test_a_rare_vocabulary_is_learned_by_its_evidence():
    toxic, clean = 4000, 8000
    insults = [(stem, 8, 0) for stem in ("tontaco", "brutal", "canalla", "gandul")]
    chance = [("window", 3, 0), ("garden", 3, 0), ("letter", 20, 30)]
    learned = tox.pick_stems([*insults, *chance, ("zorbing", 3000, 5)], toxic, clean, tox.Settings())
    assert set(learned) - set(tox.INSULTS) == {"tontaco", "brutal", "canalla", "gandul", "zorbing"}


SCHEMA = "doc_id long, text string, score string, predicted string, toxic string"


def corpus(spark):
    rows = [(i, ("zorb you zorbing " if i % 3 == 0 else "calm words ") + "filler " * (i % 7), "s", "p", "t")
            for i in range(300)]
    rows += [(1000, None, None, None, None), (1001, "", None, None, None), (1002, "you zorbing " * 20_000, "", "", ""),
             (5, "calm words again", "", "", ""), (None, "no id", "", "", "")]
    labels = [(i, int(i % 3 == 0)) for i in range(300)] + [(1000, None), (1001, 7), (None, 1), (3, 0), (4242, 1)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learned_insults_and_edge_rows(spark):
    docs, labels = corpus(spark)
    model = tox.fit(docs, labels, F.lit(True))
    assert any(stem.startswith("zorb") for stem in model.stems)
    found = tox.predict(docs, model)
    rows = {r.doc_id: r for r in found.collect()}
    assert found.count() == docs.count() and sorted(found.columns) == sorted(docs.columns)
    assert all(rows[i].predicted == int(i % 3 == 0) for i in range(300) if i != 5)
    assert rows[1002].predicted == 1 and rows[1000].predicted == rows[1001].predicted == 0
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())


def test_without_labels_the_seed_lexicon_applies(spark):
    docs, labels = corpus(spark)
    model = tox.fit(docs, labels.limit(0), F.lit(True))
    assert model.stems == tox.SEED_STEMS
    probe = spark.createDataFrame([(1, "you idiot, you moron"), (2, "fine")], "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in tox.predict(probe, model).collect()} == {1: 1, 2: 0}
    assert tox.predict(probe.limit(0), tox.fit(probe.limit(0), labels, F.lit(True))).count() == 0


def test_query_on_held_out_documents(spark, sf):
    found = queries.op5_toxicity(spark, sf)
    labels = load_table(spark, sf, "labels").select("doc_id", "toxic")
    held = found.filter("held_out").join(labels, "doc_id").collect()
    assert sum(r.toxic == r.predicted for r in held) >= 0.95 * len(held)
    assert found.count() == load_table(spark, sf, "documents").count()
