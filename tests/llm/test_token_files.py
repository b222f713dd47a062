"""Token files: exact round trip against the tokenizer on whole texts."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyfield.llm import queries, token_files
from tallyfield.sources.tables import load_table
from tokenizers import Tokenizer

PATH = queries.WORD_TOKENIZER
LIBRARY = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, shard int, first string"
ROWS = [
    (3, "It's a Test.\n\nDON'T  stop", 1, "x"), (1, None, 2, None), (None, "no id", 3, "y"), (2, "", 4, ""),
    (7, "same", 5, ""), (7, "same", 5, ""), (7, "Σίσυφος <|endoftext|> é İx 中文  ​q² ½", 6, ""),
    (9, "long " * 50_000, 7, ""), (8, "   ", 8, ""),
]


def expected(rows):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 600), max_size=1500), st.data())
def test_codes_give_any_token_and_any_run(ids, data):
    codes = token_files.Codes(*zip(*token_files.encode_levels(np.array(ids, np.uint32)), strict=True))
    assert len(codes) == len(ids)
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert codes.run(a, b).tolist() == ids[a:b]
    if a < len(ids):
        assert codes[a] == ids[a]


@settings(deadline=None, max_examples=60)
@given(st.text(max_size=60) | st.text("aA'sS.,<|>é́ \n\t\x1c9_ßÿ×", max_size=60))
def test_words_encode_as_whole_texts(text):
    ids = np.frombuffer(token_files.encoder(PATH)([text])[0], "<u4").tolist()
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids


SPECIALS = st.lists(st.sampled_from([
    "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|StartOfText|>", "<|endoftext", "|>", "It's", "DON'T", "ÉÀß", "Ünder.,", "x,.",
    " ", "\n", "\r", "\x0b", "\x85", "\u2003", "İ", "Σ", "é", "12a", "…", ",", "."]), max_size=14).map("".join)


@settings(deadline=None, max_examples=300)
@given(st.lists(SPECIALS, max_size=4))
def test_special_tokens_count_in_their_own_case(texts):
    found = token_files.encoder(PATH)(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == \
        [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_forgetting_changes_nothing():
    texts = ["one two, three.", "Two ONE four's", "one <|endoftext|> 5"] * 3
    few = token_files.Encoder(PATH, parts_kept=1)
    for text in texts:
        assert few([text]) == token_files.encoder(PATH)([text])


def test_edge_rows(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(docs, folder, PATH)
    found = token_files.read_tokens(spark, folder).orderBy("start").collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in found], key=key) == \
        sorted(expected([r[:2] for r in ROWS]), key=key)
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()
    assert [r.doc_id for r in found] == [None, 1, 2, 3, 7, 7, 7, 8, 9]
    files = spark.read.parquet(folder)
    at = {r.doc_id: r.start for r in found}
    assert token_files.token_at(files, at[1]) == 1
    assert token_files.token_at(files, 10**12) is None


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(spark.createDataFrame([], SCHEMA), folder, PATH)
    assert token_files.read_tokens(spark, folder).count() == 0


def test_query_equals_the_library(spark, small_sf):
    rows = [tuple(r) for r in load_table(spark, small_sf, "documents").select("doc_id", "text").collect()]
    found = queries.op9_token_files(spark, small_sf).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in found] == expected(rows)
    assert [r.start for r in found] == np.cumsum([0] + [r.n_tokens for r in found])[:-1].tolist()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_tokenizers_encode_whole_texts(name):
    import public_tokenizers
    path = public_tokenizers.path(name)
    text = "Two words,  and more"
    assert np.frombuffer(token_files.Encoder(path)([text])[0], "<u4").tolist() == \
        Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
