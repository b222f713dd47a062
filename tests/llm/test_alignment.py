"""Alignment against plain loops over byte offsets, counts against a counter."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tallyfield.llm import alignment as al
from tallyfield.llm import queries
from tallyfield.sources.tables import load_table
from tokenizers import Tokenizer

PATHS = (queries.BYTE_TOKENIZER, queries.PIECE_TOKENIZER)
A, B = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
A.encode_special_tokens = True
LETTERS = al.byte_letters()
MADE = al.Encoders(*PATHS)


def plain_tokens(text):
    """([(id, start, end)], the same of B), None where tokens are not the text."""
    whole = (" " + text).encode()
    sides = []
    for ids, data in ((A.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(LETTERS[c] for c in A.id_to_token(i))),
                      (B.encode(text), lambda i: bytes([B.id_to_piece(i) and int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i)
                       else B.id_to_piece(i).replace("▁", " ").encode())):
        at, side = 0, []
        for i in ids:
            side.append((i, at, at + len(data(i))))
            at = side[-1][2]
        if b"".join(map(data, ids)) != whole:
            return None
        sides.append(side)
    return sides


def plain(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of every text."""
    tokens = [plain_tokens(t) if t else None for t in texts]
    links = [[(a, b) for a, s, e in pair[0] for b, p, q in pair[1] if s < q and p < e] if pair else [] for pair in tokens]
    count = Counter(x for each in links for x in each)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    out = []
    for pair, each in zip(tokens, links, strict=True):
        if not pair:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        ends = sorted({e for _, _, e in pair[0]} & {e for _, _, e in pair[1]})
        groups = ["|".join(",".join(str(i) for i, s, e in side if low <= s and e <= high) for side in pair)
                  for low, high in zip([0, *ends], ends)]
        out.append((len(pair[0]), len(pair[1]), len(ends), len(each), sum(count[x] == best[x[1]] for x in each),
                    sum(count[x] for x in each), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def shown(df):
    return sorted(((r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256))
                   for r in df.collect()), key=repr)


@settings(deadline=None, max_examples=50)
@given(st.sets(st.integers(0, 2**40), max_size=400), st.sets(st.integers(0, 2**40), max_size=50))
def test_perfect_hash(keys, others):
    table = np.array(sorted(keys), np.int64)
    made = al.PerfectHash.build(table)
    assert sorted(made.numbers(table).tolist()) == list(range(len(keys)))
    placed = np.empty(len(table), np.int64)
    placed[made.numbers(table)] = table
    pairs = al.Pairs(1, [(0, made.sizes, made.words, placed)])
    assert (pairs.table[pairs.numbers(table)] == table).all()
    strange = np.array(sorted(others - keys), np.int64)
    if len(strange):
        with pytest.raises(ValueError):
            pairs.numbers(strange)


TEXTS = st.lists(st.sampled_from(list("aebt' .,\n\t ▁é漢🙂́\x00\x1c​") + [
    "  ", " the ", "don't", "<|endoftext|>", "<s>", "</s>", "<0x41>", "http://x.y", "1234", "ñ", "\u00a0", "\u200b", "\u2003", "\x85", "\x0b", "\x1f"]), max_size=30).map("".join)


@settings(deadline=None, max_examples=200)
@given(st.lists(TEXTS, max_size=6))
def test_units_give_the_tokens_of_whole_texts(texts):
    aligned = al.Aligned(MADE, pa.array(texts, pa.string()))
    written = aligned.written()
    for text, units, true in zip(texts, aligned.rows, plain(texts), strict=True):
        counts = tuple(int(x[units].sum()) for x in (aligned.n_a, aligned.n_b, aligned.n_groups, aligned.n_links))
        digest = hashlib.sha256(b"".join(written[i] for i in units)[:-1]).hexdigest() if len(units) else ""
        assert (*counts, digest) == (*true[:4], true[6])


@pytest.mark.parametrize("limits", [(10**6, 10**6), (40, 25)])
def test_counts(spark, monkeypatch, limits):
    monkeypatch.setattr(al, "PIECE", 16)
    monkeypatch.setattr(al, "FAN", 2)
    texts = ["The cat sat.", "The cat  sat on the mat, don't you see?", None, "", "▁", "a ▁ b", "naïve café 漢字 🙂", "x" * 3000,
             "  two  leading", "trailing ", " ", "\n", "<|endoftext|> </s>", "the cat sat. " * 200, "The cat sat."]
    rows = [(i if i != 3 else None, t, "q", i) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, N_A string, row int").repartition(5)
    df = al.align(table, *PATHS, most_pairs=limits[0], part_pairs=limits[1])
    assert shown(df) == sorted(zip([r[0] for r in rows], plain(texts), strict=True), key=repr)


def test_empty_tables(spark):
    table = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    zeros = (0, 0, 0, 0, 0, 0, "")
    assert shown(al.align(table, *PATHS)) == [(1, zeros), (2, zeros)]
    assert al.align(table.limit(0), *PATHS).collect() == []


def test_query(spark, small_sf):
    docs = load_table(spark, small_sf, "documents").collect()
    df = queries.op11_alignment(spark, small_sf)
    assert shown(df) == sorted(zip([d.doc_id for d in docs], plain_fast([d.text for d in docs]), strict=True), key=repr)


def plain_fast(texts):
    """As ``plain``, with links found by walking both token lists once."""
    tokens = [plain_tokens(t) if t else None for t in texts]
    links, groups = [], []
    for pair in tokens:
        each, parts, i, j, low_a, low_b = [], [], 0, 0, 0, 0
        a, b = pair or ([], [])
        while i < len(a):
            each.append((a[i][0], b[j][0]))
            end_a, end_b = a[i][2], b[j][2]
            i, j = i + (end_a <= end_b), j + (end_b <= end_a)
            if end_a == end_b:
                parts.append("|".join(",".join(str(t[0]) for t in x) for x in (a[low_a:i], b[low_b:j])))
                low_a, low_b = i, j
        links.append(each)
        groups.append(parts)
    count = Counter(x for each in links for x in each)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    return [(len(p[0]), len(p[1]), len(g), len(e), sum(count[x] == best[x[1]] for x in e), sum(count[x] for x in e),
             hashlib.sha256(";".join(g).encode()).hexdigest()) if p else (0, 0, 0, 0, 0, 0, "")
            for p, e, g in zip(tokens, links, groups, strict=True)]
