"""Alignment of two tokenizers' tokens, and how often each pair of ids meets in the corpus.

Texts are cut where a single space stands between two other characters. Neither tokenizer lets a
token cross such a cut (the loader checks what this rests on), so the units between are encoded once
per slice of texts. Byte offsets where a token of both ends cut a text into groups; between two
neighbouring offsets where any token ends lies exactly one link, a pair of tokens that overlap.

The first pass over the documents writes the linked pairs of ids with the counts of its task. The
distinct pairs are dealt to parts by a hash, and every part gets a minimal perfect hash function of
its pairs: in each level a pair that hashes to a bit of its own sets it, those that collide go on to
the next level, and a pair's number is the rank of its bit. Tasks add the written counts up in dense
vectors indexed by these numbers, and the vectors are summed as a tree, ``FAN`` at a time. The second
pass aligns the documents again and looks the counts up. Pairs stand in a table by number, and
whatever is looked up is compared with it, so an unknown pair is an error, not a wrong count.

There are at most |A| x |B| pairs whatever the corpus. Functions, pairs and counts of at most
``MOST_PAIRS`` of them are broadcast at once; a corpus with more takes several rounds of the second
pass, each with its share of the parts, and the rounds' results are added up by row.

Cases. NULL and empty texts, and those whose joined tokens differ from space+text on either side,
have no tokens: zeros and an empty digest. Texts of any length are taken whole. Special tokens'
strings are ordinary text. Rows that repeat count each time; NULL ids are kept. Ties for the highest
count of a B id are all best. An empty table gives no rows. Only the two named columns are read, so
others may have any name.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallyfield.llm.tables import gathered, held, stored, strings

# Pairs whose functions and counts are broadcast at once: some 14 bytes each.
MOST_PAIRS = 8_000_000
# Pairs that share a function.
PART_PAIRS = 1_000_000
# Count vectors that one task of the tree adds up, and the counts of one piece of a vector.
FAN = 32
PIECE = 65_536
# Distinct pairs that a task gathers before it hands them on.
GATHERED = 2_000_000
# Bytes of texts that are aligned at once, or one longer batch.
SLICE_BYTES = 6_000_000
# Ids that are written as text at once.
AT_ONCE = 100_000
# Longer units go to the library whose time does not grow with their square.
LONG_UNIT = 1000
CUT = re.compile(r"(?<=\S) (?=\S)")
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
ODD_SPACE = rf"\A | \z| {SPACE}|{SPACE} "
OUTER_SPACE = rf"\A{SPACE}|{SPACE}\z"
# Fixed value: the split of byte-level vocabularies.
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Bits per pair of a level.
GAMMA = 2


# ---- minimal perfect hashing ------------------------------------------------------------------


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Well-spread unsigned 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    """Distinct keys to the numbers 0 to n - 1: a bit per key over all levels, and ranks of the bits."""

    sizes: list[int]  # bits of every level
    words: np.ndarray  # 64 bits each, the levels after one another, each filling whole words
    ranks: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.ranks = np.cumsum(counts) - counts

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, words = [], []
        while len(keys):
            size = -(-GAMMA * len(keys) // 64) * 64
            at = (mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            keys = keys[~alone[at]]
        return cls(sizes, np.concatenate(words) if words else np.zeros(0, "<u8"))

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of every key; of a key outside the set some number, or -1."""
        out = np.full(len(keys), -1, np.int64)
        waiting, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(waiting):
                break
            at = mixed(keys[waiting], level) % np.uint64(size)
            word = (at >> np.uint64(6)).astype(np.int64) + start
            bit = at & np.uint64(63)
            here = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word[here]] & ((np.uint64(1) << bit[here]) - np.uint64(1))
            out[waiting[here]] = self.ranks[word[here]] + np.bitwise_count(below)
            waiting = waiting[~here]
            start += size // 64
        return out


class Pairs:
    """Numbers of the pairs of several parts, checked against the table of pairs."""

    def __init__(self, total_parts: int, functions: list[tuple[int, list[int], np.ndarray, np.ndarray]]):
        self.total_parts = total_parts
        self.functions, self.starts, tables, start = {}, {}, [], 0
        for part, sizes, words, table in functions:
            self.functions[part], self.starts[part] = PerfectHash(sizes, words), start
            tables.append(table)
            start += len(table)
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int64)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of every pair; -1 for pairs of parts that are not here."""
        out = np.full(len(keys), -1, np.int64)
        parts = part_of(keys, self.total_parts)
        for part, function in self.functions.items():
            mine = np.flatnonzero(parts == part)
            if len(mine):
                found = function.numbers(keys[mine]) + self.starts[part]
                if (found < self.starts[part]).any() or (self.table[found] != keys[mine]).any():
                    raise ValueError("a linked pair is missing in the table of pairs")
                out[mine] = found
        return out


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(keys, 63) % np.uint64(parts)).astype(np.int64)


# ---- alignment --------------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 letters for
    themselves, the other bytes as letters from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Strings:
    """Byte strings by number."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.array(list(map(len, strings)), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(strings), np.uint8)

    def text(self, numbers: np.ndarray) -> np.ndarray:
        """The strings with these numbers, one after another."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        return self.letters[np.repeat(self.starts[numbers] - (ends - sizes), sizes) + np.arange(sizes.sum())]

    def writes(self, numbers: np.ndarray, text: np.ndarray) -> bool:
        """Whether the strings make up ``text``."""
        if int(self.sizes[numbers].sum()) != len(text):
            return False
        at = 0
        for start in range(0, len(numbers), AT_ONCE):
            part = self.text(numbers[start:start + AT_ONCE])
            if not np.array_equal(part, text[at:at + len(part)]):
                return False
            at += len(part)
        return True


class Encoders:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=piece_path)
        letters = byte_letters()
        with open(byte_path) as file:
            config = json.load(file)
        special = {t["id"] for t in config["added_tokens"]}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        a_bytes = [name.encode() if i in special else bytes(letters[c] for c in name) for i, name in enumerate(names)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode()
                   for i, p in enumerate(pieces)]
        self.size = len(pieces)
        self.a_table, self.b_table = Strings(a_bytes), Strings(b_bytes)
        byte_level = (
            config["normalizer"] is None and config["post_processor"] is None and config["pre_tokenizer"] == {
                "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})
        # Byte-level splitting starts a token at a single space, and no merged piece holds a space
        # after anything else, so cuts at such spaces change no token.
        self.by_unit = byte_level and not any("\u2581" in p.lstrip("\u2581") for p in pieces)
        # Where merges make the ids in ascending order, an id is its own rank, and a faster library
        # finds the same tokens.
        known = {name: i for i, name in enumerate(names)}
        merges = [m if isinstance(m, list) else m.split(" ") for m in config["model"]["merges"]]
        made = [known["".join(m)] for m in merges]
        self.ranked = None
        if self.by_unit and made == list(range(256, 256 + len(made))) and not config["model"]["ignore_merges"]:
            self.ranked = tiktoken.Encoding(
                "ranked", pat_str=BYTE_SPLIT, special_tokens={},
                mergeable_ranks={t: i for i, t in enumerate(a_bytes) if i not in special})
        # Every id as text, A before B, with the sign behind it: another of its side, or the other side
        # or the next group.
        self.written = Strings([str(i).encode() + end for side, ends in ((names, (b",", b"|")), (pieces, (b",", b";")))
                                for i in range(len(side)) for end in ends])

    def ids_a(self, units: list[str], joined: int) -> np.ndarray:
        """Ids of all units, each with a space before it, one after another; the first ``joined`` units at once."""
        joined = 0 if self.ranked is None else joined
        found = [self.ranked.encode_to_numpy(" " + " ".join(units[:joined]), disallowed_special=())] if joined else []
        if joined < len(units):
            found += [e.ids for e in self.a.encode_batch_fast([" " + u for u in units[joined:]], add_special_tokens=False)]
        return np.concatenate([np.asarray(f, np.int64) for f in found]) if found else np.zeros(0, np.int64)


def encoders(byte_path: str, piece_path: str) -> Encoders:
    """The worker's tokenizers, kept between tasks."""
    return held(("encoders", byte_path, piece_path), lambda: Encoders(byte_path, piece_path))


class Aligned:
    """The texts of a slice as numbers of units, and what is counted in every unit."""

    def __init__(self, made: Encoders, texts: pa.Array):
        self.made = made
        texts = texts.cast(pa.large_string())
        there = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False)
        odd = there.copy()
        if made.by_unit:
            odd &= pc.fill_null(pc.match_substring_regex(texts, ODD_SPACE), False).to_numpy(zero_copy_only=False)
        own = {i: CUT.split(texts[i].as_py()) if made.by_unit else [texts[i].as_py()] for i in np.flatnonzero(odd).tolist()}
        good = self.encode(texts, there & ~odd, own)
        if not good.all():
            # Tokens of some unit differ from its text; what counts are the tokens of the whole text.
            bad = [i for i, r in enumerate(self.rows) if not good[r].all()]
            own |= {i: [texts[i].as_py()] for i in bad}
            odd[bad] = True
            good = self.encode(texts, there & ~odd, own)
            self.rows = [r if good[r].all() else r[:0] for r in self.rows]
        self.used = np.bincount(np.concatenate([*self.rows, np.zeros(0, np.int64)]), minlength=len(good))
        self.count()

    def encode(self, texts: pa.Array, plain: np.ndarray, own: dict[int, list[str]]) -> np.ndarray:
        """Whether the tokens of each distinct unit make up its text. Units that are encoded apart come
        last. ``plain`` texts are cut at every space, ``own`` has the units of others."""
        made = self.made
        split = pc.split_pattern(pc.if_else(pa.array(plain), texts, pa.scalar(None, texts.type)), " ")
        lengths = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pa.concat_arrays([split.flatten(), pa.array(list(chain.from_iterable(own.values())), texts.type)])
        coded = flat.dictionary_encode()
        units, numbers = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        alone = pc.or_(pc.greater(pc.binary_length(units), LONG_UNIT), pc.match_substring_regex(units, OUTER_SPACE)) \
            .to_numpy(zero_copy_only=False)
        order = np.argsort(alone, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        numbers, units = place[numbers], units.take(pa.array(order))
        self.rows = np.split(numbers[:lengths.sum()], np.cumsum(lengths)[:-1]) if len(lengths) else []
        at = int(lengths.sum())
        for i, parts in own.items():
            self.rows[i] = numbers[at:at + len(parts)]
            at += len(parts)
        names = strings(units)
        sizes = pc.binary_length(units).to_numpy().astype(np.int64) + 1
        whole = np.frombuffer((" " + " ".join(names)).encode() if names else b"", np.uint8)
        self.a = made.ids_a(names, len(names) - int(alone.sum()))
        found = made.b.encode(names, num_threads=1) if names else []
        self.b = np.fromiter(chain.from_iterable(found), np.int64)
        self.ends = np.cumsum(sizes)
        if made.a_table.writes(self.a, whole) and made.b_table.writes(self.b, whole):
            return np.ones(len(names), bool)
        each = [made.ids_a([u], 0) for u in names]
        found = [np.array(b, np.int64) for b in found]
        good = np.zeros(len(names), bool)
        for i, (a, b, end, size) in enumerate(zip(each, found, self.ends.tolist(), sizes.tolist(), strict=True)):
            text = whole[end - size:end]
            good[i] = made.a_table.writes(a, text) and made.b_table.writes(b, text)
        # Units whose tokens are not their text stand as empty ones.
        none = np.zeros(0, np.int64)
        self.a, self.b = (np.concatenate([*(x for x, ok in zip(side, good, strict=True) if ok), none]) for side in (each, found))
        self.ends = np.cumsum(np.where(good, sizes, 0))
        return good

    def count(self) -> None:
        made = self.made
        total = int(self.ends[-1]) if len(self.ends) else 0
        ends_a, ends_b = np.cumsum(made.a_table.sizes[self.a]), np.cumsum(made.b_table.sizes[self.b])
        at_a, at_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        at_a[ends_a], at_b[ends_b] = True, True
        self.before_a, self.before_b = np.cumsum(at_a), np.cumsum(at_b)  # tokens that end up to an offset
        both, every = at_a & at_b, np.flatnonzero(at_a | at_b)
        self.group_ends = np.flatnonzero(both)
        link_a = self.before_a[every] - at_a[every]
        link_b = self.before_b[every] - at_b[every]
        self.links = self.a[link_a] * made.size + self.b[link_b]
        self.link_ends = np.cumsum(at_a | at_b)[self.ends]
        self.n_a, self.n_b, self.n_links = (steps(x) for x in (
            self.before_a[self.ends], self.before_b[self.ends], self.link_ends))
        self.n_groups = steps(np.cumsum(both)[self.ends])

    def link_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """(pair, links of the slice) of the distinct pairs, ascending."""
        pairs, place = np.unique(self.links, return_inverse=True)
        counts = np.bincount(place, np.repeat(self.used, self.n_links), len(pairs)).astype(np.int64)
        return pairs[counts > 0], counts[counts > 0]

    def written(self) -> list[bytes]:
        """The groups of every unit as text, each group with a semicolon behind it."""
        made = self.made
        in_a, in_b = self.before_a[self.group_ends], self.before_b[self.group_ends]
        # A group's A ids stand before its B ids: an id moves by the ids of the other side before it.
        of_a = np.searchsorted(in_a, np.arange(len(self.a)), side="right")
        of_b = np.searchsorted(in_b, np.arange(len(self.b)), side="right")
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[in_a - 1], last_b[in_b - 1] = 1, 1
        stream = np.empty(len(self.a) + len(self.b), np.int64)
        stream[np.arange(len(self.a)) + np.concatenate([[0], in_b])[of_a]] = 2 * self.a + last_a
        stream[np.arange(len(self.b)) + in_a[of_b]] = 2 * (self.b + len(made.a_table.sizes)) + last_b
        text = b"".join(made.written.text(stream[at:at + AT_ONCE]).tobytes() for at in range(0, len(stream), AT_ONCE))
        letters = np.concatenate([[0], np.cumsum(made.written.sizes[stream])])
        ends = letters[np.cumsum(self.n_a + self.n_b)].tolist()
        return [text[s:e] for s, e in zip([0, *ends], ends)]


def steps(ends: np.ndarray) -> np.ndarray:
    return np.diff(ends, prepend=0)


# ---- passes over the documents ----------------------------------------------------------------


def counted_pairs(docs: DataFrame, text_col: str, paths: tuple[str, str]) -> DataFrame:
    """(pair, n): how often two ids are linked, summed over a part of a task's documents."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, pairs, counts = encoders(*paths), [], []
        for part in gathered(batches, 0, SLICE_BYTES):
            found, n = Aligned(made, part.column(0)).link_counts()
            pairs.append(found)
            counts.append(n)
            if sum(map(len, pairs)) > GATHERED:
                pairs, counts = map(list, zip(added(pairs, counts)))
                if len(pairs[0]) > GATHERED // 2:
                    yield row(pairs, counts)
                    pairs, counts = [], []
        if pairs:
            yield row(*map(list, zip(added(pairs, counts))))

    def row(pairs: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(counts[0])], names=["pair", "n"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(gather, "pair long, n long")


def added(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal pairs added up."""
    found, place = np.unique(np.concatenate(pairs), return_inverse=True)
    sums = np.zeros(len(found), np.int64)
    np.add.at(sums, place, np.concatenate(counts))
    return found, sums


def functions(pairs: DataFrame, parts: int) -> DataFrame:
    """(part, sizes, words, pairs): the perfect hash of every part, and its pairs by number."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(part_of(keys, parts)), batch.column(0)], names=["part", "pair"])

    def build(table: pa.Table) -> pa.Table:
        keys = table.column("pair").to_numpy()
        made = PerfectHash.build(keys)
        placed = np.empty(len(keys), np.int64)
        placed[made.numbers(keys)] = keys
        return pa.table({"part": [table.column("part")[0].as_py()], "sizes": [made.sizes],
                         "words": [made.words.tobytes()], "pairs": [placed.tobytes()]})

    return pairs.mapInArrow(deal, "part long, pair long").groupBy("part").applyInArrow(
        build, "part long, sizes array<long>, words binary, pairs binary")


def rounds(made: DataFrame, most: int) -> list[list[int]]:
    """Parts by round, each round with at most ``most`` pairs, or one part."""
    out, room = [], 0
    for r in made.select("part", (F.length("pairs") / 8).cast("long").alias("n")).orderBy("part").collect():
        if r.n > room:
            out.append([])
            room = most
        out[-1].append(r.part)
        room -= r.n
    return out


def shipped_pairs(spark: SparkSession, made: DataFrame, chosen: list[int], parts: int):
    """A broadcast of one round's functions."""
    rows = made.filter(F.col("part").isin(chosen)).orderBy("part").collect()
    return spark.sparkContext.broadcast(Pairs(parts, [
        (r.part, list(r.sizes), np.frombuffer(r.words, "<u8"), np.frombuffer(r.pairs, "<i8")) for r in rows]))


def summed(counted: DataFrame, pairs) -> np.ndarray:
    """The count of every pair of a round, by number."""
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(len(pairs.value.table), np.int64)
        for batch in batches:
            numbers, n = pairs.value.numbers(batch.column(0).to_numpy()), batch.column(1).to_numpy()
            np.add.at(dense, numbers[numbers >= 0], n[numbers >= 0])
        for piece, start in enumerate(range(0, len(dense), PIECE)):
            if dense[start:start + PIECE].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()]), pa.array([piece]),
                     pa.array([dense[start:start + PIECE].tobytes()])], names=["source", "piece", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_py(), "<i8") for c in table.column("counts"))
        return pa.table({"source": [table.column("source")[0].as_py() // FAN], "piece": [table.column("piece")[0].as_py()],
                         "counts": [total.tobytes()]})

    schema = "source long, piece long, counts binary"
    level = stored(counted.mapInArrow(vectors, schema), "alignment-counts")
    while (level.agg(F.max("source")).first()[0] or 0) > 0:
        level = stored(level.groupBy("piece", F.floor(F.col("source") / FAN).alias("above")).applyInArrow(add, schema),
                       "alignment-counts")
    out = np.zeros(len(pairs.value.table), np.int64)
    for r in level.collect():
        piece = np.frombuffer(r.counts, "<i8")
        out[r.piece * PIECE:r.piece * PIECE + len(piece)] = piece
    return out


def align(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
          most_pairs: int = MOST_PAIRS, part_pairs: int = PART_PAIRS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    spark, paths = docs.sparkSession, (byte_path, piece_path)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = stored(counted_pairs(rows, "text", paths), "alignment-pairs")
    pairs = stored(counted.select("pair").distinct(), "alignment-distinct")
    parts = max(1, -(-pairs.count() // part_pairs))
    made = stored(functions(pairs, parts), "alignment-functions")
    turns = rounds(made, most_pairs) or [[]]
    known, best = [], np.zeros(0, np.int64)
    for chosen in turns:
        shared = shipped_pairs(spark, made, chosen, parts)
        counts = summed(counted, shared)
        sides = shared.value.table % piece_count(piece_path)
        best = np.pad(best, (0, max(0, int(sides.max(initial=-1)) + 1 - len(best))))
        np.maximum.at(best, sides, counts)
        known.append((shared, spark.sparkContext.broadcast(counts)))
    top = spark.sparkContext.broadcast(best)
    if len(turns) > 1:
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    found = [looked_up(rows, paths, shared, counts, top, first=not turn) for turn, (shared, counts) in enumerate(known)]
    whole = found[0]
    if len(turns) > 1:
        for other in found[1:]:
            whole = whole.unionByName(other)
        whole = whole.groupBy("row").agg(
            *[F.max(n).alias(n) for n in ("id", *COLUMNS[:4])], *[F.sum(n).alias(n) for n in COLUMNS[4:6]],
            F.max(COLUMNS[6]).alias(COLUMNS[6]))
    return whole.select(F.col("id").alias(id_col), *COLUMNS)


def piece_count(piece_path: str) -> int:
    return SentencePieceProcessor(model_file=piece_path).get_piece_size()


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def looked_up(rows: DataFrame, paths: tuple[str, str], shared, counts, top, first: bool) -> DataFrame:
    """The second pass: ``rows`` with their columns but ``text``, and ``COLUMNS``. Digests are made in the first
    round only."""
    kept, at = [c for c in rows.columns if c != "text"], rows.columns.index("text")
    schema = T.StructType([*(rows.schema[c] for c in kept), *(T.StructField(c, T.LongType()) for c in COLUMNS[:6]),
                           T.StructField(COLUMNS[6], T.StringType())])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoders(*paths)
        for part in gathered(batches, at, SLICE_BYTES):
            aligned = Aligned(made, part.column("text"))
            numbers = shared.value.numbers(aligned.links)
            here = numbers >= 0
            n = np.zeros(len(numbers), np.int64)
            n[here] = counts.value[numbers[here]]
            best = here & (n == top.value[aligned.links % made.size])
            n_best, count_sum = (steps(np.concatenate([[0], np.cumsum(x)])[aligned.link_ends]) for x in (best, n))
            table = np.column_stack([aligned.n_a, aligned.n_b, aligned.n_groups, aligned.n_links, n_best, count_sum])
            sums = np.array([table[r].sum(axis=0) for r in aligned.rows], np.int64).reshape(-1, 6)
            written = aligned.written() if first else []
            digests = [hashlib.sha256(b"".join(map(written.__getitem__, r.tolist()))[:-1]).hexdigest()
                       if first and len(r) else "" for r in aligned.rows]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), *(pa.array(x) for x in sums.T), pa.array(digests, pa.string())],
                names=[*kept, *COLUMNS])

    return rows.mapInArrow(look, schema)
