"""Token-ID files as directly addressable codes.

An id is cut into chunks of ``CHUNK_BITS`` bits. Level 0 holds the lowest chunk of every id, level
k the k-th chunk of those ids that have one. One bit per chunk says whether the id goes on, and a
rank directory over these bits says where on the next level it does. So any token is read with one
look-up per level, and a run of tokens without what lies before it.

The file format is a table of segments (Parquet, in ascending document order): ``shard`` and
``seq`` order the segments, ``first`` counts the ids before the segment within its shard, ``docs``
and ``ends`` name its documents and where they end, ``chunks``, ``more`` and ``ranks`` hold one
entry per level. Segments close at ``SEGMENT_TOKENS`` ids, so a reader holds one segment, or one
longer document, at a time.

Documents are ordered by (id, hash of text), NULL ids first. Rows that repeat an id are kept, side
by side; a NULL or empty text is the end id alone, an empty table no segment at all. Very long texts
are segments of their own. Only the two named columns are read, so others may have any name. A
special token's string becomes its id where it stands exactly so, in its own letter case.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer, pre_tokenizers

from tallyfield.llm.tables import gathered, held, strings, thrifty

CHUNK_BITS = 8
RANK_BITS = 512
SEGMENT_TOKENS = 1 << 20
# Distinct words and parts of words that a worker remembers, and bytes of texts that it encodes at
# once. They bound its memory; the result is the same for any numbers.
PARTS_KEPT = 500_000
SLICE_BYTES = 4_000_000
# Parts that are encoded in one call of the library.
LINE_PARTS = 50

# The normaliser and pre-tokeniser under which words can be encoded apart.
WORD_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"}]}
WORD_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# The same split for words made of printable ASCII and composed Latin-1 letters only, and the most
# frequent of them: letters, then ASCII signs but no apostrophe.
PLAIN_WORD = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
PLAIN_SPLIT = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
SIGNS = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'")
PLAINEST = rf"\A[A-Za-zÀ-ÖØ-öø-ÿ]+[{re.escape(SIGNS)}]*\z"


def encode_levels(ids: np.ndarray) -> list[tuple[bytes, bytes, bytes]]:
    """(chunks, continuation bits, rank directory) of every level; one empty level if no ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >> CHUNK_BITS > 0
        bits = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(
            more.astype(np.int64), np.arange(0, len(more), RANK_BITS)) if len(more) else np.zeros(0, np.int64)
        ranks = np.concatenate([[0], np.cumsum(blocks)]).astype("<u4")
        chunks = (rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        levels.append((chunks.tobytes(), bits.tobytes(), ranks.tobytes()))
        if not more.any():
            return levels
        rest = rest[more] >> CHUNK_BITS


class Codes:
    """Reads single ids or runs of ids of one segment."""

    def __init__(self, chunks: list[bytes], more: list[bytes], ranks: list[bytes]):
        self.levels = [
            (np.frombuffer(c, np.uint8), np.frombuffer(m, np.uint8), np.frombuffer(r, "<u4"))
            for c, m, r in zip(chunks, more, ranks, strict=True)]

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Continuation bits that are set before position ``i``."""
        block = i // RANK_BITS
        span = bits[block * RANK_BITS // 8:(i + 7) // 8]
        inside = np.unpackbits(span, bitorder="little")[:i - block * RANK_BITS]
        return int(ranks[block]) + int(inside.sum())

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (CHUNK_BITS * k)
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            i = self._rank(bits, ranks, i)
        raise ValueError("the last level goes on")

    def run(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to before ``stop``."""
        out = np.zeros(stop - start, np.uint32)
        at = np.arange(stop - start)
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            if start == stop:
                break
            out[at] |= chunks[start:stop].astype(np.uint32) << np.uint32(CHUNK_BITS * k)
            flags = np.unpackbits(
                bits[start >> 3:(stop + 7) >> 3], bitorder="little")[start & 7:(start & 7) + stop - start]
            at = at[flags.astype(bool)]
            start = self._rank(bits, ranks, start)
            stop = start + len(at)
        return out


class Encoder:
    """Texts to ids, as the tokenizer gives them for whole texts.

    Where the tokenizer's own normaliser and split never join what white space parts, the distinct
    words of a slice of texts are found, cut into parts, and every part is encoded once and
    remembered; a text's ids are gathered by the numbers of its parts. For any other tokenizer every
    text is encoded as a whole.
    """

    def __init__(self, path: str, parts_kept: int = PARTS_KEPT):
        self.parts_kept = parts_kept
        # Tasks fill the cores; threads of the library's own would each keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as file:
            config = json.load(file)
        split = (config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = (
            config["normalizer"] == WORD_NORMALIZER and config.get("post_processor") is None
            and split[0].get("pattern") == {"Regex": WORD_SPLIT} and split[0].get("behavior") == "Removed"
            and split[0].get("invert") is True
            and not any(" " in t["content"] or t["normalized"] for t in config["added_tokens"]))
        self.special = [t["content"] for t in config["added_tokens"]]
        self.units = Tokenizer.from_file(path)
        self.units.normalizer = None
        self.units.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        end = config["model"]["end_of_word_suffix"] or "\0"
        self.ends_word = np.array([(self.units.id_to_token(i) or "").endswith(end) for i in range(self.units.get_vocab_size())])
        self.by_word &= set(config["model"]["vocab"]).issuperset(
            letter + end for letter in pre_tokenizers.ByteLevel.alphabet())
        # Numbers of the parts; a word that is encoded as a whole stands behind a space.
        self.known: dict[str, int] = {}
        self.ids, self.sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        self.forget()

    def forget(self) -> None:
        """Start anew; what was known until now can still be taken over, what was known before is gone."""
        self.before = self.known, np.concatenate(self.ids), np.concatenate(self.sizes)
        self.known = {"": 0}
        self.ids, self.sizes = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        ids, counts = self.encode(pa.array(texts, pa.string()))
        ends = np.cumsum(counts).tolist()
        return [ids[s:e].astype("<u4").tobytes() for s, e in zip([0, *ends], ends)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of every text); NULL is the empty text."""
        if not self.by_word:
            return whole(self.tokenizer, pc.fill_null(texts, "").to_pylist())
        if len(self.known) > self.parts_kept // 2:
            self.forget()
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        n_words = pc.fill_null(pc.list_value_length(split), 0).to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        parts, n_parts = self.numbered(coded.dictionary)
        # The parts of every word in turn, then the ids of every part.
        parts, n = ragged(parts, n_parts, coded.indices.to_numpy().astype(np.int64))
        n_text = sums(n, n_words)
        ids, sizes = np.concatenate(self.ids), np.concatenate(self.sizes)
        self.ids, self.sizes = [ids], [sizes]
        found, n = ragged(ids, sizes, parts)
        return found, sums(n, n_text)

    def numbered(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the parts of all words one after another, how many each word has)."""
        plainest = pc.match_substring_regex(words, PLAINEST)
        simple = pc.utf8_lower(words.filter(plainest))
        stems = pc.utf8_rtrim(simple, SIGNS).dictionary_encode()
        ends = pc.replace_substring_regex(simple, r"\A[a-zß-öø-ÿ]+", "").dictionary_encode()
        others: list[list[str]] = []
        for word in strings(words.filter(pc.invert(plainest))):
            if PLAIN_WORD.fullmatch(word) and not any(s in word for s in self.special):
                others.append(PLAIN_SPLIT.findall(word.lower()))
            else:
                others.append([" " + word])
        stem_names, end_names = strings(stems.dictionary), strings(ends.dictionary)
        flat = list(chain.from_iterable(others))
        known = self.known
        new = self.taken_over([p for p in dict.fromkeys(chain(stem_names, end_names, flat)) if p not in known])
        words = [p for p in new if p.startswith(" ")]
        parts = [p for p in new if not p.startswith(" ")] if words else new
        self.learn(parts, *self.apart(parts))
        self.learn(words, *whole(self.tokenizer, [w[1:] for w in words]))
        number = self.known.__getitem__
        of_stems, of_ends, of_others = (np.fromiter(map(number, x), np.int64, len(x)) for x in (stem_names, end_names, flat))
        n_parts = np.empty(len(plainest), np.int64)
        is_simple = plainest.to_numpy(zero_copy_only=False)
        # A simple word has its stem and what ends it, which is empty for most.
        n_parts[is_simple] = 2
        n_parts[~is_simple] = list(map(len, others))
        at = np.cumsum(n_parts) - n_parts
        out = np.empty(int(n_parts.sum()), np.int64)
        out[at[is_simple]] = of_stems[stems.indices.to_numpy()]
        out[at[is_simple] + 1] = of_ends[ends.indices.to_numpy()]
        out[np.repeat(~is_simple, n_parts)] = of_others
        return out, n_parts

    def apart(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, ids per part). Parts go to the library by the line; each ends with the only
        id of its that ends a word."""
        lines = [" ".join(parts[i:i + LINE_PARTS]) for i in range(0, len(parts), LINE_PARTS)]
        ids, _ = whole(self.units, lines)
        return ids, np.diff(np.flatnonzero(self.ends_word[ids]) + 1, prepend=0)

    def taken_over(self, parts: list[str]) -> list[str]:
        """The parts that nothing is known of; those known before the last ``forget`` are known again."""
        known, ids, sizes = self.before
        again = [p for p in parts if p in known]
        if again:
            self.learn(again, *ragged(ids, sizes, np.fromiter(map(known.__getitem__, again), np.int64, len(again))))
        return [p for p in parts if p not in known]

    def learn(self, parts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(parts, range(len(self.known), len(self.known) + len(parts)), strict=True))
        self.ids.append(ids)
        self.sizes.append(sizes)


def whole(tokenizer: Tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids one after another, ids per text) of texts that are encoded as they are."""
    found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []
    counts = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum())), counts


def ragged(values: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values of the chosen rows one after another, their number per row); ``sizes`` cuts ``values`` into rows."""
    starts = np.cumsum(sizes) - sizes
    n = sizes[rows]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts[rows] - (ends - n), n) + np.arange(total)], n


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``."""
    upto = np.concatenate([[0], np.cumsum(values)])
    return np.diff(upto[np.cumsum(sizes)], prepend=0)


def encoder(path: str, parts_kept: int = PARTS_KEPT) -> Encoder:
    """The worker's encoder for a tokenizer file, kept between tasks."""
    return held(("encoder", path, parts_kept), lambda: Encoder(path, parts_kept))


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text", parts_kept: int = PARTS_KEPT, slice_bytes: int = SLICE_BYTES,
) -> None:
    """Encode every text, append ``end_id``, and write the segments to ``folder``.

    ``parts_kept`` and ``slice_bytes`` trade a worker's memory for time; the ids are the same.

    The one shuffle ranges the rows by document, so every task writes one run of documents.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("seq", T.IntegerType()),
        T.StructField("first", T.LongType()), T.StructField("docs", T.ArrayType(id_type)),
        T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("chunks", T.ArrayType(T.BinaryType())),
        T.StructField("more", T.ArrayType(T.BinaryType())),
        T.StructField("ranks", T.ArrayType(T.BinaryType()))])
    arrow = to_arrow_schema(schema)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encode = TaskContext.get().partitionId(), encoder(tokenizer, parts_kept)
        seq = first = size = 0
        ids: list[object] = []
        codes: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            ends = np.cumsum(list(map(len, codes))).tolist()
            levels = encode_levels(np.concatenate(codes))
            row = [[shard], [seq], [first], [ids], [ends], *([list(x)] for x in zip(*levels, strict=True))]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, type=f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)

        for part in gathered(batches, 1, slice_bytes):
            found, counts = encode.encode(part.column(1))
            upto = np.cumsum(counts + 1)
            text = np.full(int(upto[-1]) if len(upto) else 0, end_id, np.uint32)
            inside = np.ones(len(text), bool)
            inside[upto - 1] = False
            text[inside] = found
            for doc, start, stop in zip(part.column(0).to_pylist(), (upto - counts - 1).tolist(), upto.tolist(), strict=True):
                ids.append(doc)
                codes.append(text[start:stop])
                size += stop - start
                if size >= SEGMENT_TOKENS:
                    yield close()
                    seq, first, size, ids, codes = seq + 1, first + size, 0, [], []
        if ids:
            yield close()
        ids, codes = [], []

    keys = [F.col("doc").asc_nulls_first(), F.xxhash64("text")]
    ordered = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")) \
        .repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.mapInArrow(thrifty(segments), schema).write.parquet(folder)


def read_tokens(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, decoded from the files.

    ``start`` counts the ids of all documents before it. It is the sum within the shard, which the
    file holds, and the total of the shards before; there are as many totals as write tasks, so
    their table may be broadcast at any size of the input.
    """
    files = spark.read.parquet(folder)
    id_type = files.schema["docs"].dataType.elementType
    schema = T.StructType([
        T.StructField(id_col, id_type), T.StructField("shard", T.IntegerType()),
        T.StructField("inner", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType())])
    arrow = to_arrow_schema(schema)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, first, docs, ends, *levels = (
                    c[0].as_py() for c in batch.slice(i, 1).columns)
                codes, starts = Codes(*levels), [0, *ends[:-1]]
                crcs = [zlib.crc32(codes.run(a, b).astype("<u4").tobytes())
                        for a, b in zip(starts, ends, strict=True)]
                values = [docs, [shard] * len(docs), [first + a for a in starts],
                          [b - a for a, b in zip(starts, ends, strict=True)], crcs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip(values, arrow, strict=True)], schema=arrow)

    decoded = files.select("shard", "first", "docs", "ends", "chunks", "more", "ranks") \
        .mapInArrow(thrifty(documents), schema)
    last = F.element_at("ends", -1)
    totals = files.select("shard", (F.col("first") + last).alias("upto")) \
        .groupBy("shard").agg(F.max("upto").alias("total"))
    before = totals.select("shard", F.coalesce(F.sum("total").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return decoded.join(F.broadcast(before), "shard").select(
        id_col, (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def token_at(files: DataFrame, position: int) -> int | None:
    """The id at a position of the whole corpus; only the segment that holds it is read."""
    heads = files.select("shard", "seq", "first", F.element_at("ends", -1).alias("n"))
    start = 0
    for row in heads.orderBy("shard", "seq").toLocalIterator():
        if start <= position < start + row.n:
            segment = files.filter((F.col("shard") == row.shard) & (F.col("seq") == row.seq)) \
                .select("chunks", "more", "ranks").first()
            return Codes(*segment)[position - start]
        start += row.n
    return None
