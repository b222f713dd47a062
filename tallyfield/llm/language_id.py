"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased; every run of characters that are no letters becomes one space; its n-grams
are hashed into a fixed number of buckets. Training counts grams per language inside the tasks and
adds the counts up; the log-probability matrix (buckets x languages) is the whole model and is
broadcast: its size is fixed by the parameters and the label set. Scoring builds one sparse
row-pointer structure per slice of texts and sums matrix rows between the pointers.

Cases. NULL text, or text without a letter: ``und``, score 0. No training rows at all: ``und``,
score 0 for every row. Ties between languages: the first in code-point order. NULL languages are
never learned. Other columns are kept unless they clash with an added one, which then replaces it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.tables import add_columns, row_slices

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (2, 3)
    buckets: int = 1 << 16
    smoothing: float = 0.5
    # Training takes about so many rows of each language, picked by a hash of the whole row.
    rows_per_language: int = 3000


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prior: np.ndarray    # log, per language
    weights: np.ndarray  # log-probabilities, buckets x languages
    settings: Settings


@cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str | None], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(hashed grams of all texts, row pointers); a text without letters has none."""
    points = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    row = np.repeat(np.arange(len(texts)), [len(p) for p in points])
    code = np.concatenate(points) if points else np.zeros(0, np.uint32)
    letter = letters()[code]
    # Keep letters, and of every run of other characters the first one, as a space.
    before = np.concatenate([[False], letter[:-1] & (row[1:] == row[:-1])]) if len(code) else letter
    keep = letter | before
    code, row = np.where(letter, code, np.uint32(32))[keep], row[keep]
    buckets, rows = [], []
    for n in settings.orders:
        if len(code) < n:
            continue
        size = len(code) - n + 1
        mixed = np.full(size, n, np.uint32)
        for k in range(n):
            mixed = (mixed ^ code[k:k + size]) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
        inside = row[:size] == row[n - 1:]
        buckets.append(mixed[inside] % np.uint32(settings.buckets))
        rows.append(row[:size][inside])
    if not buckets:
        return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    bucket, row = np.concatenate(buckets), np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    return bucket[order], np.searchsorted(row[order], np.arange(len(texts) + 1))


def fit(docs: DataFrame, learn: Column, settings: Settings = Settings(),
        text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the rows of ``docs`` that ``learn`` accepts and that have a language."""
    rows = docs.filter(learn & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    totals = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = tuple(sorted(totals))
    if not languages:
        return Model((), np.zeros(0), np.zeros((settings.buckets, 0), np.float32), settings)
    parts = 1 << 30
    share = F.create_map(*(F.lit(x) for lang in languages for x in (
        lang, int(parts * min(1.0, settings.rows_per_language / totals[lang])))))
    picked = rows.filter(F.pmod(F.xxhash64("lang", "text"), F.lit(parts)) < share[F.col("lang")])
    known = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(known), settings.buckets), np.int64)
        for batch in batches:
            for part in row_slices(batch, 1):
                bucket, ends = grams(part.column(1).to_pylist(), settings)
                for i, lang in enumerate(part.column(0).to_pylist()):
                    np.add.at(seen[known[lang]], bucket[ends[i]:ends[i + 1]], 1)
        lang, bucket = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(seen[lang, bucket], pa.int64())],
            names=["lang", "bucket", "n"])

    counts = picked.mapInArrow(count, "lang int, bucket int, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros((settings.buckets, len(languages)))
    seen[counts["bucket"].to_numpy(), counts["lang"].to_numpy()] = counts["n"].to_numpy()
    seen += settings.smoothing
    rows_of = np.array([totals[lang] for lang in languages], float)
    return Model(languages, np.log(rows_of / rows_of.sum()),
                 np.log(seen / seen.sum(axis=0)).astype(np.float32), settings)


def score_texts(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """The most probable language of every text and its posterior probability."""
    if not model.languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    has_letter = np.array([any(map(str.isalpha, t or "")) for t in texts], bool)
    bucket, ends = grams(texts, model.settings)
    total = np.tile(model.prior, (len(texts), 1))
    filled = np.flatnonzero(np.diff(ends))
    if len(filled):
        for k in range(len(model.languages)):
            total[filled, k] += np.add.reduceat(
                model.weights[:, k][bucket], ends[filled], dtype=np.float64)
    best = total.argmax(axis=1)
    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    return ([model.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter, strict=True)],
            np.where(has_letter, share, 0.0).tolist())


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs``, or its columns ``keep``, with ``lang_pred`` and ``score``. No other column is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("lang_pred", "score")
    return add_columns(kept, [text_col], "lang_pred string, score double",
                       lambda: lambda texts: score_texts(texts, shared.value), keep)
