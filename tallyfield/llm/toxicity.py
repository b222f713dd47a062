"""Toxicity: a weighted finite-state grammar over clauses.

Words become symbols (insult, threat, target, negation, report, other); transducers for negation
scope, reported speech and targets are composed into one machine that reads a clause and tags what
it matched. A text's evidence is the weight of its matched clauses by tag; a logistic model over
that evidence gives the score.

Learning. The insult lexicon is a fixed seed list and word stems learned from labels, each with
its log-odds as weight. One half of a bounded sample of labelled rows yields the stems on which the
other half calibrates the logistic model, so the calibration sees the error rate of unseen texts;
the final lexicon then comes from both halves.

Only texts in which an insult or a threat occurs run through the machine; a text without one has
no evidence by definition.

Cases. NULL and empty texts have no evidence and get the score of that. Labels other than 0 and 1,
or NULL, are not learned from; of several labels for one id the largest counts. Without labels of
both kinds the seed lexicon and ``PRIOR`` weights apply. Other columns are kept unless they clash
with an added one, which then replaces it.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.tables import add_columns, held, stored, thrifty

# Word lists in four languages.
INSULTS = ("idiot", "moron", "scum", "clown", "pathetic", "worthless", "loser", "trash", "stupid", "disgusting",
           "imbecile", "bastard", "vermin", "dummkopf", "abschaum", "crétin", "ordure", "imbécil", "escoria")
THREATS = ("kill", "hurt", "destroy", "strangle", "stab", "shoot", "umbringen", "töten", "tuer", "détruire",
           "matar", "destruir")
TARGETS = ("you", "your", "yours", "he", "she", "they", "them", "him", "her", "people", "du", "dich", "ihr", "sie",
           "tu", "toi", "vous", "ils", "usted", "ellos", "tú", "vosotros")
NEGATIONS = ("not", "never", "no", "isn't", "aren't", "wasn't", "don't", "nicht", "kein", "keine", "nie", "pas",
             "jamais", "nunca", "jamás")
REPORTS = ("said", "says", "wrote", "quoted", "called", "reported", "claimed", "sagte", "schrieb", "dit", "écrit",
           "dijo", "escribió")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = "OITGNR"
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE_END = re.compile(r"[.!?;:\n|]")
NEGATION_SCOPE = 3  # words
COUNTED_STEMS = 150_000  # that a task holds before it passes its counts on
# Evidence columns: insults and threats by (negated, reported, in a clause with a target).
TAGS = [(kind, neg, rep, hit) for kind in (INSULT, THREAT) for neg in (0, 1) for rep in (0, 1) for hit in (0, 1)]
COLUMN = {tag: i for i, tag in enumerate(TAGS)}


@dataclass(frozen=True)
class Settings:
    toxic_rows: int = 4000    # labelled rows that training takes at most, by label
    clean_rows: int = 8000
    # A stem is learned if so many toxic texts hold it, clean texts hold it at most this much as
    # often, and the counts differ by so many standard errors (root of the likelihood ratio).
    min_toxic: int = 3
    max_clean_share: float = 0.1
    min_errors: float = 3.0
    stem_chars: tuple[int, int] = (4, 10)
    ridge: float = 0.05


# Evidence weights where nothing can be learned: direct insults and threats count, negated and
# reported ones hardly.
PRIOR_BIAS = -3.0
PRIOR = [(2.0 if kind == INSULT else 2.5 if hit else 1.0) * (0.2 if neg else 1) * (0.3 if rep else 1)
         * (1.2 if hit else 1) for kind, neg, rep, hit in TAGS]


class Transducer:
    """Deterministic: ``arcs[state, symbol] = (state, output symbol)``, from state ``start``."""

    def __init__(self, start: object, arcs: dict):
        self.start, self.arcs = start, arcs

    def compose(self, other: Transducer) -> Transducer:
        """Reads what ``self`` reads and writes what ``other`` makes of it."""
        start = (self.start, other.start)
        arcs, todo, seen = {}, [start], {start}
        inputs = defaultdict(list)
        for state, symbol in self.arcs:
            inputs[state].append(symbol)
        while todo:
            a, b = here = todo.pop()
            for symbol in inputs[a]:
                a2, middle = self.arcs[a, symbol]
                b2, out = other.arcs[b, middle]
                arcs[here, symbol] = ((a2, b2), out)
                if (a2, b2) not in seen:
                    seen.add((a2, b2))
                    todo.append((a2, b2))
        return Transducer(start, arcs)

    def read(self, symbols: list[str]) -> tuple[object, list]:
        state, out = self.start, []
        for symbol in symbols:
            state, written = self.arcs[state, symbol]
            out.append(written)
        return state, out


SYMBOLS = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT)


def negation() -> Transducer:
    """Tags every symbol with whether a negation came at most ``NEGATION_SCOPE`` words before."""
    arcs = {}
    for left, symbol in product(range(NEGATION_SCOPE + 1), SYMBOLS):
        then = NEGATION_SCOPE if symbol == NEGATION else max(0, left - 1)
        arcs[left, symbol] = (then, (symbol, int(left > 0)))
    return Transducer(0, arcs)


def reported() -> Transducer:
    """Tags what follows a reporting word within the clause."""
    arcs = {}
    for state, symbol, neg in product((0, 1), SYMBOLS, (0, 1)):
        arcs[state, (symbol, neg)] = (state or int(symbol == REPORT), (symbol, neg, state))
    return Transducer(0, arcs)


def targeted() -> Transducer:
    """Ends in state 1 if the clause names a target."""
    arcs = {}
    for state, symbol, neg, rep in product((0, 1), SYMBOLS, (0, 1), (0, 1)):
        arcs[state, (symbol, neg, rep)] = (state or int(symbol == TARGET), (symbol, neg, rep))
    return Transducer(0, arcs)


CLAUSE = negation().compose(reported()).compose(targeted())
FUNCTION_WORDS = {
    **dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(NEGATIONS, NEGATION), **dict.fromkeys(REPORTS, REPORT)}


def prefix_pattern(stems: list[str]) -> str:
    """A pattern for any of the stems, branching letter by letter, longest first."""
    branches: dict[str, list[str]] = defaultdict(list)
    for stem in stems:
        if stem:
            branches[stem[0]].append(stem[1:])
    body = "|".join(re.escape(c) + prefix_pattern(rest) for c, rest in sorted(branches.items()))
    if not body:
        return ""
    return f"(?:{body})?" if "" in stems else f"(?:{body})"


class Grammar:
    """The lexicon as a first transducer (word to symbol and weight) before ``CLAUSE``."""

    def __init__(self, stems: dict[str, float]):
        self.weights = {stem: (INSULT, weight) for stem, weight in stems.items()}
        self.weights |= {stem: (THREAT, 1.0) for stem in THREATS if stem not in stems}
        self.match = re.compile(r"\b" + prefix_pattern(sorted(self.weights)))

    def symbol(self, word: str) -> tuple[str, float]:
        if word in FUNCTION_WORDS:
            return FUNCTION_WORDS[word], 0.0
        hit = self.match.match(word)
        return self.weights[hit.group()] if hit else (OTHER, 0.0)

    def evidence(self, text: str | None) -> np.ndarray:
        """Weight of the matched clauses by tag, and the number of characters."""
        text = (text or "").lower()
        found = np.zeros(len(TAGS) + 1)
        found[-1] = len(text)
        done = -1
        for hit in self.match.finditer(text):
            if hit.start() < done:
                continue
            end = CLAUSE_END.search(text, hit.end())
            done = end.start() if end else len(text)
            begin = max(0, *(text.rfind(c, 0, hit.start()) + 1 for c in ".!?;:\n|"))
            read = [self.symbol(w) for w in WORD.findall(text[begin:done])]
            (_, aimed), written = CLAUSE.read([s for s, _ in read])
            for (kind, neg, rep), (_, weight) in zip(written, read, strict=True):
                if kind in (INSULT, THREAT):
                    found[COLUMN[kind, neg, rep, aimed]] += weight
        return found


def features(evidence: np.ndarray) -> np.ndarray:
    """Log weights by tag, then in all insults, and those to the length of the text."""
    tags, chars = evidence[:, :-1], evidence[:, -1]
    insults = tags[:, :len(TAGS) // 2].sum(axis=1)
    return np.column_stack([np.log1p(tags), np.log1p(insults), insults / np.sqrt(chars + 400)])


@dataclass(frozen=True)
class Model:
    stems: dict[str, float]
    bias: float
    weights: np.ndarray

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + features(evidence) @ self.weights, -30, 30)))


SEED_STEMS = dict.fromkeys(INSULTS, 3.0)


def pick_stems(counts: list[tuple[str, int, int]], toxic: int, clean: int, settings: Settings) -> dict[str, float]:
    """Stems by log-odds; of nested stems the one that covers most, and of equals the longest.

    Seed stems stay, with what their counts say about them where there are enough.
    """
    rated = []
    for stem, t, c in counts:
        if t >= settings.min_toxic and c / max(clean, 1) <= settings.max_clean_share * t / toxic:
            odds = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
            expected = (t + c) * toxic / (toxic + clean)
            ratio = t * math.log(t / expected) + (c * math.log(c / (t + c - expected)) if c else 0.0)
            if 2 * ratio >= settings.min_errors ** 2:
                rated.append((-t * odds, -len(stem), stem, odds))
    picked: dict[str, float] = dict(SEED_STEMS)
    for _, _, stem, odds in sorted(rated):
        if stem in SEED_STEMS:
            picked[stem] = min(odds, 6.0)
        elif not any(stem[:k] in picked for k in range(1, len(stem) + 1)) and \
                not any(other.startswith(stem) for other in picked):
            picked[stem] = min(odds, 6.0)
    return picked


def logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Newton steps for the ridge-penalised logistic model; the bias is not penalised."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), w[1:]


def sample(docs: DataFrame, labels: DataFrame, learn: Column, settings: Settings,
           id_col: str, text_col: str) -> DataFrame:
    """(text, toxic, half) of at most ``toxic_rows`` + ``clean_rows`` ids; the ids may be broadcast."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg(F.max("toxic").alias("toxic"))
    # The labels of rows that are not there, or not to be learned from, are left out beforehand.
    known = known.join(docs.filter(learn).select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    order = (F.xxhash64("id"), "id")
    ids = known.filter("toxic = 1").orderBy(*order).limit(settings.toxic_rows).unionAll(
        known.filter("toxic = 0").orderBy(*order).limit(settings.clean_rows))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), "id").select(
        "text", "toxic", F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)).cast("int").alias("half"))


def stem_counts(rows: DataFrame, settings: Settings) -> DataFrame:
    """(stem, half, toxic texts, clean texts) of every word start; counted in the tasks first."""
    low, high = settings.stem_chars

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None, lambda: None)
        seen: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = set(WORD.findall(text.lower()))
                for stem in {w[:k] for w in words for k in range(low, min(high, len(w)) + 1)}:
                    seen.setdefault((stem, half), [0, 0])[toxic] += 1
                if len(seen) > COUNTED_STEMS:
                    yield flush(seen)
                    seen = {}
        yield flush(seen)

    def flush(seen: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.int32()),
            pa.array([v[1] for v in seen.values()], pa.int64()),
            pa.array([v[0] for v in seen.values()], pa.int64())], names=["stem", "half", "toxic", "clean"])

    return rows.select("text", "toxic", "half").mapInArrow(
        thrifty(count), "stem string, half int, toxic long, clean long").groupBy("stem", "half").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, settings: Settings = Settings(),
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from labelled rows of ``docs`` that ``learn`` accepts."""
    rows = stored(sample(docs, labels, learn, settings, id_col, text_col), "toxicity-sample")
    sizes = {(r.half, r.toxic): r["count"] for r in rows.groupBy("half", "toxic").count().collect()}
    toxic, clean = ([sizes.get((half, y), 0) for half in (0, 1)] for y in (1, 0))
    if not (min(toxic) and min(clean)):
        return Model(SEED_STEMS, PRIOR_BIAS, np.array([*PRIOR, 0.0, 0.0]))
    # Stems that no selection can take stay on the executors.
    counts = stem_counts(rows, settings).groupBy("stem").agg(*(
        F.sum(F.when(F.col("half") == half, F.col(y)).otherwise(0)).alias(f"{y}{half}")
        for y in ("toxic", "clean") for half in (0, 1)))
    t, c = F.col("toxic0") + F.col("toxic1"), F.col("clean0") + F.col("clean1")
    share = settings.max_clean_share
    useful = counts.filter(
        ((F.col("toxic0") >= settings.min_toxic) & (F.col("clean0") / clean[0] <= share * F.col("toxic0") / toxic[0]))
        | ((t >= settings.min_toxic) & (c / sum(clean) <= share * t / sum(toxic)))).collect()
    half = pick_stems([(r.stem, r.toxic0, r.clean0) for r in useful], toxic[0], clean[0], settings)
    both = pick_stems([(r.stem, r.toxic0 + r.toxic1, r.clean0 + r.clean1) for r in useful],
                      sum(toxic), sum(clean), settings)
    shared = docs.sparkSession.sparkContext.broadcast(half)
    judged = add_columns(rows.filter("half = 1").select("toxic", "text"), ["text"], "evidence array<double>",
                         lambda: evidence_of(Grammar(shared.value))).select("toxic", "evidence").toPandas()
    bias, weights = logistic(
        features(np.stack(judged["evidence"].to_list())), judged["toxic"].to_numpy(float), settings.ridge)
    return Model(both, bias, weights)


def evidence_of(grammar: Grammar):
    return lambda texts: [[grammar.evidence(t).tolist() for t in texts]]


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs``, or its columns ``keep``, with ``score`` and ``predicted`` (1 from 0.5).

    Only the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        grammar, judge = Grammar(shared.value.stems), shared.value

        def work(texts: list[str | None]) -> list:
            scores = judge.score(np.stack([grammar.evidence(t) for t in texts]))
            return [scores.tolist(), (scores >= 0.5).astype(int).tolist()]

        return work

    return add_columns(docs.drop("score", "predicted"), [text_col], "score double, predicted int", make, keep)
