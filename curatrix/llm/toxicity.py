"""Toxicity by maximum-scoring segments.

Learning: from labelled texts, the log-odds of a word, or of the first bytes of a longer word, between
toxic and clean texts under a Dirichlet prior (an even part and one in proportion to the word's share of
all labelled texts). Its score is the log-odds less a standard error; only clearly positive scores are
kept, and count at every place in a text. All other words cost a small constant, so that scores
drift down in clean text.

Scoring: a linear-time scan over a text finds all maximal scoring segments, the toxic passages.
Calibration: in clean text the best segment of n words follows an extreme-value law, P(S >= s) =
1 - exp(-K n exp(-lambda s)). lambda solves sum p(score) exp(lambda score) = 1 over the clean words, K
is its maximum-likelihood estimate over the clean texts. A passage counts if its expected number of equals in
clean text is small; the strongest passage and the number of passages then give, by a logistic curve
fitted on the same labelled texts, the probability that a text is labelled toxic.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import slices, stored

#: Labelled documents that the model is fitted on: a documented bound. Above it a share of them, taken
#: by a hash of the id, is used.
MAX_TRAINING = 60_000
#: The prior: pseudo-counts a word has anyway, and those in proportion to its share of all words.
EVEN_PRIOR, SHARED_PRIOR = 0.4, 100.0
#: Standard errors that a word's log-odds must keep above the least score. Of a grid, both make the fewest errors over folds
#: inside the training rows of two given corpora; held-out labels took no part.
MARGIN, LEAST_SCORE = 1.0, 2.5
#: Cost of each other word inside a segment.
DRIFT = 0.2
#: Passages are reported up to this many expected equals in clean text.
MAX_EXPECTED = 0.05
#: A document is rejected from this score on.
REJECT_FROM = 0.7
#: Bytes of words to themselves, A-Z to a-z, other ASCII to a space.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


#: A longer word is also known by its beginnings of so many bytes, so that rare inflections of a root count.
BEGINNINGS = (4, 5, 6)
#: Words whose score a worker keeps at hand.
MAX_KNOWN = 500_000


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


def traits_of(word: bytes) -> list[bytes]:
    """The word and its beginnings, these marked by a star, which is in no word."""
    return [word, *(word[:k] + b"*" for k in BEGINNINGS if len(word) > k)]


def segments(places: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score), in order of place.

    ``places`` are the positions of the positively scored words, ascending; all words between cost ``drift``.
    Each candidate keeps the sums before and after it and where the last earlier one with a lower left sum is; it is
    joined with that one and this repeats. The search follows these pointers, so that it steps over
    candidates that no later one can join and takes time in proportion to the scored words.
    """
    kept: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, the one with a lower left sum
    total, last = 0.0, -1
    for at, score in zip(places, scores, strict=True):
        total -= drift * (at - last - 1)
        one = (at, at, total, total + score)
        total += score
        last = at
        while True:
            k = len(kept) - 1
            while k >= 0 and kept[k][2] >= one[2]:
                k = kept[k][4]
            if k < 0 or kept[k][3] >= one[3]:
                kept.append((*one, k))
                break
            one = (kept[k][0], one[1], kept[k][2], one[3])
            del kept[k:]
    return [(a, b, high - low) for a, b, low, high, _ in kept]


@dataclass
class ToxicityModel:
    weights: dict[bytes, float] = field(default_factory=dict)
    drift: float = DRIFT
    decay: float = 1.0
    rate: float = 1.0
    #: Of the logistic curve: constant, strength of the best passage, logarithm of 1 + number of passages.
    curve: tuple[float, float, float] = (-3.0, 0.0, 0.0)

    #: Words met so far and their best trait.
    known: dict[bytes, tuple[bytes, float] | None] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def best_trait(self, word: bytes) -> tuple[bytes, float] | None:
        """The highest scored trait of a word, and its score; None if no trait scores."""
        if len(self.known) >= MAX_KNOWN:
            self.known.clear()
        scored = [(self.weights[t], t) for t in traits_of(word) if t in self.weights]
        best = self.known[word] = (max(scored)[1], max(scored)[0]) if scored else None
        return best

    def expected(self, score: float, n_words: int) -> float:
        """How many segments of this score ``n_words`` of clean text are expected to hold."""
        return self.rate * max(1, n_words) * math.exp(-self.decay * score)

    def hits(self, words: list[bytes]) -> tuple[list[int], list[float]]:
        """The places of all scored words and their scores."""
        known = self.known
        places, scores = [], []
        for k, w in enumerate(words):
            best = known.get(w, self)
            if best is self:
                best = self.best_trait(w)
            if best is not None:
                places.append(k)
                scores.append(best[1])
        return places, scores

    def passages(self, text: str) -> tuple[int, list[tuple[int, int, float, float]]]:
        """(number of words, passages as (first word, last word, score, expected number in clean text))."""
        words = words_of(text)
        return len(words), [(a, b, s, self.expected(s, len(words))) for a, b, s in segments(*self.hits(words), self.drift)]

    def traits(self, n_words: int, passages: list[tuple[int, int, float, float]]) -> tuple[float, float]:
        """(strength, count): minus the logarithm of the least p-value, and log(1 + significant passages)."""
        least = min((e for *_, e in passages), default=float("inf"))
        strength = 0.0 if least == float("inf") else min(40.0, max(0.0, -math.log(-math.expm1(-least)))) if least > 1e-15 else 40.0
        return strength, math.log1p(sum(e <= MAX_EXPECTED for *_, e in passages))

    def probability(self, strength: float, count: float) -> float:
        a, b, c = self.curve
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, a + b * strength + c * count))))


def held_out(id_column: Column) -> Column:
    """Whether crc32 of the id as text, mod 3, is 1; a null id counts as empty text."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, bound: int = MAX_TRAINING) -> DataFrame:
    """(text, toxic) of labelled documents outside the held-out fold, equal texts once.

    Labels that are null are left out; a document with several labels is toxic if one of them says so.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    if n > bound:
        known = known.where(F.pmod(F.xxhash64("label_id", F.lit("sample")), F.lit(1 << 20)) < F.lit(int(bound / n * (1 << 20))))
    # ``bound`` rows of two numbers at most
    pairs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(known), F.col("id") == F.col("label_id"))
    return pairs.groupBy("text").agg(F.max("toxic").alias("toxic")).select("text", "toxic")


def _word_counts(texts: DataFrame) -> DataFrame:
    """(word, n_toxic, n): in how many texts, and how many toxic ones, a word or beginning occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts: Counter = Counter()
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                counts.update((t, toxic) for t in {t for w in set(words_of(text)) for t in traits_of(w)})
            yield pa.record_batch([pa.array([w for w, _ in counts], pa.binary()), pa.array([t for _, t in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())], ["word", "toxic", "n"])

    return texts.mapInArrow(run, "word binary, toxic int, n long").groupBy("word").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("n_toxic"), F.sum("n").alias("n"))


def log_odds(n_toxic: Column, n_clean: Column, total_toxic: float, total_clean: float) -> tuple[Column, Column]:
    """(log-odds, standard error) of a word under the prior."""
    prior = EVEN_PRIOR + SHARED_PRIOR * (n_toxic + n_clean) / F.lit(max(1.0, total_toxic + total_clean))
    t, c = n_toxic + prior, n_clean + prior
    odds = F.log(t / (F.lit(total_toxic + SHARED_PRIOR) - n_toxic + 1)) - F.log(c / (F.lit(total_clean + SHARED_PRIOR) - n_clean + 1))
    return odds, F.sqrt(1 / t + 1 / c)


def solve_decay(masses: list[tuple[float, float]]) -> float:
    """The positive root of sum p exp(x s) = 1 for (score s, share p) with a negative mean, by bisection."""
    at = lambda x: sum(p * math.exp(min(700.0, x * s)) for s, p in masses) - 1.0
    low, high = 0.0, 1.0
    while at(high) < 0 and high < 50:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if at(middle) < 0 else (low, middle)
    return max(high, 1e-3)


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; the first column of ``x`` is the constant."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = MAX_TRAINING) -> ToxicityModel:
    """The model of labelled documents outside the held-out fold. Labels of one kind only, or none, give a
    model without words, which scores all texts alike and low."""
    texts = stored(training_texts(docs, labels, id_col, text_col, bound), "toxicity")
    sizes = {r.toxic: r.n for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return ToxicityModel()
    counts = _word_counts(texts).select("word", F.col("n_toxic").cast("double").alias("t"), (F.col("n") - F.col("n_toxic")).cast("double").alias("c"))
    counts = stored(counts, "toxicity-words")
    totals = counts.agg(F.sum("t"), F.sum("c")).first()
    odds, error = log_odds(F.col("t"), F.col("c"), totals[0], totals[1])
    score = odds - F.lit(MARGIN) * error
    # words of a bounded sample of texts, and of these the few that speak clearly
    lexicon = counts.select("word", "c", score.alias("score")).where(F.col("score") >= LEAST_SCORE).collect()
    model = ToxicityModel({bytes(r.word): r.score for r in lexicon})
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in slices(batches, "text"):
            rows = []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                places, scores = own.hits(words)
                times = Counter(scores)
                rows.append((len(words), [s for _, _, s in segments(places, scores, own.drift)], list(times), list(times.values())))
            lists = [pa.array([r[k] for r in rows], pa.list_(kind)) for k, kind in ((1, pa.float64()), (2, pa.float64()), (3, pa.int64()))]
            yield pa.record_batch([batch.column("toxic"), pa.array([r[0] for r in rows], pa.int64()), *lists], ["toxic", "n_words", "scores", "marks", "times"])

    table = stored(texts.select("text", "toxic").mapInArrow(best, "toxic int, n_words long, scores array<double>, marks array<double>, times array<long>"), "toxicity-scores")
    clean = table.where("toxic <> 1")
    clean_words = max(1, clean.agg(F.sum("n_words")).first()[0] or 0)
    seen = Counter({r.score: 0.5 for r in lexicon})
    # one row for each score that the lexicon knows
    for r in clean.select(F.explode(F.arrays_zip("marks", "times")).alias("m")).groupBy("m.marks").agg(F.sum("m.times").alias("n")).collect():
        seen[r.marks] += r.n
    masses = [(s, n / clean_words) for s, n in seen.items()]
    model.decay = solve_decay([*masses, (-model.drift, max(0.0, 1 - sum(p for _, p in masses)))])
    words, top = F.greatest("n_words", F.lit(1)), F.array_max("scores")
    model.rate = clean.agg(F.count("*") / F.sum(words * F.exp(-F.lit(model.decay) * F.coalesce(top, F.lit(0.0))))).first()[0]
    expected = lambda score: F.lit(model.rate) * words * F.exp(-F.lit(model.decay) * score)
    strength = F.when(top.isNull(), 0.0).when(expected(top) <= 1e-15, 40.0).otherwise(F.least(F.lit(40.0), F.greatest(F.lit(0.0), -F.log(-F.expm1(-expected(top))))))
    count = F.log1p(F.size(F.filter("scores", lambda s: expected(s) <= MAX_EXPECTED)))
    # three numbers for each of at most ``bound`` texts
    rows = table.select(strength.alias("strength"), count.alias("count"), (F.col("toxic") == 1).alias("toxic")).collect()
    traits = np.array([(1.0, r.strength, r["count"]) for r in rows])
    model.curve = tuple(fit_curve(traits, np.array([r.toxic for r in rows], float)))
    return model


SCORED = "n_words long, score double, passages array<struct<first_word:int,last_word:int,score:double,expected:double>>"


def score_texts(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_words, score (0 to 1) and passages, the significant toxic ones.

    Whole texts; null and empty ones have no passages and the score of such texts. Repeated rows are kept;
    only the text is looked at, other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in slices(batches, "text"):
            rows = [own.passages(t or "") for t in batch.column("text").to_pylist()]
            scores = [own.probability(*own.traits(n, p)) for n, p in rows]
            kept = [[dict(zip(("first_word", "last_word", "score", "expected"), x, strict=True)) for x in p if x[3] <= MAX_EXPECTED] for _, p in rows]
            yield pa.record_batch([batch.column("id"), pa.array([n for n, _ in rows], pa.int64()), pa.array(scores, pa.float64()), pa.array(kept, kind)], ["id", "n_words", "score", "passages"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, {SCORED}").withColumnRenamed("id", id_col)


def reject_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", reject_from: float = REJECT_FROM) -> DataFrame:
    """The rows of ``docs`` whose text scores under ``reject_from``, all columns unchanged, whatever their names.

    Null and empty texts score as texts without passages and stay; repeated rows stay or go together. Labels of ids
    that ``docs`` lacks, null labels and null ids of labels are not used; an empty table gives an empty table.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col))

    @F.pandas_udf("double")
    def score(texts):  # noqa: ANN001, ANN202
        own = sent.value
        return texts.map(lambda t: own.probability(*own.traits(*own.passages(t or ""))))

    return docs.where(score(F.coalesce(F.col(text_col).cast("string"), F.lit(""))) < reject_from)
