"""Toxic passages by maximum-scoring segments, and a toxicity score of whole texts.

Every word has a score: the log-odds, between toxic and other texts, of the most telling of its units, which are
the word and its first few letters (inflected and disguised forms share them). The log-odds are taken under
Dirichlet priors, one for each class, that agree on every unit (so one seen by chance weighs nothing), at
the cautious end of their standard error, less a drift that makes ordinary text score below zero. A linear scan finds all
maximal segments of a text (Ruzzo and Tompa). Segment scores of ordinary text follow an extreme-value
law: with its ``scale`` and ``size``, fitted on the texts labelled not toxic, a segment of score S in a text of n
words is expected size * n * exp(-scale * S) times by chance. A text's evidence is made of the expectations of its best segment and of all
significant ones, and a logistic fit turns it into a score from 0 to 1.

The classifier is fitted on the ``SAMPLE_ROWS`` labelled rows with the smallest hashes of their ids; it holds one
number for each word of these rows that tells anything. All texts are scored whole.

Defined results: a null or blank text has no segments and gets the score of no evidence; if the labels lack one of
the classes, every text gets the same score (0, or 1 if all are toxic); rows of the labels with nulls are not learnt from;
repeated rows get the same answer each; label, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reportgrid.sources.staging import staged

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE_ROWS = 20_000
#: Weight of the prior, in texts for each unit; both classes share it by their sizes.
PRIOR = 5.0
#: Standard errors that a unit's log-odds are moved towards zero.
CAUTION = 1.96
#: What each word costs.
DRIFT = 0.4
#: Words whose log-odds stay below this tell nothing and are not kept.
LEAST = 0.1
#: A segment expected less often than this by chance is significant.
SIGNIFICANT = 0.01
#: Lengths of the beginnings of words that are units too.
STEMS = (4, 5, 6)
#: Word scores that a task remembers.
REMEMBERED = 400_000
WORD = re.compile(r"\w+")
EULER = 0.5772156649015329


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def units(word: str) -> list[str]:
    return [word, *[word[:n] + "*" for n in STEMS if len(word) >= n]]


def held_out(id_: Column, folds: int = 5) -> Column:
    """Whether a row is kept from learning: the checksum of its id as text is divisible by ``folds``."""
    return F.crc32(id_.cast("string").cast("binary")) % folds == 0


def segments(scores: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, as (first, last, score), in one pass and linear time.

    A held segment knows the nearest one before it with a smaller sum before it. Where there is none for a new segment,
    nothing that is held can grow any more: it is closed.
    ``scores`` has the words that score above ``-drift`` or below it, by place; every other word costs ``drift``.
    """
    found: list[list[float]] = []
    held: list[list[float]] = []  # first, last, sum before, sum after, place of the nearest smaller sum before
    total, place = 0.0, 0
    for at, score in scores:
        total -= drift * (at - place)
        place = at + 1
        before = total
        total += score
        if score <= 0:
            continue
        new = [at, at, before, total, -1]
        k = len(held) - 1
        while True:
            while k >= 0 and held[k][2] >= new[2]:
                k = held[k][4]
            if k < 0:
                found += held
                held = [new]
                new[4] = -1
                break
            if held[k][3] >= new[3]:
                new[4] = k
                held.append(new)
                break
            new = [held[k][0], new[1], held[k][2], new[3], -1]
            below = held[k][4]
            del held[k:]
            k = below
    return [(int(a), int(b), right - left) for a, b, left, right, _ in found + held]


#: What most pieces hold: one word that tells nothing.
PLAIN = (1, ())


class Pieces(dict):
    """For each piece of text without white space: its number of words, and the scores of those that tell something."""

    def __init__(self, told: dict[str, float]):
        self.told = told

    def __missing__(self, piece: str) -> tuple[int, list[tuple[int, float]]]:
        words = WORD.findall(piece)
        scores = [(k, s) for k, w in enumerate(words) if (s := self.word_score(w)) is not None]
        found = self[piece] = PLAIN if len(words) == 1 and not scores else (len(words), scores)
        return found

    def word_score(self, word: str) -> float | None:
        """Of the unit with the largest log-odds either way; none for a word that tells nothing."""
        found = [s for u in units(word) if (s := self.told.get(u)) is not None]
        return max(found, key=abs) - DRIFT if found else None


@dataclass
class Model:
    told: dict[str, float]
    scale: float
    size: float
    weights: tuple[float, float, float]

    def __post_init__(self) -> None:
        self._seen = Pieces(self.told)

    def passages(self, text: str | None) -> tuple[int, list[tuple[int, int, float, float]]]:
        """How many words the text has; its segments with the logarithm of how often each is expected."""
        seen = self._seen
        if len(seen) > REMEMBERED:
            seen.clear()
        n, hits = 0, []
        for words, told in [seen[piece] for piece in (text or "").lower().split()]:
            for at, score in told:
                hits.append((n + at, score))
            n += words
        base = math.log(max(self.size, 1e-300)) + math.log(max(n, 1))
        return n, [(a, b, s, base - self.scale * s) for a, b, s in segments(hits, DRIFT)]

    def evidence(self, found: list[tuple[int, int, float, float]]) -> tuple[float, float]:
        """Of the best segment, and of all significant ones together; both zero or more, and bounded."""
        best = max((-e for *_, e in found), default=0.0)
        limit = math.log(SIGNIFICANT)
        return min(max(best, 0.0), 60.0) / 10, min(sum(-e for *_, e in found if e < limit), 300.0) / 30

    def score(self, found: list[tuple[int, int, float, float]]) -> float:
        x, y = self.evidence(found)
        a, b, c = self.weights
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, a + b * x + c * y))))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each class a unit occurs: a text that repeats one word thousands of times counts once."""
    seen = [Counter(), Counter()]
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1)):
            seen[toxic.as_py()].update({u for w in set(tokens(text.as_py())) for u in units(w)})
    words = sorted(seen[0].keys() | seen[1].keys())
    for k in range(0, len(words), 50_000):
        part = words[k : k + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), *[pa.array([c[w] for w in part], pa.int64()) for c in seen]],
            names=["word", "other", "toxic"],
        )


def _scale(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root x of sum(share * exp(score * x)) = 1."""

    def over(x: float) -> float:
        return float(np.sum(shares * np.exp(np.minimum(scores * x, 500)))) - 1

    low, high = 1e-3, 1.0
    while over(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if over(mid) < 0 else (low, mid)
    return (low + high) / 2


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic fit with a small penalty, by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(train: DataFrame) -> Model | float:
    """From columns ``text`` and ``toxic`` (0 or 1) of a bounded frame; a number if it lacks a class."""
    counts = train.mapInArrow(_count, "word string, other long, toxic long").groupBy("word").agg(
        F.sum("other").alias("other"), F.sum("toxic").alias("toxic")
    )
    n0, n1 = counts.agg(F.sum("other"), F.sum("toxic")).first()
    if not n0 or not n1:
        return 1.0 if n1 else 0.0
    n = n0 + n1
    prior1, prior0 = PRIOR * n1 / n, PRIOR * n0 / n
    odds = F.log((F.col("toxic") + prior1) / n1) - F.log((F.col("other") + prior0) / n0)
    error = F.sqrt(1 / (F.col("toxic") + prior1) + 1 / (F.col("other") + prior0))
    told = counts.withColumn("odds", odds).withColumn(
        "odds", F.signum("odds") * F.greatest(F.abs("odds") - CAUTION * error, F.lit(0.0))
    )
    kept = told.filter(F.abs("odds") >= LEAST).withColumn("share", F.col("other") / n0)
    rows = kept.select("word", "odds", "share").toPandas()
    scores = rows["odds"].to_numpy() - DRIFT
    shares = rows["share"].to_numpy()
    if not (scores > 0).any():
        return n1 / (n0 + n1)
    scale = _scale(np.append(scores, -DRIFT), np.append(shares, max(1 - shares.sum(), 0)))
    draft = Model(dict(zip(rows["word"], rows["odds"].tolist())), scale, 1.0, (0.0, 0.0, 0.0))
    sent = train.sparkSession.sparkContext.broadcast(astuple(draft))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for batch in batches:
            found = [model.passages(t) for t in batch.column(0).to_pylist()]
            tops = [max((s for _, _, s, _ in segs), default=0.0) for _, segs in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in found], pa.int64()), pa.array(tops, pa.float64())], names=["n", "top"]
            )

    # the law of the extreme values: the mean of scale * top - log(n) over ordinary texts is log(size) + Euler's constant
    ordinary = train.filter("toxic = 0").select("text").mapInArrow(best, "n long, top double")
    mean = ordinary.filter("n > 0").agg(F.avg(scale * F.col("top") - F.log("n"))).first()[0]
    draft.size = math.exp(min((mean if mean is not None else 0.0) - EULER, 0.0))
    sent = train.sparkSession.sparkContext.broadcast(astuple(draft))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        for batch in batches:
            found = [model.evidence(model.passages(t)[1]) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64()), batch.column(1)],
                names=["x", "y", "toxic"],
            )

    seen = train.mapInArrow(features, "x double, y double, toxic int").toPandas()
    x = np.column_stack([np.ones(len(seen)), seen["x"], seen["y"]])
    draft.weights = tuple(_logistic(x, seen["toxic"].to_numpy(float)).tolist())
    return draft


def training_rows(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Texts and labels of the labelled rows not held out, ``sample_rows`` at most, chosen by hash.

    Equal texts are one row, with the label that most of them have; toxic where as many have either.
    """
    ids = labels.select(F.col(id_col).alias("label_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        "label_id IS NOT NULL AND toxic IN (0, 1)"
    )
    ids = ids.filter(~held_out(F.col("label_id"))).groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    ids = ids.orderBy(F.xxhash64("label_id"), "label_id").limit(sample_rows)
    rows = docs.select(F.col(id_col).alias("row_id"), F.col(text_col).cast("string").alias("text"))
    # at most sample_rows pairs of two numbers: bounded, whatever the tables hold
    rows = rows.join(F.broadcast(ids), F.col("row_id") == F.col("label_id"))
    return rows.groupBy("text").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))


def add_score(docs: DataFrame, model: Model | float, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, and ``toxicity`` and ``passages``: the significant ones as first word, last word and expectation."""
    sent = docs.sparkSession.sparkContext.broadcast(model if isinstance(model, float) else astuple(model))
    columns = [c for c in docs.columns if c not in ("toxicity", "passages")]
    at = columns.index(text_col)
    shape = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("expected", pa.float64())]))
    limit = math.log(SIGNIFICANT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = None if isinstance(sent.value, float) else Model(*sent.value)
        for batch in batches:
            scores, passages = [], []
            for text in batch.column(at).to_pylist():
                if fitted is None:
                    scores.append(sent.value)
                    passages.append([])
                    continue
                _, found = fitted.passages(text)
                scores.append(fitted.score(found))
                passages.append(
                    [{"first": a, "last": b, "expected": math.exp(max(e, -700))} for a, b, _, e in found if e < limit]
                )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array(passages, shape)],
                names=[*columns, "toxicity", "passages"],
            )

    rows = docs.select(*columns)
    added = StructType.fromDDL("toxicity double, passages array<struct<first:int,last:int,expected:double>>")
    return rows.mapInArrow(run, StructType([*rows.schema.fields, *added.fields]))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``held_out``, ``score`` and ``predicted``, learnt from the rows that are not held out."""
    model = fit(staged(training_rows(docs, labels, id_col=id_col, text_col=text_col)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = add_score(rows, model)
    return found.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )
