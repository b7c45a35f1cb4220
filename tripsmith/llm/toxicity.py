"""Operator 9: toxicity from class-conditional Kneser-Ney letter models.

Two interpolated, absolutely discounted models of the letters of a word (orders 2 to
``ORDER``), one of toxic and one of ordinary labelled texts.  The longest context that a
class knows (``ORDER`` - 1 letters at most) has the class's counts, each less ``DISCOUNT``;
the mass that this frees goes to lower orders that both classes share, built from
continuation counts: in how many different left contexts a sequence occurs, in either
class.  Sequences seen once count like all others.  A word's
evidence is the difference of its two log-likelihoods.  A text is described by the
length-normalised difference (per letter) over the whole text and over its strongest
window of 1, 3, 10 and 30 words; a logistic fit on held-back labelled rows turns these
into a score.

Fitting takes a bounded sample of the labelled rows: the ``SAMPLE_TOXIC`` and
``SAMPLE_ORDINARY`` rows with the smallest hash of doc_id.  Whole texts are used, and
every row of the table is scored.

Results: one row per input row.  Null and empty texts, and texts without letters,
get the score of neutral evidence.  A doc_id with several labels is toxic if one is;
null labels and ids are not learned from.  Without labelled rows of both classes
every score is 0.0.  Language, source, doc_id and labels never enter a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER, DISCOUNT = 5, 0.75
#: Documented bounds of the labelled sample that the models are fitted on.
SAMPLE_TOXIC, SAMPLE_ORDINARY = 4000, 8000
WINDOWS = (1, 3, 10, 30)
THRESHOLD = 0.3
#: One labelled row in so many is kept back from the counts for the logistic fit.
CALIBRATION_FOLD = 3
CACHE_WORDS = 100_000

_WORD = re.compile(r"[^\W\d_]+")


def grams(word: str) -> list[str]:
    """All letter sequences of 1..ORDER that end at a letter or at the word's end."""
    s = f"^{word}$"
    return [s[j - o + 1:j + 1] for j in range(1, len(s)) for o in range(1, min(ORDER, j + 1) + 1)]


class LetterModels:
    """Both models.  counts: sequence -> (ordinary, toxic)."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        self.counts = counts
        #: context -> total of ordinary and toxic, and how many different letters follow in each
        self.context: dict[str, list[int]] = {}
        #: sequence -> in how many left contexts it occurs in either class
        self.continuations: Counter = Counter(gram[1:] for gram in counts if len(gram) > 1)
        #: context -> total of its continuation counts, and how many different letters follow
        self.lower: dict[str, list[int]] = {}
        for gram, pair in counts.items():
            if len(gram) > 1:
                c = self.context.setdefault(gram[:-1], [0, 0, 0, 0])
                for k in (0, 1):
                    c[k] += pair[k]
                    c[2 + k] += pair[k] > 0
        for gram, n in self.continuations.items():
            c = self.lower.setdefault(gram[:-1], [0, 0])
            c[0] += n
            c[1] += 1
        self.steps: dict[str, float] = {}
        self.words: dict[str, float] = {}

    def probability(self, k: int, gram: str) -> float:
        """Of the last letter after the others, in class k."""
        total, kinds = self.lower.get("", (0, 0))
        lower = [(self.continuations.get(gram[-1], 0) + 0.5) / (total + 0.5 * (kinds + 1))]
        for o in range(2, len(gram)):
            seen = self.lower.get(gram[-o:-1])
            lower.append((max(self.continuations.get(gram[-o:], 0) - DISCOUNT, 0) + DISCOUNT * seen[1] * lower[-1]) / seen[0]
                         if seen else lower[-1])
        for o in range(len(gram), 1, -1):
            seen = self.context.get(gram[-o:-1])
            if seen and seen[k]:
                return (max(self.counts.get(gram[-o:], (0, 0))[k] - DISCOUNT, 0) + DISCOUNT * seen[2 + k] * lower[o - 2]) / seen[k]
        return lower[0]

    def evidence(self, word: str) -> float:
        """Toxic minus ordinary log-likelihood of a word."""
        if (known := self.words.get(word)) is not None:
            return known
        s, d, steps = f"^{word}$", 0.0, self.steps
        for j in range(1, len(s)):
            gram = s[max(0, j - ORDER + 1):j + 1]
            step = steps.get(gram)
            if step is None:
                if len(steps) >= CACHE_WORDS:
                    steps.clear()
                step = steps[gram] = math.log(self.probability(1, gram) / self.probability(0, gram))
            d += step
        if len(word) <= 40:
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            self.words[word] = d
        return d

    def features(self, text: str | None) -> list[float]:
        words = _WORD.findall(text.lower()) if text else []
        if not words:
            return [0.0] * (len(WINDOWS) + 1)
        score = np.concatenate(([0.0], np.cumsum([self.evidence(w) for w in words])))
        size = np.concatenate(([0.0], np.cumsum([len(w) + 1 for w in words])))
        out = [score[-1] / size[-1]]
        for w in WINDOWS:
            w = min(w, len(words))
            out.append(float(((score[w:] - score[:-w]) / (size[w:] - size[:-w])).max()))
        return out


class Scorer:
    """Models and logistic weights; picklable, read-only after fitting."""

    def __init__(self, models: LetterModels | None, mean=None, spread=None, weights=None):
        self.models, self.mean, self.spread, self.weights = models, mean, spread, weights

    def score(self, texts) -> np.ndarray:
        if self.models is None or not len(texts):
            return np.zeros(len(texts))
        x = (np.array([self.models.features(t) for t in texts]) - self.mean) / self.spread
        z = np.clip(x @ self.weights[:-1] + self.weights[-1], -500, 500)
        return 1 / (1 + np.exp(-z))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 30):
    """Ridge-penalised logistic regression by Newton steps on standardised columns."""
    mean, spread = x.mean(0), x.std(0)
    spread = np.where(spread < 1e-6, 1.0, spread)
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    b = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -500, 500)))
        h = z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + penalty * len(x) * np.eye(len(b))
        b = b + np.linalg.solve(h, z.T @ (y - p) - penalty * len(x) * b)
    return mean, spread, b


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample(labels: DataFrame) -> DataFrame:
    """_id, _toxic, _fold of a bounded sample of the rows to learn from."""
    own = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").alias("_toxic"))
           .dropna().where(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
           .withColumn("_h", F.xxhash64("_id")))
    parts = [own.where(F.col("_toxic") == k).orderBy("_h", "_id").limit(n)
             for k, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY))]
    return reduce(DataFrame.unionAll, parts).withColumn("_fold", F.pmod(F.col("_h"), F.lit(CALIBRATION_FOLD)))


def fit(docs: DataFrame, labels: DataFrame) -> Scorer:
    """Fit both models and the logistic weights on the bounded labelled sample."""
    spark = docs.sparkSession
    texts = (docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
             .join(F.broadcast(_sample(labels)), "_id"))  # SAMPLE_TOXIC + SAMPLE_ORDINARY rows at most

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            words: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for toxic, text in zip(part["_toxic"], part["_text"]):
                words[int(toxic)].update(_WORD.findall((text or "").lower()))
            found: dict[str, list[int]] = {}
            for k, counted in words.items():
                for word, n in counted.items():
                    for gram in grams(word):
                        found.setdefault(gram, [0, 0])[k] += n
            yield pd.DataFrame([(g, *c) for g, c in found.items()], columns=["gram", "ordinary", "toxic"])

    counted = (texts.where(F.col("_fold") != 0).mapInPandas(count, "gram string, ordinary long, toxic long")
               .groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")))
    rows = counted.toPandas()  # bounded by the sample: sequences of at most ORDER letters
    models = LetterModels({g: (o, t) for g, o, t in zip(rows["gram"], rows["ordinary"].tolist(), rows["toxic"].tolist())})
    shared = spark.sparkContext.broadcast(models)

    def describe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"y": part["_toxic"].astype(float),
                                "x": [shared.value.features(t) for t in part["_text"]]})

    rest = texts.where(F.col("_fold") == 0).mapInPandas(describe, "y double, x array<double>").toPandas()
    if not rest["y"].nunique() == 2 or not len(rows):
        return Scorer(None)
    return Scorer(models, *logistic(np.stack(rest["x"].to_numpy()), rest["y"].to_numpy()))


def toxic_score(text: Column, scorer: Broadcast) -> Column:
    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(scorer.value.score(part.tolist()))

    return run(text)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    scorer = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), toxic_score(F.col("text"), scorer).alias("score"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
