"""Toxicity severity by cumulative-link ordinal regression over sparse features (words and beginnings of words).

P(grade >= k) = sigmoid(w.x - t_k), with one weight vector shared by all thresholds t_1 < t_2.  ``labels.toxic`` only
says yes or no, so the grades to learn are 0 (not toxic), and 1 or 2 for toxic rows whose amount of features typical of
toxic rows lies below or above its median.  The expected severity is the sum of P(grade >= k).

Defined cases: null text counts as empty; a text without known words gets the base probabilities; repeated rows get
equal results; without toxic or without other labels nothing is called toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, held_out, labelled_sample, query, table
from millrace.session import ship_with_tasks

ship_with_tasks(__name__)

# Labelled rows the model is fitted on, and features that get a weight, at most.
SAMPLE_ROWS = 20_000
VOCABULARY = 5_000
# Only features in this share of the sample, and with a chi-square that chance does not give among 100,000 words.
MIN_SHARE, MIN_CHI = 0.001, 20.0
GRADES = 3
STEPS, RATE, RIDGE = 800, 0.05, 3e-5
THRESHOLD = 0.5

WORD = re.compile(r"[^\W\d_]+")


# Letters of the beginnings of words that are features too: insults are inflected and compounded.
STEMS = range(4, 8)


def words(text: str) -> Counter:
    return Counter(WORD.findall(text.lower()))


def word_features(word: str) -> list[str]:
    return [word, *(word[:k] + "-" for k in STEMS if k < len(word))]


def known_features(counts: Counter, known, memory: dict[str, tuple]) -> Counter:
    """How often each feature in ``known`` occurs; ``memory`` keeps what was found out about a word."""
    if len(memory) > 500_000:
        memory.clear()
    out: Counter = Counter()
    for word, n in counts.items():
        found = memory.get(word)
        if found is None:
            found = memory[word] = tuple(f for f in word_features(word) if f in known)
        for feature in found:
            out[feature] += n
    return out


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: np.ndarray

    def tails(self, counts: Counter, memory: dict[str, tuple] | None = None) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        found = known_features(counts, self.weights, {} if memory is None else memory)
        z = sum(self.weights[f] * (1.0 + np.log(n)) for f, n in sorted(found.items())) - self.thresholds
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_ordinal(row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of highest penalised likelihood, by full-batch gradient steps (Adam).

    The entries (row, column, value) are the sparse features.  Thresholds are kept ordered by learning the first and
    the logarithms of the gaps.
    """
    shares = np.array([(grade >= k).mean() for k in range(1, GRADES)]).clip(1e-4, 1 - 1e-4)
    start = np.log(1 / shares - 1)
    theta = np.concatenate([np.zeros(width), start[:1], np.log(np.diff(start).clip(1e-2))])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    n, here = len(grade), np.arange(len(grade))
    for step in range(1, STEPS + 1):
        w, cuts = theta[:width], theta[width] + np.concatenate([[0.0], np.cumsum(np.exp(theta[width + 1:]))])
        z = np.bincount(row, w[column] * value, n)
        tail = z[:, None] - cuts
        upper = np.concatenate([np.ones((n, 1)), _sigmoid(tail), np.zeros((n, 1))], 1)
        rest = np.concatenate([np.zeros((n, 1)), _sigmoid(-tail), np.ones((n, 1))], 1)
        # The slope of log(high - low); these forms stay exact where both are almost 0 or 1.
        by_z = rest[here, grade] - upper[here, grade + 1]
        apart = 1 - np.concatenate([[0.0], np.exp(-np.diff(cuts)), [0.0]])[grade]
        dhigh = rest[here, grade] / (rest[here, grade + 1] * apart)
        dlow = upper[here, grade + 1] / (upper[here, grade] * apart)
        by_cut = np.array([(dlow[grade == k - 1].sum() - dhigh[grade == k].sum()) for k in range(1, GRADES)])
        gaps = np.exp(theta[width + 1:]) * np.cumsum(by_cut[::-1])[::-1][1:]
        slope = np.concatenate([np.bincount(column, by_z[row] * value, width) / n - RIDGE * w, [by_cut.sum() / n], gaps / n])
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
        theta = theta + RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:width], theta[width] + np.concatenate([[0.0], np.cumsum(np.exp(theta[width + 1:]))])


def typical_words(sample: DataFrame, limit: int = VOCABULARY) -> pd.DataFrame:
    """The words whose presence differs most between toxic and other rows (chi-square), at most ``limit``."""

    def counted(batches):
        for batch in batches:
            toxic, all_rows = Counter(), Counter()
            for text, label in zip(batch["text"], batch["label"], strict=True):
                found = {f for w in words(text) for f in word_features(w)}
                all_rows.update(found)
                if label:
                    toxic.update(found)
            yield pd.DataFrame({"word": list(all_rows), "hits": [toxic[w] for w in all_rows], "n": list(all_rows.values())})

    sizes = sample.agg(F.count("*").alias("all"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic"))
    sums = sample.mapInPandas(counted, "word string, hits long, n long").groupBy("word").agg(F.sum("hits").alias("a"), F.sum("n").alias("n"))
    expected = F.col("n") * F.col("toxic") / F.col("all")
    share = F.col("toxic") / F.col("all")
    return (
        sums.join(F.broadcast(sizes)).where((F.col("n") >= F.greatest(F.lit(3), F.col("all") * MIN_SHARE)) & (share > 0) & (share < 1))
        .select("word", (F.col("a") > expected).alias("toxic_side"), (F.pow(F.col("a") - expected, 2) / (expected * (1 - share))).alias("chi"))
        .where(F.col("chi") > MIN_CHI).orderBy(F.desc("chi"), "word").limit(limit).toPandas()
    )


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents; the driver gets counts of the chosen words only."""
    bound_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, "toxic", rows)
    vocabulary = typical_words(sample).sort_values("word")
    place = {w: i for i, w in enumerate(vocabulary["word"])}
    typical = set(vocabulary["word"][vocabulary["toxic_side"].astype(bool)])

    def sparse(batches):
        memory: dict[str, tuple] = {}
        for batch in batches:
            out = []
            for doc_id, text, label in zip(batch["doc_id"], batch["text"], batch["label"], strict=True):
                counts = words(text)
                found = sorted(known_features(counts, place, memory).items())
                strength = float(sum(1.0 + np.log(n) for f, n in found if f in typical))
                out.append((doc_id, label, strength, [place[f] for f, _ in found], [1.0 + float(np.log(n)) for _, n in found]))
            yield pd.DataFrame(out, columns=["doc_id", "label", "strength", "at", "value"])

    if not place:
        return Model({}, np.array([30.0] * (GRADES - 1)))
    kind = "doc_id long, label int, strength double, at array<int>, value array<double>"
    found = sample.mapInPandas(sparse, kind).toPandas().sort_values(["doc_id", "label", "strength"], kind="stable")
    toxic = found["label"].to_numpy() > 0
    strength = found["strength"].to_numpy()
    grade = np.where(toxic, np.where(strength > np.median(strength[toxic]), 2, 1), 0)
    row = np.repeat(np.arange(len(found)), found["at"].map(len))
    weights, thresholds = fit_ordinal(
        row, np.concatenate(found["at"].to_numpy()).astype(int), np.concatenate(found["value"].to_numpy()), grade, len(place)
    )
    return Model({w: float(weights[i]) for w, i in place.items()}, thresholds)


def severity_column(spark: SparkSession, model: Model, text: str = "text") -> Column:
    """P(grade >= k) for each k, as an array."""
    bound_batches(spark)
    known = spark.sparkContext.broadcast(model)  # at most VOCABULARY weights
    kept: dict[int, dict[str, tuple]] = {}

    @F.pandas_udf("array<double>")
    def graded(texts: pd.Series) -> pd.Series:
        model, memory = known.value, kept.setdefault(0, {})
        return pd.Series([model.tails(words(x), memory) for x in texts])

    return graded(F.coalesce(F.col(text), F.lit("")))


@query("op1_toxicity_ordinal")
def op1_toxicity_ordinal(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, held_out, p_mild and p_severe (P(grade >= 1), P(grade >= 2)), severity (0 to 2), score (p_mild), toxic, predicted."""
    docs = table(spark, folder, "documents")
    model = train(docs, table(spark, folder, "labels"))
    tails = docs.select("doc_id", held_out().alias("held_out"), severity_column(spark, model).alias("tails"))
    return tails.select(
        "doc_id", "held_out", F.col("tails")[0].alias("p_mild"), F.col("tails")[1].alias("p_severe"),
        (F.col("tails")[0] + F.col("tails")[1]).alias("severity"), F.col("tails")[0].alias("score"),
        (F.col("tails")[0] >= THRESHOLD).alias("toxic"), (F.col("tails")[0] >= THRESHOLD).cast("int").alias("predicted"),
    )
