"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting: round after round, each feature in turn gets one shallow tree on its bins, and the tree's leaf values
are added to the feature's lookup table.  Then the pairs of features that explain most of what is left get
two-dimensional tables in the same way.  A score is a sum of table entries, so scoring is a few vectorised additions.

Defined cases: null text counts as empty; empty and white-space texts have all features zero and still get a score;
repeated rows get equal scores; without labels of both kinds every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

import itertools
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bound_batches, held_out, labelled_sample, query, table
from millrace.session import ship_with_tasks

ship_with_tasks(__name__)

FEATURES = (
    "words", "word_length", "distinct_words", "top_word", "repeated_triples", "repeated_lines", "symbols", "marks",
    "exclamations", "capitals", "digits", "shouted",
)
# Labelled rows the model is fitted on, at most.
SAMPLE_ROWS = 20_000
# A document with a lower score is predicted to be of label 0.
THRESHOLD = 0.7
BINS, PAIR_BINS, PAIRS = 48, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1

SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
MARKS = np.frombuffer(b".,;:?'\"()-", np.uint8)


def features(text: str) -> list[float]:
    """The numbers a text is judged by; every share lies between 0 and 1."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    of_byte = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    solid = int(of_byte[33:128].sum() + of_byte[192:].sum())
    counts = Counter(words)
    triples = len(words) - 2
    distinct = len(set(zip(words, words[1:], words[2:], strict=False))) if triples > 0 else 0
    lines = [x for x in text.split("\n") if x.strip()]
    capitals = int(of_byte[65:91].sum())
    letters = capitals + int(of_byte[97:123].sum())
    return [
        float(np.log1p(len(words))), solid / len(words), len(counts) / len(words), max(counts.values()) / len(words),
        1 - distinct / triples if triples > 0 else 0.0, 1 - len(set(lines)) / len(lines),
        int(of_byte[SYMBOLS].sum()) / len(words), int(of_byte[MARKS].sum()) / len(words), int(of_byte[33]) / len(words),
        capitals / max(1, letters), int(of_byte[48:58].sum()) / max(1, solid), sum(map(str.isupper, words)) / len(words),
    ]


def feature_matrix(texts) -> np.ndarray:
    return np.array([features(x or "") for x in texts], float).reshape(len(texts), len(FEATURES))


@dataclass
class Model:
    """Lookup tables over binned features.  ``cuts[j]`` are the inner edges of feature j's bins."""

    intercept: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, own in enumerate(self.tables):
            total += own[np.searchsorted(self.cuts[j], x[:, j], "right")]
        for (i, j), own in self.pairs.items():
            total += own[np.searchsorted(self.coarse[i], x[:, i], "right"), np.searchsorted(self.coarse[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g, h):
    return g * g / (h + 1.0)


def _best_split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The gain and place of the best cut of a run of bins."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gains))
    return float(gains[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values, bin by bin, of a tree of ``depth`` on one feature's gradient and curvature histograms."""
    gain, at = _best_split(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + 1.0))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree that cuts a two-dimensional histogram once along each axis."""
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    big_g, big_h = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0))), np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))

    def parts(big):
        inner, right, low = big[1:-1, 1:-1], big[1:-1, -1:], big[-1:, 1:-1]
        return inner, right - inner, low - inner, big[-1, -1] - right - low + inner

    gains = sum(_gain(a, b) for a, b in zip(parts(big_g), parts(big_h), strict=True)) - _gain(g.sum(), h.sum())
    r, c = np.unravel_index(int(np.argmax(gains)), gains.shape)
    leaves = np.zeros_like(g)
    for rows, columns in itertools.product((slice(0, r + 1), slice(r + 1, None)), (slice(0, c + 1), slice(c + 1, None))):
        leaves[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + 1.0)
    return float(gains[r, c]), leaves


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit on a bounded sample held in memory.  The same rows in the same order give the same model."""
    if len(y) == 0 or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        return Model(float(np.log(share / (1 - share))))
    total = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    model = Model(float(total[0]))
    model.cuts = [_cuts(x[:, j], BINS) for j in range(x.shape[1])]
    model.coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.cuts)]
    rough = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(model.coarse)]

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, own in enumerate(bins):
            g, h = slopes()
            step = RATE * _tree(np.bincount(own, g, len(model.tables[j])), np.bincount(own, h, len(model.tables[j])))
            model.tables[j] += step
            total += step[own]

    def square(i, j, weights):
        shape = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
        return np.bincount(rough[i] * shape[1] + rough[j], weights, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    found = {(i, j): _pair_tree(square(i, j, g), square(i, j, h))[0] for i, j in itertools.combinations(range(x.shape[1]), 2)}
    chosen = sorted((p for p in found if found[p] > 1e-9), key=lambda p: (-found[p], p))[:PAIRS]
    model.pairs = {p: np.zeros((len(model.coarse[p[0]]) + 1, len(model.coarse[p[1]]) + 1)) for p in chosen}
    for _ in range(PAIR_ROUNDS):
        for i, j in chosen:
            g, h = slopes()
            step = RATE * _pair_tree(square(i, j, g), square(i, j, h))[1]
            model.pairs[i, j] += step
            total += step[rough[i], rough[j]]
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents; only their features reach the driver."""
    names = ", ".join(f"{x} double" for x in FEATURES)

    def measure(batches):
        for batch in batches:
            out = pd.DataFrame(feature_matrix(batch["text"]), columns=FEATURES)
            out["doc_id"], out["label"] = batch["doc_id"].to_numpy(), batch["label"].to_numpy()
            yield out

    bound_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, "quality", rows)
    found = sample.mapInPandas(measure, f"{names}, doc_id long, label int").toPandas()
    found = found.sort_values(["doc_id", "label", *FEATURES], kind="stable")
    return fit(found[list(FEATURES)].to_numpy(float), found["label"].to_numpy(float))


def score_column(spark: SparkSession, model: Model, text: str = "text") -> Column:
    """The score of a text, 0 to 1; higher means label 1 is likelier."""
    bound_batches(spark)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(feature_matrix(texts)))

    return scored(F.coalesce(F.col(text), F.lit("")))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents predicted to be of label 1, with their columns unchanged."""
    return docs.where(score_column(docs.sparkSession, model) >= threshold)


@query("op10_quality_gam")
def op10_quality_gam(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train(docs, table(spark, folder, "labels"))
    return docs.select("doc_id", held_out().alias("held_out"), score_column(spark, model).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
