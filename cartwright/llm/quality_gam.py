"""Quality classifier: a generalised additive model with pairwise interactions."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import broadcast_if_small, saved
from cartwright.llm.text_measures import _WORD, base_measures, measured

BINS = 32
PAIR_BINS = 8

# Characters of a kind, counted as a share of all.
_SHARES = {
    "upper": re.compile(r"[A-ZÀ-ÖØ-Þ]"),
    "digit": re.compile(r"[0-9]"),
    "bar": re.compile(r"\|"),
    "mark": re.compile(r"[!?]"),
    "comma": re.compile(r"[,;:]"),
    "stop": re.compile(r"[.]"),
    "space": re.compile(r"[\x20\x09-\x0D]"),
    "letter": re.compile(r"[^\W\d_]"),
}
FEATURES = (
    "log_words",
    "word_length",
    "symbols",
    "dup_lines",
    "repeats",
    "distinct",
    "commonest",
    "line_words",
    *_SHARES,
)


def features(text: str | None) -> tuple[float, ...]:
    """In the order of FEATURES; all are defined for an empty text too. NULL counts as empty."""
    text = text or ""
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = base_measures(text)
    words, chars = max(n_words, 1), max(len(text), 1)
    counts = Counter(_WORD.findall(text.lower()))
    lines = text.count("\n") + 1
    return (
        float(np.log1p(n_words)),
        word_chars / words,
        n_symbols / chars,
        n_dup_lines / lines,
        n_repeat_words / words,
        len(counts) / words,
        max(counts.values(), default=0) / words,
        n_words / lines,
        *(len(kind.findall(text)) / chars for kind in _SHARES.values()),
    )


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _best_cut(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins into two leaves."""
    g, h = np.cumsum(gradient), np.cumsum(weight)
    left, right = g[:-1] ** 2 / (h[:-1] + 1), (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1)
    if not len(left):
        return 0.0, 0
    gain = left + right - g[-1] ** 2 / (h[-1] + 1)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _shallow_tree(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The values of a tree of at most four leaves over the bins of one feature."""
    cuts, parts = {0, len(gradient)}, [(0, len(gradient))]
    for _ in range(2):
        for a, b in list(parts):
            gain, at = _best_cut(gradient[a:b], weight[a:b])
            if gain > 1e-9:
                cuts.add(a + at)
        parts = list(zip(sorted(cuts)[:-1], sorted(cuts)[1:]))
    tree = np.zeros(len(gradient))
    for a, b in parts:
        tree[a:b] = gradient[a:b].sum() / (weight[a:b].sum() + 1)
    return tree


def _pair_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts each of two features once."""
    g = np.zeros(np.add(gradient.shape, 1))
    h = np.zeros_like(g)
    g[1:, 1:], h[1:, 1:] = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    best, cut = 0.0, None
    whole = g[-1, -1] ** 2 / (h[-1, -1] + 1)
    for i in range(1, gradient.shape[0]):
        for j in range(1, gradient.shape[1]):
            gain = -whole
            for a, b, c, d in ((0, i, 0, j), (0, i, j, -1), (i, -1, 0, j), (i, -1, j, -1)):
                gain += (g[b, d] - g[a, d] - g[b, c] + g[a, c]) ** 2 / (
                    h[b, d] - h[a, d] - h[b, c] + h[a, c] + 1
                )
            if gain > best:
                best, cut = float(gain), (i, j)
    tree = np.zeros(gradient.shape)
    if cut:
        for rows in (slice(0, cut[0]), slice(cut[0], None)):
            for columns in (slice(0, cut[1]), slice(cut[1], None)):
                tree[rows, columns] = gradient[rows, columns].sum() / (weight[rows, columns].sum() + 1)
    return best, tree


class AdditiveModel:
    """Lookup tables: one per feature and one per pair, added up and squashed to a score."""

    def __init__(self, rounds: int = 150, pair_rounds: int = 40, pairs: int = 6, rate: float = 0.1):
        self.rounds, self.pair_rounds, self.n_pairs, self.rate = rounds, pair_rounds, pairs, rate
        self.base = 0.0
        self.edges: list[np.ndarray] = []
        self.tables: list[np.ndarray] = []
        self.coarse: list[np.ndarray] = []
        self.pairs: dict[tuple[int, int], np.ndarray] = {}

    def fit(self, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        """Boost one feature after the other, round by round, then the pairs that explain most of the rest."""
        if not len(y):
            return self
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        self.edges = [_edges(column, BINS) for column in x.T]
        self.coarse = [_edges(column, PAIR_BINS) for column in x.T]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        if share <= 1e-3 or share >= 1 - 1e-3:
            return self
        bins, wide = self._bins(x, self.edges), self._bins(x, self.coarse)
        total = np.full(len(y), self.base)
        for _ in range(self.rounds):
            for k, table in enumerate(self.tables):
                gradient, weight = self._slopes(total, y)
                size = len(table)
                tree = self.rate * _shallow_tree(
                    np.bincount(bins[k], gradient, size), np.bincount(bins[k], weight, size)
                )
                table += tree
                total += tree[bins[k]]

        def grid(i: int, j: int) -> tuple[np.ndarray, tuple[int, int]]:
            shape = len(self.coarse[i]) + 1, len(self.coarse[j]) + 1
            return wide[i] * shape[1] + wide[j], shape

        def tree_of(i: int, j: int) -> tuple[float, np.ndarray]:
            cell, shape = grid(i, j)
            gradient, weight = self._slopes(total, y)
            size = shape[0] * shape[1]
            return _pair_tree(
                np.bincount(cell, gradient, size).reshape(shape),
                np.bincount(cell, weight, size).reshape(shape),
            )

        ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda p: -tree_of(*p)[0])
        self.pairs = {p: np.zeros(grid(*p)[1]) for p in ranked[: self.n_pairs]}
        for _ in range(self.pair_rounds):
            for (i, j), table in self.pairs.items():
                tree = self.rate * tree_of(i, j)[1]
                table += tree
                total += tree.ravel()[grid(i, j)[0]]
        return self

    @staticmethod
    def _slopes(total: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1, by looking up every feature's bin and adding."""
        total = np.full(len(x), self.base)
        for table, at in zip(self.tables, self._bins(x, self.edges)):
            total += table[at]
        if self.pairs:
            wide = self._bins(x, self.coarse)
            for (i, j), table in self.pairs.items():
                total += table[wide[i], wide[j]]
        return 1 / (1 + np.exp(-total))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _smallest_hashes(labelled: DataFrame, sample: int) -> pd.DataFrame:
    """At most ``sample`` labelled rows, counting each as often as its ``n`` says: those with the smallest hash.

    Equal rows are combined and counted first. Where there are more than twice ``sample`` others,
    only those in so low a range of hashes are sorted that about twice ``sample`` remain, so tasks send the driver
    about as many in all, however many tasks there are.
    """
    columns = ["doc_id", "quality", *FEATURES]
    combined = labelled.groupBy(*columns).agg(F.sum("n").alias("n"))
    combined = saved(combined.withColumn("place", F.xxhash64(*columns)), "labelled")
    total = combined.count()
    if total > 2 * sample:
        combined = combined.filter(F.col("place") < -(2**63) + 2**64 * 2 * sample // total)
    first = combined.orderBy("place", *columns).limit(sample).toPandas()
    at = np.repeat(np.arange(len(first)), np.minimum(first["n"].to_numpy(dtype=np.int64), sample))
    return first.iloc[at[:sample]]


def classify(
    documents: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = 20_000
) -> DataFrame:
    """Score every document for quality with a model learned from the labelled ones that aren't held out.

    Inputs are measures of the whole text alone. The model is fitted on at most ``sample`` labelled
    rows, those with the smallest hash; that bounds what reaches the driver. Documents are
    held out where the CRC-32 of their id as text leaves 2 modulo 4.

    Returns doc_id, held_out, score and predicted (1 from ``threshold`` on), one row per input row.
    NULL and empty texts have all measures of an empty text and get a score. Labels that are NULL,
    not 0 or 1, or of an unknown document don't count; repeated ones count as often as they
    stand there; without any the score is 0.5, with one class nearly that class. An empty table gives
    no rows; other columns don't matter.

    The texts are read once and not shuffled; labels meet the measures only.
    """
    schema = ", ".join(f"{name} double" for name in FEATURES)
    rows = saved(measured(documents, ["text"], features, schema, list(FEATURES)), "measures")
    known = labels.select("doc_id", F.col("quality").cast("double").alias("quality"))
    known = known.filter(F.col("quality").isin(0.0, 1.0) & ~held_out(F.col("doc_id")))
    counted = saved(known.groupBy("doc_id", "quality").agg(F.count("*").alias("n")), "labels")
    train = _smallest_hashes(rows.join(broadcast_if_small(counted), "doc_id"), sample)
    model = AdditiveModel().fit(train[list(FEATURES)].to_numpy(float), train["quality"].to_numpy(float))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = model.score(batch[list(FEATURES)].to_numpy(float))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scores})

    scored = rows.mapInPandas(run, "doc_id long, score double")
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
