"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are binned at quantiles. Shallow trees over one feature's bins are
boosted in turn, feature after feature, with a small step (cyclic boosting), so each
feature ends up with one lookup table; then the pairs of features that explain most of what
is left get two-dimensional tables the same way. A score is the logistic of the intercept
plus one table entry per feature and pair, read for all rows at once.

Fitting uses at most about `TRAIN_ROWS` labelled rows (chosen by hash) whose
crc32(doc_id as text) mod 4 is not 2: the driver receives one row of numbers per sampled
document, never a text.

Defined cases: null text counts as empty (every feature 0) and gets a score; without labels
every score is 0.5; with one label value the score is that value's smoothed share; repeated
rows get equal scores; an empty table gives no rows; texts are measured whole.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from orebridge.llm.common import ship_code, whole_text
from orebridge.llm.toxicity import labelled_rows

TRAIN_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, STEP, RIDGE = 120, 0.15, 2.0
THRESHOLD = 0.7

FEATURES = ("words", "word_length", "longest_word", "upper", "digits", "marks", "symbols", "spaces",
            "distinct_words", "top_word", "same_neighbours", "repeated_triples", "repeated_lines",
            "words_per_line", "stops", "non_ascii", "shouts", "bars")


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Code point -> 0 other, 1 upper, 2 lower or caseless letter, 3 digit, 4 space, 5 stop,
    6 ! or ?, 7 |, 8 other ASCII mark."""
    kinds = np.zeros(0x110000, dtype=np.uint8)
    for i in range(0x3000):
        ch = chr(i)
        kinds[i] = 1 if ch.isupper() else 2 if ch.isalpha() else 3 if ch.isdigit() else 4 if ch.isspace() else 0
    for ch in map(chr, range(33, 127)):
        if not ch.isalnum():
            kinds[ord(ch)] = 5 if ch in ".,;:" else 6 if ch in "!?" else 7 if ch == "|" else 8
    kinds[0x3000:0xA000] = 2
    return kinds


def text_features(text: str) -> tuple[float, ...]:
    words = text.split()
    if not words:
        return (0.0,) * len(FEATURES)
    n, chars = len(words), len(text)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = np.bincount(_kinds()[codes], minlength=9)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts = Counter(words)
    triples = n - 2 - len(set(zip(words, words[1:], words[2:]))) if n > 2 else 0
    lines = [x for x in text.split("\n") if x.strip()]
    return (float(np.log1p(n)), float(sizes.mean()), float(np.log1p(sizes.max())),
            kind[1] / chars, kind[3] / chars, (kind[5] + kind[6] + kind[8]) / chars, kind[8] / n, kind[4] / chars,
            len(counts) / n, max(counts.values()) / n,
            sum(map(str.__eq__, words, words[1:])) / n, triples / n,
            1 - len(set(lines)) / len(lines), float(np.log1p(n / len(lines))), kind[5] / n,
            float((codes > 127).mean()), kind[6] / n, kind[7] / n)


def feature_udf():
    @F.pandas_udf("array<double>")
    def of(texts):
        import pandas as pd
        return pd.Series([text_features(t) for t in texts])
    return of


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best split of ordered bins with gradients g and curvatures h."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl ** 2 / (hl + RIDGE) + (g.sum() - gl) ** 2 / (h.sum() - hl + RIDGE)
    at = int(gain.argmax()) if len(gain) else 0
    return (float(gain[at] - g.sum() ** 2 / (h.sum() + RIDGE)), at + 1) if len(gain) else (0.0, 0)


def _shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values per bin of a tree of depth two over ordered bins."""
    out = np.zeros(len(g))

    def grow(a: int, b: int, depth: int) -> None:
        gain, at = _best_cut(g[a:b], h[a:b]) if b - a > 1 and depth else (0.0, 0)
        if gain > 1e-9:
            grow(a, a + at, depth - 1)
            grow(a + at, b, depth - 1)
        else:
            out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    grow(0, len(g), 2)
    return out


def _cross_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values per cell of a table: one split of the rows, then of each part's columns."""
    out = np.zeros(g.shape)
    _, at = _best_cut(g.sum(axis=1), h.sum(axis=1))
    for part in (slice(0, at), slice(at, g.shape[0])):
        gc, hc = g[part].sum(axis=0), h[part].sum(axis=0)
        gain, cut = _best_cut(gc, hc)
        for cols in ((slice(0, cut), slice(cut, None)) if gain > 1e-9 else (slice(None),)):
            out[part, cols] = gc[cols].sum() / (hc[cols].sum() + RIDGE)
    return out


@dataclass
class AdditiveModel:
    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            z += table[np.searchsorted(edges, x[:, f], side="right")]
        for a, b, table in self.pairs:
            z += table[np.searchsorted(self.pair_edges[a], x[:, a], side="right"),
                       np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> AdditiveModel:
    """Cyclic boosting of single tables, then of the strongest pairs' tables."""
    width = x.shape[1] if x.ndim == 2 else 0
    base = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    model = AdditiveModel(float(np.log(base / (1 - base))), [], [], [], [])
    if not len(y) or y.min() == y.max():
        return model
    model.edges = [_edges(x[:, f], BINS) for f in range(width)]
    model.pair_edges = [_edges(x[:, f], PAIR_BINS) for f in range(width)]
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    z = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(width):
            g, h = slopes()
            size = len(model.tables[f])
            step = STEP * _shallow_tree(np.bincount(bins[f], g, size), np.bincount(bins[f], h, size))
            model.tables[f] += step
            z += step[bins[f]]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.pair_edges)]
    sizes = [len(e) + 1 for e in model.pair_edges]
    g, h = slopes()

    def grid(a, b, v):
        return np.bincount(coarse[a] * sizes[b] + coarse[b], v, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])
    gains = []
    for a, b in combinations(range(width), 2):
        gg, hh = grid(a, b, g), grid(a, b, h)
        joint = (gg ** 2 / (hh + RIDGE)).sum()
        alone = max((gg.sum(axis=k) ** 2 / (hh.sum(axis=k) + RIDGE)).sum() for k in (0, 1))
        gains.append((joint - alone, a, b))
    chosen = [(a, b) for _, a, b in sorted(gains, key=lambda t: (-t[0], t[1:]))[:PAIRS]]
    tables = {ab: np.zeros((sizes[ab[0]], sizes[ab[1]])) for ab in chosen}
    for _ in range(rounds // 3):
        for a, b in chosen:
            g, h = slopes()
            step = STEP * _cross_tree(grid(a, b, g), grid(a, b, h))
            tables[a, b] += step
            z += step[coarse[a], coarse[b]]
    model.pairs = [(a, b, t) for (a, b), t in tables.items()]
    return model


def learn_quality(rows: DataFrame) -> AdditiveModel:
    """Fit on (text, label) rows, a bounded sample."""
    ship_code(rows.sparkSession)
    data = rows.select("label", feature_udf()("text").alias("f")).toPandas()
    x = np.array(data["f"].tolist(), dtype=float).reshape(len(data), len(FEATURES))
    # the sample's order must not matter for the sums below
    order = np.lexsort([*x.T, data["label"].to_numpy()]) if len(data) else np.arange(0)
    return fit(x[order], data["label"].to_numpy(dtype=float)[order])


def score_quality(docs: DataFrame, model: AdditiveModel, text: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 from `THRESHOLD` on)."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd
        x = np.array([text_features(t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
        return pd.Series(shared.value.score(x))

    return docs.withColumn("score", score(whole_text(text))).withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def classify_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Learn from the labelled rows and score every document."""
    return score_quality(docs, learn_quality(labelled_rows(docs, labels, "quality", train_rows)))
