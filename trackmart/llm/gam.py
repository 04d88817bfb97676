"""Quality classifier: a generalised additive model with pairwise interactions.

The score is a sum of table look-ups. Every feature is cut into bins at quantiles of the fitting
rows; boosting goes round the features in turn and adds the leaves of a shallow tree to the
feature's table. Then the pairs of features that explain most of what is left get
two-dimensional tables in the same way. Scoring adds one entry per table, for all rows of a
batch at once.

Contract: null and empty texts have all features 0 and get a score; repeated rows are scored
each; an empty table gives an empty result; without a labelled row every score is 0.5; labels
that are neither 0 nor 1 are left out; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import texts, written
from trackmart.llm.rules import STOP_WORDS

# The model is fitted on at most this many labelled rows, those with the smallest hashes.
FIT_ROWS = 200_000
BINS, PAIR_BINS, PAIRS = 64, 12, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAVES, LEAST = 120, 60, 0.1, 4, 10

FEATURES = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "upper_share", "digit_share", "symbol_share", "mark_share",
    "stop_share", "bang_share", "pipe_share", "space_share", "high_share", "distinct_words", "distinct_pairs", "stutter_share",
    "distinct_lines", "line_words", "long_words", "top_word_share",
)


def text_features(text: str, stop: frozenset[str] = frozenset(STOP_WORDS)) -> list[float]:
    raw = text.encode()
    histogram = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    words, lines = text.split(), [x for x in text.split("\n") if x]
    size, n, n_lines = max(1, len(raw)), max(1, len(words)), max(1, len(lines))
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1

    def share(chars: bytes) -> float:
        return float(histogram[list(chars)].sum()) / size

    stops = sum(c for w, c in counts.items() if w.lower().strip(".,;:!?") in stop)
    return [
        float(np.log1p(len(raw))),
        float(np.log1p(len(words))),
        float(np.log1p(len(lines))),
        sum(map(len, words)) / n,
        float(histogram[65:91].sum()) / size,
        float(histogram[48:58].sum()) / size,
        share(b"#*$%&<>@^~=_\\{}[]"),
        share(b".,;:?'\"-()"),
        stops / n,
        share(b"!"),
        share(b"|"),
        share(b" \t\n\r"),
        float(histogram[128:].sum()) / size,
        len(counts) / n,
        len(set(zip(words, words[1:]))) / max(1, len(words) - 1),
        sum(map(eq, words, words[1:])) / n,
        len(set(lines)) / n_lines,
        len(words) / n_lines,
        sum(c for w, c in counts.items() if len(w) > 15) / n,
        max(counts.values(), default=0) / n,
    ]


def features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and one double per feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([text_features(t) if t else [0.0] * len(FEATURES) for t in batch.column("text").to_pylist()], dtype=float)
            values = values.reshape(-1, len(FEATURES))
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(v) for v in values.T)], names=["doc_id", *FEATURES])

    return texts(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


@dataclass
class Model:
    start: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.cuts[j], x[:, j], side="right")]
        coarse = {j: np.searchsorted(self.pair_cuts[j], x[:, j], side="right") for pair in self.pairs for j in pair}
        for (a, b), table in self.pairs.items():
            total += table[coarse[a], coarse[b]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _quantile_cuts(x: np.ndarray, bins: int) -> np.ndarray:
    values = np.unique(x)
    if len(values) <= bins:
        return (values[1:] + values[:-1]) / 2
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def _tree(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray, leaves: int, least: int) -> np.ndarray:
    """Leaf values per bin of a tree on ordered bins: the best split first, by Newton gain."""
    g, h, n = (np.concatenate([[0.0], np.cumsum(v)]) for v in (gradient, weight, count))
    segments = [(0, len(gradient))]
    while len(segments) < leaves:
        best = (1e-9, None, 0)
        for low, high in segments:
            cut = np.arange(low + 1, high)
            if not len(cut):
                continue
            enough = (n[cut] - n[low] >= least) & (n[high] - n[cut] >= least)
            left = (g[cut] - g[low]) ** 2 / (h[cut] - h[low] + 1)
            right = (g[high] - g[cut]) ** 2 / (h[high] - h[cut] + 1)
            gain = np.where(enough, left + right - (g[high] - g[low]) ** 2 / (h[high] - h[low] + 1), 0)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], (low, high), int(cut[k]))
        if best[1] is None:
            break
        segments.remove(best[1])
        segments += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(gradient))
    for low, high in segments:
        out[low:high] = (g[high] - g[low]) / (h[high] - h[low] + 1)
    return out


def _plane(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray, least: int) -> tuple[np.ndarray, float]:
    """Leaf values of a two-level tree on a grid, cut once along each axis, and its gain."""

    def corner(v: np.ndarray) -> np.ndarray:
        return np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0)))[1:-1, 1:-1]

    def four(v: np.ndarray) -> np.ndarray:
        c, rows, columns, total = corner(v), v.sum(1).cumsum()[:-1, None], v.sum(0).cumsum()[None, :-1], v.sum()
        return np.stack([c, rows - c, columns - c, total - rows - columns + c])

    if min(gradient.shape) < 2:
        return np.zeros(gradient.shape), 0.0
    g, h, n = four(gradient), four(weight), four(count)
    gain = (g**2 / (h + 1)).sum(0) * (n.min(0) >= least)
    a, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if gain[a, b] <= 0:
        return np.zeros(gradient.shape), 0.0
    value = g[:, a, b] / (h[:, a, b] + 1)
    out = np.empty(gradient.shape)
    out[: a + 1, : b + 1], out[: a + 1, b + 1 :], out[a + 1 :, : b + 1], out[a + 1 :, b + 1 :] = value
    return out, float(gain[a, b])


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting on the logistic loss."""
    model = Model()
    if not len(y):
        return model
    rate = (y.sum() + 1) / (len(y) + 2)
    model.start = float(np.log(rate / (1 - rate)))
    model.cuts = [_quantile_cuts(x[:, j], BINS) for j in range(x.shape[1])]
    binned = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.cuts)]
    counts = [np.bincount(b, minlength=len(c) + 1) for b, c in zip(binned, model.cuts, strict=True)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    margin = np.full(len(y), model.start)

    def step() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, bins in enumerate(binned):
            g, h = step()
            size = len(counts[j])
            leaf = RATE * _tree(np.bincount(bins, g, size), np.bincount(bins, h, size), counts[j], LEAVES, LEAST)
            model.tables[j] += leaf
            margin += leaf[bins]

    model.pair_cuts = [_quantile_cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.pair_cuts)]
    sizes = [len(c) + 1 for c in model.pair_cuts]

    def grids(a: int, b: int, g: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
        cell, shape = coarse[a] * sizes[b] + coarse[b], (sizes[a], sizes[b])
        return [np.bincount(cell, w, sizes[a] * sizes[b]).reshape(shape) for w in (g, h, None)]

    g, h = step()
    gains = {(a, b): _plane(*grids(a, b, g, h), LEAST)[1] for a, b in combinations(range(x.shape[1]), 2)}
    chosen = sorted(gains, key=gains.get, reverse=True)[:PAIRS]
    model.pairs = {(a, b): np.zeros((sizes[a], sizes[b])) for a, b in chosen}
    for _ in range(PAIR_ROUNDS):
        for a, b in chosen:
            g, h = step()
            leaf = RATE * _plane(*grids(a, b, g, h), LEAST)[0]
            model.pairs[a, b] += leaf
            margin += leaf[coarse[a], coarse[b]]
    return model


def train(feature_table: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fits on the labelled rows: ``labels`` has ``doc_id`` and ``label`` 0 or 1.

    Of more than ``fit_rows`` rows those with the smallest hashes are taken. A limit on the hash,
    six deviations above what is expected to do, goes first, so that the others stay where they are.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")).filter("label IN (0, 1)")
    labelled = feature_table.join(known, "doc_id")
    share = (fit_rows + 6 * fit_rows**0.5) / max(1, labelled.count())
    if share < 1:
        labelled = labelled.filter(F.xxhash64("doc_id") < F.lit(int((2 * share - 1) * 2**63)))
    rows = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    frame = rows.select("label", *FEATURES).toPandas()
    return fit(frame[list(FEATURES)].to_numpy(dtype=float).reshape(-1, len(FEATURES)), frame["label"].to_numpy(dtype=float))


def score(feature_table: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score``: the model is a few tables of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(f).to_numpy() for f in FEATURES])
            yield pa.record_batch([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return feature_table.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Scores every text of ``docs`` by a model of the labelled ones; features are stored once."""
    table = written(features(docs), "features")
    return score(table, train(table, labels, fit_rows))
