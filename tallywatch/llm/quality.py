"""A text quality classifier: a generalised additive model with pairwise
interactions. Shallow trees, boosted in cycles over the features, add up to one
lookup table per feature and one per chosen pair; a text's score is the
logistic of the sum of its table entries."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import crc_part, label_sample, sampled_texts, texts
from .text_features import DIGIT, LETTER, MARK, NEWLINE, STOP, SYMBOL, UPPER, WIDE, Texts, in_slices, share

FEATURES = (
    "log_bytes",
    "log_words",
    "word_length",
    "letters",
    "capitals",
    "digits",
    "marks",
    "stops",
    "symbols",
    "wide",
    "lines_per_word",
    "distinct",
    "repeats",
    "symbol_words",
    "marked_words",
    "wordless",
    "capital_words",
)


def features(column: pa.Array) -> np.ndarray:
    """One row per text, one column per name in ``FEATURES``."""
    return in_slices(column, _features)


def _features(column: pa.Array) -> np.ndarray:
    batch = Texts(column)
    size, words = batch.bytes, batch.words
    letters = batch.count(LETTER)
    columns = [
        np.log1p(size),
        np.log1p(words),
        share(size, words),
        share(letters, size),
        share(batch.count(UPPER), letters),
        share(batch.count(DIGIT), size),
        share(batch.count(MARK), words),
        share(batch.count(STOP), words),
        share(batch.count(SYMBOL), size),
        share(batch.count(WIDE), size),
        share(batch.count(NEWLINE), words),
        share(batch.distinct_words(), words),
        share(batch.repeats(), words),
        share(batch.per_words(batch.words_with("symbol")), words),
        share(batch.per_words(batch.words_with("mark")), words),
        share(batch.per_words(~batch.words_with("upper", "lower", "wide", "digit")), words),
        share(batch.per_words(batch.upper_words()), words),
    ]
    return np.column_stack(columns)


@dataclass
class AdditiveModel:
    """``edges[f]`` cut feature ``f`` into bins; ``tables[f]`` holds the bins'
    additions; ``pairs`` maps two features to a table over coarser bins."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.intercept)
        for column, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, values[:, column], "right")]
        for (a, b), table in self.pairs.items():
            at = np.searchsorted(self.coarse[a], values[:, a], "right")
            total += table[at, np.searchsorted(self.coarse[b], values[:, b], "right")]
        return 1 / (1 + np.exp(-total))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(gradient: np.ndarray, weight: np.ndarray, l2: float) -> tuple[int, float]:
    """Best cut of ordered bins, and its gain; 0 means no cut."""
    g, h = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    if not len(g):
        return 0, 0.0
    all_g, all_h = gradient.sum(), weight.sum()
    gain = g * g / (h + l2) + (all_g - g) ** 2 / (all_h - h + l2) - all_g**2 / (all_h + l2)
    best = int(np.argmax(gain))
    return best + 1, float(gain[best])


def _tree(gradient: np.ndarray, weight: np.ndarray, l2: float) -> np.ndarray:
    """A tree of at most three leaves over ordered bins: each bin's addition."""
    first, _ = _split(gradient, weight, l2)
    parts = [slice(0, first), slice(first, len(gradient))] if first else [slice(0, len(gradient))]
    cuts = [_split(gradient[part], weight[part], l2) for part in parts]
    widest = max(range(len(parts)), key=lambda i: cuts[i][1])
    if cuts[widest][1] > 0 and first:
        part, middle = parts[widest], parts[widest].start + cuts[widest][0]
        parts[widest : widest + 1] = [slice(part.start, middle), slice(middle, part.stop)]
    out = np.zeros(len(gradient))
    for part in parts:
        out[part] = gradient[part].sum() / (weight[part].sum() + l2)
    return out


def _pair_tree(gradient: np.ndarray, weight: np.ndarray, l2: float) -> tuple[np.ndarray, float]:
    """Best four quadrants of a grid: each cell's addition, and the gain over none."""
    g, h = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    top, side = (x[:-1, -1:] for x in (g, h)), (x[-1:, :-1] for x in (g, h))
    (g_top, h_top), (g_side, h_side) = top, side
    corner = [(g[:-1, :-1], h[:-1, :-1])]
    corner.append((g_top - corner[0][0], h_top - corner[0][1]))
    corner.append((g_side - corner[0][0], h_side - corner[0][1]))
    corner.append((g[-1, -1] - g_top - g_side + corner[0][0], h[-1, -1] - h_top - h_side + corner[0][1]))
    gains = sum(a * a / (b + l2) for a, b in corner)
    if not gains.size:
        return np.zeros_like(gradient), 0.0
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    out = np.empty_like(gradient)
    for (a, b), cells in zip(corner, (np.s_[: i + 1, : j + 1], np.s_[: i + 1, j + 1 :], np.s_[i + 1 :, : j + 1], np.s_[i + 1 :, j + 1 :])):
        out[cells] = a[i, j] / (b[i, j] + l2)
    return out, float(gains[i, j])


def even_weights(weights: np.ndarray | None, count: int) -> np.ndarray:
    """Weights with a mean of one, so that penalties keep their meaning."""
    return np.ones(count) if weights is None or not count else weights / weights.mean()


def fit(
    values: np.ndarray,
    labels: np.ndarray,
    weights: np.ndarray | None = None,
    rounds: int = 150,
    pair_rounds: int = 50,
    pairs: int = 8,
    bins: int = 48,
    coarse_bins: int = 12,
    rate: float = 0.15,
    l2: float = 2.0,
) -> AdditiveModel:
    """Cycles over all features, then over the pairs whose best quadrants
    explain most of what is left. ``weights`` tell how many rows each stands
    for. Without labels every score is one half."""
    if not len(labels):
        return AdditiveModel()
    weights = even_weights(weights, len(labels))
    mean = np.clip(np.average(labels, weights=weights), 0.01, 0.99)
    model = AdditiveModel(float(np.log(mean / (1 - mean))))
    width = values.shape[1]
    model.edges = [_cuts(values[:, f], bins) for f in range(width)]
    model.coarse = [_cuts(values[:, f], coarse_bins) for f in range(width)]
    model.tables = [np.zeros(len(edges) + 1) for edges in model.edges]
    at = [np.searchsorted(model.edges[f], values[:, f], "right") for f in range(width)]
    total = np.full(len(labels), model.intercept)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        chance = 1 / (1 + np.exp(-total))
        return weights * (labels - chance), weights * chance * (1 - chance)

    for _ in range(rounds):
        for f in range(width):
            left, curve = residuals()
            size = len(model.tables[f])
            step = rate * _tree(np.bincount(at[f], left, size), np.bincount(at[f], curve, size), l2)
            model.tables[f] += step
            total += step[at[f]]

    low = [np.searchsorted(model.coarse[f], values[:, f], "right") for f in range(width)]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = len(model.coarse[a]) + 1, len(model.coarse[b]) + 1
        cell = low[a] * shape[1] + low[b]
        left, curve = residuals()
        size = shape[0] * shape[1]
        return cell, *(np.bincount(cell, x, size).reshape(shape) for x in (left, curve))

    gains = {pair: _pair_tree(*grid(*pair)[1:], l2)[1] for pair in combinations(range(width), 2)}
    chosen = sorted(gains, key=gains.get, reverse=True)[:pairs]
    model.pairs = {(a, b): np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)) for a, b in chosen}
    for _ in range(pair_rounds):
        for pair in chosen:
            cell, left, curve = grid(*pair)
            step = rate * _pair_tree(left, curve, l2)[0]
            model.pairs[pair] += step
            total += step.ravel()[cell]
    return model


def scored_texts(rows: DataFrame, values_of, model, threshold: float) -> DataFrame:
    """``doc_id, score, predicted`` by a model over ``values_of(text column)``."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(values_of(batch["text"])) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "score": pa.array(scores, pa.float64())})

    return rows.mapInArrow(scored, "doc_id long, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def passing_texts(docs: DataFrame, values_of, model, condition, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score meets
    ``condition``; nothing is shuffled."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield batch.filter(pa.array(condition(model.score(values_of(batch[text_col]))), pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def train_quality(docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0, per_class: int = 8000):
    """A model fitted on at most ``per_class`` labelled texts of either class;
    ids in the held-out part are never used. Texts are weighted to the shares
    that the classes have among all labels, so the bound doesn't shift scores.
    The sample is joined by broadcast, which its bound allows."""
    sample = label_sample(labels, "quality", parts, held_out, per_class)
    rows = sampled_texts(docs, sample)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = features(batch["text"]) if len(batch) else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["label"],
                    "weight": batch["weight"],
                    "values": pa.array(list(values), pa.list_(pa.float64())),
                }
            )

    found = rows.mapInArrow(measured, "doc_id long, label int, weight double, values array<double>").toPandas()
    found = found.sort_values("doc_id", kind="stable")
    values = np.array(found["values"].tolist(), float).reshape(len(found), len(FEATURES))
    return fit(values, found["label"].to_numpy(float), found["weight"].to_numpy(float))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.3,
    parts: int = 5,
    held_out: int = 0,
    per_class: int = 8000,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Scores see the text alone. A null text counts as empty and is scored like
    any other; rows with equal or null ids are all scored, and of equal ids one
    row, whichever order they are read in, is learned from; an empty table gives
    no rows; without labelled training rows every score is 0.5. Other columns
    of ``docs`` and ``labels`` are ignored. Model fitting uses a sample of at
    most ``2 * per_class`` texts, which passes through the driver as numbers."""
    model = train_quality(docs, labels, parts, held_out, per_class)
    scored = scored_texts(texts(docs), features, model, threshold)
    return scored.select("doc_id", (crc_part("doc_id", parts) == held_out).alias("held_out"), "score", "predicted")


def good_texts(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **fitting: int) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches
    ``threshold``; scores and edge cases as for ``quality_scores``."""
    model = train_quality(docs, labels, **fitting)
    return passing_texts(docs, features, model, lambda scores: scores >= threshold)
