"""Toxicity scores: gradient-boosted trees over dense features of a text
(lexicon densities, second-person proximity, capitals, punctuation and
obfuscation rates), calibrated by isotonic regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import combine, rows_of_words, word_bounds, word_hashes
from .quality import even_weights, passing_texts, scored_texts
from .tables import crc_part, label_sample, sampled_texts, stored, texts
from .text_features import DIGIT, LETTER, MARK, SYMBOL, UPPER, Texts, in_slices, share

# Insults to start from; the rest of the lexicon is learned from the labels.
INSULTS = "idiot moron stupid dumb loser scum trash pathetic worthless disgusting clown fool jerk freak".split()
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine euch tu te toi ton ta tes vous votre usted ustedes tus vos"
).split()
# Words here end at any ASCII byte that is neither letter nor digit.
_BREAK = ~(LETTER | DIGIT)
KINDS = (4, 5, 1 << 30)
NEAR = 3
FOLDS = 4


def _hashes_of(words: list[str]) -> np.ndarray:
    joined = " ".join(words).encode()
    data = np.frombuffer(joined, np.uint8)
    starts, ends = word_bounds(data, np.array([0, len(data)]))
    return np.sort(word_hashes(data, starts, ends))


def _among(values: np.ndarray, members: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(members, values), len(members) - 1)
    return members[at] == values


class _Words:
    """The words of a batch with one key per kind: prefixes of 4 and 5 bytes
    and the whole word."""

    def __init__(self, texts: Texts):
        self.starts, self.ends = word_bounds(texts.lower, texts.offsets, _BREAK)
        self.first = rows_of_words(self.starts, texts.offsets)
        self.count = np.diff(self.first)
        self.rows = np.repeat(np.arange(len(self.count)), self.count)
        self.whole = word_hashes(texts.lower, self.starts, self.ends)
        self.keys = [
            combine(word_hashes(texts.lower, self.starts, np.minimum(self.ends, self.starts + kind)), np.full(len(self.starts), place, np.uint64))
            for place, kind in enumerate(KINDS)
        ]


@dataclass
class Lexicon:
    """Sorted keys and their weights."""

    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def weigh(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.weights[at], 0.0)


FEATURES = (
    "insults",
    "insult_count",
    *(f"lexicon_{kind}" for kind in ("prefix_4", "prefix_5", "word")),
    *(f"strongest_{kind}" for kind in ("prefix_4", "prefix_5", "word")),
    "hit_count",
    "lexicon_weight",
    "near_second_person",
    "second_person",
    "capitals",
    "capital_words",
    "marks",
    "symbols",
    "mixed_words",
    "log_words",
)


def features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row per text, one column per name in ``FEATURES``."""
    return in_slices(column, lambda part: _features(part, lexicon))


def _features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    batch = Texts(column)
    words = _Words(batch)
    insults, second = _hashes_of(INSULTS), _hashes_of(SECOND_PERSON)
    insult, person = _among(words.whole, insults), _among(words.whole, second)
    weights = [lexicon.weigh(keys) for keys in words.keys]
    strongest = np.maximum.reduce(weights)
    hit = insult | (strongest > 0)
    # Hits with a second-person word at most NEAR words away in the same text.
    total = np.concatenate([[0], np.cumsum(person)])
    place = np.arange(len(hit))
    left = np.maximum(words.first[:-1][words.rows], place - NEAR)
    right = np.minimum(words.first[1:][words.rows], place + NEAR + 1)
    near = hit & (total[right] > total[left])

    def sums(values: np.ndarray) -> np.ndarray:
        return np.bincount(words.rows, values, minlength=len(words.count))

    def largest(values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words.count))
        filled = words.count > 0
        if filled.any():
            out[filled] = np.maximum.reduceat(values, words.first[:-1][filled])
        return out

    mixed = batch.words_with("upper", "lower", "wide") & batch.words_with("digit", "symbol")
    count = words.count
    columns = [
        share(sums(insult), count),
        np.minimum(sums(insult), 20),
        *(share(sums(weight > 0), count) for weight in weights),
        *(largest(weight) for weight in weights),
        np.minimum(sums(hit), 20),
        share(sums(strongest), count),
        share(sums(near), count),
        share(sums(person), count),
        share(batch.count(UPPER), batch.count(LETTER)),
        share(batch.per_words(batch.upper_words()), batch.words),
        share(batch.count(MARK), batch.words),
        share(batch.count(SYMBOL), batch.bytes),
        share(batch.per_words(mixed), batch.words),
        np.log1p(count),
    ]
    return np.column_stack(columns)


def learn_lexicons(rows: DataFrame, folds: int, size: int = 6000, least: int = 3, odds: float = 2.0) -> list[Lexicon]:
    """From ``text, label, fold`` rows: for each fold the lexicon of all other
    folds, then the lexicon of all. A key belongs to a lexicon if at least
    ``least`` toxic texts hold it, and far more of them than of the others;
    that compares shares within the classes, whatever the classes' sizes.
    Batches are counted before the shuffle; at most ``size`` keys come to the
    driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch["label"].to_numpy(zero_copy_only=False).astype(np.uint64)
            fold = batch["fold"].to_numpy(zero_copy_only=False).astype(np.uint64)
            group = fold * np.uint64(2) + labels
            words = _Words(Texts(batch["text"]))
            pairs = [combine(keys, words.rows.astype(np.uint64)) for keys in words.keys]
            # Each key once per text.
            once = [np.unique(pair, return_index=True)[1] for pair in pairs]
            keys = np.concatenate([k[at] for k, at in zip(words.keys, once)])
            groups = np.concatenate([group[words.rows[at]] for at in once]).astype(np.int64)
            found, place = np.unique(keys, return_inverse=True)
            counts = np.bincount(place * 2 * folds + groups, minlength=len(found) * 2 * folds).reshape(len(found), 2 * folds)
            columns = {"key": found.view(np.int64), **{f"c{n}": counts[:, n] for n in range(2 * folds)}}
            yield pa.RecordBatch.from_pydict(columns)

    names = [f"c{n}" for n in range(2 * folds)]
    sizes = np.zeros(2 * folds)
    for row in rows.groupBy("fold", "label").count().collect():
        sizes[2 * row["fold"] + row["label"]] = row["count"]
    good, bad = (sum((F.col(name) for name in names[side::2]), F.lit(0)) for side in (0, 1))
    ratio = F.log((bad + 0.5) / F.lit(sizes[1::2].sum() + 1)) - F.log((good + 0.5) / F.lit(sizes[0::2].sum() + 1))
    found = (
        rows.mapInArrow(counted, "key long, " + ", ".join(f"{name} long" for name in names))
        .groupBy("key")
        .agg(*(F.sum(name).alias(name) for name in names))
        .where((bad >= least) & (ratio >= odds))
        .orderBy(F.desc(ratio * bad), "key")
        .limit(size)
        .toPandas()
    )
    found = found.iloc[np.argsort(found["key"].to_numpy(np.int64).view(np.uint64))]
    keys, counts = found["key"].to_numpy(np.int64).view(np.uint64), found[names].to_numpy(float)

    def lexicon(used: np.ndarray) -> Lexicon:
        good, bad = (counts[:, side::2][:, used].sum(1) for side in (0, 1))
        all_good, all_bad = (sizes[side::2][used].sum() for side in (0, 1))
        weight = np.log((bad + 0.5) / (all_bad + 1)) - np.log((good + 0.5) / (all_good + 1))
        kept = (bad >= least) & (weight >= odds)
        return Lexicon(keys[kept], weight[kept])

    every = np.arange(folds)
    return [lexicon(every != fold) for fold in range(folds)] + [lexicon(every >= 0)]


@dataclass
class BoostedTrees:
    """Depth-limited trees over binned features. A tree is three arrays in heap
    order: feature, bin bound (larger goes right), and the leaves' additions."""

    start: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def binned(self, values: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, values[:, f], "right") for f, e in enumerate(self.edges)])

    def raw(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.start)
        if self.trees:
            bins = self.binned(values)
            for tree in self.trees:
                total += _leaf_values(tree, bins)
        return total


def _leaf_values(tree: tuple[np.ndarray, np.ndarray, np.ndarray], bins: np.ndarray) -> np.ndarray:
    feature, bound, leaves = tree
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while node.size and node[0] < len(feature):
        node = 2 * node + 1 + (bins[rows, feature[node]] > bound[node])
    return leaves[node - len(feature)]


def boost(
    values: np.ndarray,
    labels: np.ndarray,
    weights: np.ndarray | None = None,
    rounds: int = 80,
    depth: int = 3,
    bins: int = 32,
    rate: float = 0.2,
    l2: float = 2.0,
) -> BoostedTrees:
    """Trees fitted to the log-loss by second-order steps; ``weights`` tell how
    many rows each stands for."""
    if not len(labels):
        return BoostedTrees()
    weights = even_weights(weights, len(labels))
    mean = np.clip(np.average(labels, weights=weights), 0.01, 0.99)
    model = BoostedTrees(float(np.log(mean / (1 - mean))))
    model.edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in values.T]
    # Rare nonzero values lie beyond every quantile; zero gets a bin of its own.
    model.edges = [np.unique(np.append(edges, np.nextafter(0, 1))) for edges in model.edges]
    at = model.binned(values)
    width = max(len(edges) for edges in model.edges) + 1
    total = np.full(len(labels), model.start)
    inner = 2**depth - 1
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-total))
        left, curve = weights * (labels - chance), weights * chance * (1 - chance)
        feature, bound = np.zeros(inner, np.int64), np.full(inner, width)
        node = np.zeros(len(labels), np.int64)
        for level in range(depth):
            first, size = 2**level - 1, 2**level
            best = np.zeros(size)
            for f in range(at.shape[1]):
                cell = (node - first) * width + at[:, f]
                g = np.bincount(cell, left, size * width).reshape(size, width).cumsum(1)
                h = np.bincount(cell, curve, size * width).reshape(size, width).cumsum(1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + l2) + (all_g - g) ** 2 / (all_h - h + l2) - all_g**2 / (all_h + l2)
                cut = gain.argmax(1)
                value = gain[np.arange(size), cut]
                for n in np.flatnonzero(value > best + 1e-9):
                    best[n], feature[first + n], bound[first + n] = value[n], f, cut[n]
            node = 2 * node + 1 + (at[np.arange(len(at)), feature[node]] > bound[node])
        leaf = node - inner
        g, h = np.bincount(leaf, left, 2**depth), np.bincount(leaf, curve, 2**depth)
        tree = feature, bound, rate * g / (h + l2)
        model.trees.append(tree)
        total += tree[2][leaf]
    return model


def isotonic(
    scores: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: rising score bounds and the weighted shares of
    label 1 between which calibrated values are interpolated."""
    weights = even_weights(weights, len(labels))
    order = np.argsort(scores, kind="stable")
    blocks: list[list[float]] = []
    for score, label, weight in zip(scores[order], labels[order], weights[order]):
        blocks.append([weight * label, weight, score, score])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            value, count, _, end = blocks.pop()
            blocks[-1][0] += value
            blocks[-1][1] += count
            blocks[-1][3] = end
    x, y = [], []
    for value, count, start, end in blocks:
        # One half-observation each way keeps small blocks away from 0 and 1.
        share_of_ones = (value + 0.5) / (count + 1)
        x += [start, end]
        y += [share_of_ones, share_of_ones]
    return np.array(x), np.maximum.accumulate(np.array(y)) if y else np.array(y)


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: BoostedTrees
    x: np.ndarray
    y: np.ndarray

    def score(self, values: np.ndarray) -> np.ndarray:
        raw = self.trees.raw(values)
        return np.interp(raw, self.x, self.y) if len(self.x) else 1 / (1 + np.exp(-raw))


def train_toxicity(
    docs: DataFrame, labels: DataFrame, parts: int = 3, held_out: int = 1, per_class: int = 12000
) -> ToxicityModel:
    """A model fitted on at most ``per_class`` labelled texts of either class;
    ids in the held-out part are never used. A training text is measured with
    the lexicon of the folds it isn't in, and three tenths of the texts are kept
    from the trees for the calibration, so that nothing is judged by what has
    learned from it. Trees and calibration weight the texts to the shares that
    the classes have among all labels, so the bound doesn't shift scores."""
    sample = label_sample(labels, "toxic", parts, held_out, per_class)
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int")
    rows = sampled_texts(docs, sample).withColumn("fold", fold)
    rows = stored(rows.select("doc_id", "label", "weight", "fold", "text"), "toxicity-sample")
    lexicons = learn_lexicons(rows, FOLDS)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds = batch["fold"].to_numpy(zero_copy_only=False)
            for number in np.unique(folds):
                part = batch.filter(pa.array(folds == number))
                values = pa.array(list(features(part["text"], lexicons[number])), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part["doc_id"], "label": part["label"], "weight": part["weight"], "values": values}
                )

    found = rows.mapInArrow(measured, "doc_id long, label int, weight double, values array<double>").toPandas()
    found = found.sort_values("doc_id", kind="stable")
    label, weight = found["label"].to_numpy(float), found["weight"].to_numpy(float)
    values = np.array(found["values"].tolist(), float).reshape(len(found), len(FEATURES))
    last = np.random.default_rng(7).random(len(found)) < 0.3
    trees = boost(values[~last], label[~last], weight[~last])
    x, y = isotonic(trees.raw(values[last]), label[last], weight[last])
    return ToxicityModel(lexicons[-1], trees, x, y)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.7,
    parts: int = 3,
    held_out: int = 1,
    per_class: int = 12000,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Scores see the text alone. A null text counts as empty and is scored like
    any other; rows with equal or null ids are all scored, and of equal ids one
    row, whichever order they are read in, is learned from; an empty table gives
    no rows; without labelled training rows every score is 0.5. Other columns
    of ``docs`` and ``labels`` are ignored. Model fitting uses a sample of at
    most ``2 * per_class`` texts, which passes through the driver as numbers."""
    model = train_toxicity(docs, labels, parts, held_out, per_class)
    scored = scored_texts(texts(docs), lambda column: features(column, model.lexicon), model, threshold)
    return scored.select("doc_id", (crc_part("doc_id", parts) == held_out).alias("held_out"), "score", "predicted")


def civil_texts(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **fitting: int) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score stays below
    ``threshold``; scores and edge cases as for ``toxicity_scores``."""
    model = train_toxicity(docs, labels, **fitting)
    return passing_texts(docs, lambda column: features(column, model.lexicon), model, lambda scores: scores < threshold)
