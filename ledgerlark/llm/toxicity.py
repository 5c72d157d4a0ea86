"""Toxicity by a chain of linear classifiers.

The categories are predicted one after another. Each is a logistic regression over a
bounded list of selected features (words and word beginnings, hashed) and a few shares
of character kinds; every model but the first also gets the log-odds of the categories
before it. In training these come from out-of-fold models, so a later model learns from
predictions as good as the ones it will meet; in use they come from the full models.

Only the fit is bounded: it takes at most ``SAMPLE`` labelled rows (lowest hash of the
id, so the choice does not depend on the order of rows). Scoring reads every whole text.

Defined cases: a null or empty text has no features and gets the score of that; a row
without a label, or with a null one, takes no part in the fit, and of several labels of
an id the largest counts; ids that match several texts are fitted once per text; repeated
rows get equal scores; without labelled rows, or with one class only, a category's score
is the share seen (0 for none); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.blocks import ALNUM_GAPS, LOWER, Block, Prefixes, blocks, mix, rows_of, string_list, word_bounds

SAMPLE = 8000
FOLDS = 4
FEATURES = 4096
LEAST_DOCS = 3
BEGINNINGS = (4, 5, 6)
STYLES = 5
LEAST_CHI2 = 10.83  # a chance of one in a thousand
PENALTY = 1e-3
STEPS = 200


def features_of(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature hash) of every word and word beginning, and the style shares and sizes of rows."""
    data = LOWER[block.data]
    starts, ends = word_bounds(data, block.offsets, ALNUM_GAPS)
    prefixes, row = Prefixes(data), rows_of(starts, block.offsets)
    rows, keys = [row], [prefixes.slices(starts, ends)]
    for size in BEGINNINGS:
        long = ends - starts > size
        rows.append(row[long])
        keys.append(mix(prefixes.slices(starts[long], starts[long] + size) + np.uint64(size)))
    upper = (block.data >= ord("A")) & (block.data <= ord("Z"))
    marks = np.isin(block.data, np.frombuffer(b"!|#*$%&<>", np.uint8))
    digits = (block.data >= ord("0")) & (block.data <= ord("9"))
    size = np.diff(block.offsets)
    at = [np.concatenate([[0], np.cumsum(mask)]) for mask in (upper, marks, digits, data == 0x0A)]
    shares = [(s[block.offsets[1:]] - s[block.offsets[:-1]]) / np.maximum(size, 1) for s in at]
    distinct = np.zeros(block.rows)
    pairs = np.unique(np.stack([row.astype(np.uint64), keys[0]], axis=1), axis=0) if len(row) else np.zeros((0, 2), np.uint64)
    distinct += np.bincount(pairs[:, 0].astype(np.int64), minlength=block.rows)
    words = np.bincount(row, minlength=block.rows)
    return (np.concatenate(rows), np.concatenate(keys),
            np.stack([*shares, distinct / np.maximum(words, 1)], axis=1), words)


def _counts(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, key) pairs with log-scaled counts, in the order of rows."""
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    heads = np.flatnonzero(new)
    return row[heads], key[heads], np.log1p(np.diff(np.append(heads, len(row))))


@dataclass
class Linear:
    """A logistic regression over sparse features and dense extras (the constant last)."""

    sparse: np.ndarray
    dense: np.ndarray

    def odds(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, extras: np.ndarray) -> np.ndarray:
        return np.bincount(row, self.sparse[column] * value, len(extras)) + extras @ self.dense

    @staticmethod
    def fit(row, column, value, extras, labels, width: int) -> Linear:
        """Full-batch Adam with balanced classes; the data order does not matter."""
        model = Linear(np.zeros(width), np.zeros(extras.shape[1]))
        share = labels.mean() if len(labels) else 0.0
        if share in (0.0, 1.0):
            model.dense[-1] = 30.0 * (2 * share - 1)
            return model
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / len(labels)
        size = width + extras.shape[1]
        first, second = np.zeros(size), np.zeros(size)
        for step in range(1, STEPS + 1):
            error = (1 / (1 + np.exp(-np.clip(model.odds(row, column, value, extras), -30, 30))) - labels) * weight
            slope = np.concatenate([np.bincount(column, error[row] * value, width) + PENALTY * model.sparse, error @ extras])
            first = 0.9 * first + 0.1 * slope
            second = 0.99 * second + 0.01 * slope ** 2
            move = 0.2 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-6)
            model.sparse -= move[:width]
            model.dense -= move[width:]
        return model


@dataclass
class Chain:
    """Selected features and one model per category, in the order of prediction."""

    categories: list[str]
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    middle: np.ndarray = field(default_factory=lambda: np.zeros(STYLES))
    width: np.ndarray = field(default_factory=lambda: np.ones(STYLES))
    models: list[Linear] = field(default_factory=list)
    cuts: list[float] = field(default_factory=list)
    held_out: list[float] = field(default_factory=list)

    def select(self, row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
        return _counts(row[known], at[known])

    def scaled(self, styles: np.ndarray) -> np.ndarray:
        return np.column_stack([np.clip((styles - self.middle) / self.width, -5, 5), np.ones(len(styles))])

    def score(self, row, key, styles) -> np.ndarray:
        """Log-odds of each category for each row."""
        row, column, value = self.select(row, key)
        extras, odds = self.scaled(styles), []
        for model in self.models:
            odds.append(model.odds(row, column, value, extras))
            extras = np.column_stack([np.clip(odds[-1], -6, 6), extras])
        return np.stack(odds, axis=1) if odds else np.zeros((len(styles), 0))


def _sample(docs: DataFrame, labels: DataFrame, categories: list[str], doc_id: str, text: str) -> DataFrame:
    known = labels.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [doc_id, *categories])).groupBy(
        F.col(f"`{doc_id}`").alias("_id")).agg(*(F.max(f"`{c}`").cast("int").alias(f"_y{i}") for i, c in enumerate(categories)))
    known = known.withColumn("_order", F.xxhash64("_id")).orderBy("_order", "_id").limit(SAMPLE)
    texts = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    # One text an id, the one of the lowest hash: rows that share an id meet before the shuffle,
    # so the sample has at most SAMPLE rows however often an id occurs.
    first = F.min(F.struct(F.xxhash64("_text").alias("hash"), F.col("_text").alias("text")))["text"]
    ys = [f"_y{i}" for i in range(len(categories))]
    return texts.join(F.broadcast(known), "_id").groupBy("_id", "_order", *ys).agg(first.alias("_text"))


def _collect(sample: DataFrame, count: int):
    """Labels, folds, styles and sparse features of the bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0)):
                row, key, styles, _ = features_of(block)
                order = np.lexsort((key, row))
                row, key = row[order], key[order]
                part = batch.slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2),
                     string_list(key.view(np.int64), np.bincount(row, minlength=block.rows), pa.int64()),
                     string_list(styles.ravel(), np.full(block.rows, STYLES), pa.float64())],
                    names=["order", "y", "keys", "styles"])

    ys = F.array(*(F.col(f"_y{i}") for i in range(count)))
    table = sample.select("_text", "_order", ys.alias("y")).mapInArrow(
        run, "order long, y array<int>, keys array<long>, styles array<double>").toArrow().combine_chunks()
    rows = table.num_rows
    if not rows:
        return np.zeros(0, np.int64), np.zeros((0, count)), np.zeros((0, STYLES)), np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def flat(name):
        return table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False)

    sizes = np.diff(table["keys"].combine_chunks().offsets.to_numpy())
    return (table["order"].to_numpy(), flat("y").reshape(rows, count), flat("styles").reshape(rows, STYLES),
            np.repeat(np.arange(rows), sizes), flat("keys").view(np.uint64))


def _choose(row, key, labels) -> np.ndarray:
    """The features whose document counts differ most between the classes of any category."""
    row, key, _ = _counts(row, key)
    keys, at, docs = np.unique(key, return_inverse=True, return_counts=True)
    best = np.zeros(len(keys))
    for y in labels.T:
        hits = np.bincount(at, y[row], len(keys))
        n, p = len(y), y.sum()
        expected = docs * p / max(n, 1)
        best = np.maximum(best, (hits - expected) ** 2 / np.maximum(expected * (1 - docs / max(n + 1, 1)), 1e-9))
    best[docs < LEAST_DOCS] = -1
    order = np.lexsort((keys, -best))[:FEATURES]
    return np.sort(keys[order[best[order] > LEAST_CHI2]])


def train(
    docs: DataFrame, labels: DataFrame, categories: list[str], doc_id: str = "doc_id", text: str = "text"
) -> Chain:
    """Fit the chain on a bounded sample of the labelled rows."""
    order, y, styles, row, key = _collect(_sample(docs, labels, categories, doc_id, text), len(categories))
    chain = Chain(list(categories))
    if not len(order):
        chain.models = [Linear(np.zeros(0), np.append(np.zeros(STYLES + i), -30.0)) for i in range(len(categories))]
        chain.cuts, chain.held_out = [0.5] * len(categories), [float("nan")] * len(categories)
        return chain
    chain.keys = _choose(row, key, y)
    chain.middle, chain.width = styles.mean(axis=0), np.maximum(styles.std(axis=0), 1e-6)
    row, column, value = chain.select(row, key)
    fold = order % FOLDS
    extras, width = chain.scaled(styles), len(chain.keys)
    for i in range(len(categories)):
        target = y[:, i].astype(float)
        held = np.zeros(len(order))
        for k in range(FOLDS):
            mine = fold != k
            place = np.cumsum(mine) - 1
            use = mine[row]
            model = Linear.fit(place[row[use]], column[use], value[use], extras[mine], target[mine], width)
            held[~mine] = model.odds(row, column, value, extras)[~mine]
        chain.models.append(Linear.fit(row, column, value, extras, target, width))
        chain.cuts.append(_cut(held, target))
        chain.held_out.append(float(((held > chain.cuts[-1]) == (target == 1)).mean()))
        extras = np.column_stack([np.clip(held, -6, 6), extras])
    return chain


def _cut(odds: np.ndarray, target: np.ndarray) -> float:
    """The log-odds that give the best F1 on held-out rows, midway between two rows."""
    order = np.argsort(-odds, kind="stable")
    hits = np.cumsum(target[order])
    if not len(odds) or not hits[-1]:
        return 0.5
    score = 2 * hits / (np.arange(1, len(odds) + 1) + hits[-1])
    best = int(np.argmax(score))
    after = odds[order[best + 1]] if best + 1 < len(odds) else odds[order[best]] - 1
    return float((odds[order[best]] + after) / 2)


def predict(docs: DataFrame, chain: Chain, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all, unless named) with ``p_<category>`` and ``is_<category>``."""
    share = docs.sparkSession.sparkContext.broadcast(chain)
    columns = docs.columns
    kept = range(len(columns)) if carry is None else [columns.index(name) for name in carry]
    added = [T.StructField(f"p_{c}", T.DoubleType()) for c in chain.categories]
    added += [T.StructField(f"is_{c}", T.BooleanType()) for c in chain.categories]
    schema = T.StructType([*(docs.schema.fields[i] for i in kept), *added])
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = share.value
        for batch in batches:
            for block in blocks(batch.column(at)):
                row, key, styles, _ = features_of(block)
                odds = chain.score(row, key, styles)
                part = batch.slice(block.first, block.rows)
                chances = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in kept), *(pa.array(np.round(c, 6)) for c in chances.T),
                     *(pa.array(o > cut) for o, cut in zip(odds.T, chain.cuts))],
                    names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)
