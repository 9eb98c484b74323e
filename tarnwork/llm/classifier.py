"""Quality classifier: histogram gradient-boosted trees over text statistics (operator 7).

Statistics of every whole text are measured in numpy. Trees are fitted on a bounded
sample of labelled rows: features are cut into quantile bins once, and each level of a
tree sums gradients by node, feature and bin. A fitted model is three flat arrays, by
which whole batches are scored without a loop over rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.llm import rules
from tarnwork.llm.words import Piece, in_text, later, pieces, repeated, spread
from tarnwork.scratch import materialize

#: Labelled rows the trees are fitted on, at most; those with the lowest hashes of the id.
SAMPLE = 20_000

_LENGTHS = (2, 5)
#: Fixed classes of bytes whose shares of a text are features.
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "stop": b".,;:",
    "shout": b"!?",
    "pipe": b"|",
    "symbol": b"#*$%&<>@=~^_+",
    "bracket": b"()[]{}\"'`/\\",
    "line": b"\n",
}
_FLAGS = {name: np.isin(np.arange(256), list(chars)) for name, chars in _CLASSES.items()}

FEATURES = [
    "log_words", "word_length", "word_length_spread", "long_words", "short_words", "distinct",
    "symbol_words", "dup_lines", "repeat_words", "dup_line_chars",
    *[f"dup_chars_{n}" for n in _LENGTHS],
    *[f"share_{name}" for name in _CLASSES], "share_other", "line_words", "capital_words", "marked_words",
]


def features(piece: Piece) -> np.ndarray:
    """One row of :data:`FEATURES` per text; an empty text has zeros."""
    found = rules.measure(piece, _LENGTHS)
    words = np.maximum(piece.n_words, 1)
    chars = np.maximum(found["word_chars"], 1)
    size = np.maximum(np.diff(piece.bounds), 1)
    lengths = piece.ends - piece.starts
    per_text = partial(_by_text, bounds=piece.words)
    mean = per_text(lengths) / words
    spread_ = np.sqrt(np.maximum(per_text(lengths**2) / words - mean**2, 0))
    keys = in_text(piece.word_hashes(), piece.text_of_word())
    first = np.ones(len(keys), bool)
    first[later(keys, repeated(keys))] = False
    heads, tails = piece.data[piece.starts], piece.data[piece.ends - 1]
    mark = _FLAGS["symbol"] | _FLAGS["shout"] | _FLAGS["pipe"]
    shares = [piece.total(flag[piece.data]) / size for flag in _FLAGS.values()]
    lines = piece.total(_FLAGS["line"][piece.data]) + 1
    columns = [
        np.log1p(piece.n_words), mean, spread_, per_text(lengths > 12) / words,
        per_text(lengths < 3) / words, per_text(first) / words, found["n_symbols"] / words,
        found["n_dup_lines"] / lines, found["n_repeat_words"] / words, found["dup_line_chars"] / chars,
        *[found[f"dup_chars_{n}"] / chars for n in _LENGTHS],
        *shares, piece.total(piece.data >= 128) / size, piece.n_words / lines,
        per_text(_FLAGS["upper"][heads]) / words, per_text(mark[tails] | mark[heads]) / words,
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def _by_text(of_words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = spread(of_words.astype(np.int64))
    return sums[bounds[1:]] - sums[bounds[:-1]]


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: node ``i`` has the children ``2 i + 1`` and ``2 i + 2``."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row: one step down all trees at a time."""
        n_trees, inner = self.feature.shape
        depth = (inner + 1).bit_length() - 1
        tree = np.arange(n_trees)[None, :]
        node = np.zeros((len(rows), n_trees), np.int64)
        row = np.arange(len(rows))[:, None]
        for _ in range(depth):
            right = rows[row, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        total = self.base + self.leaf[tree, node - inner].sum(axis=1, dtype=np.float64)
        return 1 / (1 + np.exp(-total))


def fit_trees(
    rows: np.ndarray,
    labels: np.ndarray,
    n_trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    ridge: float = 0.5,
    least: float = 0.3,
) -> Trees:
    """Boost trees for the logistic loss.

    ``least`` is the smallest sum of second derivatives in a child. With no rows or one
    label only, the trees are stumps of zeros and the score is the smoothed base rate.
    """
    n, m = rows.shape
    labels = labels.astype(np.float64)
    rate_of_ones = (labels.sum() + 1) / (n + 2)
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    inner = 2**depth - 1
    feature = np.zeros((n_trees, inner), np.int32)
    threshold = np.full((n_trees, inner), np.inf, np.float32)
    leaf = np.zeros((n_trees, inner + 1), np.float64)
    if n:
        steps = np.linspace(0, 1, bins + 1)[1:-1]
        cuts = np.quantile(rows, steps, axis=0, method="lower").astype(np.float32)  # bins - 1 x m
        binned = np.stack([np.searchsorted(cuts[:, j], rows[:, j], "left") for j in range(m)], 1)
        flat = binned + np.arange(m) * bins
    total = np.full(n, base)
    for t in range(n_trees if n else 0):
        chance = 1 / (1 + np.exp(-total))
        slope, curve = labels - chance, chance * (1 - chance)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (m * bins) + flat).ravel()
            shape = (width, m, bins)
            g = np.bincount(cell, np.repeat(slope, m), width * m * bins).reshape(shape)
            h = np.bincount(cell, np.repeat(curve, m), width * m * bins).reshape(shape)
            left_g, left_h = g.cumsum(2)[:, :, :-1], h.cumsum(2)[:, :, :-1]
            all_g, all_h = g.sum(2, keepdims=True), h.sum(2, keepdims=True)
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - all_g**2 / (all_h + ridge)
            gain[(left_h < least) | (right_h < least)] = -1
            best = gain.reshape(width, -1).argmax(1)
            worth = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            where = first + np.arange(width)
            feature[t, where] = np.where(worth, best // (bins - 1), 0)
            threshold[t, where] = np.where(
                worth, cuts[best % (bins - 1), best // (bins - 1)], np.float32(np.inf)
            )
            node = 2 * node + 1 + (rows[np.arange(n), feature[t, node]] > threshold[t, node])
        at = node - inner
        g, h = np.bincount(at, slope, inner + 1), np.bincount(at, curve, inner + 1)
        leaf[t] = rate * g / (h + ridge)
        total += leaf[t, at]
    return Trees(feature, threshold, leaf, base)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [features(p) for p in pieces(batch.column(batch.num_columns - 1))]
        rows = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)), np.float32)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *[pa.array(rows[:, j], pa.float32()) for j in range(rows.shape[1])]],
            [*batch.schema.names[:-1], *FEATURES],
        )


def _score_batches(batches: Iterator[pa.RecordBatch], trees: Trees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [trees.score(features(p)) for p in pieces(batch.column(batch.num_columns - 1))]
        joined = np.concatenate(scores) if scores else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(joined, pa.float64())], [*batch.schema.names[:-1], "score"]
        )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
    **options,
) -> Trees:
    """Trees fitted on those labelled documents for which ``learn`` (over the id) holds.

    At most ``sample`` of them: the ones with the lowest hashes of their ids, chosen
    before any text is read. Null labels are ignored; contradicting ones count as their
    mean, rounded.
    """
    known = (
        labels.where(F.col(f"`{label}`").isNotNull() & learn)
        .groupBy(F.col(f"`{doc_id}`").alias("_id"))
        .agg(F.round(F.avg(f"`{label}`")).cast("int").alias("label"))
    )
    chosen = materialize(known.orderBy(F.xxhash64("_id"), "_id").limit(sample), "labelled")
    texts = docs.select(F.col(f"`{doc_id}`").alias("_d"), F.col(f"`{text}`").alias("_text_"))
    # No more than ``sample`` rows of two numbers.
    joined = texts.join(F.broadcast(chosen), F.col("_d") == F.col("_id")).select("_d", "label", "_text_")
    schema = "id bigint, label int, " + ", ".join(f"{name} float" for name in FEATURES)
    measured = joined.select(F.col("_d").cast("long").alias("id"), "label", "_text_").mapInArrow(_feature_batches, schema)
    # Repeated rows of a document would make the sample larger than promised; of several
    # texts under one id the one with the smallest figures counts, in every run the same.
    first = measured.groupBy("id").agg(F.min(F.struct("label", *FEATURES)).alias("first"))
    table = first.select("id", "first.*").toPandas().sort_values("id")
    return fit_trees(table[FEATURES].to_numpy(np.float32), table["label"].to_numpy(), **options)


def score(docs: DataFrame, trees: Trees, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """``keep`` and ``score`` of every document; null and empty texts are scored too.

    A kept column named ``score`` gives way to the result.
    """
    keep = tuple(c for c in keep if c != "score")
    chosen = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text_"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(partial(_score_batches, trees=trees), f"{schema}, score double")
