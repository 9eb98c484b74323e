"""Quality rules: how much of a text is repetition (operator 10).

For several n-gram lengths, rolling hashes of the words find n-grams that have
occurred earlier in the same text; the share of the text's characters that they
cover is measured without counting a character twice, as is the share in repeated
lines. One pass over the texts in numpy, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnwork.llm.words import (
    Piece,
    give_back,
    in_text,
    later,
    pieces,
    repeated,
    spread,
    window_hashes,
    windows_inside,
)

#: Largest percentage of a text's characters inside repeated n-grams, by n-gram length.
NGRAM_LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: Largest percentage of a text's characters inside repeated lines.
LINE_LIMIT = 30
#: So many words in 3-word windows that recur are allowed in any text: a line of
#: boilerplate at its beginning and its end.
ALLOWED_WORDS = 40

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


def measures(lengths: Mapping[int, int] = NGRAM_LIMITS) -> list[str]:
    return [*_COUNTS, *[f"dup_chars_{n}" for n in lengths]]


def measure(piece: Piece, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """All measures of the texts of a piece."""
    data, texts, words = piece.data, piece.text_of_word(), piece.word_hashes()
    char = (data & 0xC0) != 0x80  # bytes that begin a code point
    chars = spread(char)
    word_chars = chars[piece.ends] - chars[piece.starts]
    of_words = partial(_by_text, bounds=piece.words)
    out = {
        "n_words": piece.n_words,
        "word_chars": of_words(word_chars),
        "n_symbols": piece.total(_SYMBOL[data]),
    }

    # A line ends at \n or at the end of its text.
    stops = np.unique(np.concatenate([np.flatnonzero(data == 10), piece.bounds[1:]]))
    starts = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, piece.bounds[:-1]]))
    starts = starts[starts < len(data)]
    starts = starts[data[starts] != 10]  # else the line is empty
    ends = stops[np.searchsorted(stops, starts, "right")]
    has_word = np.searchsorted(piece.starts, ends) > np.searchsorted(piece.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    line_text = np.searchsorted(piece.bounds, starts, "right") - 1
    keys = in_text(piece.hash_spans(starts, ends), line_text)
    again = later(keys, repeated(keys))
    out["n_dup_lines"] = np.bincount(line_text[again], minlength=piece.n_texts)
    covered = _cover(np.searchsorted(piece.starts, starts[again]),
                     np.searchsorted(piece.starts, ends[again]), len(texts))
    out["dup_line_chars"] = of_words(word_chars * covered)

    for n in (3, *lengths):
        at = windows_inside(texts, n)
        keys = in_text(window_hashes(words, n)[at], texts[at])
        found = repeated(keys)
        if n == 3:
            covered = _cover(at[found], at[found] + n, len(texts))
            out["n_repeat_words"] = of_words(covered)
        if n in lengths:
            again = later(keys, found)
            covered = _cover(at[again], at[again] + n, len(texts))
            out[f"dup_chars_{n}"] = of_words(word_chars * covered)
    return out


def _by_text(of_words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = spread(of_words)
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _cover(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Whether each of ``n`` words lies in one of the spans."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:n]) > 0


def judge(found: Mapping[str, np.ndarray], limits: Mapping[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """``base_failed`` and ``kept`` of measured texts.

    Base: fewer than 50 words, or over half of them in 3-word windows that recur. The
    method's verdict: repeated n-grams or lines cover too much, and there is more
    repetition than a boilerplate line at both ends.
    """
    repeat = found["n_repeat_words"]
    base_failed = (found["n_words"] < 50) | (100 * repeat > 50 * found["n_words"])
    repetitive = 100 * found["dup_line_chars"] > LINE_LIMIT * found["word_chars"]
    for n, limit in limits.items():
        repetitive |= 100 * found[f"dup_chars_{n}"] > limit * found["word_chars"]
    return base_failed, ~base_failed & ~(repetitive & (repeat > ALLOWED_WORDS))


def _measured(texts: pa.Array, limits: Mapping[int, int]) -> dict[str, np.ndarray]:
    found = [measure(p, tuple(limits)) for p in pieces(texts)]
    none = np.zeros(0, np.int64)
    return {name: np.concatenate([none, *[f[name] for f in found]]) for name in measures(limits)}


def _measure_batches(
    batches: Iterator[pa.RecordBatch], limits: Mapping[int, int], judged: bool
) -> Iterator[pa.RecordBatch]:
    """The last column is the text; the others are carried."""
    for batch in batches:
        found = _measured(batch.column(batch.num_columns - 1), limits)
        if judged:
            found["base_failed"], found["kept"] = judge(found, limits)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *map(pa.array, found.values())],
            [*batch.schema.names[:-1], *found],
        )
    give_back()


def _keep_batches(
    batches: Iterator[pa.RecordBatch], text: int, limits: Mapping[int, int]
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, kept = judge(_measured(batch.column(text), limits), limits)
        yield batch.filter(pa.array(kept))
    give_back()


def _ddl(fields: Sequence[T.StructField]) -> list[str]:
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]


def _apply(
    docs: DataFrame, text: str, keep: Sequence[str] | None, limits: Mapping[int, int], judged: bool
) -> DataFrame:
    names = measures(limits) + ["base_failed", "kept"] * judged
    carried = [c for c in (docs.columns if keep is None else keep) if c not in names]
    chosen = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").alias("_text_"))
    schema = _ddl(chosen.schema.fields[:-1]) + [f"{name} bigint" for name in measures(limits)]
    schema += ["base_failed boolean", "kept boolean"] * judged
    run = partial(_measure_batches, limits=limits, judged=judged)
    return chosen.mapInArrow(run, ", ".join(schema))


def repetition(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] | None = None,
    limits: Mapping[int, int] = NGRAM_LIMITS,
) -> DataFrame:
    """``docs`` with the measures of :func:`measures` added.

    A null or empty text has zeros throughout. Columns named like a measure are
    replaced. ``keep`` names the columns to carry (default: all). Long texts are
    measured whole; a row's result depends on its text alone, so repeated rows give
    repeated results.
    """
    return _apply(docs, text, keep, limits, judged=False)


def apply_rules(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] | None = None,
    limits: Mapping[int, int] = NGRAM_LIMITS,
) -> DataFrame:
    """Measures plus ``base_failed`` and ``kept``, see :func:`judge` and :func:`repetition`."""
    return _apply(docs, text, keep, limits, judged=True)


def keep_documents(
    docs: DataFrame, text: str = "text", limits: Mapping[int, int] = NGRAM_LIMITS
) -> DataFrame:
    """The rows of ``docs`` that :func:`apply_rules` keeps, unchanged.

    Rows are judged and left out batch by batch, so each column travels once.
    """
    run = partial(_keep_batches, text=docs.columns.index(text), limits=limits)
    return docs.mapInArrow(run, ", ".join(_ddl(docs.schema.fields)))
