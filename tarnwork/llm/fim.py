"""Fill-in-the-middle rearrangement at token boundaries (operator 11).

A text is cut into units (runs of ASCII letters, other characters singly), and two cuts
fall after a number of units that a hash of the document's id gives. Finding the
offsets is a *select* on the set of unit ends: the n-th smallest of them. The set is
kept as Roaring bitmaps are: the high bits of an offset name a container of 65,536
offsets, which is an array, a bitmap or a list of runs, whichever is smallest.
Cumulative cardinalities find the container of a rank by binary search, and a select
inside the container gives the offset.

One pass over the texts in numpy, no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.words import Piece, give_back, pieces

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1:"
#: Of 100 documents so many stay plain, and of the others so many have the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LOW = (1 << 16) - 1


class _Array:
    """Few offsets: themselves."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        return self.low[ranks].astype(np.int64)

    def rank(self, below: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, below)


class _Bitmap:
    """Many offsets: 1,024 words of 64 bits, and the number of bits before each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << 16, np.uint8)
        bits[low] = 1
        self.bytes = np.packbits(bits, bitorder="little").reshape(1024, 8)
        self.before = np.zeros(1025, np.int32)
        np.cumsum(np.bitwise_count(self.bytes).sum(axis=1, dtype=np.int32), out=self.before[1:])

    def _bits(self, words: np.ndarray) -> np.ndarray:
        return np.unpackbits(self.bytes[words], axis=1, bitorder="little")

    def select(self, ranks: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, ranks, "right") - 1
        seen = np.cumsum(self._bits(word), axis=1)
        return word * 64 + (seen == (ranks - self.before[word] + 1)[:, None]).argmax(axis=1)

    def rank(self, below: np.ndarray) -> np.ndarray:
        word, bit = below >> 6, below & 63
        inside = np.arange(64) < bit[:, None]
        return self.before[word] + (self._bits(word) & inside).sum(axis=1, dtype=np.int64)


class _Runs:
    """Consecutive offsets: where each run begins, and the number of offsets before it."""

    def __init__(self, low: np.ndarray, breaks: np.ndarray):
        first = np.concatenate([[0], breaks + 1])
        self.starts = low[first].astype(np.int64)
        self.before = np.concatenate([first, [len(low)]])

    def select(self, ranks: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, ranks, "right") - 1
        return self.starts[run] + ranks - self.before[run]

    def rank(self, below: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.starts, below) - 1
        at = np.maximum(run, 0)
        inside = np.minimum(below - self.starts[at], self.before[at + 1] - self.before[at])
        return np.where(run < 0, 0, self.before[at] + inside)


class BoundarySet:
    """A set of offsets in containers, with rank and select for many queries at once."""

    def __init__(self, offsets: np.ndarray):
        """``offsets`` ascend and are distinct."""
        self.keys, first = np.unique(offsets >> 16, return_index=True)
        #: Offsets before each container, and all of them.
        self.before = np.append(first, len(offsets))
        self.containers = [
            self._container(offsets[a:b] & _LOW) for a, b in zip(self.before[:-1], self.before[1:])
        ]

    @staticmethod
    def _container(low: np.ndarray) -> _Array | _Bitmap | _Runs:
        breaks = np.flatnonzero(np.diff(low) != 1)
        sizes = (4 * (len(breaks) + 1), 2 * len(low), 8192)
        if sizes[0] == min(sizes):
            return _Runs(low, breaks)
        return _Array(low) if sizes[1] < sizes[2] else _Bitmap(low)

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The offsets with the given ranks, from 0."""
        which = np.searchsorted(self.before, ranks, "right") - 1
        out = np.empty(len(ranks), np.int64)
        for c in np.unique(which):
            mine = which == c
            local = self.containers[c].select(ranks[mine] - self.before[c])
            out[mine] = (int(self.keys[c]) << 16) + local
        return out

    def rank(self, below: np.ndarray) -> np.ndarray:
        """How many offsets are smaller than each of ``below``."""
        which = np.searchsorted(self.keys, below >> 16)
        out = self.before[which].astype(np.int64)
        for c in np.unique(which[which < len(self.keys)]):
            mine = (which == c) & (below >> 16 == self.keys[c])
            out[mine] += self.containers[c].rank(below[mine] & _LOW)
        return out


def unit_ends(piece: Piece) -> np.ndarray:
    """Byte offsets after each unit of each text of a piece."""
    data = piece.data
    ends = np.ones(len(data) + 1, bool)
    letter = _LETTER[data]
    ends[1:-1] = ((data[1:] & 0xC0) != 0x80) & ~(letter[:-1] & letter[1:])
    ends[piece.bounds] = True
    ends[0] = False
    return np.flatnonzero(ends)


def _draws(doc_id: int | None) -> list[int]:
    """Four unsigned numbers of 32 bits that depend on the id alone."""
    digest = hashlib.sha256(f"{SEED}{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12)]


def _rearranged(piece: Piece, ids: Sequence[int | None]) -> list[tuple]:
    """``n, form, prefix_chars, middle_chars, output`` of each text of a piece."""
    ends = BoundarySet(unit_ends(piece))
    base = ends.rank(piece.bounds + 1)
    n = np.diff(base)
    draws = np.array([_draws(i) for i in ids], np.int64).reshape(-1, 4)
    cuts = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    # After no unit a cut stands at the text's beginning, else at the end of a unit.
    first = np.broadcast_to(piece.bounds[:-1, None], cuts.shape).copy()
    found = cuts > 0
    first[found] = ends.select((base[:-1, None] + cuts - 1)[found])
    text = piece.data.tobytes()
    p, s, m = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))
    out = []
    for i, (low, high) in enumerate(zip(piece.bounds[:-1], piece.bounds[1:])):
        whole = text[low:high]
        plain = not whole or any(mark in whole for mark in (p, s, m))
        if plain or draws[i, 2] % 100 >= 100 - PLAIN:
            out.append((int(n[i]), "plain", None, None, whole.decode()))
            continue
        x, y = first[i] - low
        prefix, middle, suffix = (part.decode() for part in (whole[:x], whole[x:y], whole[y:]))
        if draws[i, 3] % 100 < SUFFIX_FIRST:
            form, parts = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
        else:
            form, parts = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
        out.append((int(n[i]), form, len(prefix), len(middle), "".join(parts)))
    return out


_NEW = pa.schema(
    [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
     ("middle_chars", pa.int64()), ("output", pa.string())]
)


def _fim_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last two columns are the id and the text; the others are carried."""
    for batch in batches:
        carried = batch.columns[:-2]
        ids = batch.column(batch.num_columns - 2)
        for piece in pieces(batch.column(batch.num_columns - 1)):
            mine = ids.slice(piece.first, piece.n_texts)
            rows = _rearranged(piece, mine.to_pylist())
            new = [pa.array(c, f.type) for c, f in zip(zip(*rows), _NEW)]
            kept = [c.slice(piece.first, piece.n_texts) for c in carried]
            yield pa.RecordBatch.from_arrays(
                [*kept, *new], [*batch.schema.names[:-2], *_NEW.names]
            )
    give_back()


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep`` and ``n, form, prefix_chars, middle_chars, output`` of every row.

    ``output`` is the text, rearranged as ``form`` says: ``psm`` (prefix, suffix, middle),
    ``spm`` (suffix first) or ``plain``. ``n`` is the number of units. The lengths count
    code points and are null where the text stayed plain: because it is null (written as
    empty) or empty, holds one of the marks, or the hash says so. A row depends on its id
    and text alone: repeated rows give repeated results, and all null ids draw alike. Ids
    are whole numbers. Kept columns named like a new one are left out.
    """
    carried = [c for c in keep if c not in _NEW.names]
    chosen = docs.select(
        *[F.col(f"`{c}`") for c in carried],
        F.col(f"`{doc_id}`").cast("long").alias("_id_"), F.col(f"`{text}`").alias("_text_"),
    )
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-2]]
        + ["n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"]
    )
    return chosen.mapInArrow(_fim_batches, schema)


def restore(output: Column, form: Column) -> Column:
    """The text that :func:`fill_in_middle` rearranged, from its output and form.

    No rearranged text holds a mark, and no mark can arise where parts meet, so the first
    occurrence of each is the one that was written.
    """

    def between(start: Column, stop: Column | None = None) -> Column:
        length = F.char_length(output) if stop is None else stop - start
        return F.substring(output, start, length)

    def after(mark: str) -> Column:
        return F.instr(output, mark) + len(mark)

    p, s, m = (F.instr(output, mark) for mark in (PREFIX, SUFFIX, MIDDLE))
    psm = F.concat(between(after(PREFIX), s), between(after(MIDDLE)), between(after(SUFFIX), m))
    spm = F.concat(between(after(PREFIX), m), between(after(MIDDLE)), between(after(SUFFIX), p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
