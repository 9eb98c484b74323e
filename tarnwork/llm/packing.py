"""Best-fit packing with a swap-based local search (operator 13).

Documents become token ids; those longer than a sequence are cut into full pieces, only
the first of which may be shorter. Pieces are packed in *cells* of consecutive stored
rows, so nothing is shuffled: best fit first, then a local search among the underfull
sequences of a cell. The emptiest sequence gives a document to another one, exchanges
one for one, two for one or one for two, always so that the sum of squared fills grows,
until it is empty or nothing helps. Sequences that stay clearly underfull in their cell
are packed anew together with those of other cells, level by level, as long as that
saves sequences; only their rows, without token ids, are ever moved.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.token_files import byte_level
from tarnwork.llm.words import give_back, pieces, spread
from tarnwork.scratch import materialize

CAPACITY = 1024
#: Pieces that are packed together.
CELL = 8192
#: A sequence filled to no more than this share goes on to the next level.
LOOSE = 7 / 8

_PIECE_SQL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>"
_NARROW = ("doc_id", "piece", "start", "length", "ids_crc32")


# --- pieces -------------------------------------------------------------------


def _piece_batches(
    batches: Iterator[pa.RecordBatch], path: str, capacity: int
) -> Iterator[pa.RecordBatch]:
    encoder = byte_level(path)
    for batch in batches:
        for part in pieces(batch.column(1)):
            flat, n = encoder.encode(part)
            count = -(-n // capacity)
            of = np.repeat(np.arange(part.n_texts), count)
            number = np.arange(len(of)) - np.repeat(spread(count)[:-1], count)
            first = n - (count - 1) * capacity
            start = np.where(number == 0, 0, first[of] + (number - 1) * capacity)
            length = np.where(number == 0, first[of], capacity)
            offsets = spread(length)
            little = np.asarray(flat, "<i4")
            sums = [zlib.crc32(little[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            ids = batch.column(0).slice(part.first, part.n_texts)
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(of)), pa.array(number.astype(np.int32)), pa.array(start),
                 pa.array(length), pa.array(sums, pa.int64()), lists],
                [*_NARROW, "ids"],
            )
    give_back()


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, ids`` of every document.

    A document's ids end with the end id, so a null or empty text is one piece of length
    1. ``tokenizer`` is a file that every executor can read. Ids of documents are whole
    numbers; repeated rows, and null ids, give pieces like any others. Other columns are
    ignored.
    """
    chosen = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    return chosen.mapInArrow(partial(_piece_batches, path=tokenizer, capacity=capacity), _PIECE_SQL)


# --- one cell -----------------------------------------------------------------


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: large items keep others out of their bins."""
    count = np.bincount(lengths, minlength=capacity + 1)
    size = count * np.arange(capacity + 1)
    n_up, s_up = spread(count), spread(size)  # items, and their sum, below each length
    half = capacity // 2
    k = np.arange(half + 1)
    alone = n_up[-1] - n_up[capacity - k + 1]
    n_large = n_up[capacity - k + 1] - n_up[half + 1]
    room = n_large * capacity - (s_up[capacity - k + 1] - s_up[half + 1])
    small = s_up[half + 1] - s_up[k]
    return int((alone + n_large + np.maximum(0, -(-(small - room) // capacity))).max())


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Items in descending order, each into the fullest bin that can take it."""
    bins: list[list[int]] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has room r
    for s in np.sort(lengths)[::-1].tolist():
        fits = rooms >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            chosen = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
            bins[chosen].append(s)
        else:
            room, chosen = capacity, len(bins)
            bins.append([s])
        if room > s:
            with_room[room - s].append(chosen)
            rooms |= 1 << (room - s)
    return bins


class _Reach:
    """What underfull bins can take: ``reach`` is the largest length that fits in place of
    ``give`` (0: nothing, a length, or the sum of two), found by the smallest reach."""

    def __init__(self, capacity: int):
        self.by_reach: list[dict[int, dict[int, tuple]]] = [{} for _ in range(capacity + 1)]
        self.used = 0

    def add(self, reach: int, give: int, bin_: int, items: tuple) -> None:
        self.by_reach[reach].setdefault(give, {})[bin_] = items
        self.used |= 1 << reach

    def drop(self, reach: int, give: int, bin_: int) -> None:
        gives = self.by_reach[reach]
        if gives.get(give, {}).pop(bin_, None) is not None and not gives[give]:
            del gives[give]
            if not gives:
                self.used ^= 1 << reach

    def find(self, size: int) -> tuple[int, int, int, tuple] | None:
        """``reach, give, bin, items`` for something smaller to be replaced by ``size``."""
        left = self.used >> size
        while left:
            step = (left & -left).bit_length() - 1
            gives = self.by_reach[size + step]
            give = min(gives)
            if give < size:
                bin_ = next(iter(gives[give]))
                return size + step, give, bin_, gives[give][bin_]
            left &= left - 1
        return None


class LocalSearch:
    """Moves and exchanges among underfull bins; each step adds to the sum of squared fills."""

    def __init__(self, bins: list[list[int]], capacity: int):
        self.bins, self.capacity = bins, capacity
        self.fill = [sum(b) for b in bins]
        self.none, self.one, self.two = (_Reach(capacity) for _ in range(3))

    @staticmethod
    def _pairs(items: list[int]) -> list[tuple[int, int]]:
        """Pairs of lengths; equal items are interchangeable, so each pair stands once."""
        kinds = sorted(set(items))
        twice = [(k, k) for k in kinds if items.count(k) > 1]
        return [(a, b) for i, a in enumerate(kinds) for b in kinds[i + 1 :]] + twice

    def _each(self, j: int):
        items, room = self.bins[j], self.capacity - self.fill[j]
        if room and items:
            yield self.none, room, 0, ()
            for t in set(items):
                yield self.one, t + room, t, (t,)
            for a, b in self._pairs(items):
                yield self.two, a + b + room, a + b, (a, b)

    def _list(self, j: int) -> None:
        for table, reach, give, items in self._each(j):
            table.add(reach, give, j, items)

    def _unlist(self, j: int) -> None:
        for table, reach, give, _ in self._each(j):
            table.drop(reach, give, j)

    def _best_step(self, i: int) -> tuple | None:
        """The step with the largest gain for bin ``i``: what it gives, to whom, for what."""
        singles = [(s, (s,)) for s in set(self.bins[i])]
        pairs = [(a + b, (a, b)) for a, b in self._pairs(self.bins[i])]
        tries = [(self.none, singles), (self.one, singles), (self.two, singles), (self.one, pairs)]
        best = None
        for table, gifts in tries:
            if not table.used:
                continue
            for size, given in gifts:
                found = table.find(size) if size <= self.capacity else None
                if found is None:
                    continue
                _, give, j, taken = found
                d = size - give
                gain = d * (self.fill[j] - self.fill[i] + d)
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, given, j, taken)
        return best

    def empty(self, i: int) -> bool:
        """Take steps for bin ``i`` while there are any; whether it is empty then."""
        self._unlist(i)
        while self.bins[i]:
            step = self._best_step(i)
            if step is None:
                self._list(i)
                return False
            _, given, j, taken = step
            self._unlist(j)
            for source, target, items in ((i, j, given), (j, i, taken)):
                for s in items:
                    self.bins[source].remove(s)
                    self.bins[target].append(s)
                    self.fill[source] -= s
                    self.fill[target] += s
            self._list(j)
        return True

    def run(self, least: int) -> list[list[int]]:
        """Sweep from the emptiest bin on, until a sweep empties none or ``least`` are left."""
        underfull = [j for j, f in enumerate(self.fill) if f < self.capacity]
        for j in underfull:
            self._list(j)
        left, emptied = len(self.bins), True
        while emptied and left > least:
            emptied = False
            for i in sorted(underfull, key=lambda j: (self.fill[j], j)):
                if left > least and 0 < self.fill[i] < self.capacity and self.empty(i):
                    left, emptied = left - 1, True
        return [b for b in self.bins if b]


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item, bins from 0, and its offset there."""
    bins = best_fit(lengths, capacity)
    least = least_bins(lengths, capacity)
    if len(bins) > least:
        bins = LocalSearch(bins, capacity).run(least)
    # Items of one length are dealt in their order to the places of that length.
    places = np.array([(s, j) for j, b in enumerate(bins) for s in b], np.int64).reshape(-1, 2)
    bin_of = np.empty(len(lengths), np.int64)
    bin_of[np.argsort(lengths, kind="stable")] = places[np.argsort(places[:, 0], kind="stable"), 1]
    order = np.argsort(bin_of, kind="stable")
    before = spread(lengths[order])[:-1]
    head = np.searchsorted(bin_of[order], np.arange(len(bins)))
    offset = np.empty(len(lengths), np.int64)
    offset[order] = before - before[head][bin_of[order]]
    return bin_of, offset


# --- all cells ----------------------------------------------------------------


def _pack_cells(
    batches: Iterator[pa.RecordBatch], level: int, capacity: int, cell: int
) -> Iterator[pa.RecordBatch]:
    """Rows with ``sequence_id, offset, loose``; a cell is a run of a task's rows.

    A cell whose rows had sequences before keeps them unless fewer do.
    """
    task = TaskContext.get().partitionId()
    names = [*_NARROW, "sequence_id", "offset", "loose"]
    held, size, made = [], 0, 0

    def pack() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        lengths = table["length"].to_numpy()
        bins, offset = pack_lengths(lengths, capacity)
        sequence = (level << 58) + (task << 36) + (made << 14) + bins
        before = table["sequence_id"].to_numpy(zero_copy_only=False)
        if level and len(np.unique(before)) <= bins.max() + 1:
            _, bins = np.unique(before, return_inverse=True)
            sequence, offset = before, table["offset"].to_numpy()
        fill = np.bincount(bins, weights=lengths)
        loose = fill[bins] <= LOOSE * capacity
        columns = [table[c].combine_chunks() for c in _NARROW]
        new = [pa.array(sequence), pa.array(offset), pa.array(loose)]
        return pa.RecordBatch.from_arrays([*columns, *new], names)

    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, cell - size)
            held, size = [*held, part], size + part.num_rows
            batch = batch.slice(part.num_rows)
            if size == cell:
                yield pack()
                held, size, made = [], 0, made + 1
    if size:
        yield pack()


_PACKED_SQL = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
    "sequence_id bigint, offset bigint, loose boolean"
)


def pack_pieces(stored: DataFrame, capacity: int = CAPACITY, cell: int = CELL) -> DataFrame:
    """``stored`` pieces (without ids) with ``sequence_id`` and ``offset``.

    ``stored`` is a written table: tasks that run again read the same rows in the same
    order. Sequences hold at most ``capacity`` tokens, offsets are gapless from 0. Every
    row gets a place, repeated rows too; an empty table gives an empty one.
    """
    if cell > 1 << 14:
        raise ValueError("a cell holds at most 16,384 pieces")
    rows = stored.select(
        *_NARROW, F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset")
    )

    def packed(rows: DataFrame, level: int) -> DataFrame:
        run = partial(_pack_cells, level=level, capacity=capacity, cell=cell)
        return materialize(rows.mapInArrow(run, _PACKED_SQL), f"packed-{level}")

    def loose_figures(table: DataFrame) -> tuple[int, int]:
        found = table.where("loose").agg(F.count(F.lit(1)), F.count_distinct("sequence_id")).first()
        return found[0], found[1]

    done = []
    table = packed(rows, 0)
    n_rows, n_sequences = loose_figures(table)
    for level in range(1, 32):
        n_cells = -(-n_rows // cell)
        if n_sequences < 2:
            break
        # Sequences of many cells are mixed; the rows of one stay together.
        mixed = table.where("loose").drop("loose").repartition(n_cells, F.xxhash64("sequence_id", F.lit(level)))
        mixed = mixed.sortWithinPartitions(F.xxhash64("sequence_id"), "sequence_id", "offset")
        after = packed(mixed, level)
        left = after.select("sequence_id").distinct().count()
        if left >= n_sequences:
            break
        done.append(table.where("not loose"))
        table = after
        n_rows, n_sequences = loose_figures(table)
        if n_cells == 1:
            break
    out = table
    for part in done:
        out = out.unionByName(part)
    return out.drop("loose")


def read_sequences(packed: DataFrame, stored: DataFrame) -> DataFrame:
    """``sequence_id, n_pieces, ids``: the whole sequences, from the places and the stored ids.

    Pieces that agree in id, number, start, length and checksum are interchangeable; where
    rows repeat, each place takes one.
    """
    places = packed.groupBy(*_NARROW).agg(
        F.collect_list(F.struct("sequence_id", "offset")).alias("places")
    )
    ids = stored.groupBy(*_NARROW).agg(F.first("ids").alias("ids"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in _NARROW]
    placed = places.alias("p").join(ids.alias("s"), same).select(
        F.explode("places").alias("place"), "ids"
    )
    parts = F.array_sort(F.collect_list(F.struct("place.offset", "ids")))
    return placed.groupBy("place.sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.size("parts").alias("n_pieces"),
        F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = _NARROW,
) -> tuple[DataFrame, DataFrame]:
    """The places of all pieces (``keep``, ``sequence_id, offset``) and the stored pieces."""
    stored = materialize(token_pieces(docs, tokenizer, capacity, doc_id, text), "pieces")
    return pack_pieces(stored, capacity).select(*keep, "sequence_id", "offset"), stored
