"""Token ids in ORC files (operator 4).

Documents are range-partitioned and sorted by id before they are encoded, so the work
is done once and every file holds one range. ORC stores the ids run-length encoded, a
row index every few thousand rows and Bloom filters on ``doc_id``: stripes are read in
parallel, and looking up documents skips files, stripes and row groups by metadata.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnwork.llm.words import Piece, give_back, pieces, spread
from tarnwork.scratch import materialize

END_ID = 2
#: Distinct pieces that a worker process remembers before it starts over.
MEMO = 1_000_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_ASCII = np.arange(256) < 128
_GAP = np.isin(np.arange(256), [10, 32])
_VISIBLE = (np.arange(256) > 32) & (np.arange(256) < 127)


def cuts(data: np.ndarray) -> np.ndarray:
    """Places at which a byte-level pre-tokenizer always cuts a text.

    It takes runs of letters, of digits and of other signs, each with at most one space
    before. So a run of letters ends before any other ASCII character, and nothing
    visible is joined with white space after it. Letters are told from their bytes:
    ASCII, and the Latin letters from U+00C0 to U+024F. Other places are left uncut.
    """
    latin = np.zeros(len(data), bool)  # last byte of a two-byte Latin letter
    lead, last = data[:-1], data[1:]
    latin[1:] = (lead >= 0xC3) & (lead <= 0xC8) & (last >= 0x80)
    latin[1:] &= ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))  # the signs x and :
    before = _LETTER[data] | latin
    after_letters = before[:-1] & (_ASCII & ~_LETTER)[data[1:]]
    after_signs = _VISIBLE[data[:-1]] & _GAP[data[1:]]
    return np.flatnonzero(after_letters | after_signs) + 1


class PieceEncoder:
    """Encodes texts piece by piece, each distinct piece once.

    Pieces are told apart by 64-bit hashes, in numpy; only new ones become strings. A
    subclass says where pieces may be cut and encodes them.
    """

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # ascending
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.exact = np.zeros(0, bool)
        self.ids, self.used = np.zeros(1 << 20, np.int32), 0

    def opens(self, piece: Piece) -> np.ndarray:
        """For each byte, and the end, whether a piece may begin there."""
        raise NotImplementedError

    def encode_pieces(self, pieces_: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def is_exact(self, piece: str, ids: list[int]) -> bool:
        """Whether the ids stand for the piece, byte for byte."""
        return True

    def _learn(self, keys: np.ndarray, pieces_: list[str]) -> None:
        encoded = self.encode_pieces(pieces_)
        exact = [self.is_exact(p, ids) for p, ids in zip(pieces_, encoded)]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter(chain.from_iterable(encoded), np.int32, int(lengths.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.int32)])
        self.ids[self.used : self.used + len(flat)] = flat
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.starts = np.insert(self.starts, at, self.used + np.cumsum(lengths) - lengths)
        self.lengths = np.insert(self.lengths, at, lengths)
        self.exact = np.insert(self.exact, at, exact)
        self.used += len(flat)

    def ids_of(self, piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of the texts, how many each has, and whether its pieces are all exact."""
        if len(self.keys) > MEMO:
            self.clear()
        data, bounds = piece.data, piece.bounds
        starts = np.flatnonzero(self.opens(piece)[:-1])
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        keys, first, which = np.unique(
            piece.hash_spans(starts, ends), return_index=True, return_inverse=True
        )
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        if not known.all():
            text = data.tobytes()
            new = first[~known]
            self._learn(keys[~known], [text[a:b].decode() for a, b in zip(starts[new], ends[new])])
            at = np.searchsorted(self.keys, keys)
        at = at[which]
        lengths, where = self.lengths[at], self.starts[at]
        stops = np.cumsum(lengths)
        borders = np.searchsorted(starts, bounds)
        sums = np.concatenate([[0], stops])[borders]
        odd = spread(~self.exact[at])[borders]
        source = np.arange(sums[-1]) + np.repeat(where - (stops - lengths), lengths)
        return self.ids[source], np.diff(sums), np.diff(odd) == 0

    def encode(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text's followed by the end id, and how many each has."""
        ids, counts, _ = self.ids_of(piece)
        n_tokens = counts + 1
        flat = np.full(len(ids) + piece.n_texts, END_ID, np.int32)
        keep = np.ones(len(flat), bool)
        keep[np.cumsum(n_tokens) - 1] = False
        flat[keep] = ids
        return flat, n_tokens


class ByteLevelEncoder(PieceEncoder):
    """Ids as the tokenizer file gives them: its added tokens are found in the texts first,
    but special ones are ordinary text if ``special_as_text``."""

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        added = [t for t in added if not (t.special and special_as_text)]
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("added tokens that depend on the text around them are not supported")
        self.added = [t.content.encode() for t in added]

    def opens(self, piece: Piece) -> np.ndarray:
        out = np.zeros(len(piece.data) + 1, bool)
        out[piece.bounds] = True
        out[cuts(piece.data)] = True
        text = piece.data.tobytes() if self.added else b""
        for token in self.added:
            at = text.find(token)
            while at >= 0:
                end = at + len(token)
                border = np.searchsorted(piece.bounds, at, "right")
                inside = piece.bounds[border] >= end  # not across two texts
                if inside:
                    out[at:end] = False
                    out[[at, end]] = True
                at = text.find(token, end if inside else at + 1)
        return out

    def encode_pieces(self, pieces_: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(pieces_, add_special_tokens=False)
        return [e.ids for e in found]


@lru_cache(maxsize=1)
def byte_level(path: str, special_as_text: bool = False) -> ByteLevelEncoder:
    """One encoder per worker process: its pieces serve all tasks that run there."""
    # Spark runs a task per core; threads of the tokenizer's own would only cost memory.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ByteLevelEncoder(path, special_as_text)


def _encode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoder, place = byte_level(path), 0
    for batch in batches:
        ids = batch.column(0)
        for piece in pieces(batch.column(1)):
            flat, counts = encoder.encode(piece)
            offsets = spread(counts).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            places = pa.array(np.arange(place, place + piece.n_texts), pa.int64())
            place += piece.n_texts
            yield pa.RecordBatch.from_arrays(
                [ids.slice(piece.first, piece.n_texts), places, lists], ["doc_id", "place", "ids"]
            )
    give_back()


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    row_index_stride: int = 2000,
    stripe_bytes: int = 16 << 20,
) -> None:
    """Write ``doc_id, place, ids`` of every document as ORC, ascending by id.

    ``place`` is the row's number in its file. ``tokenizer`` is a file that every
    executor can read; where a text holds the string of one of its added tokens, that token
    is written, as the tokenizer does unless told otherwise. A null text has only the end id; null ids come first, documents
    of equal ids in the order of a hash of their texts.
    """
    chosen = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"),
        F.xxhash64(F.col(f"`{text}`")).alias("h"),
    )
    ranged = chosen.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    encoded = ranged.select("doc_id", "text").mapInArrow(
        partial(_encode_batches, path=tokenizer), "doc_id bigint, place bigint, ids array<int>"
    )
    encoded.write.options(
        **{
            "orc.bloom.filter.columns": "doc_id",
            "orc.bloom.filter.fpp": "0.01",
            "orc.row.index.stride": str(row_index_stride),
            "orc.stripe.size": str(stripe_bytes),
            "compression": "zstd",
        }
    ).orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """The stored documents, or those with the given ids: the filter reaches the files."""
    stored = spark.read.schema("doc_id bigint, place bigint, ids array<int>").orc(path)
    return stored if doc_ids is None else stored.where(F.col("doc_id").isin(list(doc_ids)))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        offsets = lists.offsets.to_numpy()
        values = np.asarray(lists.values, dtype="<i4")
        sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(np.diff(offsets), pa.int64()), pa.array(sums, pa.int64())],
            [*batch.schema.names[:-1], "n_tokens", "ids_crc32"],
        )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every stored document, from the files.

    ``start`` counts the ids of all documents before it. Running sums are kept within a
    file; files, one row each, are summed up in the order of their names.
    """
    stored = read_tokens(spark, path).select(
        "doc_id", "place", F.regexp_extract("_metadata.file_name", r"part-\d+", 0).alias("part"),
        F.col("_metadata.file_name").alias("file"), "ids",
    )
    rows = stored.mapInArrow(
        _digest,
        "doc_id bigint, place bigint, part string, file string, n_tokens bigint, ids_crc32 bigint",
    )
    rows = materialize(rows, "token-index")
    inside = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    files = rows.groupBy("file", "part").agg(F.sum("n_tokens").alias("in_file"))
    number = F.substring("part", 6, 20).cast("long")
    earlier = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(
        F.col("file").alias("f"), F.coalesce(F.sum("in_file").over(earlier), F.lit(0)).alias("base")
    )
    return rows.join(starts, F.col("file") == F.col("f")).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )
