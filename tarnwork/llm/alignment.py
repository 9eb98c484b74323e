"""Alignment of two tokenizers' ids over the same texts (operator 12).

Both tokenizers cut the bytes of a space and the text. Byte offsets at which both end a
token cut them into groups. The two arrays of token ends are walked at an index shift:
where the next ends agree the tokens are one to one, and exponential probing (stretches
of 1, 2, 4, ... ends compared as blocks of memory, then halved again) jumps to the end
of that diagonal run. Where they differ, the smaller end moves on until both agree: one
irregular group, after which the shift is another.

A token pair is linked where byte ranges overlap. How often each pair of ids is linked
is counted over the whole corpus: a task reports a block of documents with its distinct
pairs, pairs are summed up by Spark, and each block gets the sums of its own pairs back.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.token_files import ByteLevelEncoder, PieceEncoder
from tarnwork.llm.words import Piece, give_back, pieces, spread
from tarnwork.scratch import materialize

#: A block of documents is closed at so many links or documents.
BLOCK_LINKS = 2_000_000
BLOCK_DOCS = 50_000

_SPACE = np.arange(256) == 32


# --- two encoders -------------------------------------------------------------


class SentencePieceEncoder(PieceEncoder):
    """Ids of a sentencepiece model that adds a space before each text.

    Texts are given with that space in front. They may be cut before every run of spaces:
    no entry of the vocabulary goes on after a space, which is checked.
    """

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in entry.lstrip("▁") for entry in entries):
            raise ValueError("vocabularies with entries of several words are not supported")
        byte = [self.model.is_byte(i) for i in range(len(entries))]
        self.bytes = [
            bytes([int(e[3:5], 16)]) if b else e.replace("▁", " ").encode()
            for e, b in zip(entries, byte)
        ]
        self.space = self.model.piece_to_id("▁")

    def opens(self, piece: Piece) -> np.ndarray:
        out = np.zeros(len(piece.data) + 1, bool)
        out[piece.bounds] = True
        space = _SPACE[piece.data]
        out[1:-1] |= space[1:] & ~space[:-1]
        return out

    def encode_pieces(self, pieces_: list[str]) -> list[list[int]]:
        found = self.model.encode([p[1:] for p in pieces_], num_threads=1)
        # An empty text gets no space from the model; a last space of a text stands alone.
        return [[self.space] if p == " " else ids for p, ids in zip(pieces_, found)]

    def is_exact(self, piece: str, ids: list[int]) -> bool:
        return b"".join([self.bytes[i] for i in ids]) == piece.encode()


class _ByteLevel(ByteLevelEncoder):
    """The byte-level encoder, special strings as text, with the bytes of its entries."""

    def __init__(self, path: str):
        super().__init__(path, special_as_text=True)
        self.bytes = byte_level_bytes(self.tokenizer)

    def is_exact(self, piece: str, ids: list[int]) -> bool:
        return b"".join([self.bytes[i] for i in ids]) == piece.encode()


def byte_level_bytes(tokenizer) -> list[bytes]:
    """The bytes each entry of a byte-level vocabulary stands for.

    Bytes are written as characters: the printable ones of Latin-1 as themselves, the
    others, in order, as the characters from U+0100 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    added = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
    out = []
    for i in range(tokenizer.get_vocab_size()):
        if i in added:
            out.append(added[i].encode())
        else:
            out.append(bytes(byte_of[c] for c in tokenizer.id_to_token(i)))
    return out


@lru_cache(maxsize=1)
def _encoders(a_path: str, b_path: str) -> tuple[_ByteLevel, SentencePieceEncoder]:
    """One pair per worker process: their pieces serve all tasks that run there."""
    # Spark runs a task per core; threads of the tokenizer's own would only cost memory.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return _ByteLevel(a_path), SentencePieceEncoder(b_path)


# --- alignment ----------------------------------------------------------------


def diagonal_groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group, how many tokens of either side lie before its end.

    ``a`` and ``b`` are the ascending ends of the tokens; the last ones are equal.
    """
    a_ends, b_ends = a.tolist(), b.tolist()
    a_raw, b_raw = np.asarray(a, "<i8").tobytes(), np.asarray(b, "<i8").tobytes()
    n, m = len(a_ends), len(b_ends)
    stops: list[int] = []  # i, j after a run of one-to-one groups, or after one group
    i = j = 0

    def same(count: int) -> bool:
        return (
            i + count <= n and j + count <= m
            and a_raw[8 * i : 8 * (i + count)] == b_raw[8 * j : 8 * (j + count)]
        )

    while i < n:
        x, y = a_ends[i], b_ends[j]
        if x == y:
            run = i
            i, j, step = i + 1, j + 1, 1
            while same(step):
                i, j, step = i + step, j + step, 2 * step
            while step > 1:
                step //= 2
                if same(step):
                    i, j = i + step, j + step
            stops += (i, j, i - run)
        else:
            while x != y:
                if x < y:
                    i += 1
                    x = a_ends[i]
                else:
                    j += 1
                    y = b_ends[j]
            i, j = i + 1, j + 1
            stops += (i, j, 1)
    i_stop, j_stop, count = np.array(stops, np.int64).reshape(-1, 3).T
    back = np.repeat(np.cumsum(count), count) - 1 - np.arange(count.sum())
    return np.repeat(i_stop, count) - back, np.repeat(j_stop, count) - back


def overlaps(
    a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The linked tokens of both sides, as positions, in order.

    In a one-to-one group that is its pair. In another one each stretch between two ends of
    either side lies in one token of both, and no pair shares two stretches.
    """
    a_size, b_size = np.diff(a_cuts, prepend=0), np.diff(b_cuts, prepend=0)
    single = (a_size == 1) & (b_size == 1)
    a_in, b_in = np.repeat(~single, a_size), np.repeat(~single, b_size)
    stretches = np.union1d(a[a_in], b[b_in])
    a_at = np.concatenate([a_cuts[single] - 1, np.searchsorted(a, stretches)])
    b_at = np.concatenate([b_cuts[single] - 1, np.searchsorted(b, stretches)])
    order = np.lexsort((b_at, a_at))
    return a_at[order], b_at[order]


@dataclass
class Aligned:
    """The texts of a piece, aligned: flat arrays over all texts, and their borders."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_cuts: np.ndarray  # tokens before the end of each group
    b_cuts: np.ndarray
    a_links: np.ndarray  # positions of the linked tokens
    b_links: np.ndarray
    a_texts: np.ndarray  # tokens before each text, and all
    b_texts: np.ndarray
    groups: np.ndarray  # groups before each text, and all
    links: np.ndarray


def _exactly(encoder: PieceEncoder, piece: Piece, whole) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts; those whose pieces are not exact are encoded whole, and have no
    tokens if their joined bytes still differ."""
    ids, counts, exact = encoder.ids_of(piece)
    if exact.all():
        return ids, counts
    parts = np.split(ids, np.cumsum(counts)[:-1])
    for i in np.flatnonzero(~exact):
        text = piece.data[piece.bounds[i] : piece.bounds[i + 1]].tobytes()
        found = whole(text.decode())
        same = b"".join([encoder.bytes[k] for k in found]) == text
        parts[i] = np.array(found if same else [], np.int32)
    return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def align_piece(piece: Piece, a: _ByteLevel, b: SentencePieceEncoder) -> Aligned:
    """Align the texts of a piece, each of which begins with the added space or is empty."""
    a_ids, a_counts = _exactly(a, piece, lambda t: a.tokenizer.encode(t, add_special_tokens=False).ids)
    b_ids, b_counts = _exactly(b, piece, lambda t: b.model.encode(t[1:], num_threads=1))
    none = (a_counts == 0) | (b_counts == 0)
    if none.any():
        a_ids, a_counts = a_ids[np.repeat(~none, a_counts)], np.where(none, 0, a_counts)
        b_ids, b_counts = b_ids[np.repeat(~none, b_counts)], np.where(none, 0, b_counts)
    a_ends, b_ends = (
        np.cumsum(_sizes(e)[ids], dtype=np.int64) for e, ids in ((a, a_ids), (b, b_ids))
    )
    a_cuts, b_cuts = diagonal_groups(a_ends, b_ends)
    a_links, b_links = overlaps(a_ends, b_ends, a_cuts, b_cuts)
    a_texts, b_texts = spread(a_counts), spread(b_counts)
    return Aligned(
        a_ids, b_ids, a_cuts, b_cuts, a_links, b_links, a_texts, b_texts,
        np.searchsorted(a_cuts, a_texts, "right"), np.searchsorted(a_links, a_texts),
    )


def _sizes(encoder) -> np.ndarray:
    if not hasattr(encoder, "sizes"):
        encoder.sizes = np.array([len(x) for x in encoder.bytes], np.int64)
    return encoder.sizes


def _aligned(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str):
    """Ids of documents and their alignment, piece by piece."""
    a, b = _encoders(a_path, b_path)
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
        empty = pc.equal(pc.binary_length(texts), 0)
        space, nothing = (pa.scalar(t, pa.large_string()) for t in (" ", ""))
        spaced = pc.if_else(empty, texts, pc.binary_join_element_wise(space, texts, nothing))
        for piece in pieces(spaced):
            yield batch.column(0).slice(piece.first, piece.n_texts), align_piece(piece, a, b)
    give_back()


def _lists(values: np.ndarray, borders: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(values.astype(np.int32)))


def _align_batches(batches, a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts", "a_links", "b_links"]
    for ids, x in _aligned(batches, a_path, b_path):
        n_groups, n_links = np.diff(x.groups), np.diff(x.links)
        lists = [
            _lists(x.a_ids, x.a_texts), _lists(x.b_ids, x.b_texts),
            _lists(x.a_cuts - np.repeat(x.a_texts[:-1], n_groups), x.groups),
            _lists(x.b_cuts - np.repeat(x.b_texts[:-1], n_groups), x.groups),
            _lists(x.a_links - np.repeat(x.a_texts[:-1], n_links), x.links),
            _lists(x.b_links - np.repeat(x.b_texts[:-1], n_links), x.links),
        ]
        yield pa.RecordBatch.from_arrays([ids, *lists], names)


def _chosen(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))


def align(
    docs: DataFrame, byte_bpe: str, piece_model: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The alignment of every text under two tokenizer files that every executor can read.

    ``a_ids, b_ids``: the ids of the byte-level and of the sentencepiece tokenizer.
    ``a_cuts, b_cuts``: for each group, how many tokens of either side stand before its
    end. ``a_links, b_links``: positions of the linked tokens. All are empty for texts
    that are null or empty, or whose tokens do not give back a space and the text. Ids of
    documents are whole numbers or null; other columns are ignored.
    """
    run = partial(_align_batches, a_path=byte_bpe, b_path=piece_model)
    names = ("a_ids", "b_ids", "a_cuts", "b_cuts", "a_links", "b_links")
    schema = "doc_id bigint, " + ", ".join(f"{name} array<int>" for name in names)
    return _chosen(docs, doc_id, text).mapInArrow(run, schema)


# --- counts over the corpus ---------------------------------------------------

_BLOCK_SQL = (
    "block bigint, ids array<bigint>, figures binary, texts array<string>, "
    "borders binary, places binary, times binary, pairs array<bigint>, counts array<bigint>"
)
_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def _group_texts(x: Aligned, a_names: list[str], b_names: list[str]) -> list[str]:
    """The digest of each text's groups, ``a1,a2|b1;a3|b2``; of no tokens the empty text."""
    a = [a_names[i] for i in x.a_ids.tolist()]
    b = [b_names[i] for i in x.b_ids.tolist()]
    # A token is followed by its separator: the last one of a group by another one.
    a_last, b_last = x.a_cuts - 1, x.b_cuts - 1
    out = []
    a_cuts, b_cuts = a_last.tolist(), b_last.tolist()
    for low, high in zip(x.groups[:-1].tolist(), x.groups[1:].tolist()):
        if low == high:
            out.append("")
            continue
        parts = []
        i = a_cuts[low - 1] + 1 if low else 0
        j = b_cuts[low - 1] + 1 if low else 0
        for i_end, j_end in zip(a_cuts[low:high], b_cuts[low:high]):
            if i == i_end and j == j_end:
                parts.append(a[i] + "|" + b[j])
            else:
                parts.append(",".join(a[i : i_end + 1]) + "|" + ",".join(b[j : j_end + 1]))
            i, j = i_end + 1, j_end + 1
        out.append(hashlib.sha256(";".join(parts).encode()).hexdigest())
    return out


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, so that the leading bytes, mostly zero, compress."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(value: bytes) -> np.ndarray:
    planes = np.frombuffer(value, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _block_batches(batches, a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    """Blocks of aligned documents: figures and digest of each, and the pairs they hold."""
    task = TaskContext.get().partitionId()
    a, b = _encoders(a_path, b_path)
    a_names, b_names = ([str(i) for i in range(len(e.bytes))] for e in (a, b))
    held, n_links, n_docs, made = [], 0, 0, 0
    for ids, x in _aligned(batches, a_path, b_path):
        figures = np.stack([np.diff(v) for v in (x.a_texts, x.b_texts, x.groups, x.links)], axis=1)
        keys = x.a_ids[x.a_links].astype(np.int64) * len(b_names) + x.b_ids[x.b_links]
        owners = np.repeat(np.arange(len(ids)) + n_docs, figures[:, 3])
        held.append((ids, figures, _group_texts(x, a_names, b_names), keys, owners))
        n_links, n_docs = n_links + len(keys), n_docs + len(ids)
        if n_links >= BLOCK_LINKS or n_docs >= BLOCK_DOCS:
            yield _block(held, (task << 32) + made)
            held, n_links, n_docs, made = [], 0, 0, made + 1
    if held:
        yield _block(held, (task << 32) + made)


def _block(held: list, block: int) -> pa.RecordBatch:
    ids = pa.chunked_array([h[0] for h in held]).combine_chunks()
    figures = np.concatenate([h[1] for h in held]).astype("<i8")
    texts = [t for h in held for t in h[2]]
    keys, owners = (np.concatenate([h[k] for h in held]) for k in (3, 4))
    pairs, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    # A document's links, each of its pairs once: the owner in the high bits.
    own, times = np.unique((owners << 32) + which, return_counts=True)
    places = own & 0xFFFFFFFF
    borders = np.searchsorted(own >> 32, np.arange(len(ids) + 1)).astype("<i8")
    values = {
        "block": pa.array([block], pa.int64()),
        "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        "figures": pa.array([figures.tobytes()], pa.binary()),
        "texts": pa.array([texts], pa.list_(pa.string())),
        "borders": pa.array([borders.tobytes()], pa.binary()),
        # Differences are small; where the next document begins they wrap around.
        "places": pa.array([_planes(np.diff(places, prepend=0))], pa.binary()),
        "times": pa.array([_planes(times)], pa.binary()),
        "pairs": pa.array([pairs], pa.list_(pa.int64())),
        "counts": pa.array([counts], pa.list_(pa.int64())),
    }
    return pa.RecordBatch.from_arrays(list(values.values()), list(values))


def _finish(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a block with the counts of their pairs over the corpus."""
    row = left.drop(["ids"]).to_pylist()[0]
    ids = left["ids"].combine_chunks().flatten()
    figures = np.frombuffer(row["figures"], "<i8").reshape(-1, 4)
    borders = np.frombuffer(row["borders"], "<i8")
    places = np.cumsum(_unplanes(row["places"]), dtype=np.uint32)
    times = _unplanes(row["times"]).astype(np.int64)
    total = np.zeros(right.num_rows, np.int64)
    total[right["place"].to_numpy()] = right["total"].to_numpy()
    best = total < 0
    by_doc = [spread(v)[borders] for v in (times * best[places], times * np.abs(total)[places])]
    n_best, count_sum = (np.diff(v) for v in by_doc)
    columns = {name: pa.array(figures[:, k]) for k, name in enumerate(_FIGURES)}
    return pa.table(
        {"doc_id": ids, **columns, "n_best": pa.array(n_best), "count_sum": pa.array(count_sum),
         "groups_sha256": pa.array(row["texts"], pa.string())}
    )


def link_counts(
    docs: DataFrame, byte_bpe: str, piece_model: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Figures of every document's alignment, see :func:`align`.

    ``n_a, n_b, n_groups, n_links``; ``n_best``: links whose pair of ids is the one, or one
    of those, that is linked most often in the corpus among the pairs with its second id;
    ``count_sum``: the corpus-wide counts of its links, added up; ``groups_sha256``: digest of
    ``a1,a2|b1;a3|b2,b3``, the ids of its groups, or the empty text. Texts without tokens
    have zeros. Repeated rows count, and come out, as often as they stand there.
    """
    import sentencepiece

    n_second = sentencepiece.SentencePieceProcessor(model_file=piece_model).get_piece_size()
    run = partial(_block_batches, a_path=byte_bpe, b_path=piece_model)
    blocks = materialize(_chosen(docs, doc_id, text).mapInArrow(run, _BLOCK_SQL), "aligned")
    pairs = blocks.select(F.inline(F.arrays_zip("pairs", "counts"))).toDF("pair", "times")
    totals = materialize(pairs.groupBy("pair").agg(F.sum("times").alias("total")), "pair-counts")
    second = F.pmod("pair", F.lit(n_second))
    highest = totals.groupBy(second.alias("second")).agg(F.max("total").alias("highest"))
    # A pair that is its second id's best has a negative count: one number per answer.
    marked = totals.withColumn("second", second).join(highest, "second").select(
        "pair", F.when(F.col("total") == F.col("highest"), -F.col("total")).otherwise(F.col("total")).alias("total")
    )
    asked = blocks.select(F.col("block").alias("asker"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(marked, "pair").select("asker", "place", "total")
    return (
        blocks.drop("pairs", "counts").groupBy("block").cogroup(answers.groupBy("asker"))
        .applyInArrow(
            _finish,
            "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
            "n_best bigint, count_sum bigint, groups_sha256 string",
        )
    )
