"""Exact Jaccard join of documents' word n-gram sets (operator 8).

A document's set holds the hashes of its runs of five words. Sets link when
``100 * intersection >= threshold * union``.

*Counting.* One pass over the texts cuts the input into blocks of documents and sends
each block's distinct shingles to hash buckets, packed as binary arrays. A bucket
counts in how many documents each shingle stands and answers each block with those
that stand in two or more. The rest, most of all shingles, cannot be shared: from here
on a set is its size and its shared shingles, rarest first. Equal sets are kept once.

*Index.* Two sets that link share one of their ``n - ceil(t n) + 1`` rarest shingles.
The index lists, for each shingle, the sets that have it there, with size and position.

*Set relations.* The set with the fewest rarer shingles leads a list; the overlap of
the other sets with it is counted first. Sets linked to one leader are in one component
already. For two others ``y, z`` of the list the leader's answers bound theirs:
``o(y) + o(z) - n(x) <= |y & z| <= o(y) + n(z) - o(z)``. Pairs that these bounds decide
are not counted again. What is left is searched block by block: lists are cut by size
and position, and pairs of blocks are skipped if sizes, positions, or one component
throughout rule out any new link.

Shingles are compared by 64-bit hashes, equal sets by 128 bits and their size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.components import components
from tarnwork.llm.words import (
    give_back,
    in_text,
    later,
    mix,
    pieces,
    repeated,
    spread,
    window_hashes,
    windows_inside,
)
from tarnwork.operators.joins import fits_broadcast
from tarnwork.scratch import materialize

N = 5
#: A block of documents is closed at so many shingles or documents.
BLOCK_SHINGLES = 1_000_000
BLOCK_DOCS = 60_000
#: Bytes of text behind one counting bucket.
BUCKET_BYTES = 8 << 20
#: Tasks that buckets, and blocks, are dealt to; beyond it a task has several.
MAX_TASKS = 20_000
#: Entries of an index list that are searched as one block.
LIST_BLOCK = 256

_BLOCK = pa.schema(
    [
        ("bucket", pa.int32()),
        ("block", pa.int64()),
        ("tokens", pa.binary()),  # shingles in one document of the block, packed
        ("places", pa.binary()),  # that document: uint16
        ("shared", pa.binary()),  # shingles in several documents, packed
        ("counts", pa.binary()),  # in how many: uint32
        ("ids", pa.list_(pa.int64())),  # the block's documents, in one row of each block
        ("sizes", pa.binary()),
        ("signs", pa.binary()),
        ("holders", pa.binary()),  # the first document of the block with the same set
    ]
)
_BLOCK_SQL = (
    "bucket int, block bigint, tokens binary, places binary, shared binary, counts binary, "
    "ids array<bigint>, sizes binary, signs binary, holders binary"
)
_SET_SQL = "block bigint, doc_id bigint, n int, sign binary, tokens array<bigint>"


def shingles(piece, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a piece and the text of each. Fewer words than ``n``: one."""
    words, texts = piece.word_hashes(), piece.text_of_word()
    at = windows_inside(texts, n)
    tokens, owners = window_hashes(words, n)[at], texts[at]
    short = np.flatnonzero((piece.n_words > 0) & (piece.n_words < n))
    if len(short):
        whole = []
        for text in short:
            run = words[piece.words[text] : piece.words[text + 1]]
            whole.append(window_hashes(run, len(run))[0])
        tokens = np.concatenate([tokens, np.array(whole, np.uint64)])
        owners = np.concatenate([owners, short])
    keys = in_text(tokens, owners)
    kept = np.ones(len(tokens), bool)
    kept[later(keys, repeated(keys))] = False
    return tokens[kept], owners[kept]


def _sum_by(values: np.ndarray, owners: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    np.add.at(out, owners, values)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], n_buckets: int, n: int) -> Iterator[pa.RecordBatch]:
    """Cut the documents of a task into blocks and pack their shingles by bucket."""
    task = TaskContext.get().partitionId()
    made, size, docs, held = 0, 0, 0, []
    for batch in batches:
        ids = batch.column(0)
        for piece in pieces(batch.column(1), fold=True, most=BLOCK_DOCS):
            if held and (size > BLOCK_SHINGLES or docs + piece.n_texts > BLOCK_DOCS):
                yield _pack(held, (task << 32) + made, n_buckets)
                made, size, docs, held = made + 1, 0, 0, []
            tokens, owners = shingles(piece, n)
            owners = (owners + docs).astype(np.uint16)
            held.append((ids.slice(piece.first, piece.n_texts), tokens, owners))
            size, docs = size + len(tokens), docs + piece.n_texts
    if held:
        yield _pack(held, (task << 32) + made, n_buckets)
    give_back()


def _bucket_of(tokens: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of each hash: equal ranges of its upper 32 bits, ascending with it."""
    return ((tokens >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)


def _pack(held: list, block: int, n_buckets: int) -> pa.RecordBatch:
    ids = pa.chunked_array([h[0] for h in held]).combine_chunks().cast(pa.int64())
    tokens = np.concatenate([h[1] for h in held])
    owners = np.concatenate([h[2] for h in held])
    n_docs = len(ids)
    sizes = np.bincount(owners, minlength=n_docs).astype(np.uint32)
    signs = np.stack(
        [
            _sum_by(mix(tokens), owners, n_docs),
            _sum_by(mix(tokens ^ np.uint64(0xA0761D6478BD642F)), owners, n_docs),
            sizes.astype(np.uint64),
        ],
        axis=1,
    )
    _, first, which = np.unique(signs, axis=0, return_index=True, return_inverse=True)
    holders = first[which.ravel()].astype(np.uint16)
    mine = holders[owners] == owners  # a set is sent once, not once per copy
    tokens, owners = tokens[mine], owners[mine]
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    head = np.ones(len(tokens), bool)
    head[1:] = tokens[1:] != tokens[:-1]
    starts = np.flatnonzero(head)
    counts = np.diff(np.append(starts, len(tokens)))
    one = starts[counts == 1]
    many = counts > 1
    several, times = tokens[starts[many]], counts[many].astype(np.uint32)
    in_several = owners[np.repeat(many, counts)]
    one_keys = tokens[one]
    columns: dict[str, list] = {name: [] for name in _BLOCK.names}

    def row(**values):
        for name in _BLOCK.names:
            columns[name].append(values.get(name))

    # Only buckets that get something; both key arrays ascend, and buckets with them.
    one_of, many_of = _bucket_of(one_keys, n_buckets), _bucket_of(several, n_buckets)
    for b in np.union1d(one_of, many_of).tolist():
        i, j = np.searchsorted(one_of, [b, b + 1])
        k, m = np.searchsorted(many_of, [b, b + 1])
        row(
            bucket=b, block=block, tokens=_pack_sorted(one_keys[i:j]),
            places=owners[one[i:j]].tobytes(),
            shared=_pack_sorted(several[k:m]), counts=times[k:m].tobytes(),
        )
    # This row only passes through its bucket.
    row(
        bucket=block % n_buckets, block=block, shared=_pack_sorted(several), counts=times.tobytes(),
        places=in_several.tobytes(), ids=ids, sizes=sizes.tobytes(),
        signs=signs.tobytes(), holders=holders.tobytes(),
    )
    arrays = [_column(columns[field.name], field.type) for field in _BLOCK]
    return pa.RecordBatch.from_arrays(arrays, schema=_BLOCK)


def _column(values: list, kind: pa.DataType) -> pa.Array:
    if not pa.types.is_list(kind):
        return pa.array(values, kind)
    lists = [v for v in values if v is not None]
    lengths = [None if v is None else len(v) for v in values]
    offsets = spread(np.array([x or 0 for x in lengths], np.int64)).astype(np.int32)
    mask = pa.array([x is None for x in lengths], pa.bool_())
    content = pa.concat_arrays(lists) if lists else pa.array([], kind.value_type)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), content, mask=mask)


def _read(value, kind) -> np.ndarray:
    return np.frombuffer(value or b"", kind)


def _pack_sorted(tokens: np.ndarray) -> bytes:
    """Ascending numbers as differences, byte by byte: the leading bytes are mostly zero,
    which the shuffle's compression removes."""
    steps = np.diff(tokens, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack_sorted(value) -> np.ndarray:
    planes = np.frombuffer(value or b"", np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel())


def _count_bucket(table: pa.Table) -> pa.Table:
    """Answer every block of a bucket with its shingles that stand in two documents.

    In the answer, ``counts`` belongs to ``tokens``, and ``sizes`` to ``shared``.
    """
    passed = table.filter(table["ids"].is_valid())
    rows = table.filter(table["ids"].is_null()).to_pydict()
    single = [_unpack_sorted(v) for v in rows["tokens"]]
    shared = [_unpack_sorted(v) for v in rows["shared"]]
    counts = [_read(v, np.uint32) for v in rows["counts"]]
    tokens = np.concatenate([*single, *shared, np.zeros(0, np.uint64)])
    times = np.concatenate(
        [np.ones(sum(map(len, single)), np.int64), *counts, np.zeros(0, np.int64)]
    ).astype(np.int64)
    order = np.argsort(tokens)
    ordered = tokens[order]
    head = np.ones(len(ordered), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(head)
    found = np.add.reduceat(times[order], starts) if len(starts) else np.zeros(0, np.int64)
    frequency = np.empty(len(tokens), np.int64)
    frequency[order] = np.repeat(np.minimum(found, 2**32 - 1), np.diff(np.append(starts, len(tokens))))
    out: dict[str, list] = {name: [] for name in _BLOCK.names}
    at, at_shared = 0, sum(map(len, single))
    for i, block in enumerate(rows["block"]):
        mine = frequency[at : at + len(single[i])]
        shared_mine = frequency[at_shared : at_shared + len(shared[i])]
        at, at_shared = at + len(single[i]), at_shared + len(shared[i])
        kept = mine > 1
        if not kept.any() and not len(shared[i]):
            continue
        values = {
            "bucket": -1, "block": block, "tokens": _pack_sorted(single[i][kept]),
            "places": _read(rows["places"][i], np.uint16)[kept].tobytes(),
            "counts": mine[kept].astype(np.uint32).tobytes(),
            "shared": _pack_sorted(shared[i]), "sizes": shared_mine.astype(np.uint32).tobytes(),
        }
        for name in _BLOCK.names:
            out[name].append(values.get(name))
    answers = pa.table([_column(out[f.name], f.type) for f in _BLOCK], schema=_BLOCK)
    return pa.concat_tables([passed.cast(_BLOCK), answers])


def _finish_block(table: pa.Table) -> pa.Table:
    """One row per document: size, sign, and (once per set of the block) shared shingles."""
    base = table.filter(table["ids"].is_valid()).to_pydict()
    rows = table.filter(table["ids"].is_null()).to_pydict()
    ids = table.filter(table["ids"].is_valid())["ids"].combine_chunks().flatten()
    sizes = _read(base["sizes"][0], np.uint32)
    signs = _read(base["signs"][0], np.uint64).reshape(-1, 3)
    holders = _read(base["holders"][0], np.uint16)
    several, times = _unpack_sorted(base["shared"][0]), _read(base["counts"][0], np.uint32)
    tokens = [_unpack_sorted(v) for v in rows["tokens"]]
    owners = [_read(v, np.uint16) for v in rows["places"]]
    counts = [_read(v, np.uint32) for v in rows["counts"]]
    # Of the shingles in several documents of the block, the counts came back by bucket.
    names = np.concatenate([_unpack_sorted(v) for v in rows["shared"]] + [several[:0]])
    found = np.concatenate([_read(v, np.uint32) for v in rows["sizes"]] + [times[:0]])
    order = np.argsort(names)
    tokens.append(np.repeat(several, times))
    owners.append(_read(base["places"][0], np.uint16))
    counts.append(np.repeat(found[order], times))  # ``several`` is sorted
    token, owner, count = map(np.concatenate, (tokens, owners, counts))
    order = np.lexsort((token, count, owner))
    token, owner = token[order].view(np.int64), owner[order]
    lengths = np.bincount(owner, minlength=len(ids))
    offsets = spread(lengths).astype(np.int32)
    held = holders == np.arange(len(ids))
    mask = pa.array(~held | (sizes == 0))
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(token), mask=mask)
    packed = [s.tobytes() if n else None for s, n in zip(signs, sizes)]
    return pa.table(
        {
            "block": pa.array(np.full(len(ids), base["block"][0]), pa.int64()),
            "doc_id": ids, "n": pa.array(sizes.astype(np.int32)),
            "sign": pa.array(packed, pa.binary()), "tokens": lists,
        }
    )


def shared_shingles(docs: DataFrame, doc_id: str, text: str, n: int = N) -> DataFrame:
    """``block, doc_id, n, sign, tokens`` of every document, stored.

    ``n`` is the size of its set; ``tokens`` are those shingles that also stand in
    another set or block, rarest first, given once for each set and block; else null.
    A text without words has size 0 and no sign.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    n_buckets = max(8, -(-size // BUCKET_BYTES))
    chosen = docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`"))
    # As many tasks as the data needs, whatever the session's shuffles have.
    n_tasks = min(n_buckets, MAX_TASKS)
    packed = chosen.mapInArrow(partial(_blocks, n_buckets=n_buckets, n=n), _BLOCK_SQL)
    counted = packed.repartition(n_tasks, "bucket").groupBy("bucket").applyInArrow(_count_bucket, _BLOCK_SQL)
    finished = counted.repartition(n_tasks, "block").groupBy("block").applyInArrow(_finish_block, _SET_SQL)
    return materialize(finished, "sets")


def _least(n: Column, threshold: int) -> Column:
    """The smallest size, and overlap, with which a set can link to one of size ``n``."""
    return F.floor((threshold * n + 99) / 100).cast("int")


def _needed(a: Column, b: Column, threshold: int) -> Column:
    """The overlap that two sets of these sizes need."""
    return F.floor((threshold * (a + b) + 99 + threshold) / (100 + threshold)).cast("int")


def _fits(n1: Column, p1: Column, n2: Column, p2: Column, threshold: int) -> Column:
    """Whether sizes, and positions of the first common shingle, allow a link."""
    sizes = 100 * F.least(n1, n2) >= threshold * F.greatest(n1, n2)
    return sizes & (F.least(n1 - p1, n2 - p2) >= _needed(n1, n2, threshold))


def _overlaps(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """``a, b, overlap, linked`` for pairs of set signs; stored."""
    one = sets.select(F.col("sign").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("sign").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    joined = pairs.join(one, "a").join(two, "b")
    overlap = F.size(F.array_intersect("ta", "tb"))
    counted = joined.select("a", "b", "na", "nb", overlap.alias("overlap"))
    linked = 100 * F.col("overlap") >= threshold * (F.col("na") + F.col("nb") - F.col("overlap"))
    return materialize(counted.select("a", "b", "overlap", linked.alias("linked")), "overlaps")


def link_sets(holders: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """``node, label`` of the sets that have a link: equal labels, one component.

    ``holders`` (sign, block, n, tokens) has each set once per block, ``classes`` (sign,
    block) names one block for each. Only sets in lists of two or more are ever moved.
    """
    singles = F.col("n") - F.size("tokens")
    room = F.col("n") - _least(F.col("n"), threshold) + 1 - singles
    heads = holders.where(room > 0).select(
        "sign", "block", "n", singles.alias("singles"),
        F.slice("tokens", F.lit(1), F.greatest(room, F.lit(0))).alias("head"),
    )
    entries = materialize(
        heads.join(classes.select("sign", "block"), ["sign", "block"], "left_semi")
        .select("sign", "n", "singles", F.posexplode("head").alias("i", "token"))
        .select("token", "sign", "n", (F.col("singles") + F.col("i")).alias("p")),
        "entries",
    )
    leaders = materialize(
        entries.groupBy("token")
        .agg(F.count(F.lit(1)).alias("listed"), F.min(F.struct("p", "n", "sign")).alias("lead"))
        .where("listed > 1"),
        "leaders",
    )
    lists = materialize(
        entries.join(leaders, "token").select(
            "token", "sign", "n", "p", "listed", F.col("lead.sign").alias("leader"),
            F.col("lead.n").alias("lead_n"), F.col("lead.p").alias("lead_p"),
        ),
        "lists",
    )
    listed = lists.select("sign").distinct().join(classes.select("sign", "block"), "sign")
    listed = materialize(listed, "listed")
    # Where they are few, and that was counted, the sets need no shuffle.
    listed = F.broadcast(listed) if fits_broadcast(listed) else listed
    sets = materialize(
        holders.join(listed, ["sign", "block"], "left_semi").select("sign", "n", "tokens"),
        "listed-sets",
    )
    near = lists.where(
        (F.col("sign") != F.col("leader"))
        & _fits(F.col("n"), F.col("p"), F.col("lead_n"), F.col("lead_p"), threshold)
    )
    answers = _overlaps(
        near.select(F.col("sign").alias("a"), F.col("leader").alias("b")).distinct(), sets, threshold
    )
    stars = answers.where("linked").select("a", "b")
    found = components(stars)

    # Only lists in which several components are left can hold further links.
    named = lists.join(
        found.select(F.col("node").alias("sign"), "label"), "sign", "left"
    ).withColumn("label", F.coalesce("label", "sign"))
    named = materialize(named, "named")
    open_ = materialize(
        named.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y"))
        .where("x != y").select("token"),
        "open",
    )
    known = answers.select(F.col("a").alias("sign"), F.col("b").alias("leader"), "overlap")
    rest = (
        named.join(open_, "token")
        .join(known, ["sign", "leader"], "left")
        .withColumn("overlap", F.when(F.col("sign") == F.col("leader"), F.col("n")).otherwise(F.col("overlap")))
    )
    # Blocks: by size in steps of a few per cent, and by position.
    big = F.col("listed") > LIST_BLOCK
    rest = rest.withColumn(
        "zone",
        F.when(big, F.struct(
            F.floor(F.log(F.col("n")) * 25).cast("int").alias("size"),
            F.floor(F.col("p") * 100 / F.col("n")).cast("int").alias("place"),
        )).otherwise(F.struct(F.lit(0).alias("size"), F.lit(0).alias("place"))),
    ).select("token", "sign", "n", "p", "label", "lead_n", "overlap", "zone")
    rest = materialize(rest, "rest")
    zones = materialize(rest.groupBy("token", "zone").agg(F.count(F.lit(1)).alias("c")), "zones")
    cut = F.pmod(F.xxhash64("sign"), F.ceil(F.col("c") / LIST_BLOCK)).cast("int")
    rest = materialize(
        rest.join(zones, ["token", "zone"]).select(
            "token", "sign", "n", "p", "label", "lead_n", "overlap",
            F.struct("zone.size", "zone.place", cut.alias("part")).alias("block"),
        ),
        "blocks",
    )
    stats = materialize(
        rest.groupBy("token", "block").agg(
            F.min("n").alias("n_lo"), F.max("n").alias("n_hi"), F.min("p").alias("p_lo"),
            F.min("label").alias("l_lo"), F.max("label").alias("l_hi"),
        ),
        "block-stats",
    )
    s1 = stats.select("token", *[F.col(c).alias(f"{c}_1") for c in stats.columns[1:]])
    s2 = stats.select("token", *[F.col(c).alias(f"{c}_2") for c in stats.columns[1:]])
    c = F.col
    blocks = s1.join(s2, "token").where(
        (c("block_1") <= c("block_2"))
        & (100 * c("n_hi_1") >= threshold * c("n_lo_2"))
        & (100 * c("n_hi_2") >= threshold * c("n_lo_1"))
        & (
            F.least(c("n_hi_1") - c("p_lo_1"), c("n_hi_2") - c("p_lo_2"))
            >= _needed(c("n_lo_1"), c("n_lo_2"), threshold)
        )
        & ~((c("l_lo_1") == c("l_hi_1")) & (c("l_lo_1") == c("l_lo_2")) & (c("l_lo_2") == c("l_hi_2")))
    ).select("token", "block_1", "block_2")
    r1 = rest.select("token", *[c(x).alias(f"{x}_1") for x in rest.columns[1:]])
    r2 = rest.select("token", *[c(x).alias(f"{x}_2") for x in rest.columns[1:] if x != "lead_n"])
    needed = _needed(c("n_1"), c("n_2"), threshold)
    o1, o2 = c("overlap_1"), c("overlap_2")
    at_most = F.least(o1 + c("n_2") - o2, o2 + c("n_1") - o1)
    pairs = (
        blocks.join(r1, ["token", "block_1"])
        .join(
            r2.withColumnRenamed("token", "t2"),
            (c("token") == c("t2"))
            & r2["block_2"].eqNullSafe(blocks["block_2"])
            & ((c("block_1") != r2["block_2"]) | (c("sign_1") < c("sign_2")))
            & (c("label_1") != c("label_2"))
            & _fits(c("n_1"), c("p_1"), c("n_2"), c("p_2"), threshold)
            & F.coalesce(at_most >= needed, F.lit(True)),
        )
        .select(
            F.least("sign_1", "sign_2").alias("a"), F.greatest("sign_1", "sign_2").alias("b"),
            F.coalesce(o1 + o2 - c("lead_n_1") >= needed, F.lit(False)).alias("sure"),
        )
        .groupBy("a", "b").agg(F.max("sure").alias("sure"))
    )
    pairs = materialize(pairs, "pairs")
    more = _overlaps(pairs.where("not sure").select("a", "b"), sets, threshold)
    links = stars.union(pairs.where("sure").select("a", "b")).union(
        more.where("linked").select("a", "b")
    )
    return components(links)


def jaccard_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = 80, n: int = N
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links; rows with equal sets are
    linked. A null or wordless text has an empty set, links with nothing, and is its own
    component. A null id is never the smallest. Repeated rows give repeated results. Ids are
    whole numbers, as text or not; any other id fails. Columns besides the two are ignored.
    """
    stored = shared_shingles(docs, doc_id, text, n)
    holder = F.when(F.col("tokens").isNotNull(), F.col("block"))
    classes = materialize(
        stored.where(F.col("sign").isNotNull()).groupBy("sign")
        .agg(F.min("doc_id").alias("root"), F.min(holder).alias("block")),
        "classes",
    )
    roots = classes.select("sign", "root")
    holders = stored.where(F.col("tokens").isNotNull())
    labels = link_sets(holders, classes, threshold).select(F.col("node").alias("sign"), "label")
    rooted = materialize(
        roots.join(labels, "sign", "left").withColumn("label", F.coalesce("label", "sign")), "roots"
    )
    lowest = rooted.groupBy("label").agg(F.min("root").alias("component_id"))
    named = materialize(rooted.join(lowest, "label").select("sign", "component_id"), "named")
    return stored.join(named, "sign", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("sign").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
