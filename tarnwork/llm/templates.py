"""Benchmark decontamination by template windows (operator 2).

Texts become templates: numbers, units after numbers, and capitalised words give way to
typed placeholders. Hashes of windows of eight template tokens are joined with those of
the benchmark, and so are those of the text in one letter case, where names stay words;
windows of one document and item that lie at the same distance form an alignment. In an alignment, what stands in the slots must be consistent: a value of the
item always became the same value in the document. That holds for verbatim copies and
for re-parameterised ones, not for texts that merely share phrases. Windows of few words are
compared verbatim, and items made of such windows also as whole templates.

DataFrame functions only. Texts are read once for blocks of half a window, next to each
other, and those few that have a block in common with the benchmark again for the windows,
of which each holds a whole block, and for the alignments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.operators.joins import fits_broadcast
from tarnwork.scratch import materialize

WINDOW = 8
#: Tokens of a window of the benchmark that must not be placeholders.
LITERALS = 5
#: Share of an item's windows that a document must hold.
SHARE = 0.3
#: Values in slots that may break the mapping: one in so many.
ODD_SLOT = 5

NUMBER, NAME, UNIT = "0", "1", "2"  # no other token holds a digit
MARKS = (NUMBER, NAME, UNIT)

#: How an item is found: by windows of its template; by windows in one letter case with
#: numbers and units as placeholders; verbatim, where windows of few words count too; whole,
#: in either of the first two views, where none of its windows there has enough words.
#: Where a pair is found in several ways, the first of them is given.
TEMPLATE, FOLDED, VERBATIM, WHOLE_TEMPLATE, WHOLE_FOLDED = range(5)

# Units that follow a number.
UNITS = [
    "cm", "cents", "days", "degrees", "dollars", "euros", "feet", "ft", "g", "grams", "hours",
    "inches", "kg", "km", "kmh", "l", "lb", "litres", "liters", "m", "meters", "metres", "mg",
    "miles", "minutes", "ml", "mm", "months", "mph", "percent", "pounds", "seconds", "tons",
    "weeks", "yards", "years",
]

#: Words that are equal one after the other are a leak whatever their share of the item.
RUN = 13
#: Keys of documents, of 8 bytes, that are broadcast at most.
NEAR_ROWS = 1_000_000
#: Items of fewer tokens match nothing: nearly every text would hold some of them.
LEAST_ITEM = 3

_SPACES = r"[\x20\x09-\x0D]+"
_START, _IN = "(?<![^ ])", "[^ ]"  # in plain texts, where one space stands between tokens


def plain(text: Column) -> Column:
    """The text without punctuation and symbols, with one space between tokens."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\p{P}\p{S}]+", "")
    return F.btrim(F.regexp_replace(bare, _SPACES, " "), F.lit(" "))


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, " "), lambda t: t != "")


def one_case(text: Column) -> Column:
    """Equal for texts that differ in letter case only; as many tokens as before."""
    return F.lower(F.replace(F.upper(text), F.lit("ẞ"), F.lit("SS")))


def numbered(text: Column) -> Column:
    """A :func:`plain` text with placeholders for numbers."""
    marked = F.regexp_replace(text, rf"{_START}[^ \p{{Nd}}]*+\p{{Nd}}{_IN}*+", NUMBER)
    return F.when(text.rlike(r"\p{Nd}"), marked).otherwise(text)


def _units(text: Column) -> Column:
    units = "|".join(UNITS)
    marked = F.regexp_replace(text, rf"(?<={_START}{NUMBER} )(?:{units})(?!{_IN})", UNIT)
    return F.when(F.contains(text, F.lit(f"{NUMBER} ")), marked).otherwise(text)


def template(marked: Column) -> Column:
    """A :func:`numbered` text with all placeholders: token by token as many as before."""
    return F.lower(_units(F.regexp_replace(marked, rf"{_START}\p{{Lu}}{_IN}*+", NAME)))


def folded(marked: Column) -> Column:
    """As :func:`template`, but names stay words, and letter case does not count."""
    return _units(one_case(marked))


def _with_tokens(table: DataFrame, text: Column) -> DataFrame:
    """``views`` added: tokens of the template, of the folded text, and the words themselves."""
    out = table.withColumn("_plain_", plain(text)).withColumn("_marked_", numbered(F.col("_plain_")))
    views = [template(F.col("_marked_")), folded(F.col("_marked_")), one_case(F.col("_plain_"))]
    named = F.struct(*[tokens(v).alias(f"v{k}") for k, v in enumerate(views)])
    return out.withColumn("views", named).drop("_plain_", "_marked_")


def _by_place(views: Column, n: int, at_place) -> Column:
    """``at_place(views, i)`` for the start ``i`` (from 1) of each run of ``n`` tokens.

    The outer function binds the tokens to a variable. Used directly in the inner one,
    their whole expression would be evaluated again for every window.
    """

    def places(v: Column) -> Column:
        last = F.size(v["v0"]) - (n - 1)
        starts = F.when(last > 0, F.sequence(F.lit(1), last))
        return F.transform(starts, lambda i: at_place(v, i))

    return F.get(F.transform(F.array(views), places), F.lit(0))


def _hash(part: Column) -> Column:
    """The hash of a window's tokens: of its text, as :func:`doc_windows` reads it."""
    return F.xxhash64(F.array_join(part, " "))


def _verbatim(text: Column) -> Column:
    return F.xxhash64(F.lit("verbatim"), text)


def _has_number() -> Column:
    return F.col("_plain_") != F.col("_marked_")


def _doc_views(docs: DataFrame, doc_key: Column, text: Column, words_of_all: bool) -> DataFrame:
    """``doc_key, number, nth, view``: the views of all texts, each as one text.

    The second view is left out where it equals the first, the third, of words alone, where
    a text has no number, unless ``words_of_all``.
    """
    marked = docs.select(doc_key.alias("doc_key"), plain(text).alias("_plain_")).select(
        "doc_key", "_plain_", numbered(F.col("_plain_")).alias("_marked_")
    )
    views = marked.select(
        "doc_key", template(F.col("_marked_")).alias("v0"), folded(F.col("_marked_")).alias("v1"),
        F.when(_has_number() | F.lit(words_of_all), one_case(F.col("_plain_"))).alias("v2"),
        _has_number().alias("number"),
    )
    other = F.when(F.col("v1") != F.col("v0"), F.col("v1"))
    each = views.select("doc_key", "number", F.posexplode(F.array("v0", other, "v2")).alias("nth", "view"))
    return each.where("view is not null")


def _view_hash(part: str) -> Column:
    return F.when(F.col("nth") == 2, _verbatim(F.col(part))).otherwise(F.xxhash64(part))


def doc_windows(docs: DataFrame, doc_key: Column, text: Column, widths: list[int]) -> DataFrame:
    """``doc_key, nth, pos, h``: hashes of all windows of the views of all texts.

    A single pass of a regular expression reads a view's windows. Of windows that can have
    enough literals, only those of texts with a number are sought verbatim.
    """
    each = _doc_views(docs, doc_key, text, widths[0] <= LITERALS)

    def windows(of: DataFrame, width: int) -> DataFrame:
        if width > LITERALS:
            of = of.where("nth < 2 or number")
        run = rf"{_START}(?=({_IN}++(?: {_IN}++){{{width - 1}}}))"
        found = F.posexplode(F.regexp_extract_all("view", F.lit(run), F.lit(1)))
        return of.select("doc_key", "nth", found.alias("pos", "window"))

    found = windows(each, widths[0])
    for width in widths[1:]:
        found = found.unionByName(windows(each, width))
    return found.select("doc_key", "nth", "pos", _view_hash("window").alias("h"))


def _block(n: int) -> int:
    """Tokens of a block. Each window of ``n`` tokens holds a whole one of a text cut into such."""
    return (n + 1) // 2


def doc_blocks(docs: DataFrame, doc_key: Column, text: Column, n: int) -> DataFrame:
    """``doc_key, h``: hashes of the blocks, one after the other, that the views are cut into.

    Without the last tokens, too few for a block: a window holds another block as well.
    """
    run = rf"{_IN}++(?: {_IN}++){{{_block(n) - 1}}}"
    each = _doc_views(docs, doc_key, text, n <= LITERALS)
    found = each.select(
        "doc_key", "nth", F.explode(F.regexp_extract_all("view", F.lit(run), F.lit(0))).alias("block")
    )
    return found.select("doc_key", _view_hash("block").alias("h"))


def item_blocks(benchmark: DataFrame, text: str, n: int) -> DataFrame:
    """``h``: hashes of all runs of a block's length in items that have windows of ``n`` tokens."""
    width = _block(n)
    texts = benchmark.select(F.col(f"`{text}`").alias("text"))
    parts = _with_tokens(texts, F.col("text")).where(F.size("views.v0") >= n)

    def of_place(v: Column, i: Column) -> Column:
        part, other, said = (F.slice(v[f"v{k}"], i, width) for k in range(3))
        return F.array(_hash(part), _hash(other), _verbatim(F.array_join(said, " ")))

    hashes = F.flatten(_by_place(F.col("views"), F.lit(width), of_place))
    return parts.select(F.explode(hashes).alias("h")).distinct()


def near_docs(docs: DataFrame, benchmark: DataFrame, doc_key: Column, text: Column, item_text: str, n: int) -> DataFrame:
    """Those of ``docs`` that can have a window of ``n`` tokens in common with the benchmark.

    They have a block in common with it, and there are but a few blocks to compare. Keys are
    8 bytes, so far more of them than of other rows are broadcast; else texts are shuffled.
    """
    blocks = materialize(item_blocks(benchmark, item_text, n), "item-blocks")
    side = F.broadcast(blocks) if fits_broadcast(blocks) else blocks
    hit = doc_blocks(docs, doc_key, text, n).join(side, "h", "left_semi")
    near = materialize(hit.select(F.col("doc_key").alias("_near_")).distinct(), "near-documents")
    keys = F.broadcast(near) if near.count() <= NEAR_ROWS else near
    return docs.join(keys, doc_key == F.col("_near_"), "left_semi")


def _literals(part: Column) -> Column:
    return F.size(F.filter(part, lambda t: ~t.isin(*MARKS)))


def item_windows(benchmark: DataFrame, item_id: str, text: str, n: int) -> DataFrame:
    """``h, item, view, at, n_item, width``: what to look for, and how many windows the item has.

    A window holds ``n`` tokens, or the whole item where that has fewer.
    """
    parts = _with_tokens(
        benchmark.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{text}`").alias("text")), F.col("text")
    ).where(F.size("views.v0") >= LEAST_ITEM)
    width = F.least(F.size("views.v0"), F.lit(n))

    def of_window(v: Column, i: Column) -> Column:
        w = F.least(F.size(v["v0"]), F.lit(n))
        part, other = F.slice(v["v0"], i, w), F.slice(v["v1"], i, w)
        rich = _literals(other) >= LITERALS
        words = F.when(rich, _hash(other)).otherwise(_verbatim(F.array_join(F.slice(v["v2"], i, w), " ")))
        return F.array(
            F.struct(_hash(part).alias("h"), _literals(part).alias("words")),
            F.struct(_hash(other).alias("h"), _literals(other).alias("words")),
            F.struct(words.alias("h"), F.lit(n).alias("words")),
        )

    windows = parts.select(
        "item", "views", width.alias("width"), _by_place(F.col("views"), width, of_window).alias("ws")
    )
    placed = windows.select("item", "width", F.posexplode("ws").alias("at", "all"))
    placed = placed.select("item", "width", "at", F.posexplode("all").alias("view", "w"))
    rich = placed.where((F.col("w.words") >= LITERALS) | (F.col("view") == VERBATIM)).select(
        "w.h", "item", "view", "at", "width"
    )
    counts = rich.groupBy(F.col("item").alias("i"), F.col("view").alias("v")).agg(
        F.count(F.lit(1)).alias("n_item")
    )
    same = F.col("item").eqNullSafe(F.col("i")) & (F.col("view") == F.col("v"))
    sought = rich.join(counts, same).select("h", "item", "view", "at", "n_item", "width")
    for view, whole in ((TEMPLATE, WHOLE_TEMPLATE), (FOLDED, WHOLE_FOLDED)):
        richest = F.array_max(
            F.transform("ws", lambda w, i: F.struct(w[view]["words"], -i, w[view]["h"]))  # noqa: B023
        )
        best = windows.where(_literals(F.col(f"views.v{view}")) >= LITERALS).select(
            "item", "width", F.size("ws").cast("long").alias("n_item"), richest.alias("b")
        ).toDF("item", "width", "n_item", "b").select(
            "item", "width", "n_item", F.col("b").cast("struct<words:int,back:int,h:bigint>").alias("b")
        )
        sought = sought.unionByName(
            best.where(F.col("b.words") < LITERALS).select(
                "b.h", "item", F.lit(whole).alias("view"), (-F.col("b.back")).alias("at"), "n_item", "width"
            )
        )
    return sought


def row_key(doc_id: str, text: str) -> Column:
    """Names a row by id and text; repeated rows share it, rows of one id need not."""
    return F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = WINDOW,
    share: float = SHARE,
) -> DataFrame:
    """One row for each document and item it holds, in words or in template.

    ``doc_key`` (:func:`row_key`), ``doc_id``, ``item_id``, ``n_windows`` matched at
    distinct places of the item, ``item_windows``, ``n_slots`` and ``n_changed``: slots
    whose value differs from the item's. They are those of the template, or, where only the
    words agree, in whatever letter case, those of the words. A pair counts where
    the document holds ``share`` of the item's windows, or ``RUN`` equal words one after the
    other. Items of fewer than ``n`` tokens are found whole, those of fewer than ``LEAST_ITEM``
    not at all; templates of fewer than ``LITERALS`` words only verbatim. Null
    texts and those without a token match nothing. Repeated documents give one row, as do repeated
    items. Other columns are ignored.
    """
    items = benchmark.select(item_id, item_text).dropDuplicates()
    wanted = materialize(item_windows(items, item_id, item_text, n), "item-windows")
    key = row_key(doc_id, text)
    widths = sorted(r[0] for r in wanted.select("width").distinct().collect())  # up to n of them
    body = F.col(f"`{text}`")
    found = doc_windows(near_docs(docs, items, key, body, item_text, n), key, body, [n])
    if short := [w for w in widths if w < n]:
        found = found.unionByName(doc_windows(docs, key, body, short))
    # Broadcast only what was counted and sized; else both sides are shuffled by hash.
    side = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    hits = materialize(
        found.join(side, "h").where(
            (F.col("nth") == 0) | ~F.col("view").isin(TEMPLATE, WHOLE_TEMPLATE)
        ).select(
            "doc_key", "item", "view", "at", "n_item", (F.col("pos") - F.col("at")).alias("shift")
        ).distinct(),
        "template-hits",
    )
    aligned = hits.groupBy("doc_key", "item", "view", "shift", "n_item").agg(
        F.collect_set("at").alias("ats")  # no more than the item has windows
    )
    long_runs = aligned.where(F.size("ats") >= RUN - n + 1).select(
        F.col("doc_key").alias("d"), F.col("item").alias("i"), F.col("view").alias("v")
    )
    enough = hits.groupBy("doc_key", "item", "view").agg(
        F.countDistinct("at").alias("m"), F.first("n_item").alias("k")
    ).where(
        (F.col("m") >= share * F.col("k")) | F.col("view").isin(WHOLE_TEMPLATE, WHOLE_FOLDED)
    ).select(
        F.col("doc_key").alias("d"), F.col("item").alias("i"), F.col("view").alias("v")
    ).union(long_runs)
    aligned = materialize(
        aligned.join(
            enough,
            (F.col("doc_key") == F.col("d")) & F.col("item").eqNullSafe(F.col("i")) & (F.col("view") == F.col("v")),
            "left_semi",
        ),
        "template-runs",
    )
    bodies = (
        docs.select(
            key.alias("d"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("body")
        )
        .join(aligned.select("doc_key").distinct(), F.col("d") == F.col("doc_key"), "left_semi")
        .dropDuplicates(["d"])
    )
    bodies = _both(bodies, "body", "doc")
    sources = _both(items.select(F.col(f"`{item_id}`").alias("i"), F.col(f"`{item_text}`").alias("source")), "source", "item")
    runs = aligned.join(bodies, F.col("doc_key") == F.col("d")).join(
        sources, F.col("item").eqNullSafe(F.col("i"))
    )
    named = F.col("view").isin(TEMPLATE, WHOLE_TEMPLATE)

    def of_view(side: str) -> tuple[Column, Column]:
        """Tokens with placeholders and values of a side, in the view of the run."""
        marked = F.when(named, F.col(f"{side}_template")).otherwise(F.col(f"{side}_folded"))
        return marked, F.when(named, F.col(f"{side}_plain")).otherwise(F.col(f"{side}_words"))

    item_marked, item_values = of_view("item")
    doc_marked, doc_values = of_view("doc")
    runs = runs.select(
        "doc_key", "doc_id", "item", "view", "n_item", "ats", "shift", item_marked.alias("marked"),
        item_values.alias("old"), doc_values.alias("new"), doc_marked.alias("doc_marked"),
        F.least(F.size(item_marked), F.lit(n)).alias("width"),
    )
    whole = (F.col("shift") >= 0) & F.slice(
        "doc_marked", F.greatest("shift", F.lit(0)) + 1, F.size("marked")
    ).eqNullSafe(F.col("marked"))
    said = F.filter(
        "ats",
        lambda a: F.slice("old", a + 1, F.col("width"))
        == F.slice("new", a + F.col("shift") + 1, F.col("width")),
    )
    ats = (
        F.when(F.col("view") == VERBATIM, said)
        .when(F.col("view").isin(TEMPLATE, FOLDED), F.col("ats"))
        .when(whole, F.sequence(F.lit(0), (F.col("n_item") - 1).cast("int")))
        .otherwise(F.array().cast("array<int>"))
    )
    runs = runs.withColumn("ats", ats).where(F.size("ats") > 0)
    # Places of the item, 1 where the document has the same word: is there a long run of ones?
    same = F.transform(
        F.sequence(F.lit(0), F.size("old") - 1),
        lambda p: F.when(F.get("old", p) == F.get("new", p + F.col("shift")), "1").otherwise("0"),
    )
    runs = runs.withColumn("said", F.contains(F.array_join(same, ""), F.lit("1" * RUN)))
    inside = F.flatten(F.transform("ats", lambda a: F.sequence(a, a + (F.col("width") - 1))))
    slots = F.transform(
        F.filter(F.array_distinct(inside), lambda p: F.get("marked", p).isin(*MARKS)),
        lambda p: F.struct(
            F.get("old", p).alias("old"), F.get("new", p + F.col("shift")).alias("new")
        ),
    )
    judged = runs.select("doc_key", "doc_id", "item", "view", "n_item", "ats", "said", slots.alias("slots")).withColumn(
        "odd",
        F.size(F.array_distinct("slots"))
        - F.size(F.array_distinct(F.transform("slots", lambda s: s["old"]))),
    )
    consistent = judged.where(ODD_SLOT * F.col("odd") <= F.size(F.array_distinct("slots")))
    changed = F.size(F.filter("slots", lambda s: ~s["old"].eqNullSafe(s["new"])))
    by_view = (
        consistent.select(
            "doc_key", "doc_id", "item", "view", "n_item", "said", F.size("slots").alias("s"), changed.alias("c"),
            F.explode("ats").alias("at"),
        )
        .groupBy("doc_key", "doc_id", "item", "view", "n_item")
        .agg(
            F.countDistinct("at").cast("long").alias("n_windows"),
            F.max("s").cast("long").alias("n_slots"),
            F.min("c").cast("long").alias("n_changed"),
            F.max("said").alias("said"),
        )
        .where((F.col("n_windows") >= share * F.col("n_item")) | F.col("said"))
    )
    figures = F.struct("view", "n_windows", F.col("n_item").cast("long").alias("item_windows"), "n_slots", "n_changed")
    return (
        by_view.groupBy("doc_key", "doc_id", "item").agg(F.min(figures).alias("first"))
        .select(
            "doc_key", "doc_id", F.col("item").alias("item_id"), "first.n_windows", "first.item_windows",
            "first.n_slots", "first.n_changed",
        )
    )


def _both(table: DataFrame, text: str, name: str) -> DataFrame:
    """Plain tokens and those of the views of a text, place by place; stored."""
    cleaned = table.withColumn("_plain_", plain(F.col(text))).withColumn("_marked_", numbered(F.col("_plain_")))
    bare, marked = F.col("_plain_"), F.col("_marked_")
    makes = {"plain": bare, "words": one_case(bare), "template": template(marked), "folded": folded(marked)}
    arrays = cleaned.select(
        *[c for c in table.columns if c != text],
        *[tokens(made).alias(f"{name}_{view}") for view, made in makes.items()],
    )
    return materialize(arrays, f"{name}-tokens")
