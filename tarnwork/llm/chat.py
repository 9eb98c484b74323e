r"""Chat formatting of typed content parts (operator 3).

A turn holds parts: text, or an image, audio clip or document given by reference. A
visitor walks the parts in order and writes text, or a numbered placeholder with a
record of the attachment and the tokens it will expand to. A conversation becomes

    <|turn:user|>\nLook: <|image:1|><|end|>\n<|turn:assistant|>\nI see.<|end|>\n

Inside texts ``\``, ``<`` and ``|`` are written ``\0``, ``\1`` and ``\2``, so no text
can hold a control string, and replacing the three back (``\0`` last) is exact.

DataFrame functions only. Offsets come from running sums within a conversation, so the
work is linear in its length; only the finished conversation is one cell.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens that one unit of an attachment expands to: image tiles, seconds, pages.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 700}

_ESCAPES = [("\\", "\\0"), ("<", "\\1"), ("|", "\\2")]
PART = "struct<kind:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    for plain, written in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(_ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def text_parts(text: Column) -> Column:
    """The parts of a turn that is only a text; null counts as empty."""
    none = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
            none.cast("string").alias("ref"), none.cast("bigint").alias("units"),
        )
    )


def _visit(parts: Column, offset: Column, rates: Mapping[str, int]) -> Column:
    """Body, attachments and text spans of a turn whose body begins at 0.

    ``offset`` is the number of attachments in earlier turns. Parts of a kind that is
    neither text nor in ``rates`` are attachments that expand to no tokens.
    """
    rate = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    empty = F.struct(
        F.lit("").alias("body"),
        F.array().cast("array<struct<number:bigint,kind:string,ref:string,tokens:bigint>>").alias("attached"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("texts"),
    )

    def step(so_far: Column, part: Column) -> Column:
        kind = F.coalesce(part["kind"], F.lit("unknown"))
        is_text = kind == "text"
        number = offset + F.size(so_far["attached"]) + 1
        piece = F.when(is_text, escape(F.coalesce(part["text"], F.lit("")))).otherwise(
            F.concat(F.lit("<|"), escape(kind), F.lit(":"), number.cast("string"), F.lit("|>"))
        )
        body = F.concat(so_far["body"], piece)
        record = F.struct(
            number.cast("bigint").alias("number"), kind.alias("kind"), part["ref"].alias("ref"),
            (F.coalesce(part["units"], F.lit(1)) * F.coalesce(F.try_element_at(rate, kind), F.lit(0)))
            .cast("bigint").alias("tokens"),
        )
        span = F.struct(
            F.char_length(so_far["body"]).cast("bigint").alias("start"),
            F.char_length(body).cast("bigint").alias("end"),
        )
        return F.struct(
            body.alias("body"),
            F.when(is_text, so_far["attached"]).otherwise(F.concat(so_far["attached"], F.array(record))).alias("attached"),
            F.when(is_text, F.concat(so_far["texts"], F.array(span))).otherwise(so_far["texts"]).alias("texts"),
        )

    return F.aggregate(F.coalesce(parts, F.array().cast(f"array<{PART}>")), empty, step)


def format_chats(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: str = "parts",
    rates: Mapping[str, int] = TOKENS_PER_UNIT,
) -> DataFrame:
    """One row per conversation of ``turns``; ``parts`` is an array of :data:`PART`.

    ``n_turns``, ``formatted``, ``attachments`` (number, kind, ref, tokens) in order,
    ``attachment_tokens``, and ``loss``: spans of ``formatted``, in code points, that
    hold the assistant's texts. Turns are ordered by number, ties by role and content;
    a repeated row is a turn of its own. A null role is empty, null parts are none, rows
    with a null id form one conversation. Other columns are ignored.
    """
    rows = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.col(f"`{parts}`").alias("parts"),
    )
    order = ["turn", "role", F.to_json("parts")]
    numbered = Window.partitionBy("conv_id").orderBy(*order)
    before = numbered.rowsBetween(Window.unboundedPreceding, -1)
    n_attached = F.size(F.filter(F.coalesce("parts", F.array().cast(f"array<{PART}>")),
                                 lambda p: ~p["kind"].eqNullSafe("text")))
    rows = rows.withColumn("n_attached", n_attached.cast("bigint")).select(
        "*", F.row_number().over(numbered).alias("at"),
        F.coalesce(F.sum("n_attached").over(before), F.lit(0)).alias("earlier"),
    )
    visited = rows.select(
        "conv_id", "at", "role", _visit(F.col("parts"), F.col("earlier"), rates).alias("seen")
    )
    head = F.concat(F.lit("<|turn:"), escape(F.col("role")), F.lit("|>\n"))
    written = F.concat(head, F.col("seen.body"), F.lit("<|end|>\n"))
    written = visited.select(
        "conv_id", "at", "role", "seen", written.alias("written"),
        F.char_length(head).cast("bigint").alias("head"),
    ).withColumn("length", F.char_length("written").cast("bigint"))
    ordered = Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = written.withColumn("start", F.coalesce(F.sum("length").over(ordered), F.lit(0)) + F.col("head"))
    shifted = F.transform(
        "seen.texts",
        lambda s: F.struct(
            (s["start"] + F.col("start")).alias("start"), (s["end"] + F.col("start")).alias("end")
        ),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    cells = placed.select(
        "conv_id",
        F.struct(
            "at", "written", F.col("seen.attached").alias("attached"),
            F.when(F.col("role") == "assistant", shifted).otherwise(none).alias("loss"),
        ).alias("turn"),
    )
    grouped = cells.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    attachments = F.flatten("turns.attached")
    return grouped.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join("turns.written", "").alias("formatted"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]).alias("attachment_tokens"),
        F.flatten("turns.loss").alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: ``array<struct<role, text>>``.

    A turn's text is that of its text parts; placeholders are left out.
    """
    chunks = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda c: c != "")

    def turn(chunk: Column) -> Column:
        role = F.regexp_extract(chunk, r"^<\|turn:([^|]*)\|>", 1)
        body = F.regexp_replace(chunk, r"^<\|turn:[^|]*\|>\n", "")
        texts = F.regexp_replace(body, r"<\|[^|]*:\d+\|>", "")
        return F.struct(unescape(role).alias("role"), unescape(texts).alias("text"))

    return F.transform(chunks, turn)


def read_spans(formatted: Column, spans: Column) -> Column:
    """The texts under the given spans, joined."""
    texts = F.transform(
        spans, lambda s: formatted.substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
    )
    return unescape(F.array_join(texts, ""))
