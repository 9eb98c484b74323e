"""The registered queries of the llm operators and the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm import (
    alignment,
    chat,
    classifier,
    fim,
    licenses,
    mixing,
    packing,
    pii,
    rules,
    setjoin,
    sharding,
    templates,
    token_files,
)
from tarnwork.scratch import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function of the session and the table folder under its own name."""

    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if oracle:
            ORACLES[build.__name__] = oracle
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op5_karmarkar_karp_shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return sharding.shard_by_bytes(docs, keep=("doc_id",), n_shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op9_hash_threshold_mix(spark: SparkSession, folder: str) -> DataFrame:
    sized = mixing.size_documents(_table(spark, folder, "documents"))
    return mixing.mix(sized, weights=(5, 2, 1)).select(
        "doc_id", "size", "source_size", "target",
        (F.col("repeats") * F.col("size")).alias("taken"),
    )


def _rules_sql() -> str:
    lengths = list(rules.NGRAM_LIMITS)
    dups = ", ".join(f"coalesce(dup_chars_{n}, 0) as dup_chars_{n}" for n in lengths)
    sums = ", ".join(
        f"cast(sum(length(words[p])) filter (where n = {n}) as bigint) as dup_chars_{n}" for n in lengths
    )
    fine = " and ".join(f"100 * dup_chars_{n} <= {x} * word_chars" for n, x in rules.NGRAM_LIMITS.items())
    space = r"[\x20\x09-\x0D]+"
    return rf"""
    with docs as (
        select doc_id, coalesce(text, '') as text,
               [x for x in string_split_regex(coalesce(text, ''), '{space}') if x <> ''] as words
        from documents),
    runs as (
        select doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') as run
        from docs, (select unnest({[3, *lengths]}) as n) as lengths,
             lateral (select unnest(range(1, greatest(len(words) - n + 2, 1))) as i) as places),
    marked as (
        select doc_id, n, i, row_number() over (partition by doc_id, n, run order by i) as nth,
               count(*) over (partition by doc_id, n, run) as times
        from runs),
    hits as (
        select distinct doc_id, n, unnest(range(i, i + n)) as p from marked
        where case when n = 3 then times > 1 else nth > 1 end),
    covered as (
        select doc_id, count(*) filter (where n = 3) as n_repeat_words, {sums}
        from hits join docs using (doc_id) group by doc_id),
    lines as (
        select doc_id, line, count(*) - 1 as again,
               length(regexp_replace(line, '{space}', '', 'g')) as chars
        from (select doc_id, unnest(string_split(text, chr(10))) as line from docs) as split
        group by doc_id, line),
    repeats as (
        select doc_id, cast(sum(again) as bigint) as n_dup_lines,
               cast(sum(again * chars) as bigint) as dup_line_chars
        from lines where chars > 0 group by doc_id),
    measured as (
        select doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
               length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
               coalesce(n_dup_lines, 0) as n_dup_lines,
               coalesce(n_repeat_words, 0) as n_repeat_words,
               coalesce(dup_line_chars, 0) as dup_line_chars, {dups}
        from docs left join covered using (doc_id) left join repeats using (doc_id)),
    judged as (
        select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from measured)
    select *, not base_failed
              and (n_repeat_words <= {rules.ALLOWED_WORDS}
                   or (100 * dup_line_chars <= {rules.LINE_LIMIT} * word_chars and {fine})) as kept
    from judged
    """


@query(_rules_sql())
def op10_repetition_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return rules.apply_rules(docs, keep=("doc_id",))


@query()
def op8_jaccard_components(spark: SparkSession, folder: str) -> DataFrame:
    return setjoin.jaccard_components(_table(spark, folder, "documents"))


@query()
def op2_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    return templates.find_leaks(docs, benchmark).drop("doc_key")


#: Under this key, pseudonyms of different runs agree.
PSEUDONYM_KEY = b"op1 registered query"


@query()
def op1_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, PSEUDONYM_KEY)


@query(
    r"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
        from conversations
        union all select -7, 0, 'user', '\### Assistant: </turn> ok'
        union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    written as (
        select *, role || text as said,
               length('<|turn:' || role || '|>' || chr(10) || text || '<|end|>' || chr(10)) as plain
        from turns)
    select conv_id, count(*) as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text))
             as turns_sha256,
           cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint)
             as loss_chars,
           sha256(coalesce(string_agg(text, '' order by turn, role, text)
                             filter (where role = 'assistant'), '')) as loss_sha256,
           cast(sum(plain + length(said)
                    - length(replace(replace(replace(said, '\', ''), '<', ''), '|', ''))) as bigint)
             as formatted_chars,
           cast(0 as bigint) as n_attachments, cast(0 as bigint) as attachment_tokens
    from written group by conv_id
    """
)
def op3_typed_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"),
    )
    parts = turns.unionByName(extra).withColumn("parts", chat.text_parts(F.col("text")))
    written = materialize(chat.format_chats(parts), "chats")
    read = materialize(
        written.select(
            "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
            chat.read_spans(F.col("formatted"), F.col("loss")).alias("loss_text"), "attachments",
            "attachment_tokens",
        ),
        "chats-read",
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"), "attachment_tokens",
    )


@query()
def op4_orc_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "tokens.orc")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_tokens(_table(spark, folder, "documents"), path, tokenizer)
    return token_files.token_index(spark, path)


@query()
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents have no paths: here they are laid out as a tree by source, language and id."""
    id_ = F.col("doc_id")
    name = F.when(id_ % 50 == 0, F.lit("LICENSE")).otherwise(F.concat(id_.cast("string"), F.lit(".txt")))
    place = F.concat_ws("/", "source", "lang", F.floor(id_ / 5000).cast("string"), F.floor(id_ / 50).cast("string"), name)
    files = _table(spark, folder, "documents").select("doc_id", place.alias("path"), "text")
    return licenses.scan_licenses(files, keep=("doc_id",))


@query()
def op7_boosted_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    trees = classifier.fit(docs, labels, learn=fold != 0)
    return classifier.score(docs, trees, keep=("doc_id",)).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query(
    r"""
    with drawn as (
        select doc_id, coalesce(text, '') as text,
               sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h
        from documents),
    cut as (
        select doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as units,
               [cast('0x' || substr(h, 8 * k + 1, 8) as bigint) for k in range(4)] as h
        from drawn),
    formed as (
        select *, len(units) as n,
               case when text = '' or contains(text, '<P>') or contains(text, '<S>')
                         or contains(text, '<M>') or h[3] % 100 >= 90 then 'plain'
                    when h[4] % 100 < 20 then 'spm' else 'psm' end as form,
               least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as a,
               greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as b
        from cut),
    parts as (
        select *, array_to_string(units[1:a], '') as p, array_to_string(units[a + 1:b], '') as m,
               array_to_string(units[b + 1:], '') as s
        from formed)
    select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
           case when form <> 'plain' then length(m) end as middle_chars,
           sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                            else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
           sha256(text) as restored_sha256
    from parts
    """
)
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    written = fim.fill_in_middle(_table(spark, folder, "documents"))

    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    return written.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(fim.restore(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


@query()
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, folder, "documents")
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.link_counts(docs, a, b)


@query()
def op13_swap_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, folder, "documents")
    places, _ = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return places
