"""A training corpus in five stages: rules, near duplicates, decontamination, mix, shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of their input. Between stages the documents are stored in the
shared scratch folder, so no stage is computed twice and a lost executor costs no more
than the running one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm import mixing, rules, setjoin, sharding, templates
from tarnwork.operators.joins import fits_broadcast
from tarnwork.scratch import drop_scratch, materialize, written

#: Sources by name weigh so much in turn.
WEIGHTS = (5, 2, 1)
SHARDS = 8


def _small(stored: DataFrame) -> DataFrame:
    """A stored list of ids, broadcast where it was counted and is small: then the texts
    need not be shuffled. A larger one is joined by a shuffle of both sides."""
    return F.broadcast(stored) if fits_broadcast(stored) else stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return rules.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id; null is no id.

    Rows are told apart by id and text, so one id may stand for several documents, and
    rows without an id are grouped like any others. Of rows that repeat one stays.
    """
    key = templates.row_key("doc_id", "text")
    rows = docs.select(key.alias("key"), "doc_id", "text")
    groups = materialize(setjoin.jaccard_components(rows.select("key", "text"), "key"), "groups")
    # jaccard_components names its rows doc_id: here that is the key.
    ids = rows.groupBy("key").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    groups = groups.select(F.col("doc_id").alias("key"), F.col("component_id").alias("group")).distinct()
    members = materialize(groups.join(ids, "key"), "members")
    first = F.struct(F.col("id").isNull(), "id", "key")
    stay = members.groupBy("group").agg(F.min(first).alias("first"))
    stay = stay.select(F.col("first.key").alias("key")).withColumn("stays", F.lit(True))
    judged = members.join(stay, "key", "left")
    listed = F.col("key").alias("_listed")
    gone = _small(materialize(judged.where("stays is null").select(listed), "gone"))
    again = _small(materialize(judged.where("stays and n > 1").select(listed), "again"))
    same = F.col("_key") == F.col("_listed")
    left = docs.withColumn("_key", key).join(gone, same, "left_anti")
    return left.join(again, same, "left_anti").drop("_key").unionByName(
        left.join(again, same, "left_semi").dropDuplicates(["_key"]).drop("_key")
    )


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = templates.find_leaks(docs.select("doc_id", "text"), benchmark)
    leaks = _small(materialize(leaks.select("doc_key").distinct(), "leaks"))
    return docs.join(leaks, templates.row_key("doc_id", "text") == F.col("doc_key"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    sized = mixing.size_documents(docs, keys=("doc_id", "text"))
    chosen = mixing.thresholds(sized, mixing.source_targets(sized, WEIGHTS))
    packed = docs.select(
        F.struct("*").alias("row"), "source", F.xxhash64("doc_id", "text").alias("h")
    )
    taken = mixing.apply_thresholds(packed, chosen).where("repeats > 0")
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))
    return taken.select("row", copies.alias("copy")).select("row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each row goes: shards of nearly equal bytes, copies of a text together."""
    return sharding.shard_by_bytes(docs, keep=("doc_id", "lang", "source"), n_shards=SHARDS)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

#: Differencing and the hashes that decide the mix have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mark = written()
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_scratch(spark, since=mark, keep=1)  # what the stage stored, and its input
    return STAGES[-1][1](spark, docs, sf_dir)
