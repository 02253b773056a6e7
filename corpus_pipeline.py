"""A training corpus from the documents table: five stages, each by one operator of `fieldsync.llm`.

    toxicity            documents that score as toxic go
    simhash_near_dedup  one document of each group of near duplicates stays
    substring_dedup     words of passages that an earlier document holds are cut out of the text
    mixing              documents are put in the order of their sources' schedule
    bpe                 texts are coded; `position` rises in the order of the schedule

Each stage takes all that its predecessor kept, written as Parquet and read again. The filters pass null
and empty texts on. A toxicity score is learned from the labels beside the table, in a bounded sample.
The mixing table holds the order in its files, by number, and in the rows of each: the last stage reads it there.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldsync.llm import bpe, mixing, superkmers, toxicity, vptree
from fieldsync.llm.batches import ship_code
from fieldsync.llm.catalog import TOKENIZER
from fieldsync.sources.staging import stage


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_code(spark)
    lexicon = toxicity.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.scored(docs, lexicon, out="__toxicity")
    return scored.where(F.col("__toxicity.score") < toxicity.THRESHOLD).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return vptree.without_near_duplicates(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = superkmers.remove_repeats(docs, out="__removal")
    shorter = F.col("__removal.n_removed") > 0
    cut = cut.withColumn("text", F.when(shorter, F.col("__removal.kept")).otherwise(F.col("text")))
    return cut.withColumn("n_chars", F.when(shorter, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.interleaved(docs, mixing.tempered_weights(docs))


def positioned(docs: DataFrame) -> DataFrame:
    """`docs`, as read from a table, with `position`: it rises over the table's files and the rows of each, with gaps between files."""
    try:
        part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long")
        return docs.withColumn("position", F.shiftleft(part, 33) + F.col("_metadata.row_index"))
    except AnalysisException:  # rows that don't come from a table
        return positioned(stage(docs, "pipeline-positions"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(positioned(docs).select("position", "doc_id", "lang", "source", "text"), TOKENIZER)
    whole = F.col("coded.decoded") == F.coalesce("text", F.lit(""))
    return coded.select(
        "doc_id", "lang", "source", F.size("coded.ids").cast("long").alias("n_tokens"), F.col("coded.ids").alias("ids"), whole.alias("round_trip"), "position"
    )


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash_near_dedup", remove_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL can't tell what a learned lexicon rejects or how a tokenizer codes: tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
