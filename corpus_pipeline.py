"""A corpus, step by step: toxic documents go, near copies go, long repeats go, sources are mixed, texts are encoded."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import bpe, minhash_dedup, mixing, suffix_dedup, toxicity
from weftline.session import materialize


#: Columns that stages work on; others are carried along under names that cannot clash.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def _carried(stage):
    """The stage, with other columns than KNOWN renamed before it and named back after it, in place."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        safe = [n if n in KNOWN and names.index(n) == i else f"carried_{i}" for i, n in enumerate(names)]
        return stage(spark, docs.toDF(*safe), sf_dir).toDF(*names)

    return run


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars as the text is now."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")) if "n_chars" in docs.columns else docs


@_carried
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier chain rejects; it is fitted on the labels in sf_dir."""
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, chain).filter(~F.col("rejected")).select(*docs.columns)


@_carried
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class."""
    return minhash_dedup.keep_one(docs)


@_carried
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words that occur elsewhere; every document stays."""
    return _counted(suffix_dedup.without_repeats(docs, unit=suffix_dedup.WORDS))


@_carried
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the sources' targets; a document may occur up to three times, each time whole."""
    return _counted(mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded bytes."""
    return bpe.op7_bpe(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The first stage fits a model, which SQL cannot; tests compare run() with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
