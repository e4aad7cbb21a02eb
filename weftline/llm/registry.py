"""Queries of this subpackage, and their SQL where there is one."""

from __future__ import annotations

from weftline.llm import bpe, chat_format, embedding_dedup, license_scan, media, minhash_dedup, mixing, suffix_dedup, toxicity, url_filter


def _table(name: str, op):
    return lambda spark, sf_dir: op(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def queries() -> dict:
    return {
        "op1_license_scan": _table("documents", license_scan.op1_license_scan),
        "op2_chat_format": _table("conversations", chat_format.op2_chat_format),
        "op3_minhash_dedup": _table("documents", minhash_dedup.op3_minhash_dedup),
        "op4_suffix_dedup": _table("documents", suffix_dedup.op4_suffix_dedup),
        "op5_media": _table("documents", media.op5_media),
        "op6_embedding_dedup": _table("embeddings", embedding_dedup.op6_embedding_dedup),
        "op7_bpe": _table("documents", bpe.op7_bpe),
        "op8_url_filter": _table("pages", url_filter.op8_url_filter),
        "op9_toxicity": lambda spark, sf_dir: toxicity.op9_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")),
        "op10_mixing": _table("documents", mixing.op10_mixing),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_scan.op1_sql(),
        "op2_chat_format": chat_format.OP2_SQL,
        "op4_suffix_dedup": suffix_dedup.op4_sql(),
        "op6_embedding_dedup": embedding_dedup.op6_sql(),
        "op8_url_filter": url_filter.op8_sql(),
    }
