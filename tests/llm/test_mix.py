"""The mixed rows themselves."""

import collections

from pyspark.sql import functions as F

from weftline.llm import mixing


def documents(spark, n=2400, sources=12):
    words = F.transform(F.sequence(F.lit(1), (F.col("id") % 37 + 20).cast("int")), lambda i: F.concat(F.lit("w"), F.col("id"), F.lit("_"), i))
    return spark.range(n).select(F.col("id").alias("doc_id"), F.array_join(words, "  ").alias("text"), F.concat(F.lit("s"), F.col("id") % sources).alias("source"))


def test_mix_keeps_documents_whole_and_meets_targets(spark):
    docs = documents(spark).cache()
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = mixing.mix(docs).collect()
    assert all(r.text == texts[r.doc_id] for r in rows)
    taken = collections.Counter()
    for r in rows:
        taken[r.source] += len(r.text.split())
    sizes = docs.select("source", mixing.word_count(F.col("text")).alias("size"))
    for r in mixing.targets(sizes).collect():
        assert abs(taken[r.source] - r.target) <= 0.1 * r.target


def test_mix_writes_shuffled_shards(spark):
    docs = documents(spark)
    shard = {r.doc_id: r.shard for r in mixing.plan(docs).collect()}
    ids = mixing.mix(docs).select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"), "doc_id").orderBy("i").collect()
    runs = [(r.p, shard[r.doc_id]) for k, r in enumerate(ids) if not k or (ids[k - 1].p, shard[ids[k - 1].doc_id]) != (r.p, shard[r.doc_id])]
    assert len(runs) == len(set(shard[r.doc_id] for r in ids))
    repeated = sum(n - 1 for n in collections.Counter(r.doc_id for r in ids).values())
    beside = sum(a.doc_id == b.doc_id for a, b in zip(ids, ids[1:]))
    assert repeated > 100 and beside < 0.2 * repeated
