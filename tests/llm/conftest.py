import pytest
from pyspark.sql import types as T

LONG = "the quick brown fox jumps over the lazy dog while nobody looks at the old red barn " * 600
NEAR = LONG.replace("barn", "shed", 1)


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    """Nulls, empty and very long texts, repeated rows, ties and extra columns with clashing names."""
    root = str(tmp_path_factory.mktemp("odd"))
    s = T.StringType()
    extra = ["node", "score", "size", "key", "rejected", "_node", "_key", "shard", "kept", "host", "path", "matches"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", s), T.StructField("lang", s), T.StructField("source", s), T.StructField("n_chars", T.LongType())] + [T.StructField(n, s) for n in extra])
    texts = [(1, ""), (2, LONG), (3, LONG), (3, LONG), (4, NEAR), (5, " \t\n "), (6, "MIT LICENSE mit license"), (7, "x" * 70_000), (8, "Zażółć gęślą jaźń 日本語 🎉"), (9, None), (None, "gnu general public license"), (10, "one two")]
    rows = [(i, t, None, None if k % 4 == 0 else f"s{k % 3}", None, *["e"] * len(extra)) for k, (i, t) in enumerate(texts)]
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, 0, None), (2, None, 1), (99, 1, 1), (None, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    urls = [(1, "HTTPS://A.Example.COM/en/7/x?y#z"), (1, "HTTPS://A.Example.COM/en/7/x?y#z"), (2, None), (3, "no scheme"), (4, "http://com/en/"), (5, "http://xcom/en/"), (6, "x://net/de/8"), (None, "http://b.example.net/de/81"), (7, "http://a.org/EN/\n")]
    spark.createDataFrame([(i, u, "h", "r") for i, u in urls], "page_id long, url string, host string, rule string").write.parquet(f"{root}/pages.parquet")
    nan, inf = float("nan"), float("inf")
    vectors = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.1], 1), (4, [0.0, 0.0], 1), (5, None, 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [1.0, 0.0], None), (9, [1.0, None], 1), (10, [], 1), (None, [0.0, 1.0], 2), (11, [1.0, 0.0, 0.0], 1)]
    spark.createDataFrame([(*v, "c") for v in vectors], "vec_id long, embedding array<float>, label int, ck string").write.parquet(f"{root}/embeddings.parquet")
    turns = [(1, 0, "user", "hi"), (1, 1, "bot", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "bot", "yo"), (4, None, None, None), (4, 300, "user", "late"), (None, 0, "user", "lost"), (5, 0, "user", "a"), (5, 0, "user", "b"), (5, 0, "user", "b")]
    spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, part string").write.parquet(f"{root}/conversations.parquet")
    return root


@pytest.fixture(scope="session")
def empty_dir(spark, odd_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "labels", "pages", "embeddings", "conversations"):
        spark.read.parquet(f"{odd_dir}/{t}.parquet").limit(0).write.parquet(f"{root}/{t}.parquet")
    return root
