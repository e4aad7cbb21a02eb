"""Hot groups, ties and repeated rows, each against SQL or a plain version."""

import collections

import numpy as np
from pyspark.sql import functions as F

from tests.compare import duck, same
from weftline.llm import chat_format, license_scan, license_texts, media, mixing, registry, toxicity, url_filter


def test_op1_finds_whole_texts_behind_comment_marks_and_very_many_notices(spark, tmp_path):
    marked = "\n".join(f" * {line}" for line in license_texts.MIT.strip().splitlines())
    shifted = license_texts.GPL_3_NOTICE.replace("useful", "very useful")
    rows = [
        (1, f"/* Copyright 2020 X.\n{marked} */ int main() {{}}"),
        (2, "MIT License. " * 20_000),
        (3, license_texts.APACHE_2_NOTICE),
        (4, shifted),
        (5, " ".join(reversed(license_texts.MIT.split()))),
        (6, "Kit and the MIT License, mit licence"),
        (7, "the general public and license"),
        (None, None),
        (7, license_texts.BSD_2 + license_texts.ISC + license_texts.ZLIB + license_texts.MPL_2_NOTICE + license_texts.UNLICENSE),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.queries()["op1_license_scan"](spark, str(tmp_path))
    assert same(got, duck(str(tmp_path)), license_scan.op1_sql()) == ""
    labels = {(r.doc_id, r.n_words): set(r.labels.split(",")) for r in got.collect()}
    by_id = {k[0]: v for k, v in labels.items()}
    assert by_id[1] == {"mit-text"} and by_id[2] == {"mit"} and {"apache", "apache-2.0", "apache-2.0-text"} <= by_id[3] and {"gpl", "gpl-3.0-text"} <= by_id[4]
    assert by_id[5] == {""} and {"bsd", "bsd-2-clause-text", "isc-text", "zlib-text", "mpl-2.0", "mpl-2.0-text", "unlicense-text"} <= set().union(*labels.values())


def test_op1_keeps_columns(spark):
    df = spark.createDataFrame([(1, "mit license", "x", 5)], "doc_id long, text string, matches string, other int")
    out = license_scan.scan(df)
    assert set(out.columns) == {"doc_id", "text", "other", "n_words", "matches", "score"} and out.first().matches[0].label == "mit"


def test_op2_ranks_turns_that_share_a_number(spark, tmp_path):
    one = [(1, 0, "user", f"t{i}") for i in range(3000)] + [(1, None, None, f"n{i}") for i in range(700)]
    none = [(None, 5, "bot", f"x{i}") for i in range(1500)]
    same_start = [(10 + c, k, "user", f"hi{k}") for c in range(300) for k in range(1 + c % 3)]
    spark.createDataFrame(one + none + same_start, "conv_id long, turn long, role string, text string").repartition(7).write.parquet(f"{tmp_path}/conversations.parquet")
    assert same(registry.queries()["op2_chat_format"](spark, str(tmp_path)), duck(str(tmp_path)), chat_format.OP2_SQL) == ""


def test_op5_gives_no_rows_for_a_huge_screen(spark):
    gif = media.encode([np.zeros((2, 3), np.uint8)])
    huge = gif[:6] + b"\xff\xff\xff\xff" + gif[10:]
    rows = media.frames(spark.createDataFrame([(1, bytearray(huge)), (2, bytearray(gif))], "doc_id long, content binary")).collect()
    assert [r.doc_id for r in rows] == [2]


def test_op8_shuffled_filter_gives_the_same_verdicts(spark, odd_dir):
    for folder in (odd_dir, "/root/testdata/sf0.01"):
        pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
        hot = pages.unionByName(spark.range(2000).select(F.col("id").alias("page_id"), F.lit("no scheme").alias("url")))
        rules, urls = url_filter.listing(spark), url_filter.listed_urls(spark)
        key = lambda df: collections.Counter(map(tuple, df.collect()))
        a, b = key(url_filter.judge(hot, rules, urls)), key(url_filter.judge(hot, rules, urls, broadcast_blocks=0))
        assert a == b and sum(a.values()) == hot.count()


def test_op8_canonical_urls(spark):
    urls = ["HTTP://Spam-Farm.example.com:80/de/./12/", "https://u:p@www.spam-farm.example.com.:443/x/../de//12?q#f", "http://spam-farm.example.com/de/12.html", "http://a.spam-farm.example.com/de/12", "http://spam-farm.example.com/de/1000", "http://spam-farm.example.com/../../de/0"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.op8_url_filter(df).collect()}
    assert [got[i] for i in range(6)] == ["block", "block", "allow", "allow", "allow", "block"]


def test_op9_uses_one_document_of_each_id(spark):
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join([*words[i % 7 : i % 7 + 9], "vile" if i % 5 == 0 else "fine"])) for i in range(400)] + [(3, f"copy {k} w1") for k in range(500)]
    labels = [(i, 1, int(i % 5 == 0)) for i in range(400)]
    documents, known = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    chain = toxicity.train(documents, known)
    got = collections.Counter((r.doc_id % 5 == 0, r.rejected) for r in toxicity.score(documents, chain).collect())
    assert got[(True, True)] == 80 and got[(False, True)] == 0
    again = toxicity.train(documents.orderBy(F.desc("text")), known)
    assert again.threshold == chain.threshold and all((a.weights == b.weights).all() for a, b in zip(chain.models, again.models))


def test_op10_takes_equal_rows_as_often_as_planned(spark):
    rows = [(None, "same words here", "s0", k % 3) for k in range(600)] + [(k, f"text {k} " + "w " * (k % 30), f"s{k % 4}", 0) for k in range(900)] + [(1, None, None, 1)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")
    planned = mixing.plan(docs)
    assert planned.count() == len(rows)
    per = {r.source: (r.t, r.target) for r in planned.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target")).collect()}
    assert all(abs(t - target) <= 1 for t, target in per.values())
    places = collections.Counter((r.source, r.shard, r.place) for r in planned.collect())
    assert max(places.values()) == 1
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = collections.Counter((r.doc_id, r.text, r.source) for r in mixed.collect())
    assert got == collections.Counter((r.doc_id, r.text, r.source) for r in mixing.mix(docs).collect())
    words = collections.Counter()
    for (_, t, s), n in got.items():
        words[s] += n * len((t or "").split())
    assert all(abs(words[s] - target) <= 0.1 * target + 40 for s, (_, target) in per.items())
    assert max(got.values()) <= 3 * 600


def test_op10_targets_with_many_sources(spark):
    sizes = spark.range(3000).select(F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("source"), (F.col("id") * F.col("id") % 977).alias("size"))
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    size = {r.source: r["size"] for r in sizes.collect()}
    order = sorted(size)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, free, want = float(sum(size.values())), set(order), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s]}
        want |= share if not over else {s: 3.0 * size[s] for s in over}
        if not over:
            break
        left -= sum(want[s] for s in over)
        free -= over
    assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 for s in want)
