"""Labels that are known in part, or lack a document."""

from weftline.llm import toxicity


def test_every_usable_label_is_used(spark):
    docs = spark.createDataFrame([(i, f"plain words number {i} " + ("nasty" if i % 4 == 0 else "nice")) for i in range(400)], "doc_id long, text string")
    rows = [(i, None, int(i % 4 == 0)) for i in range(400)] + [(i, 1, 0) for i in range(1000, 3000)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, labels, sample=200)).collect()
    assert {r.doc_id for r in got if r.rejected} == set(range(0, 400, 4))
