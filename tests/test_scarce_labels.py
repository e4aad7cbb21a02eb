"""The learned matcher where labels or values are scarce, and its draw against a plain sort."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from weftline.operators import matching, model
from weftline.operators.features import CATEGORICAL
from weftline.plans import catalog

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def features(spark):
    return catalog.Chain(spark, SF).features.limit(300).cache()


def scores(features):
    got = catalog._ml(SimpleNamespace(features=features))
    assert got.select(*model.PAIR).exceptAll(features.select(*model.PAIR)).count() == 0
    return [r.model_score for r in got.collect()]


def of_label(features, label):
    return features.join(matching.weak_labels(features).filter(F.col("label_weak") == label), model.PAIR).drop("label_weak")


def test_one_class_gives_that_class(features):
    for label in (0, 1):
        some = of_label(features, label)
        assert some.count() > 0 and scores(some) == [float(label)] * some.count()


def test_pairs_without_labels_have_null_scores_and_go_to_review(features):
    unlabelled = features.withColumns({c: F.lit(v) for c, v in {"domain_exact": 0, "country_exact": 1, "name_prefix4_eq": 1, "name_prefix6_eq": 0}.items()})
    assert scores(unlabelled) == [None] * features.count()
    got = matching.decide(catalog._ml(SimpleNamespace(features=unlabelled))).select("decision").distinct().collect()
    assert [r.decision for r in got] == ["review"]


@pytest.mark.parametrize("odd", ["no number", "no text", "no texts", "blank"])
def test_columns_without_values_and_blank_texts_are_scored(features, odd):
    kinds = dict(features.dtypes)
    lost = {"no number": ["emp_cur_reldiff"], "no text": ["city_a"], "no texts": CATEGORICAL, "blank": []}[odd]
    changed = features.withColumns({c: F.lit(None).cast(kinds[c]) for c in lost})
    if odd == "blank":
        changed = changed.withColumn("city_a", F.when(F.col("company_id_a") % 2 == 0, "").otherwise(F.col("city_a")))
    got = scores(changed)
    assert len(got) == 300 and all(0 < s < 1 for s in got) and max(got) > 0.9 and min(got) < 0.1


def test_query_without_pairs_is_empty(spark, tmp_path):
    kinds = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame([(1, "red ring", "Brand#1", "SMALL", 3, 900.0), (2, "cold plate", "Brand#2", "LARGE", 4, 901.0)], kinds).write.parquet(str(tmp_path / "part.parquet"))
    got = catalog.queries()["pair_scores_ml"](spark, str(tmp_path))
    assert got.columns == [*model.PAIR, "model_score"] and got.collect() == []


@pytest.mark.parametrize("limit", [1, 7, 50, 200_000])
def test_draw_equals_a_plain_sort(spark, limit):
    rows = spark.range(3000).select(F.col("id").alias("company_id_a"), (F.col("id") + 1).alias("company_id_b"), F.when(F.col("id") % 3 > 0, (F.col("id") % 3 - 1).cast("int")).alias("label_weak"))
    rows = rows.filter((F.col("label_weak") != 1) | (F.col("company_id_a") % 2 == 0) | F.col("label_weak").isNull())
    for seed in (42, 5):
        got = sorted(map(tuple, model.draw(rows, seed, limit).collect()))
        kept = {k: rows.filter(F.col("label_weak") == k).orderBy(F.xxhash64(*model.PAIR, F.lit(seed)), *model.PAIR) for k in (0, 1)}
        n = min(kept[1].count(), limit)
        assert got == sorted(map(tuple, kept[1].limit(n).unionByName(kept[0].limit(n)).collect())) and len(got) == 2 * n
