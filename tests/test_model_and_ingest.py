"""The learned matcher, the stages that are off by default, and a run from a file to tables."""

import zipfile

import pytest
from pyspark.sql import functions as F

from tests.test_core import HEADER, companies
from weftline.operators import blocking, matching, model, stats
from weftline.operators.features import CATEGORICAL, NUMERIC
from weftline.plans import catalog
from weftline.plans.pipeline import Run
from weftline.settings import BlockingParams, Settings

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def features(spark):
    return catalog.Chain(spark, SF).features.cache()


@pytest.fixture(scope="module")
def rows(features):
    return model.training_rows(features, matching.weak_labels(features)).cache()


def counts(df):
    return {r.label_weak: r["count"] for r in df.groupBy("label_weak").count().collect()}


def test_training_rows_are_balanced_and_repeatable(features, rows):
    everything = counts(features.join(matching.weak_labels(features), model.PAIR).filter("label_weak IS NOT NULL"))
    assert counts(rows) == {1: everything[1], 0: min(everything[0], everything[1])} and everything[0] > 0
    few = model.training_rows(features, matching.weak_labels(features), max_rows=50)
    again = model.training_rows(features, matching.weak_labels(features), max_rows=50)
    assert counts(few) == {1: 50, 0: 50} and few.select(*model.PAIR).exceptAll(again.select(*model.PAIR)).count() == 0
    other = model.training_rows(features, matching.weak_labels(features), seed=1, max_rows=50)
    assert few.select(*model.PAIR).exceptAll(other.select(*model.PAIR)).count() > 0


def test_split_is_disjoint_and_whole(rows):
    train, test = model.split(rows)
    n, m = train.count(), test.count()
    assert n + m == rows.count() and train.select(*model.PAIR).intersect(test.select(*model.PAIR)).count() == 0 and 0.15 < m / (n + m) < 0.35


def test_model_learns_the_weak_labels_and_survives_saving(rows, tmp_path):
    train, test = model.split(rows)
    fitted, fills = model.fit(train, max_iter=30)
    scored = model.score(fitted, fills, test).join(test.select(*model.PAIR, "label_weak"), model.PAIR).cache()
    cells = {(r.label_weak, r.predicted): r.n for r in model.report(scored).collect()}
    right = cells.get((0, 0), 0) + cells.get((1, 1), 0)
    assert right >= 0.9 * sum(cells.values())
    model.save(fitted, str(tmp_path / "m"))
    again = model.score(model.load(str(tmp_path / "m")), fills, test).join(scored.withColumnRenamed("model_score", "first"), model.PAIR)
    assert again.filter(F.abs(F.col("model_score") - F.col("first")) > 1e-12).count() == 0
    weights = fitted.stages[-1].coefficients.toArray()
    named = dict(zip(NUMERIC, weights))
    assert named["domain_exact"] > 0 and len(weights) > len(NUMERIC)


def test_unknown_categories_and_missing_values_are_scored(spark, rows):
    fitted, fills = model.fit(rows.limit(500), max_iter=10)
    odd = rows.limit(20).drop("label_weak")
    for c in CATEGORICAL:
        odd = odd.withColumn(c, F.when(F.col("company_id_b") % 2 == 0, "never seen"))
    odd = odd.withColumns({c: F.lit(None).cast(t) for c, t in odd.dtypes if c in NUMERIC[:3]})
    got = model.score(fitted, fills, odd).collect()
    assert len(got) == 20 and all(0 <= r.model_score <= 1 for r in got)
    with pytest.raises(ValueError, match="columns missing"):
        model.score(fitted, fills, odd.drop(NUMERIC[0]))


def test_percentiles_equal_sorted_values(spark):
    values = [((i * 7919) % 1009) / 8 for i in range(3000)] + [3.5] * 500
    got = stats.percentiles(spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(5), "x", {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.937, "e": 1.0}).first()
    ordered = sorted(values)

    def at(share):
        r = share * (len(ordered) - 1)
        low = ordered[int(r)]
        return low + (ordered[min(int(r) + 1, len(ordered) - 1)] - low) * (r - int(r))

    assert all(abs(got[c] - at(s)) < 1e-9 for c, s in {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.937, "e": 1.0}.items())
    assert stats.percentiles(spark.createDataFrame([], "x double"), "x", {"a": 0.5}).first().a is None


def test_stages_that_are_off_by_default(spark):
    base = catalog.Chain(spark, SF).comp
    without = blocking.adaptive_blocks(base, BlockingParams(max_block_size=6, enable_stage3_token=False, enable_stage3_name6=False))
    assert without.tokens is None and without.blocks.filter(F.col("kind").isin("token_country", "name6_country")).count() == 0
    rest = blocking.adaptive_blocks(base, BlockingParams(max_block_size=6, stage3_min_token_len=100, fallbacks=True))
    kinds = {r.kind for r in rest.log.unionByName(rest.blocks.select(F.lit("b").alias("stage"), "kind", "bkey", F.lit(1).cast("long").alias("n"))).select("kind").distinct().collect()}
    assert {"name8_country", "name6_city"} & kinds


def test_singletons(spark):
    m = matching.decide(spark.createDataFrame([(1, 2, 0.95), (3, 4, 0.2)], "company_id_a long, company_id_b long, model_score double"))
    got = sorted(map(tuple, matching.entities(m, companies(spark)).collect()))
    assert got == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6)]


def archive(path, lines):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("c.csv", HEADER + "".join(lines))
    return str(path)


def test_from_file_to_tables(spark, tmp_path, monkeypatch):
    lines = [f'{i},Acme {i // 2} Inc,acme{i // 2}.com,1990,tools,1-10,"Town, BC, CA",,,1{i},2{i}\n' for i in range(40)]
    monkeypatch.setenv("COMPANY_FILE", archive(tmp_path / "c.zip", lines))
    run = Run.from_file(spark, scorer=matching.linear_scores)
    out = run.run(["+resolved"])
    spark.sql("DROP DATABASE IF EXISTS weft_test CASCADE")
    names = run.save("weft_test")
    try:
        assert {"companies", "blocks", "heavy", "refinement_log", "pairing", "features", "scoring", "matching", "entities", "resolved"} == set(names)
        assert spark.table("weft_test.companies").count() == 40 and spark.table("weft_test.resolved").count() == out["resolved"].count() > 0
    finally:
        spark.sql("DROP DATABASE weft_test CASCADE")


def test_repeated_company_ids_stop_the_load(spark, tmp_path):
    path = archive(tmp_path / "d.zip", ["1,a,,,,,,,,,\n", "1,b,,,,,,,,,\n"])
    with pytest.raises(ValueError, match="1 repeated"):
        Run.from_file(spark, Settings(company_file=path))
