"""Hand-worked cases: cleaning, blocking, features, decisions, components, ingest and triggers."""

import zipfile

from pyspark.sql import functions as F

from weftline.operators import blocking, clean, components, features, matching, pairs, stats
from weftline.plans.pipeline import Run
from weftline.settings import BlockingParams, Settings, env
from weftline.sources import companies as src
from weftline.streaming import trigger

HEADER = ",name,domain,year founded,industry,size range,locality,country,linkedin url,current employee estimate,total employee estimate\n"


def companies(spark):
    rows = [
        (1, "acme inc", "acme.com", "vancouver", "ca", 120, 140),
        (2, "acme incorporated", "acme.com", "vancouver", "ca", 100, 150),
        (3, "foo, llc", "", "seattle", None, 12, 15),
        (4, "foo llc", "", None, "us", None, None),
        (5, "株式会社", "", "tokyo", "jp", None, None),
        (6, "有限会社", "", "tokyo", "jp", 0, 0),
    ]
    return spark.createDataFrame(rows, "company_id long, company_name string, domain_name string, city string, final_country string, current_employee_estimate int, total_employee_estimate int")


def test_zip_to_clean_rows(spark, tmp_path):
    body = HEADER + '0, Acme Inc ,https://www.acme.com/,1990,Manufacturing,51-200,"Vancouver, BC, CA",,https://www.linkedin.com/company/acme/,1,2\n1,nan,HTTP://WWW.Foo.com//,,,n/a,,null,uk.linkedin.com/company/x,,\n'
    with zipfile.ZipFile(tmp_path / "c.zip", "w") as z:
        z.writestr("deep/c.csv", body)
    found = src.expand_zip(str(tmp_path / "c.zip"), str(tmp_path / "out"))
    a, b = clean.clean_companies(src.read_csv(spark, found)).orderBy("company_id").collect()
    assert (a.company_name, a.domain_name, a.linkedin_url, a.city, a.state, a.final_country, a.size_range) == ("acme inc", "acme.com", "linkedin.com/company/acme", "vancouver", "bc", "ca", "51-200")
    assert (b.company_name, b.domain_name, b.linkedin_url, b.size_range, b.final_country) == (None, "foo.com", "linkedin.com/company/x", "n/a", None)


def test_blocks_and_features(spark):
    c = companies(spark)
    rows = blocking.stage1_blocks(c, BlockingParams())
    assert sorted((r.kind, r.company_id) for r in rows.collect()) == [("compact5_city", 1), ("compact5_city", 2), ("domain", 1), ("domain", 2), ("name3_country", 1), ("name3_country", 2)]
    assert pairs.capped_pairs(pairs.pairs_with_kind(rows)).collect() == [(1, 2)]
    got = {r.company_id_a: r for r in features.pair_features(spark.createDataFrame([(1, 2), (3, 4), (5, 6)], "company_id_a long, company_id_b long"), c).collect()}
    assert (got[1].domain_exact, got[1].name_exact, got[1].name_prefix6_eq, got[1].emp_cur_absdiff, round(got[1].emp_tot_reldiff, 4)) == (1, 0, 1, 20, 0.0667)
    assert (got[3].domain_exact, got[3].country_exact, got[3].city_exact, got[3].emp_tot_reldiff) == (1, 0, None, 1.0)
    assert (got[5].name_compact_exact, got[5].emp_cur_reldiff, got[5].both_have_domain) == (1, None, 1)


def test_decisions_and_entities(spark):
    s = [(1, 2, 0.95), (2, 3, 0.90), (3, 5, 0.89), (5, 6, 0.99), (7, 9, 0.91), (8, 9, 0.97), (4, 5, 0.10), (4, 6, None)]
    m = matching.decide(spark.createDataFrame(s, "company_id_a long, company_id_b long, model_score double"))
    assert {r.decision: r.n for r in stats.decision_counts(m).collect()} == {"match": 5, "nonmatch": 1, "review": 2}
    assert stats.label_counts(matching.labels(m)).first() == (5, 1, 2)
    assert sorted(map(tuple, matching.entities(m).collect())) == [(1, 1), (2, 1), (3, 1), (5, 5), (6, 5), (7, 7), (8, 7), (9, 7)]


def test_components_of_a_long_path_and_a_hub(spark):
    path = spark.range(200).select(((F.col("id") * 37) % 200).alias("a"), (((F.col("id") * 37) % 200) + 1).alias("b"))
    hub = spark.range(1001, 1500).select(F.lit(1000).cast("long").alias("a"), F.col("id").alias("b"))
    got = {r.node: r.component for r in components.connected_components(path.unionByName(hub), "a", "b").collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[i] == 1000 for i in range(1000, 1500)) and len(got) == 701


def test_pipeline_stages(spark):
    run = Run(companies(spark), Settings(), scorer=matching.linear_scores)
    out = run.run(["+pairing"])
    assert set(out) == {"blocking", "pairing"} and run.review().startswith("Resolution summary")
    assert "review failed" in run.review(lambda text: 1 / 0)


def test_settings(monkeypatch):
    monkeypatch.setenv("W_FLAG", "No")
    assert env("W_FLAG", True, bool) is False and env("W_ABSENT", 3, int) == 3


def test_trigger(spark, tmp_path):
    f, seen = tmp_path / "c.csv", []
    f.write_text(HEADER)
    cursor = trigger.run_if_changed(str(f), None, seen.append)
    assert trigger.run_if_changed(str(f), cursor, seen.append) == cursor and len(seen) == 1
    f.write_text(HEADER + "1,a,,,,,,,,,\n")
    assert trigger.run_if_changed(str(f), cursor, seen.append) != cursor and len(seen) == 2
    rows = []
    q = trigger.follow(spark, str(tmp_path), str(tmp_path / "cp"), lambda df, k: rows.append(df.count()))
    q.awaitTermination(60)
    assert sum(rows) == 1
