"""Statistics and sanity queries; each returns a small DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.blocking import block_sizes
from weftline.session import materialize


def percentiles(df: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """One row with an exact percentile of a column for each name, interpolated. Values are counted, then ranked in the parts of a range partitioning; only the parts' totals meet in one task."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("n"))
    parts = materialize(counted.repartitionByRange("v").withColumn("part", F.spark_partition_id()))
    totals = parts.groupBy("part").agg(F.sum("n").alias("m"))
    before = totals.select("part", (F.sum("m").over(Window.orderBy("part")) - F.col("m")).alias("b"), F.sum("m").over(Window.partitionBy()).alias("total"))
    last = F.col("b") + F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    ranked = parts.join(F.broadcast(before), "part").select("v", "total", last.alias("last"))
    at = {name: share * (F.col("total") - 1) for name, share in shares.items()}
    first = lambda rank: F.min(F.when(F.col("last") > rank, F.col("v")))
    ends = ranked.agg(*[x for name, r in at.items() for x in (first(F.floor(r)).alias(f"{name}_low"), first(F.ceil(r)).alias(f"{name}_high"), F.max(r - F.floor(r)).alias(f"{name}_part"))])
    between = lambda c: F.col(f"{c}_low") + (F.col(f"{c}_high") - F.col(f"{c}_low")) * F.col(f"{c}_part")
    return ends.select(*[between(name).alias(name) for name in shares])


def block_stats(blocks: DataFrame) -> DataFrame:
    # sizes are counted first: there are far fewer of them than blocks
    return block_sizes(blocks).groupBy("n").agg(F.count("*").alias("c")).agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("blocks_total"),
        F.max("n").alias("block_max"),
        (F.sum(F.col("n") * F.col("c")) / F.sum("c")).alias("block_avg"),
        F.percentile("n", 0.9, F.col("c")).alias("block_p90"),
        F.expr("sum(c * (n * (n - 1) div 2))").alias("est_pairs"),
    )


def top_heavy(heavy: DataFrame, k: int = 10) -> DataFrame:
    return heavy.select("kind", "bkey", "n").distinct().orderBy(F.desc("n"), "kind", "bkey").limit(k)


def overlap_summary(blocks: DataFrame) -> DataFrame:
    per = blocks.groupBy("company_id").agg(F.countDistinct("kind").alias("k"))
    multi = F.coalesce(F.sum(F.when(F.col("k") > 1, 1).otherwise(0)), F.lit(0))
    total = F.count("*")
    return per.agg(
        total.alias("total_companies"),
        F.coalesce(F.sum(F.when(F.col("k") == 1, 1).otherwise(0)), F.lit(0)).alias("single_kind"),
        multi.alias("multi_kind"),
        F.round(F.try_divide(F.lit(100.0).cast("double") * multi, total), 2).alias("pct_multi_kind"),
    )


def kind_overlap(blocks: DataFrame, k: int = 20) -> DataFrame:
    """Companies shared by two kinds; a company has a handful of kinds, so its pairs are few."""
    kinds = blocks.groupBy("company_id").agg(F.collect_set("kind").alias("ks"))
    a = kinds.select("ks", F.explode("ks").alias("kind_a"))
    b = a.select("kind_a", F.explode("ks").alias("kind_b")).filter("kind_a < kind_b")
    return b.groupBy("kind_a", "kind_b").agg(F.count("*").alias("shared_companies")).orderBy(F.desc("shared_companies"), "kind_a", "kind_b").limit(k)


def score_stats(features: DataFrame, scores: DataFrame) -> DataFrame:
    s = F.col("model_score")
    zero = lambda c, name: F.coalesce(c, F.lit(0.0)).alias(name)
    out = scores.agg(
        F.count("*").alias("scores_count"),
        F.count_if(s.isNull()).alias("null_scores"),
        zero(F.min(s), "score_min"),
        zero(F.max(s), "score_max"),
        zero(F.avg(s), "score_mean"),
    )
    ranks = percentiles(scores, "model_score", {"score_median": 0.5, "score_p10": 0.1, "score_p90": 0.9})
    out = out.join(ranks.select(*[zero(F.col(c), c) for c in ranks.columns]), F.lit(True))
    both = features.agg(F.count("*").alias("features_count")).join(out, F.lit(True))
    return both.withColumn("score_ratio", F.round(F.try_divide(F.col("scores_count").cast("double"), F.col("features_count").cast("double")), 4))


def label_counts(labels: DataFrame) -> DataFrame:
    y = F.col("label_weak")
    return labels.agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"), F.count_if(y.isNull()).alias("unlabeled"))


def match_stats(matches: DataFrame, labels: DataFrame, entities: DataFrame) -> DataFrame:
    sizes = entities.groupBy("entity_id").agg(F.count("*").alias("n"))
    one = [
        matches.agg(F.count("*").alias("total_pairs")),
        labels.agg(F.count_if(F.col("label_weak") == 1).alias("labeled_positive"), F.count_if(F.col("label_weak") == 0).alias("labeled_negative")),
        sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_entities"), F.count("*").alias("unique_entity_ids"), F.avg("n").alias("avg_cluster_size"), F.max("n").alias("largest_cluster"), F.count_if(F.col("n") == 1).alias("singletons")),
    ]
    return reduce(lambda a, b: a.join(b, F.lit(True)), one)


def resolved_summary(entities: DataFrame, resolved: DataFrame) -> DataFrame:
    sizes = entities.groupBy("entity_id").agg(F.count("*").alias("n")).agg(
        F.count("*").alias("entities"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.avg("n").alias("avg_cluster"),
        F.max("n").alias("max_cluster"),
        F.count_if(F.col("n") == 1).alias("singletons"),
        F.count_if(F.col("n") > 1).alias("multi_member"),
    )
    sizes = sizes.withColumn("pct_singletons", F.round(F.try_divide(F.lit(100.0).cast("double") * F.col("singletons"), F.col("entities")), 2))
    return sizes.join(resolved.agg(F.count("*").alias("resolved_rows")), F.lit(True))


def pair_sanity(pairs: DataFrame) -> DataFrame:
    """total_unique_ids adds both sides, so an id on both counts twice."""
    out = pairs.agg(
        F.count("*").alias("total_pairs"),
        F.countDistinct("company_id_a").alias("distinct_a"),
        F.countDistinct("company_id_b").alias("distinct_b"),
        F.countDistinct(F.struct("company_id_a", "company_id_b")).alias("u"),
    )
    return out.select("total_pairs", "distinct_a", "distinct_b", (F.col("distinct_a") + F.col("distinct_b")).alias("total_unique_ids"), (F.col("total_pairs") - F.col("u")).alias("duplicate_pairs"))


def pair_ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("company_id_a", "company_id_b")).alias("company_id")).distinct()


def missing_in_pairs(pairs: DataFrame, companies: DataFrame) -> DataFrame:
    return companies.join(pair_ids(pairs), "company_id", "left_anti").agg(F.count("*").alias("missing_companies"))


def orphans_in_pairs(pairs: DataFrame, companies: DataFrame) -> DataFrame:
    return pair_ids(pairs).join(companies.select("company_id"), "company_id", "left_anti").agg(F.count("*").alias("orphan_ids"))


def domain_exact_total(features: DataFrame) -> DataFrame:
    return features.agg(F.sum("domain_exact").alias("domain_exact_total"))


def blocking_overall(sizes: DataFrame, companies: DataFrame, limit: int, pairs: DataFrame) -> DataFrame:
    n = F.col("n")
    kept = n.between(2, limit)
    # sizes are counted first, as in block_stats
    c = F.col("c")
    out = sizes.groupBy("n").agg(F.count("*").alias("c")).agg(
        F.coalesce(F.sum(c), F.lit(0)).alias("blocks_all"),
        F.coalesce(F.sum(F.when(kept, c)), F.lit(0)).alias("blocks_kept"),
        F.coalesce(F.sum(F.when(n > limit, c)), F.lit(0)).alias("blocks_heavy"),
        F.coalesce(F.sum(F.when(n < 2, c)), F.lit(0)).alias("blocks_single"),
        F.max(F.when(kept, n)).alias("kept_max"),
        F.percentile(F.when(kept, n), 0.9, c).alias("kept_p90"),
        F.coalesce(F.sum(F.when(kept, F.expr("c * (n * (n - 1) div 2)"))), F.lit(0)).alias("est_pairs"),
    )
    return out.join(companies.agg(F.count("*").alias("companies")), F.lit(True)).join(pairs.agg(F.count("*").alias("actual_pairs")), F.lit(True))


def blocking_by_kind(sizes: DataFrame, limit: int) -> DataFrame:
    n = F.col("n")
    kept = n.between(2, limit)
    return sizes.groupBy("kind").agg(
        F.count("*").alias("blocks_all"),
        F.count_if(kept).alias("blocks_kept"),
        F.count_if(n > limit).alias("blocks_heavy"),
        F.count_if(n < 2).alias("blocks_single"),
        F.coalesce(F.sum(F.when(kept, F.expr("n * (n - 1) div 2"))), F.lit(0)).alias("est_pairs"),
    )


def top_kept(sizes: DataFrame, limit: int, k: int = 100) -> DataFrame:
    return sizes.filter(F.col("n").between(2, limit)).orderBy(F.desc("n"), "kind", "bkey").limit(k)


def stage_counts(named: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("stage"), "n") for name, df in named.items()]
    return reduce(DataFrame.unionByName, parts)


def duplicate_pairs(df: DataFrame) -> DataFrame:
    many = df.groupBy("company_id_a", "company_id_b").agg(F.count("*").alias("c")).filter("c > 1")
    return many.agg(F.count("*").alias("pairs_repeated"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("rows_extra"))


def decision_counts(decided: DataFrame) -> DataFrame:
    return decided.groupBy("decision").agg(F.count("*").alias("n"))


def silver_quality(clean: DataFrame) -> DataFrame:
    c = F.col
    return clean.agg(
        F.count("*").alias("n_rows"),
        F.count_if(c("domain_name").isNull()).alias("null_domains"),
        F.count_if(c("company_name").isNull()).alias("null_names"),
        F.count_if(~c("year_founded").between(1800, 2100)).alias("years_out_of_range"),
        F.count_if(c("company_name") != F.lower("company_name")).alias("names_not_lower"),
        F.count_if(c("domain_name").rlike("^https?://|^www[.]")).alias("domains_with_scheme"),
        F.count_if(c("linkedin_url").rlike("^https?://")).alias("profiles_with_scheme"),
        F.count_if(c("final_country") != F.lower("final_country")).alias("countries_not_lower"),
        F.count_if(c("company_id").isNull()).alias("null_ids"),
        (F.count("company_id") - F.countDistinct("company_id")).alias("repeated_ids"),
    )
