"""Scores to decisions, labels, entities and votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.components import connected_components

#: Weights, in hundredths, of the deterministic score that stands in for a model where results must be reproducible.
LINEAR_WEIGHTS = {"name_compact_exact": 40, "domain_exact": 20, "country_exact": 10, "city_exact": 20, "name_prefix6_eq": 10}


def labelled(features: DataFrame) -> DataFrame:
    """features with label_weak: 1, 0 or null for each pair; a positive wins over a negative."""
    rel = F.coalesce(F.col("emp_tot_reldiff"), F.lit(1.0))
    true = lambda c: F.coalesce(c, F.lit(False))
    positive = true(F.col("domain_exact") == 1) | (true(F.col("country_exact") == 1) & true(F.col("name_prefix6_eq") == 1) & (rel <= 0.20))
    negative = true(F.col("country_exact") == 0) | (true(F.col("name_prefix4_eq") == 0) & (rel >= 0.90))
    return features.withColumn("label_weak", F.when(positive, 1).when(negative, 0))


def weak_labels(features: DataFrame) -> DataFrame:
    return labelled(features).select("company_id_a", "company_id_b", "label_weak")


def linear_scores(features: DataFrame) -> DataFrame:
    total = sum((w * F.coalesce(F.col(c), F.lit(0)) for c, w in LINEAR_WEIGHTS.items()), F.lit(0))
    return features.select("company_id_a", "company_id_b", (total.cast("double") / 100.0).alias("model_score"))


def scored_view(features: DataFrame, scores: DataFrame) -> DataFrame:
    return features.join(scores, ["company_id_a", "company_id_b"], "left")


def decide(scores: DataFrame, hi: float = 0.90, lo: float = 0.10) -> DataFrame:
    """match from hi, nonmatch to lo, else review; so is a null score."""
    s = F.col("model_score")
    return scores.select("company_id_a", "company_id_b", "model_score", F.when(s >= hi, "match").when(s <= lo, "nonmatch").otherwise("review").alias("decision"))


def labels(matches: DataFrame) -> DataFrame:
    d = F.col("decision")
    return matches.select("company_id_a", "company_id_b", F.when(d == "match", 1).when(d == "nonmatch", 0).alias("label_weak"))


def entities(matches: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """(company_id, entity_id) of the companies on a match edge; with companies, the rest as their own entities too."""
    found = connected_components(matches.filter(F.col("decision") == "match"), "company_id_a", "company_id_b")
    out = found.select(F.col("node").alias("company_id"), F.col("component").alias("entity_id"))
    if companies is not None:
        rest = companies.select(F.col("company_id").cast("long").alias("company_id")).distinct().join(out, "company_id", "left_anti")
        out = out.unionByName(rest.withColumn("entity_id", F.col("company_id")))
    return out


def ambiguous(scored: DataFrame, lo: float = 0.35, hi: float = 0.65, limit: int = 50_000) -> DataFrame:
    """The pairs to ask a judge about, at most ``limit`` by id order; a null score falls under a rule of thumb."""
    s = F.col("model_score")
    hint = (F.col("country_exact") == 1) & ((F.col("name_prefix6_eq") == 1) | (F.col("city_exact") == 0)) & (F.coalesce(F.col("emp_tot_reldiff"), F.lit(1.0)) <= 0.6)
    return scored.filter(s.between(lo, hi) | (s.isNull() & hint)).orderBy("company_id_a", "company_id_b").limit(limit)


def votes(features: DataFrame, legacy_zero_is_missing: bool = False) -> DataFrame:
    """A rule-based judge's vote for each pair, with its reasons as JSON."""
    rel = F.coalesce(F.col("emp_tot_reldiff"), F.lit(1.0))
    if legacy_zero_is_missing:
        rel = F.when(rel == 0, 1.0).otherwise(rel)
    strong = F.coalesce((F.col("name_prefix6_eq") == 1) & (rel <= 0.3) & (F.col("country_exact") == 1), F.lit(False))
    reasons = F.to_json(F.array(F.when(strong, "same name prefix, size and country").otherwise("weak evidence")))
    return features.select("company_id_a", "company_id_b", strong.alias("vote_same"), F.when(strong, 0.7).otherwise(0.6).alias("confidence"), reasons.alias("reasons_json"))


def votes_table(scored: DataFrame) -> DataFrame:
    """A vote for each pair of scored_view(), with what it was cast on kept beside it for audit; absent figures as 0, 1.0 or -1.0."""
    cast = votes(scored, legacy_zero_is_missing=True).withColumnRenamed("confidence", "vote_confidence")
    rel = F.coalesce("emp_tot_reldiff", F.lit(1.0))
    names = F.to_json(F.struct(F.coalesce("country_a", F.lit("")).alias("a"), F.coalesce("country_b", F.lit("")).alias("b")))
    seen = scored.select(
        "company_id_a",
        "company_id_b",
        names.alias("normalized_names_json"),
        F.coalesce("country_exact", F.lit(0)).alias("country_exact"),
        F.coalesce("name_prefix6_eq", F.lit(0)).alias("name_prefix6_eq"),
        F.when(rel == 0, 1.0).otherwise(rel).alias("emp_tot_reldiff"),
        F.coalesce("model_score", F.lit(-1.0)).alias("model_score"),
    )
    return cast.join(seen, ["company_id_a", "company_id_b"]).select("company_id_a", "company_id_b", "vote_same", "vote_confidence", "reasons_json", "normalized_names_json", "country_exact", "name_prefix6_eq", "emp_tot_reldiff", "model_score")


def cascade(scores: DataFrame, cast_votes: DataFrame, hi: float = 0.85, lo: float = 0.15, sure: float = 0.70) -> DataFrame:
    """The model decides outside its band, a confident vote inside it, else review."""
    s, v, c = F.col("model_score"), F.col("vote_same"), F.col("confidence")

    def pick(yes: str, no: str, vote_yes: str, vote_no: str, rest: str) -> Column:
        return F.when(s >= hi, yes).when(s <= lo, no).when((c >= sure) & v, vote_yes).when((c >= sure) & ~v, vote_no).otherwise(rest)

    return scores.join(cast_votes.select("company_id_a", "company_id_b", "vote_same", "confidence"), ["company_id_a", "company_id_b"], "left").select(
        "company_id_a",
        "company_id_b",
        "model_score",
        pick("match", "nonmatch", "match", "nonmatch", "review").alias("decision"),
        pick("model", "model", "vote", "vote", "none").alias("decision_source"),
    )
