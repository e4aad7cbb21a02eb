"""Queries by name, each (spark, sf_dir) to DataFrame; plans/oracle.py has their SQL under the same names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import blocking, canonical, clean, features, matching, model, pairs, stats
from weftline.plans.oracle import ALSO_SMALL, CAP, LIMIT, SMALL, STOP
from weftline.session import materialize
from weftline.settings import BlockingParams
from weftline.sources import fixtures

#: The reference's default, and a limit at which small tables have heavy blocks too.
PARAMS = BlockingParams(max_block_size=LIMIT, stage3_stopwords=STOP)
SMALL_PARAMS = BlockingParams(max_block_size=SMALL, stage3_stopwords=STOP)


class Chain:
    """The stages over one folder, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: BlockingParams = PARAMS):
        self.comp, self.p = fixtures.comp_part(spark, sf_dir), params

    def __getattr__(self, name: str):
        make = {
            "adaptive": lambda: blocking.adaptive_blocks(self.comp, self.p),
            "sizes": lambda: blocking.all_block_sizes(self.comp, self.p),
            "kinded": lambda: pairs.pairs_with_kind(self.adaptive.blocks),
            "pairs": lambda: materialize(pairs.capped_pairs(self.kinded, CAP)),
            "features": lambda: features.pair_features(self.pairs, self.comp),
            "scores": lambda: materialize(matching.linear_scores(self.features)),
            "matches": lambda: matching.decide(self.scores),
            "labels": lambda: matching.labels(self.matches),
            "entities": lambda: materialize(matching.entities(self.matches)),
            "everyone": lambda: materialize(matching.entities(self.matches, self.comp)),
            "resolved": lambda: canonical.resolve(self.entities, self.comp),
            "votes": lambda: matching.votes(self.features),
            "cascade": lambda: matching.cascade(self.scores, self.votes),
        }.get(name)
        if make is None:
            raise AttributeError(name)
        value = make()
        setattr(self, name, value)
        return value


def _shard_union(c: Chain, modulus: int = 8) -> DataFrame:
    """What runs cut by hand add up to: the same rows as in one run."""
    return reduce(DataFrame.unionByName, [features.pair_features(pairs.in_shard(c.pairs, modulus, i), c.comp) for i in range(modulus)])


def _ml(c: Chain) -> DataFrame:
    rows = materialize(matching.labelled(c.features))
    fitted, fills = model.fit(model.draw(rows))
    return model.score(fitted, fills, rows)


def _chained() -> dict:
    """Queries of the chain by name, each a function of it."""
    return {
        "blocks_stage1": lambda c: blocking.stage1_blocks(c.comp, c.p),
        "blocks_adaptive": lambda c: c.adaptive.blocks,
        "blocks_heavy": lambda c: c.adaptive.heavy,
        "blocks_refinement_log": lambda c: c.adaptive.log,
        "stage3_tokens": lambda c: c.adaptive.tokens.select("company_id", "country", "tok", "df"),
        "pairs_with_kind": lambda c: c.kinded,
        "pairs_capped": lambda c: c.pairs,
        "pair_features": lambda c: c.features,
        "features_shard_union": _shard_union,
        "weak_labels": lambda c: matching.weak_labels(c.features),
        "pair_scores_linear": lambda c: c.scores,
        "scored_view": lambda c: matching.scored_view(c.features, c.scores),
        "pair_matches": lambda c: c.matches,
        "pair_labels": lambda c: c.labels,
        "entities": lambda c: c.entities,
        "entities_with_singletons": lambda c: c.everyone,
        "resolved": lambda c: c.resolved,
        "resolved_with_singletons": lambda c: canonical.resolve(c.everyone, c.comp),
        "votes": lambda c: c.votes,
        "votes_table": lambda c: matching.votes_table(matching.ambiguous(matching.scored_view(c.features, c.scores))),
        "cascade": lambda c: c.cascade,
        "decision_counts": lambda c: stats.decision_counts(c.cascade),
        "ambiguous_pairs": lambda c: matching.ambiguous(matching.scored_view(c.features, c.scores)).select("company_id_a", "company_id_b", "model_score"),
        "q_block_stats": lambda c: stats.block_stats(c.adaptive.blocks),
        "q_top_heavy": lambda c: stats.top_heavy(c.adaptive.heavy),
        "q_overlap": lambda c: stats.overlap_summary(c.adaptive.blocks),
        "q_kind_pairs": lambda c: stats.kind_overlap(c.adaptive.blocks),
        "q_score_stats": lambda c: stats.score_stats(c.features, c.scores),
        "q_label_counts": lambda c: stats.label_counts(c.labels),
        "q_match_stats": lambda c: stats.match_stats(c.matches, c.labels, c.entities),
        "q_resolved_summary": lambda c: stats.resolved_summary(c.entities, c.resolved),
        "q_pair_sanity": lambda c: stats.pair_sanity(c.kinded),
        "q_missing": lambda c: stats.missing_in_pairs(c.pairs, c.comp),
        "q_orphan": lambda c: stats.orphans_in_pairs(c.pairs, c.comp),
        "q_domain_exact_total": lambda c: stats.domain_exact_total(c.features),
        "q_blocking_stats_overall": lambda c: stats.blocking_overall(c.sizes, c.comp, c.p.max_block_size, c.pairs),
        "q_blocking_stats_by_kind": lambda c: stats.blocking_by_kind(c.sizes, c.p.max_block_size),
        "q_block_sizes": lambda c: c.sizes,
        "q_top_kept": lambda c: stats.top_kept(c.sizes, c.p.max_block_size),
        "q_stage_counts": lambda c: stats.stage_counts({"companies": c.comp, "blocks": c.adaptive.blocks, "pairs": c.pairs, "features": c.features, "scores": c.scores, "entities": c.entities}),
        "q_dupes": lambda c: stats.duplicate_pairs(c.kinded),
    }


def queries() -> dict:
    def q(f, params):
        return lambda spark, sf_dir: f(Chain(spark, sf_dir, params))

    def cleaned(source):
        return lambda spark, sf_dir: clean.clean_companies(source(spark, sf_dir))

    pages = cleaned(fixtures.bronze_pages)
    return {
        "clean_pages": pages,
        "clean_customer": cleaned(fixtures.bronze_customer),
        **{name: q(f, PARAMS) for name, f in _chained().items()},
        **{f"{name}_{SMALL}": q(_chained()[name], SMALL_PARAMS) for name in ALSO_SMALL},
        "pair_scores_ml": q(_ml, PARAMS),
        "q_quality": lambda spark, sf_dir: stats.silver_quality(pages(spark, sf_dir)),
    }


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies to resolved records, those without a match too."""
    c = Chain(spark, sf_dir)
    return canonical.resolve(c.everyone, c.comp).select("entity_id", "sources_count", "domain", "country", "city", "name", "employees_avg")
