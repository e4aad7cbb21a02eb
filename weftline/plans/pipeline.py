"""The whole run: a company file to resolved records. Stages are lazy; a stage with '+' in front brings its upstream."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from weftline.operators import blocking, canonical, clean, features, matching, model, pairs, stats
from weftline.session import materialize, shared_dir
from weftline.settings import Settings
from weftline.sources import companies as source

#: Stage and what it needs.
STAGES = {
    "blocking": [],
    "pairing": ["blocking"],
    "features": ["pairing"],
    "scoring": ["features"],
    "matching": ["scoring"],
    "labels": ["matching"],
    "entities": ["matching"],
    "resolved": ["entities"],
}


@dataclass
class Run:
    """companies: cleaned rows. scorer: features to scores; by default a model trained on weak labels."""

    companies: DataFrame
    settings: Settings = field(default_factory=Settings)
    scorer: Callable[[DataFrame], DataFrame] | None = None
    out: dict = field(default_factory=dict)

    @classmethod
    def from_file(cls, spark: SparkSession, settings: Settings | None = None, **more) -> Run:
        """Reads settings.company_file, a CSV file or a zip of some, cleans it and writes the rows out. A company id that is null or occurs twice stops the load, since pairs would multiply."""
        settings = settings or Settings()
        path = settings.company_file
        if path.endswith(".zip"):
            path = source.expand_zip(path, f"{shared_dir(spark).removeprefix('file://').removeprefix('file:')}/companies")
        raw = source.read_csv(spark, path)
        cleaned = materialize(clean.clean_companies(raw))
        audit = clean.count_audit(raw, cleaned)
        found = stats.silver_quality(cleaned).first()
        if not audit["equal"] or found["null_ids"] or found["repeated_ids"]:
            raise ValueError(f"company ids must be unique: {found['null_ids']} null, {found['repeated_ids']} repeated; rows {audit}")
        return cls(cleaned, settings, **more)

    def save(self, database: str) -> list[str]:
        """Writes every stage that was run as a table of the database; the tables' names."""
        tables = {"companies": self.companies}
        for stage, made in self.out.items():
            tables |= {"blocks": made.blocks, "heavy": made.heavy, "refinement_log": made.log} if stage == "blocking" else {stage: made}
        for name, df in tables.items():
            source.save_table(df, f"{database}.{name}")
        return sorted(tables)

    def _make(self, stage: str):
        s, o = self.settings, self.out
        if stage == "blocking":
            return blocking.adaptive_blocks(self.companies, s.blocking)
        if stage == "pairing":
            return pairs.capped_pairs(pairs.pairs_with_kind(o["blocking"].blocks), s.cap_per_a)
        if stage == "features":
            return features.pair_features(o["pairing"], self.companies, s.empty_domain_is_null)
        if stage == "scoring":
            return (self.scorer or self._train_and_score)(o["features"])
        if stage == "matching":
            return matching.decide(o["scoring"], s.hi, s.lo)
        if stage == "labels":
            return matching.labels(o["matching"])
        if stage == "entities":
            return matching.entities(o["matching"], self.companies if s.include_singletons else None)
        return canonical.resolve(o["entities"], self.companies)

    def _train_and_score(self, rows: DataFrame) -> DataFrame:
        rows = materialize(matching.labelled(rows))
        fitted, fills = model.fit(model.draw(rows))
        if self.settings.model_path and fitted:
            model.save(fitted, self.settings.model_path)
        return model.score(fitted, fills, rows)

    def run(self, stages: list[str] | None = None) -> dict:
        for name in stages or [f"+{s}" for s in STAGES]:
            self._need(name.lstrip("+"), name.startswith("+"))
        return self.out

    def _need(self, stage: str, upstream: bool) -> None:
        if stage not in STAGES:
            raise ValueError(f"no stage {stage}")
        for up in STAGES[stage]:
            if up not in self.out:
                if not upstream:
                    raise ValueError(f"{stage} needs {up}; ask for +{stage}")
                self._need(up, True)
        if stage not in self.out:
            self.out[stage] = self._make(stage)

    def review(self, judge: Callable[[str], str] | None = None) -> str:
        """Key figures as text, and a judge's comment on them; a judge that fails leaves only the figures."""
        self.run(["+resolved"])
        one = stats.resolved_summary(self.out["entities"], self.out["resolved"]).first().asDict()
        text = "Resolution summary: " + ", ".join(f"{k}={v}" for k, v in one.items())
        if judge is None:
            return text
        try:
            return f"{text}\n{judge(text)}"
        except Exception as e:  # a comment must not stop a finished run
            return f"{text}\nreview failed: {e}"
