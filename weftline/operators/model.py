"""The weakly supervised matcher on pyspark.ml."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.features import CATEGORICAL, NUMERIC
from weftline.session import materialize

PAIR = ["company_id_a", "company_id_b"]
#: What stands for a blank text.
BLANK = "\0"


def training_rows(features: DataFrame, labels: DataFrame, seed: int = 42, max_rows: int = 200_000) -> DataFrame:
    """draw() from features with their labels beside them."""
    return draw(features.join(labels.filter("label_weak IS NOT NULL"), PAIR), seed, max_rows)


def draw(rows: DataFrame, seed: int = 42, max_rows: int = 200_000) -> DataFrame:
    """Labelled pairs, as many negatives as positives at most (all kinds of labels count where no positive is), drawn by a seeded hash; ``max_rows`` bounds each class.

    Counts by the hash's first 14 bits show up to where it is needed, so only those rows are ranked. They are written out, since a fit reads them several times.
    """
    rows = rows.filter(F.col("label_weak").isin(0, 1))
    order = F.xxhash64(*PAIR, F.lit(seed))
    first = F.shiftright(order, 50)
    found = {0: {}, 1: {}}
    for r in rows.groupBy("label_weak", first.alias("first")).agg(F.count("*").alias("n")).collect():
        found[r["label_weak"]][r["first"]] = r["n"]
    have = {k: sum(parts.values()) for k, parts in found.items()}
    take = {1: min(have[1], max_rows), 0: min(have[0], have[1] or have[0], max_rows)}
    near, wanted = F.lit(False), F.lit(False)
    for k, parts in found.items():
        level, so_far = None, 0
        for level in sorted(parts):
            so_far += parts[level]
            if so_far >= take[k]:
                break
        if take[k]:
            near |= (F.col("label_weak") == k) & (first <= level)
            wanted |= (F.col("label_weak") == k) & (F.col("rank") <= take[k])
    ranked = rows.filter(near).withColumn("rank", F.row_number().over(Window.partitionBy("label_weak").orderBy(order, *PAIR)))
    return materialize(ranked.filter(wanted).drop("rank"))


def _numbers(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in NUMERIC})


def _texts(df: DataFrame, fills: dict) -> DataFrame:
    """Missing texts filled; a blank one gets a name, since one-hot columns need names."""
    return df.fillna(fills).replace("", BLANK, CATEGORICAL)


def fit(rows: DataFrame, max_iter: int = 100) -> tuple[PipelineModel | None, dict]:
    """Median and mode imputation, one-hot texts, balanced logistic regression. Also the fills for the text columns.

    A number that no row has is left out. Rows of one class give that class for all pairs; without rows there is no model.
    """
    rows = _numbers(rows)
    n = rows.groupBy("label_weak").agg(F.count("*").alias("n")).collect()
    total = sum(r["n"] for r in n)
    if not total:
        return None, {}
    weight = F.lit(1.0)
    for r in n:
        weight = F.when(F.col("label_weak") == r["label_weak"], total / (len(n) * r["n"])).otherwise(weight)
    seen = rows.agg(*[F.mode(c, deterministic=True).alias(c) for c in CATEGORICAL], *[F.count_if(~F.isnan(c) & F.col(c).isNotNull()).alias(c) for c in NUMERIC]).first()
    fills = {c: seen[c] if seen[c] is not None else "" for c in CATEGORICAL}
    numbers = [c for c in NUMERIC if seen[c]]
    train = _texts(rows, fills).withColumn("weight", weight).withColumn("label", F.col("label_weak").cast("double"))
    index, hot = [f"{c}_i" for c in CATEGORICAL], [f"{c}_v" for c in CATEGORICAL]
    stages = [
        *([Imputer(strategy="median", inputCols=numbers, outputCols=[f"{c}_f" for c in numbers])] if numbers else []),
        StringIndexer(inputCols=CATEGORICAL, outputCols=index, handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=hot, handleInvalid="error", dropLast=True),
        VectorAssembler(inputCols=[f"{c}_f" for c in numbers] + hot, outputCol="features"),
        LogisticRegression(maxIter=max_iter, weightCol="weight", standardization=False, elasticNetParam=0.0, regParam=1.0 / max(total, 1)),
    ]
    return Pipeline(stages=stages).fit(train), fills


def score(model: PipelineModel | None, fills: dict, features: DataFrame) -> DataFrame:
    """Null scores, which go to review, where there is no model."""
    missing = [c for c in [*PAIR, *NUMERIC, *CATEGORICAL] if c not in features.columns]
    if missing:
        raise ValueError(f"columns missing for scoring: {missing}")
    if model is None:
        return features.select(*PAIR, F.lit(None).cast("double").alias("model_score"))
    out = model.transform(_texts(_numbers(features), fills))
    return out.select(*PAIR, vector_to_array("probability")[1].alias("model_score"))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def report(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows by (label_weak, predicted): the cells that precision and recall come from."""
    return scored.groupBy("label_weak", (F.col("model_score") >= threshold).cast("int").alias("predicted")).agg(F.count("*").alias("n"))


def split(rows: DataFrame, test_share: float = 0.25, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test parts by a seeded hash of the pair, so a rerun or a lost executor gives the same parts."""
    cut = F.pmod(F.xxhash64(*PAIR, F.lit(seed)), F.lit(1000)) < int(1000 * test_share)
    return rows.filter(~cut), rows.filter(cut)
