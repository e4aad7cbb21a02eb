"""Toxicity with a classifier chain.

Categories are predicted in turn by linear models over hashed words (present or not), of which each
keeps those that depend on the category beyond chance; each later model also gets the log-odds of
the earlier ones. In training these come out of fold, so that a later
model meets earlier predictions as they are on unseen texts. The threshold of the last category is
the one with the best F1 out of fold.

Models are fitted on the driver with numpy, each on the rows where its category is known: at most
SAMPLE labelled rows in hash order of each combination of known categories, the one bound here; every
text is scored, whole. Of the sample's words the driver gets those that show half of the evidence asked
for over the whole sample, counted on the executors, so long texts don't fill it. A null or empty text
has no words and gets the models' intercepts. Labels that are null, or whose document is absent, are
not used; of a label's documents with one id, one counts, that of the smallest text hash. Without labelled rows
of both kinds a category's probability is its share among the labelled rows, 0 without any. If no
row of the last category could be scored out of fold by a model that had seen another one, there is
nothing to set a threshold by, and no document is rejected.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.arrow import map_batches
from weftline.llm.textnum import NON_WORDS, groups, utf8, words
from weftline.session import materialize

#: Labelled rows to fit on, at most; buckets of hashed words; folds.
SAMPLE, BUCKETS, FOLDS = 8000, 1 << 22, 3
#: The likelihood-ratio statistic of word and category that a word needs; four texts of a category of a tenth and no others reach it.
EVIDENCE = 17.0
#: The chain: category and the SQL over the labels that says whether a document has it.
CHAIN = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))


def features(texts: list[bytes], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text, one text after the other, and their number for each; only wanted ones, if given by a mask."""
    all_buckets, counts = [], []
    for a, b in groups(texts):
        h, n = words(texts[a:b], NON_WORDS)
        bucket, row = (h % np.uint64(BUCKETS)).astype(np.int64), np.repeat(np.arange(b - a), n)
        if wanted is not None:
            on = wanted[bucket]
            bucket, row = bucket[on], row[on]
        key = np.unique(row * BUCKETS + bucket)
        all_buckets.append((key % BUCKETS).astype(np.int32))
        counts.append(np.bincount(key // BUCKETS, minlength=b - a))
    return np.concatenate(all_buckets or [np.array([], np.int32)]), np.concatenate(counts or [np.array([], np.int64)])


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


@dataclass
class Linear:
    """Kept buckets in order, their weights, weights of the earlier categories' log-odds, and the intercept."""

    kept: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float

    def predict(self, bucket: np.ndarray, row: np.ndarray, n: int, before: np.ndarray) -> np.ndarray:
        margin = before @ self.earlier + self.intercept
        if len(self.kept):
            at = np.minimum(np.searchsorted(self.kept, bucket), len(self.kept) - 1)
            on = self.kept[at] == bucket
            margin = margin + np.bincount(row[on], weights=self.weights[at[on]], minlength=n)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def evidence(bucket: np.ndarray, row: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that occur, and the likelihood-ratio statistic of presence and category for each."""
    kept, at = np.unique(bucket, return_inverse=True)
    with_word = np.bincount(at, minlength=len(kept)).astype(float)
    positive = np.bincount(at, weights=y[row], minlength=len(kept))
    n, k = float(len(y)), y.sum()
    g = np.zeros(len(kept))
    for seen, total in ((positive, k * with_word / n), (with_word - positive, (n - k) * with_word / n), (k - positive, k * (n - with_word) / n), (n - k - with_word + positive, (n - k) * (n - with_word) / n)):
        g += 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(total, 1e-9)), 0)
    return kept, g


def fit_linear(bucket: np.ndarray, row: np.ndarray, n: int, before: np.ndarray, y: np.ndarray, steps: int = 100, rate: float = 0.1, l2: float = 1.0) -> Linear:
    """Logistic regression with balanced classes, by full-batch Adam, on the words with enough evidence."""
    share = y.mean() if n else 0.0
    none = np.array([], np.int64)
    if not 0 < share < 1:
        return Linear(none, np.zeros(0), np.zeros(before.shape[1]), float(_log_odds(np.array(share))) if share else -30.0)
    kept, g = evidence(bucket, row, y)
    kept = kept[g >= EVIDENCE].astype(np.int64)
    at = np.minimum(np.searchsorted(kept, bucket), max(0, len(kept) - 1))
    on = kept[at] == bucket if len(kept) else np.zeros(len(bucket), bool)
    column, row = at[on], row[on]
    class_weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) / n
    size = len(kept)
    w = np.zeros(size + before.shape[1] + 1)
    m, v = w.copy(), w.copy()
    for t in range(1, steps + 1):
        margin = np.bincount(row, weights=w[column], minlength=n) + before @ w[size:-1] + w[-1]
        r = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * class_weight
        slope = np.concatenate([np.bincount(column, weights=r[row], minlength=size), before.T @ r, [r.sum()]])
        slope[:-1] += l2 / n * w[:-1]
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return Linear(kept, w[:size], w[size:-1], float(w[-1]))


@dataclass
class Chain:
    names: list[str]
    models: list[Linear]
    threshold: float

    def predict(self, texts: list[bytes]) -> np.ndarray:
        """A row for each text, a column for each category."""
        wanted = np.zeros(BUCKETS, bool)
        for model in self.models:
            wanted[model.kept] = True
        bucket, counts = features(texts, wanted)
        row, n = np.repeat(np.arange(len(texts)), counts), len(texts)
        p = np.zeros((n, 0))
        for model in self.models:
            p = np.column_stack([p, model.predict(bucket, row, n, _log_odds(p))])
        return p


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The midpoint of the gap below the scores that give the best F1."""
    if not y.any() or not len(p):
        return 0.5
    order = np.argsort(-p, kind="stable")
    hit, score = np.cumsum(y[order]), p[order]
    last = np.concatenate([score[1:] < score[:-1], [True]])
    f1 = np.where(last, 2 * hit / (np.arange(1, len(p) + 1) + y.sum()), 0)
    k = int(f1.argmax())
    return float(score[k] + (score[k + 1] if k + 1 < len(p) else 0)) / 2


def fit_chain(bucket: np.ndarray, counts: np.ndarray, labels: np.ndarray, fold: np.ndarray, names: list[str]) -> Chain:
    """labels: a column for each category, in the chain's order; NaN where it is not known."""
    n = len(counts)
    row = np.repeat(np.arange(n), counts)
    out_of_fold, models = np.zeros((n, 0)), []
    for c in range(len(names)):
        y, before = labels[:, c].astype(float), _log_odds(out_of_fold)
        known = ~np.isnan(y)
        unseen, fair = np.zeros(n), np.zeros(n, bool)
        for k in range(FOLDS):
            train, test = known & (fold != k), fold == k
            new = np.cumsum(train) - 1
            on = train[row]
            part = fit_linear(bucket[on], new[row[on]], int(train.sum()), before[train], y[train])
            fair |= test & known & (y[train] > 0).any()
            new = np.cumsum(test) - 1
            on = test[row]
            unseen[test] = part.predict(bucket[on], new[row[on]], int(test.sum()), before[test])
        new = np.cumsum(known) - 1
        on = known[row]
        models.append(fit_linear(bucket[on], new[row[on]], int(known.sum()), before[known], y[known]))
        out_of_fold = np.column_stack([out_of_fold, unseen])
    return Chain(names, models, best_threshold(out_of_fold[known, -1], y[known]) if y[fair].any() else float("inf"))


def train(documents: DataFrame, labels: DataFrame, text: str = "text", chain=CHAIN, sample: int = SAMPLE) -> Chain:
    """Only the sample's buckets with some evidence reach the driver."""
    known = labels.select(F.col("doc_id"), *[F.expr(e).alias(f"y_{c}") for c, e in chain]).filter(" OR ".join(f"y_{c} IS NOT NULL" for c, _ in chain))
    # what has a document, so that other labels don't use up the sample
    known = materialize(known.join(documents.select("doc_id"), "doc_id", "left_semi"))
    drawn = None
    for combination in itertools.product((True, False), repeat=len(chain)):
        if any(combination):
            some = known.filter(" AND ".join(f"y_{c} IS {'NOT ' if on else ''}NULL" for (c, _), on in zip(chain, combination)))
            some = some.orderBy(F.xxhash64("doc_id"), "doc_id", *[f"y_{c}" for c, _ in chain]).limit(sample)
            drawn = some if drawn is None else drawn.unionByName(some)
    names = [f"y_{c}" for c, _ in chain]
    drawn = materialize(drawn)
    body = F.coalesce(F.col(text), F.lit(""))
    # the drawn ids are as bounded as the sample
    texts = documents.select("doc_id", F.struct(F.xxhash64(body).alias("h"), body.alias("text")).alias("x")).join(F.broadcast(drawn.select("doc_id").distinct()), "doc_id")
    rows = materialize(drawn.join(texts.groupBy("doc_id").agg(F.min("x").alias("x")), "doc_id").select("doc_id", *names, F.col("x.text").alias("text")))
    kind = dict(documents.dtypes)["doc_id"]
    schema = ", ".join([f"doc_id {kind}", *[f"{y} boolean" for y in names], "buckets array<int>"])
    wanted = np.zeros(BUCKETS, bool)
    for x in _evident(map_batches(rows, _bucketed(names, None), schema), rows, names).toLocalIterator():
        wanted[x[0]] = True
    got = map_batches(rows, _bucketed(names, np.packbits(wanted)), schema).toArrow()
    got = got.take(np.lexsort([np.array(got["doc_id"].to_pylist() or [], dtype=object).astype(str)])) if got.num_rows else got
    flat = got["buckets"].combine_chunks()
    bucket = flat.flatten().to_numpy() if got.num_rows else np.array([], np.int32)
    counts = flat.value_lengths().to_numpy() if got.num_rows else np.array([], np.int64)
    y = np.column_stack([np.array(got[c].to_pylist(), dtype=float) for c in names]) if got.num_rows else np.zeros((0, len(names)))
    return fit_chain(bucket, counts, y, np.arange(len(counts)) % FOLDS, [c for c, _ in chain])


def _bucketed(names: list[str], wanted: np.ndarray | None):
    """doc_id, labels and each text's buckets; only wanted ones, if given by packed bits."""

    def run(batches):
        mask = None if wanted is None else np.unpackbits(wanted).astype(bool)
        for b in batches:
            bucket, counts = features(utf8(b.column("text")), mask)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[b.column(c) for c in names], pa.ListArray.from_arrays(offsets, bucket)], names=["doc_id", *names, "buckets"])

    return run


def _evident(bucketed: DataFrame, rows: DataFrame, names: list[str]) -> DataFrame:
    """(bucket) of those that show half of EVIDENCE for a category or more over the sample."""
    seen = bucketed.select(F.explode("buckets").alias("bucket"), *names)
    counts = lambda of: of.agg(*[F.count(c).alias(f"n_{c}") for c in names], *[F.count_if(c).alias(f"k_{c}") for c in names])
    total = counts(rows).first()

    def ratio(c: str) -> Column:
        n, k, with_word, positive = float(total[f"n_{c}"]), float(total[f"k_{c}"]), F.col(f"n_{c}"), F.col(f"k_{c}")
        g = F.lit(0.0)
        for met, of, side in ((positive, with_word, k), (with_word - positive, with_word, n - k), (k - positive, n - with_word, k), (n - k - with_word + positive, n - with_word, n - k)):
            g = g + F.when(met > 0, met * F.log(met * n / (of * side))).otherwise(0)
        return 2 * g

    kept = F.lit(False)
    for c in names:
        kept = kept | (ratio(c) >= EVIDENCE / 2)
    return counts(seen.groupBy("bucket")).filter(kept).select("bucket")


def score(documents: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """documents' columns with p_<category> for each category, and rejected; columns of these names that it has are replaced."""
    added = [f"p_{c}" for c in chain.names] + ["rejected"]
    kept = documents.columns
    clash = set(added) & set(kept)
    if clash:
        documents = documents.drop(*clash)
        kept = documents.columns

    def run(batches):
        for b in batches:
            p = chain.predict(utf8(b.column(text)))
            more = [pa.array(p[:, i]) for i in range(p.shape[1])] + [pa.array(p[:, -1] >= chain.threshold)]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*kept, *added])

    schema = ", ".join([f"`{c}` {t}" for c, t in documents.dtypes] + [f"{c} double" for c in added[:-1]] + ["rejected boolean"])
    return map_batches(documents, run, schema)


def op9_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, a probability for each category, and whether the document is rejected."""
    return score(documents.select("doc_id", "text"), train(documents, labels)).drop("text")
