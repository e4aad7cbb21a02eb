"""Embedding near-duplicates by collision-counting projections.

Vectors are compared within a label (and length) by cosine >= 0.98. Equal vectors form one class, so
copies are compared once. Unit vectors are projected on LINES random lines. On the first line they are
cut into cells as wide as two close vectors can lie apart; cells are split into blocks of bounded
size, and each task holds two blocks of one cell or of neighbouring ones. In a task every line is
sorted, each vector takes those within a window around itself as collisions, and pairs with enough
collisions are verified by cosine in double precision. The count needed follows from the binomial
distribution for pairs exactly at the limit, so that MISS of them at most are lost there.

Tasks return sums of links and a spanning forest, never all pairs. Vectors that are null, empty, zero
or hold null or non-finite components, or whose label is null, link with nothing. Work within a label
grows with the square of its number of distinct vectors, in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.arrow import map_batches
from weftline.operators.components import connected_components
from weftline.session import materialize

LIMIT = 0.98
#: Lines to count on; half a window and a cell, in units of the spread of a projected difference at the limit; pairs lost at the limit.
LINES, WINDOW, CELL, MISS = 24, 1.5, 4.0, 1e-4
#: Vectors in a block; cells of the count matrix at a time; pairs verified at a time.
BLOCK, CELLS, VERIFY = 4096, 1 << 22, 1 << 16
SEED = 11


def needed(lines: int = LINES, window: float = WINDOW, miss: float = MISS) -> int:
    """The largest count that pairs at the limit reach but for a share of ``miss``."""
    p, below, t = math.erf(window / math.sqrt(2)), 0.0, 0
    while t < lines:
        below += math.comb(lines, t) * p**t * (1 - p) ** (lines - t)
        if below > miss:
            return t
        t += 1
    return lines


def _lines(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED + dim).standard_normal((dim, LINES + 1))


def _unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def collisions(a: np.ndarray, b: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows of projections that collide on enough lines."""
    found_i, found_j, least = [], [], needed()
    step = max(1, CELLS // max(1, len(b)))
    order = b.argsort(0, kind="stable")
    lines = np.take_along_axis(b, order, 0)
    for s in range(0, len(a), step):
        q = a[s : s + step]
        count = np.zeros(len(q) * len(b), np.int16)
        for t in range(a.shape[1]):
            lo = np.searchsorted(lines[:, t], q[:, t] - width, "left")
            hi = np.searchsorted(lines[:, t], q[:, t] + width, "right")
            n = hi - lo
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            cell = np.repeat(np.arange(len(q)) * len(b), n) + order[place, t]
            count[cell] += 1  # a cell occurs once a line
        i, j = np.divmod(np.flatnonzero(count >= least), len(b))
        found_i.append(i + s)
        found_j.append(j)
    return np.concatenate(found_i or [np.array([], int)]), np.concatenate(found_j or [np.array([], int)])


def linked(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, limit: float) -> np.ndarray:
    """Which of the pairs have a cosine of at least the limit."""
    return np.concatenate([np.einsum("ij,ij->i", a[i[s : s + VERIFY]], b[j[s : s + VERIFY]]) >= limit for s in range(0, len(i), VERIFY)] or [np.array([], bool)])


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest node index reachable, for nodes 0 to n - 1."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _task(limit: float):
    width = WINDOW * math.sqrt(2 - 2 * limit)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        unit = _unit(np.stack([np.frombuffer(x, np.float64) for x in pdf["vec"]]))
        lines = unit @ _lines(unit.shape[1])[:, 1:]
        side, key, copies = pdf["side"].to_numpy(), pdf["ck"].to_numpy(), pdf["copies"].to_numpy()
        left = np.flatnonzero(side != 1)
        right = left if (side == 2).any() or not (side == 1).any() else np.flatnonzero(side == 1)
        i, j = collisions(lines[left], lines[right], width)
        i, j = left[i], right[j]
        if right is left:
            on = i < j
            i, j = i[on], j[on]
        ok = linked(unit, unit, i, j, limit)
        i, j = i[ok], j[ok]
        links = np.bincount(i, weights=copies[j], minlength=len(pdf)) + np.bincount(j, weights=copies[i], minlength=len(pdf))
        root = forest(len(pdf), i, j)
        some = np.flatnonzero(links > 0)
        return pd.DataFrame({"ck": key[some], "links": links[some].astype(np.int64), "root": key[root[some]]})

    return run


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", limit: float = LIMIT) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept."""
    e = F.transform(F.col(embedding), lambda x: x.cast("double"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(F.col("label").isNotNull() & finite & F.exists("e", lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), e.alias("e")).withColumn("ck", F.when(good, F.xxhash64("label", F.size("e"), "e")))
    classes = rows.filter("ck IS NOT NULL").groupBy("ck", "label", "e").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    cell = CELL * math.sqrt(2 - 2 * limit)

    def place(batches):
        for b in batches:
            lists = b.column("e")
            vectors = [np.asarray(lists[k].values, np.float64) for k in range(len(lists))]
            cells = [int(math.floor(float(_unit(v[None])[0] @ _lines_first(len(v))) / cell)) for v in vectors]
            yield pa.RecordBatch.from_arrays([b.column("ck"), b.column("label").cast(pa.string()), b.column("copies"), b.column("first"), pa.array([len(v) for v in vectors], pa.int32()), pa.array(cells, pa.int64()), pa.array([v.tobytes() for v in vectors], pa.binary())], names=["ck", "label", "copies", "first", "dim", "cell", "vec"])

    placed = map_batches(classes.select("ck", "label", "e", "copies", "first"), place, f"ck long, label string, copies long, first {dict(df.dtypes)[vec_id]}, dim int, cell long, vec binary")
    placed = materialize(placed)
    sizes = placed.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("subs"))
    beside = lambda d, name: sizes.select("label", "dim", (F.col("cell") + d).alias("cell"), F.col("subs").alias(name))
    known = sizes.join(beside(-1, "after"), ["label", "dim", "cell"], "left").join(beside(1, "before"), ["label", "dim", "cell"], "left").fillna(0, ["after", "before"])
    rows_ = placed.join(known, ["label", "dim", "cell"]).withColumn("sub", F.pmod("ck", "subs").cast("int"))
    upto = lambda n: F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda x: x < n)
    task = lambda c, kind, i, j, side: F.struct(c.alias("c"), F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))
    me, here = F.col("sub"), F.col("cell")
    own = F.transform(upto(F.col("subs")), lambda x: task(here, 0, F.least(x, me), F.greatest(x, me), F.when(x == me, 2).when(me < x, 0).otherwise(1)))
    after = F.transform(upto(F.col("after")), lambda x: task(here, 1, me, x, F.lit(0)))
    before = F.transform(upto(F.col("before")), lambda x: task(here - 1, 1, x, me, F.lit(1)))
    dealt = rows_.select("label", "dim", "ck", "copies", "vec", F.explode(F.concat(own, after, before)).alias("t")).select("label", "dim", "t.c", "t.kind", "t.i", "t.j", "t.side", "ck", "copies", "vec")
    found = materialize(dealt.groupBy("label", "dim", "c", "kind", "i", "j").applyInPandas(_task(limit), "ck long, links long, root long"))
    links = found.groupBy("ck").agg(F.sum("links").alias("links"))
    joined = connected_components(found.filter("ck <> root"), "ck", "root").select(F.col("node").alias("ck"), "component")
    per = placed.select("ck", "copies", "first").join(links, "ck", "left").join(joined, "ck", "left").withColumn("component", F.coalesce("component", "ck"))
    least = per.groupBy("component").agg(F.min("first").alias("component_id"))
    facts = per.join(least, "component").select("ck", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "ck").join(facts, "ck", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _lines_first(dim: int, known: dict = {}) -> np.ndarray:
    if dim not in known:
        known[dim] = _lines(dim)[:, 0]
    return known[dim]


def op6_embedding_dedup(embeddings: DataFrame) -> DataFrame:
    return near_duplicates(embeddings)


def op6_sql(limit: float = LIMIT) -> str:
    return f"""WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
good AS (SELECT rid, vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
unit AS (SELECT rid, vec_id, label, list_transform(e, lambda x: x / size) AS u FROM good),
link AS (SELECT a.rid, b.rid AS other FROM unit a JOIN unit b ON a.label = b.label AND len(a.u) = len(b.u) AND a.rid <> b.rid AND list_dot_product(a.u, b.u) >= {limit}),
reach AS (SELECT rid, other FROM link UNION SELECT reach.rid, link.other FROM reach JOIN link ON reach.other = link.rid),
low AS (SELECT reach.rid, min(v.vec_id) AS m FROM reach JOIN v ON v.rid = other GROUP BY reach.rid),
n AS (SELECT rid, count(*) AS k FROM link GROUP BY rid)
SELECT vec_id, coalesce(k, 0) AS n_links, coalesce(least(vec_id, m), vec_id, m) AS component_id, coalesce(vec_id = coalesce(least(vec_id, m), m), true) AS kept
FROM v LEFT JOIN low USING (rid) LEFT JOIN n USING (rid)"""
