"""Connected components by alternating large-star and small-star steps.

Each step is an aggregate (minimum neighbour, combined map-side) joined back, so a hub is never
gathered in one task. Rounds grow with the logarithm of the longest path. Every round is written to
the shared folder; the driver sees only a row count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.session import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: distinct (u, v) with u > v. Large: each u links its larger neighbours to its minimum; small: its smaller ones."""
    if large:
        arcs = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = arcs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = arcs.filter("v > u").join(least, "u").select(F.col("v").alias("x"), "m")
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        out = joined.select(F.col("v").alias("x"), "m").unionByName(least.select(F.col("u").alias("x"), "m"))
    return out.filter("x <> m").select(F.greatest("x", "m").alias("u"), F.least("x", "m").alias("v")).distinct()


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest id reachable. Only ids on an edge appear; self-loops give their own component."""
    pairs = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    pairs = materialize(pairs)
    loops = pairs.filter("u = v").select("u")
    now, before = materialize(_star(pairs.filter("u > v"), large=False)), None
    for _ in range(max_rounds):
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            break
        before, old = state, now
        now = materialize(_star(_star(now, large=True), large=False))
        discard(old)
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    linked = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    alone = loops.join(linked.select("node").union(roots.select("node")), F.col("u") == F.col("node"), "left_anti")
    return linked.unionByName(roots).unionByName(alone.select(F.col("u").alias("node"), F.col("u").alias("component")))
