"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree, in DataFrame functions only.

Each source has so many unit blocks (a block is one word) in each of S shards, by a hash of the
document. Its quota of blocks is split down a binary tree over the shards: at each node the left
child's share is a hypergeometric draw from the node's quota, so quotas add up exactly and are what
drawing blocks without replacement from the whole source would give. Within a shard the documents
are permuted by a hash and blocks are drawn in that order until the quota is met; whole passes over
a source come on top for targets above its size. S grows with the input, so a shard of a source that
holds a third of all rows stays small. All draws come from hashes: reruns agree.

Rows with equal id, source and text are planned as one row with a count, so a group of copies meets
in an aggregate, not in a window. Sources are ranked within the parts of a range partitioning, and
the water level of the targets is found by rounds of sums, so no task holds all of them.

Null texts have size 0; a null source is a source of its own, the last. Repeated rows are documents
of their own. An empty table gives an empty result. SHARDS has an upper bound: beyond about two
million documents shards grow with the input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import materialize

#: What separates words; weights of the sources by rank, repeating; most passes.
SPACE = r"[\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
#: Documents that a shard of one source should hold on average, and the range of the number of shards.
SHARD_DOCS = 512
SHARDS = (16, 4096)
#: Up to this standard deviation a draw inverts the CDF term by term; above it, it tries points of a hat, so often at most.
INVERTED = 20
TRIES = 64


def word_count(text: Column) -> Column:
    """Runs of other than space: pieces between spaces, without an empty first or last one."""
    pieces = F.split(F.coalesce(text, F.lit("")), SPACE)
    n = F.size(pieces)
    return (n - (pieces[0] == "").cast("int") - ((n > 1) & (F.element_at(pieces, -1) == "")).cast("int")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target), written out. The level L where the targets min(most * size, L * weight) add up to all sizes is found by adding sources that are above their cap until none is."""
    order = F.col("source").asc_nulls_last()
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    parts = materialize(per.repartitionByRange(order).withColumn("part", F.spark_partition_id()).withColumn("n", F.row_number().over(Window.partitionBy("part").orderBy(order))))
    # a row for each part of the range partitioning
    before = parts.groupBy("part").agg(F.max("n").alias("m")).withColumn("b", F.sum("m").over(Window.orderBy("part")) - F.col("m"))
    rank = F.col("n") + F.col("b") - 1
    weighted = parts.join(F.broadcast(before.select("part", "b")), "part").withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int")))
    weighted = materialize(weighted.select("source", "source_size", "weight", (F.col("source_size").cast("double") * most).alias("cap")))
    total = weighted.agg(F.sum(F.col("source_size").cast("double"))).first()[0] or 0.0
    level = 0.0
    while True:
        full = F.col("cap") < level * F.col("weight")
        caps, free = weighted.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        new = (total - caps) / free if free else float("inf")
        if not free or new <= level:
            break
        level = new
    return weighted.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def _uniform(*parts: Column) -> Column:
    """In (0, 1), from a hash."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def _steps(a: Column, b: Column) -> Column:
    """a to b; none if b is less."""
    return F.when(a <= b, F.sequence(a, b)).otherwise(F.slice(F.array(a), 1, 0))


def _terms(y: Column):
    """Steps from one term's weight to that of the next one up, or the next one down, and their sum."""
    ratio = lambda i: (y["k"] - i) * (y["d"] - i) / ((i + 1) * (y["n"] - y["k"] - y["d"] + i + 1))  # noqa: E731  weight of i + 1 over that of i

    def add(acc, w):
        return F.struct(w.alias("w"), (acc["s"] + w).alias("s"))

    def up(acc, i):
        return add(acc, acc["w"] * ratio((i - 1).cast("double")))

    def down(acc, i):
        return add(acc, acc["w"] / ratio((y["m"] - i).cast("double")))

    return up, down


def _log_weight(y: Column, z: Column) -> Column:
    """Logarithm of the weight of z over that of the mode, by Stirling's series for differences, so that large numbers don't cancel out."""
    j, m = z.cast("double") - y["m"], y["m"].cast("double")
    rest = y["n"] - y["k"] - y["d"] + m

    def beyond(base: Column, step: Column) -> Column:
        """ln((base + step)! / base!) - step * ln(base + 1)."""
        b, e = base + 1, base + 1 + step
        series = lambda x: 1 / (12 * x) - 1 / (360 * x * x * x)
        return (e - 0.5) * F.log1p(step / b) - step + series(e) - series(b)

    slope = F.log((y["k"] - m + 1) / (m + 1) * ((y["d"] - m + 1) / (rest + 1)))
    return j * slope - beyond(m, j) - beyond(y["k"] - m, -j) - beyond(y["d"] - m, -j) - beyond(rest, j)


def hypergeometric(n: Column, left: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` from n blocks fall among the first ``left``; the cost has a bound whatever the numbers are.

    Narrow distributions invert the CDF at u: weights relative to the mode follow from the ratio of
    neighbouring terms, within 9 standard deviations (and 12 more) of it; what lies beyond has no mass
    in double precision. Wide ones take the first accepted point of Stadlober's ratio-of-uniforms hat
    (1990), tried with hashes of u; each point is accepted with over 0.7, so that all TRIES fail in
    1e-33 of draws, which take the mode.
    """
    packed = F.struct(
        n.cast("double").alias("n"), left.cast("double").alias("k"), draws.cast("double").alias("d"), u.alias("u"),
        F.greatest(F.lit(0).cast("bigint"), draws + left - n).alias("lo"), F.least(draws, left).alias("hi"),
    )

    def draw(x: Column) -> Column:
        total = F.greatest(F.lit(1.0), x["n"])
        mean = x["d"] * x["k"] / total
        variance = F.greatest(F.lit(0.0), mean * (x["n"] - x["k"]) / total * (x["n"] - x["d"]) / F.greatest(F.lit(1.0), x["n"] - 1))
        spread = F.sqrt(variance) * 9 + 12
        mode = F.least(x["hi"], F.greatest(x["lo"], F.floor((x["d"] + 1) * (x["k"] + 1) / (x["n"] + 2))))
        y = F.struct(*[x[c].alias(c) for c in ("n", "k", "d", "u", "lo", "hi")], mode.alias("m"), F.greatest(x["lo"], F.floor(mode - spread)).alias("a"), F.least(x["hi"], F.ceil(mode + spread)).alias("b"), (mean + 0.5).alias("centre"), variance.alias("variance"))
        return F.transform(F.array(y), lambda y: F.when(y["variance"] > INVERTED**2, first_accepted(y)).otherwise(inverse(y)))[0]

    def first_accepted(y: Column) -> Column:
        width = F.sqrt(y["variance"] + 0.5) * (2 * math.sqrt(2 / math.e)) + (3 - 2 * math.sqrt(3 / math.e))

        def attempt(i: Column) -> Column:
            v, w = _uniform(y["u"], i, F.lit(0)), _uniform(y["u"], i, F.lit(1))
            point = F.struct(v.alias("v"), F.floor(y["centre"] + width * (w - 0.5) / v).alias("z"))
            inside = lambda p: (p["z"] >= y["lo"]) & (p["z"] <= y["hi"])
            return F.transform(F.array(point), lambda p: F.when(inside(p), F.when(2 * F.log(p["v"]) <= _log_weight(y, p["z"]), p["z"])))[0]

        found = F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.lit(None).cast("bigint"), lambda found, i: F.coalesce(found, attempt(i)))
        return F.coalesce(found, y["m"])

    def inverse(y: Column) -> Column:
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"))
        up, down = _terms(y)
        above = F.aggregate(_steps(y["m"] + 1, y["b"]), start, up)["s"]
        below = F.aggregate(_steps(F.lit(1).cast("bigint"), y["m"] - y["a"]), start, down)["s"]
        return F.transform(F.array(y["u"] * (above + below + 1)), lambda goal: search(y, goal))[0]

    def search(y: Column, goal: Column) -> Column:
        up, down = _terms(y)
        # outwards from the mode: mode, then the terms above, then those below
        first = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("s"), F.when(goal <= 1, y["m"]).alias("r"))

        def seek(step, here):
            def go(acc, i):
                w = step(acc, i)["w"]
                s = acc["s"] + w
                return F.struct(w.alias("w"), s.alias("s"), F.coalesce(acc["r"], F.when(goal <= s, here(i))).alias("r"))
            return go

        top = F.aggregate(_steps(y["m"] + 1, y["b"]), first, seek(up, lambda i: i))
        again = F.struct(F.lit(1.0).alias("w"), top["s"].alias("s"), top["r"].alias("r"))
        low = F.aggregate(_steps(F.lit(1).cast("bigint"), y["m"] - y["a"]), again, seek(down, lambda i: y["m"] - i))
        return F.coalesce(low["r"], y["a"])

    return F.transform(F.array(packed), draw)[0]


def split_quota(per: DataFrame, quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """per: (source, shard, blocks); quotas: (source, quota). Gives (source, shard, shard_quota), by the tree, top down.

    One row per source holds its shards' running block counts, 2**levels + 1 numbers; each level turns
    the quotas of its nodes into those of their children.
    """
    shards = 1 << levels
    grid = quotas.select(F.col("source").alias("s1"), "quota", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("h1"))
    full = grid.join(per, F.col("s1").eqNullSafe(F.col("source")) & (F.col("h1") == F.col("shard")), "left")
    running = F.coalesce(F.sum("blocks").over(Window.partitionBy("s1").orderBy("h1")), F.lit(0))
    one = full.select("s1", "quota", F.struct("h1", running.alias("c")).alias("x")).groupBy("s1", "quota").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    out = one.select("s1", F.array_prepend(F.transform("xs", lambda x: x["c"]), F.lit(0).cast("long")).alias("cum"), F.array("quota").alias("q"))
    # a task for each source, which adaptive execution leaves alone; by s1 alone it would be taken for the partitioning that is there
    out = out.repartition(int(quotas.sparkSession.conf.get("spark.sql.shuffle.partitions")), "s1", "cum")
    for level in range(levels):
        width = shards >> level
        at = lambda i: F.get("cum", (i * width).cast("int"))

        def children(q, node):
            middle = F.get("cum", (node * width + width // 2).cast("int"))
            u = _uniform(F.col("s1"), F.lit(level), node, F.lit(seed))
            drawn = hypergeometric(at(node + 1) - at(node), middle - at(node), q, u)
            return F.flatten(F.transform(F.array(drawn), lambda d: F.array(d, q - d)))

        out = out.select("s1", "cum", F.flatten(F.transform("q", children)).alias("q"))
    # outer, since a plain one adds a filter on q that would make all draws once more, below the exchange
    return out.select(F.col("s1").alias("source"), F.posexplode_outer("q").alias("shard", "shard_quota"))


def sizes_of(documents: DataFrame, text: str = "text") -> DataFrame:
    """documents' (doc_id, source) with size and twin, a hash of the text."""
    return documents.select("doc_id", "source", word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("twin"))


def plan_groups(documents: DataFrame, text: str = "text", seed: int = 7, shards: int | None = None) -> DataFrame:
    """A row for each (doc_id, source, size, twin), with n (its rows), source_size, target, passes, shard, first (place of its first row in the shard's permutation) and left (blocks of the shard's quota that rows before it leave)."""
    sized = materialize(sizes_of(documents, text).groupBy("doc_id", "source", "size", "twin").agg(F.count("*").alias("n")))
    every = F.col("size") * F.col("n")
    aim = targets(sized.select("source", every.alias("size")))
    if shards is None:
        n = sized.agg(F.sum("n")).first()[0] or 0
        shards = min(SHARDS[1], max(SHARDS[0], 1 << max(0, (n // SHARD_DOCS)).bit_length()))
    levels = (shards - 1).bit_length()
    key = F.xxhash64("doc_id", "source", "size", "twin", F.lit(seed))
    rows = sized.withColumn("place_key", key).withColumn("shard", F.pmod(F.shiftrightunsigned("place_key", 7), F.lit(1 << levels)).cast("int"))
    per = rows.groupBy("source", "shard").agg(F.sum(every).alias("blocks"))
    # quota: blocks of the partial pass; whole passes need no draw
    whole = F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double")) + 1e-12)
    aim = aim.withColumn("passes", F.coalesce(F.least(whole, F.lit(MOST)), F.lit(0)).cast("long"))
    aim = aim.withColumn("quota", F.greatest(F.lit(0).cast("long"), F.least(F.col("source_size"), F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long"))))
    quotas = materialize(split_quota(per, aim.select("source", "quota"), levels, seed).select(F.col("source").alias("s3"), F.col("shard").alias("h3"), "shard_quota"))
    facts = aim.select(F.col("source").alias("s2"), "source_size", "target", "passes")
    order = Window.partitionBy("source", "shard").orderBy("place_key", "doc_id", "size", "twin").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("first", F.coalesce(F.sum("n").over(order), F.lit(0)) + 1).withColumn("before", F.coalesce(F.sum(every).over(order), F.lit(0)))
    joined = placed.join(quotas, F.col("source").eqNullSafe(F.col("s3")) & (F.col("shard") == F.col("h3"))).join(facts, F.col("source").eqNullSafe(F.col("s2")))
    return joined.select("doc_id", "source", "size", "twin", "n", "source_size", "target", "passes", "shard", "first", (F.col("shard_quota") - F.col("before")).alias("left"))


def plan(documents: DataFrame, text: str = "text", seed: int = 7, shards: int | None = None) -> DataFrame:
    """A row for each document: doc_id, source, size, source_size, target, shard, place in the shard's permutation, passes and part (words of a partial pass), and taken."""
    rows = plan_groups(documents, text, seed, shards).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k"))
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("left") - F.col("k") * F.col("size")))
    return rows.withColumn("part", part).select("doc_id", "source", "size", "source_size", "target", "shard", (F.col("first") + F.col("k")).alias("place"), "passes", "part", (F.col("passes") * F.col("size") + F.col("part")).alias("taken"))


def mix(documents: DataFrame, text: str = "text", seed: int = 7) -> DataFrame:
    """The mixed documents: a row for each pass over a document. A task holds whole output shards, each shuffled by a hash of document and copy.

    No document is cut. The last one drawn in a shard of a source, of which the quota covers a part, is taken whole with
    a probability of that part, so what is taken of a source meets its target on average, off by such documents only.
    Plan and texts meet on id, source, size and text hash. Rows that are equal there draw as often as their count says;
    where their other columns differ, those drawn more often come first in the order of a hash.
    """
    columns = documents.columns
    key = ["doc_id", "source", "size", "twin"]
    full = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least(F.col("n"), F.floor(F.col("left") / F.col("size"))))).otherwise(0).cast("long")
    groups = plan_groups(documents, text, seed).withColumn("full", full)
    rest = F.col("left") - F.col("full") * F.col("size")
    drawn = (F.col("full") < F.col("n")) & (rest > 0) & (_uniform(*key, F.lit(seed)) * F.col("size") < rest)
    groups = materialize(groups.select(*[F.col(c).alias(f"_{c}") for c in [*key, "n", "passes", "shard", "full"]], F.coalesce(drawn, F.lit(False)).cast("long").alias("_drawn")))
    sized = documents.withColumns({"_s": word_count(F.col(text)), "_t": F.xxhash64(text)})
    both = sized.join(groups, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_s") == F.col("_size")) & (F.col("_t") == F.col("_twin")))
    facts = ["_shard", "_passes", "_full", "_drawn", *[f"_{c}" for c in key]]
    alone = both.filter("_n = 1").select(*columns, *facts, (F.col("_passes") + F.col("_full") + F.col("_drawn")).alias("_copies"))
    # rows that are equal in all columns are one row with a count
    body = F.to_json(F.struct(*columns))
    alike = both.filter("_n > 1").groupBy(*facts, F.md5(body).alias("_all")).agg(F.first(F.struct(*columns)).alias("_row"), F.count("*").alias("_m"))
    earlier = Window.partitionBy(*[f"_{c}" for c in key]).orderBy("_all").rowsBetween(Window.unboundedPreceding, -1)
    alike = alike.withColumn("_b", F.coalesce(F.sum("_m").over(earlier), F.lit(0)))
    some = F.greatest(F.lit(0).cast("long"), F.least(F.col("_m"), F.col("_full") - F.col("_b")))
    last = F.when((F.col("_full") >= F.col("_b")) & (F.col("_full") < F.col("_b") + F.col("_m")), F.col("_drawn")).otherwise(0)
    alike = alike.select("_row.*", *facts, (F.col("_passes") * F.col("_m") + some + last).alias("_copies"))
    rows = alone.unionByName(alike).filter("_copies > 0").select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
    return rows.repartition("_shard").sortWithinPartitions("_shard", F.xxhash64(*[f"_{c}" for c in key], "_copy", F.lit(seed))).select(*columns)


def op10_mixing(documents: DataFrame) -> DataFrame:
    """The contract's columns of plan(), with the output shard and the place in its order."""
    return plan(documents).select("doc_id", "size", "source_size", "target", "taken", "shard", "place")
