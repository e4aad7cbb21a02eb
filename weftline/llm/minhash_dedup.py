"""Near-duplicates by Order MinHash, verified by banded alignment.

k-mers are runs of five words, labelled with their occurrence number in the text. Each of SKETCHES
hash functions samples the LEAST k-mers of smallest hash and keeps them in text order, so a sketch
agrees only where several k-mers agree and stand in the same order: it follows edit similarity, not
only overlap. A second set samples two of the runs of three words, which more edits leave whole. Texts
that share a sketch are candidates. So are texts of up to SHORT words, which have few k-mers, if they
share a segment: the longer one is cut into one segment more than it may have edits, so that one of
them stands in the other text, moved by no more places than that; no pair of these is missed.

Similarity is 1 - edit distance in words / words of the longer text, and a link needs 0.8. It is
decided by alignment within a band of the diagonals that such a distance can reach (furthest-reaching
points, one edit at a time).

Equal texts form one node. Each bucket (sketch value) links its members to a pivot. Where a bucket
still holds several components, its other pairs are compared too, in blocks of bounded size, by bands
of length, unless an earlier bucket has them; so no pair that shares a sketch goes unchecked unless it
is in one class already. Tasks return links, never all pairs. The blocks of such a bucket grow with the
square of the members that have similar lengths.

A null text counts as empty; texts without words link only with equal ones; a text of fewer than five
words is one k-mer. Repeated rows share a class. Words are split at white space, A-Z in lower case.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.arrow import map_batches
from weftline.llm.textnum import groups, mix, utf8, words
from weftline.operators.components import connected_components
from weftline.session import discard, materialize

WORDS, SIMILARITY = 5, 0.8
#: Hash functions, and k-mers sampled by each.
SKETCHES, LEAST = 16, 3
#: Sets of hash functions: words of a k-mer, k-mers sampled by each, and functions. Their number in all.
SETS = ((WORDS, LEAST, SKETCHES), (3, 2, 24))
ALL = sum(n for _, _, n in SETS)
#: Words of the longer text up to which candidates are exact.
SHORT = 16
#: Edits that an alignment follows one at a time.
FIRST = 12
#: Members of a block where a bucket's pairs are compared, and bins of words.
BLOCK, BINS = 1024, 256
_SEEDS = mix(np.arange(1, ALL + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = mix(np.arange(100, 100 + WORDS, dtype=np.uint64)) | np.uint64(1)
_SHORT_STEP = mix(np.arange(200, 200 + SHORT, dtype=np.uint64)) | np.uint64(1)


def kmers(h: np.ndarray, n: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-mers of all texts, occurrence-labelled, and their number for each text. h: word hashes, n: words of each text."""
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    first = np.repeat(np.cumsum(n) - n, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    padded = np.concatenate([h, np.zeros(size, np.uint64)])
    last = np.repeat(np.cumsum(n), count)
    x = np.zeros(len(first), np.uint64)
    for k in range(size):
        x += np.where(first + k < last, padded[first + k], np.uint64(0)) * _STEP[k]
    x = mix(x)
    text = np.repeat(np.arange(len(n)), count)
    order = np.lexsort((x, text))
    same = np.concatenate([[False], (x[order][1:] == x[order][:-1]) & (text[order][1:] == text[order][:-1])]) if len(x) else np.array([], bool)
    at = np.arange(len(x))
    seen = at - np.maximum.accumulate(np.where(same, 0, at)) if len(x) else at
    occurrence = np.empty(len(x), np.uint64)
    occurrence[order] = seen.astype(np.uint64)
    return mix(x + occurrence * np.uint64(0xC2B2AE3D27D4EB4F)), count


def _sampled(h: np.ndarray, n: np.ndarray, size: int, least: int, seeds: np.ndarray) -> list[np.ndarray]:
    """A value of each hash function for each text, none for a text without words."""
    out = []
    g, count = kmers(h, n, size)
    end = 0
    for c in count.tolist():
        start, end = end, end + c
        if not c:
            out.append(np.array([], np.int64))
            continue
        x = g[start:end]
        v = (x[None, :] ^ seeds[:, None]) * np.uint64(0xD6E8FEB86659FD93)
        v ^= v >> np.uint64(32)
        v *= np.uint64(0xD6E8FEB86659FD93)
        if c > least:
            at = np.sort(np.argpartition(v, least - 1, 1)[:, :least], 1)
        else:
            at = np.broadcast_to(np.arange(c), (len(seeds), c))
        total = seeds.copy()
        for k in range(at.shape[1]):
            total = mix(total + x[at[:, k]])
        out.append(total.view(np.int64))
    return out


def segments(h: np.ndarray, limit: float = SIMILARITY) -> np.ndarray:
    """Keys of the segments of a text of up to SHORT words, as the longer text of a pair or the shorter one; none for a longer text."""
    n, keys = len(h), []
    for longer in range(n, min(SHORT, int(n / limit + 1e-9)) + 1 if n else 0):
        most = int(np.floor((1 - limit) * longer + 1e-9))
        for i in range(most + 1 if most else 0):
            first, after = longer * i // (most + 1), longer * (i + 1) // (most + 1)
            low, high, size = max(0, first - most), min(n - after + first, first + most), after - first
            if low > high:
                continue
            x = np.full(high - low + 1, longer * SHORT + i, np.uint64)
            for k in range(size):
                x += h[low + k : high + k + 1] * _SHORT_STEP[k]
            keys.append(mix(x))
    return np.unique(np.concatenate(keys)).view(np.int64) if keys else np.array([], np.int64)


def sketches(texts: list[bytes], limit: float = SIMILARITY) -> list[np.ndarray]:
    """ALL values for each text, then those of a short text's segments; none for a text without words."""
    out = []
    for a, b in groups(texts):
        h, n = words(texts[a:b])
        parts, done = [], 0
        for size, least, functions in SETS:
            parts.append(_sampled(h, n, size, least, _SEEDS[done : done + functions]))
            done += functions
        ends = np.cumsum(n).tolist()
        parts.append([segments(h[y - x : y], limit) if x <= SHORT else np.array([], np.int64) for x, y in zip(n.tolist(), ends)])
        out += [np.concatenate(x) for x in zip(*parts)]
    return out


def _bag_shared(a: np.ndarray, b: np.ndarray) -> int:
    both, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    return int(np.minimum(np.bincount(at[: len(a)], minlength=len(both)), np.bincount(at[len(a) :], minlength=len(both))).sum())


def _run(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How far a[i:] and b[j:] agree; both end with values that the other lacks."""
    step, far = 16, np.zeros(len(i), np.int64)
    todo = np.arange(len(i))
    while len(todo):
        s = np.arange(step)
        x = np.minimum(i[todo, None] + far[todo, None] + s, len(a) - 1)
        y = np.minimum(j[todo, None] + far[todo, None] + s, len(b) - 1)
        differ = a[x] != b[y]
        whole = ~differ.any(1)
        far[todo] += np.where(whole, step, differ.argmax(1))
        todo = todo[whole]
        step = min(1024, step * 4)
    return far


def _columns(a: list[int], b: list[int], most: int) -> bool:
    """Whether the edit distance is at most ``most``: column by column, the band's differences as bits of two integers (Hyyrö 2003). Lengths differ by ``most`` at most, the longer one is longer than that."""
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    places: dict[int, int] = {}
    for p, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << p
    width = 2 * most + 1
    mask, top = (1 << width) - 1, 1 << width - 1
    # bit of the band's row: the last one stands for row i + most of column i
    up, down, distance, turn = mask ^ ((1 << most) - 1), 0, most, len(a) - most
    row, limit = top, most + len(b) - turn
    for i, x in enumerate(b):
        same = places.get(x, 0)
        same = (same << most - i if i < most else same >> i - most) & mask
        zero = ((((same & up) + up) ^ up) | same | down) & mask
        right, left = down | (~(zero | up) & mask), zero & up
        if i < turn:
            if not zero & top:
                distance += 1
                if distance > limit:
                    return False
        else:
            row >>= 1
            distance += bool(right & row) - bool(left & row)
        zero >>= 1
        up, down = left | (~(zero | right) & mask), zero & right
    return distance <= most


def within(a: np.ndarray, b: np.ndarray, most: int, first: int = FIRST) -> bool:
    """Whether the edit distance of two sequences of non-negative numbers is at most ``most``. The first edits are followed one at a time, to furthest-reaching points; if more are needed, the band is filled."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return False
    if max(n, m) <= most or not min(n, m):
        return max(n, m) <= most
    if max(n, m) - _bag_shared(a, b) > most:
        return False
    if most > first:
        plain = a.tolist(), b.tolist()
    a, b, goal = np.append(a, -1), np.append(b, -2), m - n
    width = min(most, first) + 1
    reach = np.full(2 * width + 3, -1 << 40, np.int64)  # by diagonal j - i, shifted by width + 1
    mid = width + 1
    reach[mid] = _run(a, b, np.zeros(1, np.int64), np.zeros(1, np.int64))[0]
    for d in range(1, most + 1):
        if d > first:
            return _columns(*plain, most)
        slack = most - d
        low, high = max(-d, goal - slack, -n), min(d, goal + slack, m)
        diagonal = np.arange(low, high + 1)
        at = diagonal + mid
        i = np.maximum(np.maximum(reach[at - 1], reach[at] + 1), reach[at + 1] + 1)
        i = np.minimum(i, np.minimum(n, m - diagonal))
        ok = (i >= 0) & (i + diagonal >= 0)
        new = np.full(len(reach), -1 << 40, np.int64)
        i, diagonal = i[ok], diagonal[ok]
        new[diagonal + mid] = i + _run(a, b, i, i + diagonal)
        reach = new
        if abs(goal) < width and reach[goal + mid] >= n:
            return True
    return False


def similar(a: np.ndarray, b: np.ndarray, limit: float = SIMILARITY) -> bool:
    longer = max(len(a), len(b))
    return bool(longer) and within(a, b, int(np.floor((1 - limit) * longer + 1e-9)))


def _sequences(texts: DataFrame) -> DataFrame:
    """(node, seq): the words of each text as 32-bit numbers."""

    def run(batches):
        for b in batches:
            texts, seqs = utf8(b.column("text")), []
            for s, e in groups(texts):
                h, n = words(texts[s:e])
                h = (h >> np.uint64(33)).astype(np.uint32)
                ends = np.cumsum(n)
                seqs += [h[y - x : y].tobytes() for x, y in zip(n.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(seqs, pa.binary())], names=["node", "seq"])

    return map_batches(texts.select("node", "text"), run, "node string, seq binary")


def _numbers(seq: bytes) -> np.ndarray:
    return np.frombuffer(seq, np.uint32).astype(np.int64)


def _verify(limit: float):
    def run(batches):
        for b in batches:
            ok = [similar(_numbers(x), _numbers(y), limit) for x, y in zip(b.column("seq_a").to_pylist(), b.column("seq_b").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _bags(seqs: list[np.ndarray]) -> np.ndarray:
    """For each text how many of its words fall into each of BINS bins."""
    out = np.zeros((len(seqs), BINS), np.int32)
    for k, x in enumerate(seqs):
        out[k] = np.bincount(x % BINS, minlength=BINS)
    return out.astype(np.int16) if out.size and out.max() < 1 << 15 else out


def _rest(limit: float):
    """Pairs of a block, or of two, that are in different components, and in no earlier bucket together. Bags tell how many words two texts can share at most, so most pairs need no alignment."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["t"].iloc[0])
        seqs = [_numbers(x) for x in pdf["seq"]]
        sketch, node, side = np.stack([x[:ALL] for x in pdf["sketches"]]), pdf["node"].to_numpy(), pdf["side"].to_numpy()
        names, group = np.unique(pdf["component"].to_numpy(), return_inverse=True)
        size, bags = np.array([len(x) for x in seqs]), _bags(seqs)
        found = []
        for i in range(len(pdf)):
            if side[i] == 1:
                continue
            longer = np.maximum(size, size[i])
            near = (side == 1) | (np.arange(len(pdf)) > i) & (side == 2) if side[i] == 2 else side == 1
            near &= (group != group[i]) & (np.minimum(size, size[i]) >= limit * longer - 1e-9)
            at = np.flatnonzero(near)
            at = at[longer[at] - np.minimum(bags[at], bags[i]).sum(1, dtype=np.int64) <= np.floor((1 - limit) * longer[at] + 1e-9)]
            for j in at[~(sketch[at, :t] == sketch[i, :t]).any(1)]:
                if group[j] != group[i] and similar(seqs[i], seqs[j], limit):
                    found.append((node[i], node[j]))
                    group[group == group[j]] = group[i]
        return pd.DataFrame(found, columns=["a", "b"]).astype(str)

    return run


def _between_components(left: DataFrame, nodes: DataFrame, seqs: DataFrame, limit: float) -> DataFrame:
    """(a, b): links between the components in one bucket. left: t, s, node, component, band.

    Similar texts are in one band of lengths or in neighbouring ones, and a band's members are dealt over blocks.
    """
    cells = left.groupBy("t", "s", "band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("subs"), F.min("component").alias("c"), F.max("component").alias("d"))
    beside = lambda step, name: cells.select("t", "s", (F.col("band") + step).alias("band"), F.struct("subs", "c", "d").alias(name))
    known = cells.join(beside(-1, "after"), ["t", "s", "band"], "left").join(beside(1, "before"), ["t", "s", "band"], "left")
    other = lambda x: F.when((F.least("c", f"{x}.c") != F.greatest("d", f"{x}.d")), F.col(f"{x}.subs")).otherwise(0)
    # where two neighbouring bands are a block each, the longer one joins the task of the shorter one, unless that has none
    alone = lambda shorter: F.coalesce((F.col(f"{shorter}c") != F.col(f"{shorter}d")) & (F.col("subs") == 1) & (F.col("after.subs" if not shorter else "before.subs") == 1), F.lit(False))
    own = F.when(F.col("c") != F.col("d"), F.col("subs")).otherwise(0)
    # a table of its own, so that both sides of the join are plain exchanges and a frequent bucket can be split
    known = materialize(known.select("t", "s", "band", "subs", own.alias("own"), F.when(alone(""), 0).otherwise(other("after")).alias("after"), F.when(alone("before."), 0).otherwise(other("before")).alias("before"), (alone("before.") & (other("before") > 0)).alias("joins")))
    rows = left.join(known, ["t", "s", "band"]).withColumn("me", F.pmod(F.xxhash64("node"), F.col("subs")).cast("int"))
    upto = lambda n: F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda x: x < n)
    task = lambda c, kind, i, j, side: F.struct(c.alias("c"), F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))
    me, here = F.col("me"), F.col("band")
    own = F.transform(upto(F.col("own")), lambda x: task(here, 0, F.least(x, me), F.greatest(x, me), F.when(x == me, 2).when(me < x, 0).otherwise(1)))
    after = F.transform(upto(F.col("after")), lambda x: task(here, 1, me, x, F.lit(0)))
    before = F.transform(upto(F.col("before")), lambda x: task(here - 1, 1, x, me, F.lit(1)))
    guest = F.transform(upto(F.col("joins").cast("int")), lambda x: task(here - 1, 0, x, x, F.lit(1)))
    dealt = rows.select("t", "s", "node", "component", F.explode(F.concat(own, after, before, guest)).alias("k")).select("t", "s", "k.*", "node", "component")
    full = dealt.join(nodes, "node").join(seqs.select("node", "seq"), "node")
    full = full.select("t", "s", "c", "kind", "i", "j", "side", "node", "component", "sketches", "seq")
    return full.groupBy("t", "s", "c", "kind", "i", "j").applyInPandas(_rest(limit), "a string, b string")


def classes(documents: DataFrame, text: str = "text", key: str = "doc_id", limit: float = SIMILARITY) -> DataFrame:
    """One row for each row of documents: key, node (of its text), class_id (the smallest key of its class), class_node (the node of that one)."""
    rows = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("node", F.md5("text"))

    def run(batches):
        for b in batches:
            found = sketches(utf8(b.column("text")), limit)
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("node"), pa.array(found, pa.list_(pa.int64()))], names=["key", "node", "sketches"])

    kind = dict(documents.dtypes)[key]
    sketched = materialize(map_batches(rows.select("key", "node", "text"), run, f"key {kind}, node string, sketches array<long>"))
    nodes = materialize(sketched.groupBy("node").agg(F.first("sketches").alias("sketches")))
    # all segments count as one sketch, the last
    members = nodes.select("node", F.posexplode("sketches").alias("t", "s")).withColumn("t", F.least("t", F.lit(ALL)))
    # tables of their own, here and below, so that both sides of a join are plain exchanges and a frequent value can be split
    pivots = materialize(members.groupBy("t", "s").agg(F.min("node").alias("pivot"), F.max("node").alias("other")).filter("pivot <> other").select("t", "s", "pivot"))
    pairs = materialize(members.join(pivots, ["t", "s"]).filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct())
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    seqs = materialize(_sequences(rows.select("node", "text").join(needed, "node", "left_semi")).groupBy("node").agg(F.first("seq").alias("seq")))
    side = lambda s: seqs.select(F.col("node").alias(s), F.col("seq").alias(f"seq_{s}"))
    links = materialize(map_batches(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "seq_a", "seq_b"), _verify(limit), "a string, b string"))
    joined = materialize(connected_components(links, "a", "b"))
    of = members.join(needed, "node", "left_semi").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_ = of.groupBy("t", "s").agg(F.min("component").alias("c"), F.max("component").alias("d")).filter("c <> d").select("t", "s")
    open_ = materialize(open_)
    words_of = F.octet_length("seq") / 4
    bands = seqs.select("node", F.floor(F.log(F.greatest(words_of, F.lit(1.0))) / float(np.log(1 / limit) * (1 + 1e-9))).cast("int").alias("band"))
    left = materialize(of.join(open_, ["t", "s"]).join(bands, "node"))
    if not left.isEmpty():
        more = materialize(_between_components(left, nodes, seqs, limit))
        if not more.isEmpty():
            joined = materialize(connected_components(links.unionByName(more), "a", "b"))
    least = sketched.groupBy("node").agg(F.min("key").alias("key")).join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = materialize(least)
    for x in (nodes, pivots, pairs, seqs, links, open_, left):
        discard(x)
    chosen = materialize(least.groupBy("component").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "node")).alias("x")))
    facts = least.select("node", "component").join(chosen, "component").select("node", F.col("x.key").alias("class_id"), F.col("x.node").alias("class_node"))
    return sketched.select(F.col("key").alias(key), "node").join(facts, "node")


def keep_one(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """documents with one row of each class."""
    found = classes(documents, text, key)
    chosen = found.select(F.col("class_id").alias("_k"), F.col("class_node").alias("_n")).distinct()
    body = F.md5(F.coalesce(F.col(text), F.lit("")))
    kept = documents.withColumn("_node", body).join(chosen, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_node") == F.col("_n")), "left_semi")
    return kept.dropDuplicates([key, "_node"]).drop("_node")


def op3_minhash_dedup(documents: DataFrame) -> DataFrame:
    """doc_id, class_id, and whether the document is its class's first."""
    found = classes(documents)
    return found.select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))
