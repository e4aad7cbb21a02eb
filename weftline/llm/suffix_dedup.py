"""Removal of long repeated strings with suffix arrays.

A string is a sequence of symbols: 400 bytes (the unit BYTES), or 51 words (WORDS). A symbol goes if a
string that covers it starts anywhere else too, in the same text or another one; strings are judged
on the input.

1. Anchors. Each window of ``length`` symbols selects the ``gram`` symbols of least hash that start
   among its first ``span``, so equal windows select them at the same distance. Windows that share an
   anchor form a run. All windows of a run hold the symbols [a, a + length - span + 1), whose hash is
   the run's key.
2. Runs whose key occurs once hold no repeated window. Runs that occur twice as a whole are repeated
   as a whole. What is left are the ends of repeats: runs that share a key and differ.
3. Those are cut into blocks of ``block`` windows, numbered by distance from the anchor. The symbols
   that all windows of a block share become one, named by the run's key, the block and themselves, so
   that one occurrence is never met under two anchors. It stands between the block - 1 symbols before
   and after it, in a string of 2 * block - 1 symbols in which each window is ``block`` symbols long.
   Suffix arrays of many such strings, built by linear grouping (suffix_grouping.py), show which
   windows repeat: those that share ``block`` symbols with a neighbour.
4. A group of strings that does not fit into one array is dealt over several, each of which gives one
   row for each different window; a count over these rows finds what repeats between arrays. So a
   passage in a third of all texts is neither gathered in one task nor cut short.

Runs and blocks are identified by two 64-bit hashes together, texts by a hash and their length, words
by a hash; words are split at all ASCII but letters and digits, A-Z in lower case. A null text counts
as empty. Texts of fewer symbols than a string has keep all bytes, equal ones too.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.arrow import map_batches
from weftline.llm.suffix_grouping import suffix_array
from weftline.llm.textnum import NON_WORDS, edges, groups, mix, prefix_hash, utf8, words
from weftline.session import discard, materialize

#: Strings in one suffix array.
ARRAY = 512
_OTHER = np.uint64(0xA24BAED4963EE407)


@dataclass(frozen=True)
class Unit:
    """length: symbols of a string; gram, span and block as above, span below 256; kind: a symbol's numpy type; least: bytes that a text must have to hold a string."""

    length: int
    gram: int
    span: int
    block: int
    kind: type
    least: int

    def symbols(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All symbols of the texts, and the number of each text's."""
        if self.kind is np.uint8:
            return np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)
        return words(texts, NON_WORDS)

    def places(self, text: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """First byte and end of each symbol; None where symbols are bytes."""
        return None if self.kind is np.uint8 else edges(np.frombuffer(text, np.uint8), NON_WORDS)


BYTES = Unit(400, 32, 201, 25, np.uint8, 400)
#: Passages of over 50 words.
WORDS = Unit(51, 4, 26, 13, np.uint64, 101)


def _least(h: np.ndarray, span: int) -> np.ndarray:
    """The place of the least hash in each window of span, the first of equal ones. By doubling."""
    v = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    rest = span - width
    v = np.minimum(v[: len(v) - rest], v[rest:]) if rest else v
    return (v & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs(texts: list[bytes], unit: Unit = BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each run: the text's index, anchor, least and most distance of its windows' starts before it, key, hash of the whole run."""
    out = []
    for s, e in groups(texts):
        data, size = unit.symbols(texts[s:e])
        if len(data) < unit.length:
            continue
        begin = np.cumsum(size) - size
        count = np.maximum(0, size - unit.length + 1)
        start = np.repeat(begin, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        if not len(start):
            continue
        p, inverse = prefix_hash(data)
        h = mix((p[unit.gram :] - p[: -unit.gram]) * inverse[: len(data) - unit.gram + 1])
        anchor = _least(h, unit.span)[start]
        text = np.repeat(np.arange(e - s), count)
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(start)]]) - 1
        a, low, high = anchor[first], start[first], start[last] + unit.length
        key = mix((p[a + unit.length - unit.span + 1] - p[a]) * inverse[a])
        whole = mix((p[high] - p[low]) * inverse[low] ^ mix(((a - low) << 16 | (high - low)).astype(np.uint64)) ^ _OTHER)
        out.append((text[first] + s, a - begin[text[first]], a - start[last], a - low, key, whole))
    if not out:
        return tuple(np.array([], np.int64) for _ in range(6))
    return tuple(np.concatenate(x) for x in zip(*out))


def _find_runs(unit: Unit):
    def run(batches):
        for b in batches:
            text, a, least, most, key, whole = runs(utf8(b.column("text")), unit)
            take = pa.array(text.astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("node").take(take), b.column("nb").take(take), pa.array((a << 16 | least << 8 | most).astype(np.int64)), pa.array(key.astype(np.uint64).view(np.int64)), pa.array(whole.astype(np.uint64).view(np.int64))], names=["node", "nb", "packed", "key", "run"])

    return run


def _unpack(packed: int) -> tuple[int, int, int]:
    return packed >> 16, packed >> 8 & 255, packed & 255


def _cut_blocks(unit: Unit):
    """The blocks of the runs in each text's list: shared symbols' name, the symbols beside them, and which windows are the run's."""
    names = ["key", "run", "block", "need", "shared", "left", "right", "copies"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]

    def run(batches):
        for b in batches:
            rows = []
            for text, found in zip(utf8(b.column("text")), b.column("found").to_pylist()):
                data = unit.symbols([text])[0]
                for x in found:
                    a, least, most = _unpack(x["packed"])
                    for k in range(least // unit.block, most // unit.block + 1):
                        l0, l1 = max(least, k * unit.block), min(most, (k + 1) * unit.block - 1)
                        need = (1 << l1 - k * unit.block + 1) - (1 << l0 - k * unit.block)
                        at = a - k * unit.block
                        end = at + unit.length - unit.block + 1
                        # equal windows have their anchor at one distance: neither key nor block may be left out of the name
                        shared = hashlib.blake2b(b"%d %d " % (x["key"], k) + data[at:end].tobytes(), digest_size=16).digest()
                        rows.append((x["key"], x["run"], k, need, shared, data[max(0, at - unit.block + 1) : at].tobytes(), data[end : end + unit.block - 1].tobytes(), x["copies"]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)

    return run


def repeated_windows(items: list[tuple[bytes, bytes, bytes]], unit: Unit = BYTES) -> list[tuple[int, list[int]]]:
    """items: shared symbols' name, symbols before, symbols after. For each, a mask of the windows (bit l: l symbols from before) that another item holds too, and for each window a name equal for equal windows of these items, -1 if it does not exist."""
    block, wide = unit.block, np.dtype(unit.kind).itemsize
    side, width = block - 1, 2 * block
    number = {s: i for i, s in enumerate(dict.fromkeys(x[0] for x in items))}
    beside, letter = np.unique(np.frombuffer(b"".join(left + right for _, left, right in items), unit.kind), return_inverse=True)
    limit = len(beside) + len(number)
    text = np.arange(len(items) * width, dtype=np.int64).reshape(-1, width) + limit  # unlike all others: padding and separators
    done = 0
    for i, (shared, left, right) in enumerate(items):
        before, after = len(left) // wide, len(right) // wide
        text[i, side - before : side] = letter[done : done + before]
        text[i, side] = len(beside) + number[shared]
        text[i, side + 1 : side + 1 + after] = letter[done + before : done + before + after]
        done += before + after
    flat = text.ravel()
    order = np.array(suffix_array(flat.tolist()), np.int64)
    # a window starts at place side - l and has ``block`` symbols
    order = order[order % width <= side]
    padded = np.append(flat, np.arange(-1, -1 - block, -1))
    same = np.ones(max(0, len(order) - 1), bool)
    whole = np.ones(len(order), bool)
    for k in range(block):
        same &= padded[order[1:] + k] == padded[order[:-1] + k]
        whole &= padded[order + k] < limit
    name = np.zeros(len(order), np.int64)
    name[1:] = np.cumsum(~same)
    repeated = np.bincount(name)[name] > 1 if len(name) else name.astype(bool)
    names, masks = np.full((len(items), block), -1, np.int64), np.zeros(len(items), np.int64)
    item, l = order[whole] // width, side - order[whole] % width
    names[item, l] = name[whole]
    np.bitwise_or.at(masks, item, np.where(repeated[whole], 1 << l, 0))
    return list(zip(masks.tolist(), names.tolist()))


def _arrays(unit: Unit):
    """Suffix arrays over consecutive strings. For each: its mask, and, where its group is not all here, a row for each different window."""
    wide = np.dtype(unit.kind).itemsize

    def solve(rows):
        here: dict[bytes, int] = {}
        for r in rows:
            here[r[0]] = here.get(r[0], 0) + 1
        out, told = [], set()
        for (shared, left, right, members), (mask, names) in zip(rows, repeated_windows([r[:3] for r in rows], unit)):
            windows = []
            if here[shared] < members:
                for l, n in enumerate(names):
                    if n >= 0 and (n not in told or mask >> l & 1 == 0):
                        told.add(n)
                        before = left[len(left) - l * wide :] if l else b""
                        windows.append({"l": l, "window": hashlib.blake2b(shared + before + b"|" + right[: (unit.block - 1 - l) * wide], digest_size=16).digest()})
            out.append((shared, left, right, mask, windows))
        return out

    def batch(rows):
        kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.struct([("l", pa.int32()), ("window", pa.binary())]))]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["shared", "left", "right", "mask", "windows"])

    def run(batches):
        held: list[tuple] = []
        for b in batches:
            held += zip(*(b.column(c).to_pylist() for c in ("shared", "left", "right", "members")))
            while len(held) >= 2 * ARRAY:
                cut = ARRAY
                while cut < 2 * ARRAY and held[cut][0] == held[cut - 1][0]:
                    cut += 1
                yield batch(solve(held[:cut]))
                held = held[cut:]
        if held:
            yield batch(solve(held))

    return run


def _union_masks(blocks: DataFrame, unit: Unit) -> DataFrame:
    """(shared, left, right, mask) of the different strings among blocks, for those that have a repeated window."""
    strings = materialize(blocks.groupBy("shared", "left", "right").agg(F.sum("copies").alias("copies")))
    whole = strings.filter("copies > 1").select("shared", "left", "right", F.lit((1 << unit.block) - 1).alias("mask"))
    # tables of their own, here and below, so that both sides of a join are plain exchanges and a frequent key can be split
    sizes = materialize(strings.groupBy("shared").agg(F.count("*").alias("members"), F.min("copies").alias("least")).filter("members > 1 AND least = 1").select("shared", "members"))
    mixed = strings.join(sizes, "shared")
    # a group of more strings than an array holds is dealt over several
    salt = F.pmod(F.xxhash64("left", "right"), F.ceil(F.col("members") / ARRAY)).cast("int")
    parts = max(1, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = mixed.withColumn("salt", salt).repartition(parts, "shared", "salt").sortWithinPartitions("shared", "salt")
    solved = materialize(map_batches(dealt.select("shared", "left", "right", "members"), _arrays(unit), "shared binary, left binary, right binary, mask int, windows array<struct<l: int, window: binary>>"))
    apart = solved.select("shared", "left", "right", F.inline("windows"))
    common = materialize(apart.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window"))
    between = apart.join(common, "window").groupBy("shared", "left", "right").agg(F.bit_or(F.expr("shiftleft(1, l)")).alias("mask"))
    # a window that its array knows to be repeated is repeated for all strings there that hold it: their masks say so
    inside = solved.select("shared", "left", "right", "mask")
    masks = materialize(whole.unionByName(inside).unionByName(between).groupBy("shared", "left", "right").agg(F.bit_or("mask").alias("mask")).filter("mask <> 0"))
    for x in (strings, sizes, solved, common):
        discard(x)
    return masks


def _marked(n: int, found: list[dict], unit: Unit) -> np.ndarray:
    """Which of a text's n symbols are covered by the repeated windows of its runs."""
    marks = np.zeros(n + 1, np.int32)
    for x in found:
        a, least, most = _unpack(x["packed"])
        if x["masks"] is None:
            marks[a - most] += 1
            marks[a - least + unit.length] -= 1
            continue
        for m in x["masks"]:
            for i in range(unit.block):
                if m["mask"] >> i & 1:
                    s = a - m["block"] * unit.block - i
                    marks[s] += 1
                    marks[s + unit.length] -= 1
    return np.cumsum(marks[:-1]) > 0


def _apply(unit: Unit, keep_text: bool):
    names = ["node", "nb", "n_removed", "n_spans", "n_symbols", "sha256", *(["kept"] if keep_text else [])]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *([pa.string()] if keep_text else [])]

    def run(batches):
        for b in batches:
            rows = []
            for text, found in zip(utf8(b.column("text")), b.column("found").to_pylist()):
                places = unit.places(text)
                gone = _marked(len(text) if places is None else len(places[0]), found, unit)
                edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                if places is not None:
                    first, last = places[0][first], places[1][last - 1]
                ends = [0, *np.stack([first, last], 1).ravel().tolist(), len(text)]
                kept = b"".join(text[ends[i] : ends[i + 1]] for i in range(0, len(ends), 2))
                rows.append((len(text) - len(kept), len(first), int(gone.sum()), hashlib.sha256(kept).hexdigest(), *([kept.decode(errors="ignore")] if keep_text else [])))
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("nb"), *[pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]], names=names)

    return run


def removals(documents: DataFrame, text: str = "text", keep_text: bool = False, unit: Unit = BYTES) -> tuple[DataFrame, DataFrame]:
    """documents with node and nb (identity of the text), and, for the texts that lose bytes: node, nb, n_removed, n_spans, n_symbols (symbols that go), sha256 and, if asked, kept."""
    body = F.coalesce(F.col(text), F.lit(""))
    named = documents.withColumns({"node": F.xxhash64(body), "nb": F.octet_length(body).cast("long")})
    texts = named.select("node", "nb", body.alias("text")).filter(F.col("nb") >= unit.least)
    rows = materialize(map_batches(texts, _find_runs(unit), "node long, nb long, packed long, key long, run long"))
    # tables of their own, here and below, so that both sides of a join are plain exchanges and a frequent key can be split
    again = materialize(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"))
    shared = materialize(rows.join(again, "key"))
    discard(rows)
    discard(again)
    different = materialize(shared.groupBy("key", "run").agg(F.count("*").alias("copies"), F.min(F.struct("node", "nb", "packed")).alias("x")))
    mixed = materialize(different.groupBy("key").agg(F.count("*").alias("n"), F.min("copies").alias("least")).filter("n > 1 AND least = 1").select("key"))
    unique_texts = texts.groupBy("node", "nb").agg(F.first("text").alias("text"))
    wanted = different.join(mixed, "key").select("x.*", "key", "run", "copies").groupBy("node", "nb").agg(F.collect_list(F.struct("packed", "key", "run", "copies")).alias("found"))
    blocks = materialize(map_batches(unique_texts.join(wanted, ["node", "nb"]).select("text", "found"), _cut_blocks(unit), "key long, run long, block int, need int, shared binary, left binary, right binary, copies long"))
    masks = _union_masks(blocks, unit)
    masked = blocks.join(masks, ["shared", "left", "right"]).withColumn("mask", F.col("mask").bitwiseAND(F.col("need"))).filter("mask <> 0")
    by_run = masked.groupBy("key", "run").agg(F.collect_list(F.struct("block", "mask")).alias("masks"))
    state = different.join(by_run, ["key", "run"], "left").filter("copies > 1 OR masks IS NOT NULL")
    state = materialize(state.select("key", "run", F.when(F.col("copies") == 1, F.col("masks")).alias("masks")))
    hit = shared.select("key", "run", "node", "nb", "packed").distinct().join(state, ["key", "run"])
    found = materialize(hit.groupBy("node", "nb").agg(F.collect_list(F.struct("packed", "masks")).alias("found")))
    for x in (shared, different, mixed, blocks, masks, state):
        discard(x)
    out = "node long, nb long, n_removed long, n_spans long, n_symbols long, sha256 string" + ", kept string" * keep_text
    return named, map_batches(unique_texts.join(found, ["node", "nb"]).select("node", "nb", "text", "found"), _apply(unit, keep_text), out)


def op4_suffix_dedup(documents: DataFrame) -> DataFrame:
    """The contract's counts for strings of 400 bytes and the digest of what is kept; and n_passage_words, the words that stand in a passage of over 50 words that starts anywhere else too."""
    documents = documents.select("doc_id", "text")
    named, changed = removals(documents)
    _, passages = removals(documents, unit=WORDS)
    of = lambda df, **more: df.select("node", "nb", *[more.get(c, F.lit(None).cast(t)).alias(c) for c, t in (("n_removed", "long"), ("n_spans", "long"), ("sha256", "string"), ("n_words", "long"))])
    both = of(changed, n_removed=F.col("n_removed"), n_spans=F.col("n_spans"), sha256=F.col("sha256")).unionByName(of(passages, n_words=F.col("n_symbols")))
    facts = materialize(both.groupBy("node", "nb").agg(*[F.max(c).alias(c) for c in ("n_removed", "n_spans", "sha256", "n_words")]))
    rows = named.select("doc_id", "node", "nb", F.sha2(F.coalesce("text", F.lit("")), 256).alias("whole")).join(facts, ["node", "nb"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return rows.select("doc_id", F.col("nb").alias("n_bytes"), zero("n_removed").alias("n_removed"), zero("n_spans").alias("n_spans"), F.coalesce("sha256", "whole").alias("kept_sha256"), zero("n_words").alias("n_passage_words"))


def op4_sql() -> str:
    """Every string by its digest; stretches of repeated ones are joined where they touch or overlap."""

    def stretches(name: str, length: int) -> str:
        return f"""{name}_new AS (SELECT rid, p, CASE WHEN p - lag(p) OVER (PARTITION BY rid ORDER BY p) <= {length} THEN 0 ELSE 1 END AS fresh FROM {name}),
{name}_no AS (SELECT rid, p, sum(fresh) OVER (PARTITION BY rid ORDER BY p) AS k FROM {name}_new),
{name}_span AS (SELECT rid, k, min(p) AS a, max(p) + {length} AS z FROM {name}_no GROUP BY rid, k)"""

    return rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b, coalesce(text, '') AS t FROM documents),
byte_all AS (SELECT rid, p, md5(b[p:p + {BYTES.length - 1}]) AS h FROM (SELECT rid, b, unnest(generate_series(1, octet_length(b) - {BYTES.length - 1})) AS p FROM d WHERE octet_length(b) >= {BYTES.length})),
bytes AS (SELECT rid, p FROM byte_all SEMI JOIN (SELECT h FROM byte_all GROUP BY h HAVING count(*) > 1) USING (h)),
{stretches("bytes", BYTES.length)},
piece AS (SELECT rid, a AS p, b[coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 1):a - 1] AS x FROM bytes_span JOIN d USING (rid)
  UNION ALL SELECT rid, max(z), any_value(b)[max(z):] FROM bytes_span JOIN d USING (rid) GROUP BY rid),
cut AS (SELECT rid, sha256(unhex(string_agg(hex(x), '' ORDER BY p))) AS s FROM piece GROUP BY rid),
gone AS (SELECT rid, sum(z - a) AS n, count(*) AS k FROM bytes_span GROUP BY rid),
word_list AS (SELECT rid, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM d),
word_all AS (SELECT rid, p, md5(array_to_string(w[p:p + {WORDS.length - 1}], ' ')) AS h FROM (SELECT rid, w, unnest(generate_series(1, len(w) - {WORDS.length - 1})) AS p FROM word_list WHERE len(w) >= {WORDS.length})),
words AS (SELECT rid, p FROM word_all SEMI JOIN (SELECT h FROM word_all GROUP BY h HAVING count(*) > 1) USING (h)),
{stretches("words", WORDS.length)},
covered AS (SELECT rid, sum(z - a) AS n FROM words_span GROUP BY rid)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed, coalesce(gone.k, 0) AS n_spans, coalesce(s, sha256(b)) AS kept_sha256, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_passage_words
FROM d LEFT JOIN gone USING (rid) LEFT JOIN cut USING (rid) LEFT JOIN covered USING (rid)"""


def without_repeats(documents: DataFrame, text: str = "text", unit: Unit = BYTES) -> DataFrame:
    """documents with what is kept of each text; a character that loses some of its bytes goes whole."""
    named, changed = removals(documents, text, keep_text=True, unit=unit)
    rows = named.join(changed.select(F.col("node").alias("_n"), F.col("nb").alias("_b"), "kept"), (F.col("node") == F.col("_n")) & (F.col("nb") == F.col("_b")), "left")
    return rows.withColumn(text, F.coalesce("kept", text)).select(*documents.columns)
