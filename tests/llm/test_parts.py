"""Parts of the operators, without Spark or with little of it."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import media, minhash_dedup, mixing, textnum, url_filter
from weftline.llm.suffix_grouping import suffix_array


def test_suffix_array_equals_sorting():
    r = random.Random(1)
    for _ in range(1500):
        t = [r.randrange(r.choice([1, 2, 3, 9])) for _ in range(r.randrange(60))]
        assert suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_alignment_equals_edit_distance():
    r = random.Random(2)
    for _ in range(1500):
        a = [r.randrange(4) for _ in range(r.randrange(25))]
        b = a[:]
        for _ in range(r.randrange(6)):
            if b and r.random() < 0.5:
                del b[r.randrange(len(b))]
            else:
                b.insert(r.randrange(len(b) + 1), r.randrange(4))
        k = r.randrange(8)
        assert minhash_dedup.within(np.array(a, int), np.array(b, int), k) == (distance(a, b) <= k)


def test_word_hashes_do_not_depend_on_place():
    h, n = textnum.words([b"Hello world", b"", b"  world\thello "])
    assert n.tolist() == [2, 0, 2] and h[0] == h[3] and h[1] == h[2] and h[0] != h[1]


@pytest.mark.parametrize("data", [b"", b"a", b"ab" * 9000, bytes(range(256)) * 300, random.Random(3).randbytes(50_000)])
def test_lzw_round_trip(data):
    assert media.lzw_decode(media.pack(media.lzw_codes(data)), 8, len(data)) == data


def frame(data):
    return [f.rgba.copy() for f in media.decode(data)]


def test_gif_disposal_and_transparency():
    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0]) + bytes(3 * 253)
    red, part = np.full((2, 2), 1, np.uint8), np.array([[2, 0], [0, 0]], np.uint8)
    kept = frame(media.encode([red, part, part], palette, [5, 7, 1], disposal=1, transparent=0))
    assert kept[1][0, 0].tolist() == [0, 255, 0, 255] and kept[1][1, 1].tolist() == [255, 0, 0, 255]
    cleared = frame(media.encode([red, part], palette, disposal=2, transparent=0))
    assert cleared[1][1, 1].tolist() == [0, 0, 0, 0]
    restored = frame(media.encode([red, part], palette, disposal=3, transparent=0))
    assert restored[1][1, 1].tolist() == [0, 0, 0, 0] and restored[1][0, 0].tolist() == [0, 255, 0, 255]
    times = [(f.start_ms, f.delay_ms) for f in media.decode(media.encode([red, part], palette, [5, 7]))]
    assert times == [(0, 50), (50, 70)]


def test_gif_frames_table(spark):
    gif = media.encode([np.zeros((2, 3), np.uint8), np.full((2, 3), 255, np.uint8)])
    rows = media.frames(spark.createDataFrame([(1, bytearray(gif)), (2, None), (3, bytearray(b"GIF89a"))], "doc_id long, content binary")).collect()
    assert [(r.doc_id, r.frame, r.red[0], r.red[7], r.start_ms) for r in rows] == [(1, 0, 6, 0, 0), (1, 1, 0, 6, 100)]


def test_hypergeometric_draws(spark):
    n, k, d = 60, 25, 30
    u = (F.col("id") + 0.5) / 4000
    rows = spark.range(4000).select(mixing.hypergeometric(F.lit(n).cast("long"), F.lit(k).cast("long"), F.lit(d).cast("long"), u).alias("x")).groupBy("x").count().collect()
    for r in rows:
        want = math.comb(k, r.x) * math.comb(n - k, d - r.x) / math.comb(n, d)
        assert abs(r["count"] / 4000 - want) < 0.001


@pytest.mark.parametrize("n, k, d", [(40_000, 9_000, 21_000), (2_000_000, 1_995_000, 900_000), (10**15, 4 * 10**14, 10**14)])
def test_wide_hypergeometric_draws(spark, n, k, d):
    """Mean and spread; where it can be summed, the distribution function too."""
    m = 20_000
    u = F.xxhash64("id") / float(1 << 63)
    got = np.array([r.x for r in spark.range(m).select(mixing.hypergeometric(F.lit(n).cast("long"), F.lit(k).cast("long"), F.lit(d).cast("long"), u).alias("x")).collect()])
    mean, sd = d * k / n, math.sqrt(d * k / n * (n - k) / n * (n - d) / (n - 1))
    assert sd > mixing.INVERTED and got.min() >= max(0, d + k - n) and got.max() <= min(d, k)
    assert abs((got - mean).mean()) < 5 * sd / math.sqrt(m) and abs(got.std() / sd - 1) < 5 / math.sqrt(2 * m)
    if n < 10**6:
        x = np.arange(max(0, d + k - n), min(d, k) + 1)
        lf = lambda a: np.array([math.lgamma(i + 1) for i in a])
        w = -lf(x) - lf(k - x) - lf(d - x) - lf(n - k - d + x)
        below = np.cumsum(np.exp(w - w.max()) / np.exp(w - w.max()).sum())
        assert np.abs(np.searchsorted(np.sort(got), x, "right") / m - below).max() < 1.95 / math.sqrt(m)


def test_bloom_filter_passes_all_listed_and_few_others(spark):
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    bloom, blocks = url_filter.build_filter(keys, 2000)
    block, places = url_filter._place(F.col("key"), blocks)
    asked = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"), "id").withColumns({"block": block, "places": places}).join(bloom, "block")
    hit = F.forall("places", lambda p: F.getbit(F.get("words", F.shiftright(p, 6)), p.bitwiseAND(F.lit(63))) == 1)
    passed = {r.id for r in asked.filter(hit).collect()}
    assert set(range(2000)) <= passed and len(passed) < 2050


def test_long_pieces_give_the_same_ids_folded():
    import tiktoken

    from weftline.llm import bpe

    tokens, pattern = bpe.public_vocabulary()
    codec, rng = bpe.Codec(tokens, pattern), np.random.default_rng(3)
    plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    letters = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzäß漢"), 20_000))
    for text in ("a" * 5000, "ab" * 2500 + "c", letters, " " * 3000 + "x", "!?" * 2000, "word " + "z" * (bpe.LONG + 1) + " end"):
        assert codec.encode(text) == plain.encode_ordinary(text)
        assert codec.decode(codec.encode(text)).decode() == text
    for n in (2, 255, 256, 257, 600):
        ids = codec.table.ids[rng.choice(list(b"abeilnorst"), n)]
        assert bpe.merge_folded(ids, codec.table).tolist() == bpe.merge_rows(ids[None].copy(), codec.table)[0].tolist()
