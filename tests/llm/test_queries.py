"""Each query against SQL or a brute-force version, and over odd and empty tables."""

import collections
import hashlib
import math

import numpy as np
import pytest

import corpus_pipeline
from tests.compare import duck, same
from weftline.llm import registry

SF = "/root/testdata/sf0.001"
TABLE = {"op2_chat_format": "conversations", "op6_embedding_dedup": "embeddings", "op8_url_filter": "pages"}


def run(spark, name, folder):
    return registry.queries()[name](spark, folder)


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet").toPandas()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
@pytest.mark.parametrize("odd", [False, True])
def test_equals_sql(spark, odd_dir, name, odd):
    folder = odd_dir if odd else SF
    assert same(run(spark, name, folder), duck(folder), registry.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_empty_table(spark, empty_dir, name):
    assert run(spark, name, empty_dir).count() == 0


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - {"op2_chat_format"}))
def test_one_row_each_on_odd_rows(spark, odd_dir, name):
    assert run(spark, name, odd_dir).count() == spark.read.parquet(f"{odd_dir}/{TABLE.get(name, 'documents')}.parquet").count()


def test_op3_on_odd_rows(spark, odd_dir):
    got = collections.Counter((r.doc_id, r.class_id) for r in run(spark, "op3_minhash_dedup", odd_dir).collect())
    assert got[(2, 2)] == 1 and got[(3, 2)] == 2 and got[(4, 2)] == 1
    assert got[(1, 1)] == got[(9, 1)] == 1  # null and empty are equal
    assert got[(5, 5)] == got[(10, 10)] == 1


def test_op3_finds_near_copies_and_only_those(spark):
    got = {r.doc_id: r.class_id for r in run(spark, "op3_minhash_dedup", SF).collect()}
    docs = table(spark, SF, "documents")
    shingles = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in zip(docs.doc_id, docs.text.str.lower().str.split())}
    for a in shingles:
        for b in shingles:
            if a < b:
                j = len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b])
                assert j < 0.8 or got[a] == got[b]
                assert j > 0.1 or got[a] != got[b] or len([c for c in got.values() if c == got[a]]) > 2


def brute_repeats(texts, length=400):
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        marks = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                marks[i] += 1
                marks[i + length] -= 1
        gone = np.cumsum(marks)[: len(t)] > 0
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def brute_passages(texts, length=51):
    """For each text, which of its words stand in a passage that starts elsewhere too, and the words' places."""
    import re

    found = [[(m.start(), m.end(), m.group().lower()) for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", t)] for t in texts]
    count = collections.Counter(tuple(w[2] for w in f[i : i + length]) for f in found for i in range(len(f) - length + 1))
    out = []
    for f in found:
        gone = np.zeros(len(f), bool)
        for i in range(len(f) - length + 1):
            if count[tuple(w[2] for w in f[i : i + length])] > 1:
                gone[i : i + length] = True
        out.append((f, gone))
    return out


def cut_passages(text, f, gone):
    """The text without stretches of gone words and what is between them."""
    keep, i = [], 0
    for k in range(len(f)):
        if gone[k] and (not k or not gone[k - 1]):
            keep.append(text[i : f[k][0]])
        if gone[k]:
            i = f[k][1]
    return b"".join([*keep, text[i:]])


def edited_copies(n=60, length=2500, seed=5):
    """Copies of one text with a changed byte here and there, so that many texts share parts between many pairs of anchors."""
    rng = np.random.default_rng(seed)
    base = rng.integers(97, 123, length, dtype=np.uint8)
    base[rng.integers(0, length, length // 6)] = 32
    out = []
    for _ in range(n):
        t = base.copy()
        t[rng.integers(0, length, 6)] = 48
        out.append(t.tobytes())
    return out


def op4_wanted(ids, texts):
    words = [int(gone.sum()) for _, gone in brute_passages(texts)]
    return collections.Counter((i, *x, w) for i, x, w in zip(ids, brute_repeats(texts), words))


def op4_got(rows):
    return collections.Counter((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.n_passage_words) for r in rows)


@pytest.mark.parametrize("odd", [False, True])
def test_op4_equals_brute_force(spark, odd_dir, odd):
    folder = odd_dir if odd else SF
    docs = table(spark, folder, "documents")
    want = op4_wanted(docs.doc_id.fillna(-1), [(t or "").encode() for t in docs.text])
    assert op4_got(run(spark, "op4_suffix_dedup", folder).collect()) == want


def test_op4_counts_an_occurrence_under_two_anchors_once(spark):
    from weftline.llm.suffix_dedup import BYTES, op4_suffix_dedup, runs

    texts = edited_copies()
    found = runs(texts)
    pairs = collections.defaultdict(list)
    for t, a in zip(found[0].tolist(), found[1].tolist()):
        pairs[t].append(a)
    assert any((b - a) % BYTES.block == 0 and b - a < BYTES.span for x in pairs.values() for a in x for b in x if b > a)
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string")
    assert op4_got(op4_suffix_dedup(docs).collect()) == op4_wanted(range(len(texts)), texts)


def test_op6_equals_brute_force(spark, odd_dir):
    for folder in (SF, odd_dir):
        rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
        good = [r.label is not None and bool(r.embedding) and all(x is not None and math.isfinite(x) for x in r.embedding) and any(r.embedding) for r in rows]
        unit = [np.array(r.embedding, float) / np.linalg.norm(np.array(r.embedding, float)) if g else None for r, g in zip(rows, good)]
        link = [[i != j and good[i] and good[j] and rows[i].label == rows[j].label and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98 for j in range(len(rows))] for i in range(len(rows))]
        root = [r.vec_id for r in rows]
        while True:
            new = [min([root[i], *(root[j] for j in range(len(rows)) if link[i][j])]) if any(link[i]) else root[i] for i in range(len(rows))]
            if new == root:
                break
            root = new
        want = collections.Counter((r.vec_id, sum(x), c) for r, x, c in zip(rows, link, root))
        assert collections.Counter((r.vec_id, r.n_links, r.component_id) for r in run(spark, "op6_embedding_dedup", folder).collect()) == want


def test_op5_round_trip(spark, odd_dir):
    import zlib

    docs = table(spark, odd_dir, "documents")
    want = collections.Counter()
    for t in docs.text:
        b = (t or "").encode()
        p = b.ljust(max(64, -(-len(b) // 64) * 64), b"\0")
        want[(len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))] += 1
    rows = run(spark, "op5_media", odd_dir).collect()
    assert collections.Counter((r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == want


@pytest.mark.parametrize("odd", [False, True])
def test_op7_equals_tiktoken(spark, odd_dir, odd):
    import tiktoken

    from weftline.llm.bpe import public_vocabulary

    folder = odd_dir if odd else SF
    tokens, pattern = public_vocabulary()
    plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    want = collections.Counter()
    for t in table(spark, folder, "documents").text:
        ids = plain.encode_ordinary(t or "")
        want[(len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert collections.Counter((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(spark, "op7_bpe", folder).collect()) == want


def test_op9_held_out(spark):
    """Fitted on three quarters of about 4,000 labels, it finds most toxic ones of the rest; each language has its own few words."""
    from pyspark.sql import functions as F

    from weftline.llm import toxicity

    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    part = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) > 0
    chain = toxicity.train(docs, labels.filter(part))
    cells = collections.Counter((r.toxic, r.rejected) for r in toxicity.score(docs.join(labels.filter(~part), "doc_id").select("doc_id", "text", "toxic"), chain).collect())
    print(dict(cells))
    assert cells[(1, True)] >= 0.85 * (cells[(1, True)] + cells[(1, False)])
    assert cells[(0, True)] <= 0.01 * (cells[(0, True)] + cells[(0, False)])


@pytest.mark.parametrize("odd", [False, True])
def test_op10_contract(spark, odd_dir, odd):
    import re

    folder = odd_dir if odd else SF
    docs = table(spark, folder, "documents")
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    rows = run(spark, "op10_mixing", folder).collect()
    assert sorted(r.size for r in rows) == sorted(map(size, docs.text))
    total = collections.Counter()
    for s, t in zip(docs.source, docs.text):
        total[s] += size(t)
    order = sorted((s for s in total if s is not None), key=str.encode) + [s for s in total if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(total.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * total[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * total[s]
            left -= target[s]
        free -= over
    by_target = collections.Counter()
    taken = collections.Counter()
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[(r.source_size, round(r.target, 6))] += r.taken
    for s in order:
        by_target[(total[s], round(target[s], 6))] += target[s]
    assert set(taken) == set(by_target)
    assert all(abs(taken[k] - by_target[k]) <= len(order) for k in taken)
    again = run(spark, "op10_mixing", folder).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_pipeline_on_odd_rows(spark, odd_dir, tmp_path):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, odd_dir)
        assert name == "bpe" or out.columns == columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(docs.count())
    assert kept[0] == 12 and kept[1] == 8 and kept[2] == 8


def test_pipeline_on_empty_tables(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_pipeline_equals_its_plain_version(spark):
    """The rows of each stage, from the operators' decisions applied in plain Python."""
    from weftline.llm.bpe import Codec, public_vocabulary

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    rejected = {r.doc_id for r in run(spark, "op9_toxicity", SF).collect() if r.rejected}
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in docs.collect()} - rejected
    second = corpus_pipeline.STAGES[1][1](spark, first, SF)
    from weftline.llm.minhash_dedup import op3_minhash_dedup

    assert {r.doc_id for r in second.collect()} == {r.doc_id for r in op3_minhash_dedup(first).collect() if r.kept}
    third = {r.doc_id: r.text for r in corpus_pipeline.STAGES[2][1](spark, second, SF).collect()}
    rows = second.collect()
    texts = [(r.text or "").encode() for r in rows]
    for r, t, (words, gone) in zip(rows, texts, brute_passages(texts)):
        assert (third[r.doc_id] or "").encode() == cut_passages(t, words, gone)
    out = corpus_pipeline.run(spark, SF).collect()
    assert len(out) > 0 and {r.doc_id for r in out} <= set(third)
    codec = Codec(*public_vocabulary())
    assert all(r.n_tokens <= len(codec.encode(third[r.doc_id])) for r in out)
