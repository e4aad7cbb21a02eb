"""Near copies that only a denser or an exact choice of candidates finds."""

import numpy as np

from weftline.llm import minhash_dedup as m

VOCABULARY = [f"w{i}" for i in range(5000)]


def substituted(rng, n, share):
    a = rng.choice(VOCABULARY, n).tolist()
    b = list(a)
    for i in rng.choice(n, int(n * share + 1e-9), replace=False):
        b[i] = f"x{rng.integers(1 << 30)}"
    return " ".join(a), " ".join(b)


def candidates(pairs):
    found = m.sketches([t.encode() for p in pairs for t in p])
    return [bool((x[: m.ALL] == y[: m.ALL]).any() or np.intersect1d(x[m.ALL :], y[m.ALL :]).size) for x, y in zip(found[::2], found[1::2])]


def test_recall_by_edit_similarity():
    rng = np.random.default_rng(1)
    for share, least in ((0.05, 1.0), (0.1, 0.98), (0.15, 0.95), (0.2, 0.85)):
        assert np.mean(candidates([substituted(rng, 250, share) for _ in range(200)])) >= least


def test_short_texts_are_all_candidates():
    rng = np.random.default_rng(2)
    pairs = []
    for n in range(4, m.SHORT + 1):
        for _ in range(60):
            a = rng.choice(VOCABULARY, n).tolist()
            b = list(a)
            for _ in range(int(0.2 * n + 1e-9)):
                kind, at = rng.integers(3), rng.integers(len(b))
                b = b[:at] + ([f"x{rng.integers(1 << 30)}"] if kind else []) + b[at + (kind < 2) :]
            x, y = (np.unique(a + b, return_inverse=True)[1][s] for s in (slice(0, n), slice(n, None)))
            if max(len(a), len(b)) <= m.SHORT and m.similar(x, y):
                pairs.append((" ".join(a), " ".join(b)))
    assert len(pairs) > 500 and all(candidates(pairs))


def test_short_near_copies_share_a_class(spark):
    rows = []
    for i, n in enumerate(range(9, 12)):
        a = [f"t{i}a{k}" for k in range(n)]
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(a[: n // 2] + ["other"] + a[n // 2 + 1 :]))]
    got = {r.doc_id: r.class_id for r in m.op3_minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k // 2 * 2 for k in range(6)}
