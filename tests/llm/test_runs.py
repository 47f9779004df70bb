import hashlib
import random
import zlib

import awkward
import numpy as np

from concord.llm import runs


def stretches(words):
    """Every run by comparing words at every distance."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            own = words[i:j + q]
            if length >= max(6, 4 * q) and not any(own[p:] == own[:-p] for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng):
    n, k = rng.randint(0, 70), rng.choice([1, 2, 3, 5, 30])
    words = [b"%d" % rng.randrange(k) for _ in range(n)]
    if words and rng.random() < 0.7:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // rng.randint(3, 9)))
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        words += [b"%d" % rng.randrange(k) for _ in range(rng.choice([0, 0, 12]))]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(7)
    for _ in range(1500):
        docs = [some_words(rng) for _ in range(rng.randint(1, 5))]
        assert runs.search(docs, rng.choice([20, 1 << 17])) == [stretches(w) for w in docs]


def test_long_sequences():
    assert runs.search([[b"a"] * 200_000]) == [[(0, 200_000, 1)]]
    assert runs.search([[b"a", b"b", b"a"] * 50_000]) == [[(0, 150_000, 3)]]
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 100_000:  # no repetition of the Fibonacci word reaches four periods
        a, b = b, b + a
    assert runs.search([b]) == [[]]


def test_wavelet_matrix_equals_sorting():
    rng = np.random.default_rng(3)
    for n in (1, 2, 63, 64, 65, 300):
        values = rng.permutation(n)
        tree = runs.WaveletMatrix(values)
        lo = rng.integers(0, n, 50)
        hi = lo + 1 + rng.integers(0, n - lo)
        v = rng.integers(0, n, 50)
        k = rng.integers(0, hi - lo)
        assert tree.below(lo, hi, v).tolist() == [(values[a:b] < x).sum() for a, b, x in zip(lo, hi, v)]
        assert tree.quantile(lo, hi, k).tolist() == [sorted(values[a:b])[x] for a, b, x in zip(lo, hi, k)]


def test_query_rows_from_the_operator(spark, tmp_path):
    """The registered query on a folder of its own, against the contract in plain Python."""
    from concord.llm.queries import QUERIES
    rng = random.Random(5)
    texts = [" ".join(w.decode() for w in some_words(rng)) for _ in range(200)] + [None, "", " \t\n"]
    texts += ["a\x0bb\x0cc " * 9, "é x é x é x é x é x é x"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        found = stretches(words)
        top = min(found, key=lambda r: (-r[1] * 1_000_000_007 // r[2], r[0], r[2]), default=(None, None, None))
        kept = [w for j, w in enumerate(words) if not any(s + q <= j < s + m for s, m, q in found)]
        r = got[i]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *top)
        assert r["exponent_milli"] == (1000 * top[1] // top[2] if found else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(kept)).hexdigest()


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    for rewrite in (False, True):
        got = runs.periodic_runs(docs, rewrite=rewrite)
        rows = got.collect()
        assert got.columns == ["doc_id", "runs", "collapsed"] and len(rows) == docs.count()
        assert all(r["runs"] == [] and r["collapsed"] == "" for r in rows if r["doc_id"] in (0, 1, 2))
        same = [r for r in rows if r["doc_id"] == 3]
        assert len(same) == 3 and len(set(map(str, same))) == 1
        assert runs.periodic_runs(awkward.empty(spark), rewrite=rewrite).count() == 0
