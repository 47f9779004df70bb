import hashlib

import awkward
import numpy as np
from conftest_paths import SF01
from hypothesis import given, settings
from hypothesis import strategies as st

from concord.llm import sketch


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_real_documents(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in sketch.fingerprint(spark.read.parquet(f"{SF01}/documents.parquet")).collect()}
    assert len(got) == len(rows)
    off, prints = [], {}
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut, r = len(text) // 2, got[doc]
        edited = text[:len(text) - cut] + after[:cut]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        own, other = shingles(text), shingles(edited)
        off.append(abs(r["near_edited"] - likeness(own, other)))
        assert abs(r["near_next"] - likeness(own, shingles(after))) < 0.25
        if len(own) < 128:
            assert r["n_shingles"] == len(own)
        if len(own | other) <= 128:
            assert off[-1] < 1e-9
    assert np.mean(off) < 0.04 and max(off) < 0.25


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = []
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 2
        want.append((str(doc), len(text), hashlib.sha256((text[:len(text) - cut] + after[:cut]).encode()).hexdigest()))
    got = sketch.fingerprint(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    assert sketch.fingerprint(awkward.empty(spark)).count() == 0
    one = sketch.fingerprint(docs.where("doc_id = 3").limit(1)).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(
        (awkward.BASE[:len(awkward.BASE) - len(awkward.BASE) // 2] + awkward.BASE[:len(awkward.BASE) // 2]).encode()).hexdigest()


def test_order_over_many_buckets(spark):
    """Successors across bucket boundaries, with gaps, negative ids and repeated ids."""
    rng = np.random.default_rng(2)
    ids = [int(x) for x in rng.integers(-10**12, 10**12, 300)] + [5, 5, 5, None, None]
    docs = spark.createDataFrame([(i, f"text {k} of row") for k, i in enumerate(ids)], "doc_id long, text string").repartition(7)
    run = sketch.with_next(docs, "doc_id", "text", rows_per_bucket=4)
    assert run.select("bucket").distinct().count() > 20
    order = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    after = dict(zip([t for _, t in order], [t for _, t in order[1:] + order[:1]]))
    buckets = {}
    for r in run.collect():
        buckets.setdefault(r["bucket"], []).append((r["ahead"], r["id"] is None, r["id"] or 0, r["text"]))
    seen = {}
    for rows in buckets.values():
        rows.sort()
        assert [r[0] for r in rows] == [0] * (len(rows) - 1) + [1]
        seen |= {a[3]: b[3] for a, b in zip(rows, rows[1:])}
    assert seen == after


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text("ab ", max_size=40), min_size=1, max_size=5))
def test_sketches_merge(parts):
    """The sketch of the union of parts is the merge of their sketches."""
    k = 8
    merged = np.empty(0, np.uint64)
    every = np.empty(0, np.uint64)
    for p in parts:
        merged = sketch.merge(merged, sketch.sketch(p, k, 2), k)
        every = np.union1d(every, sketch.sketch(p, 10**6, 2))
    assert merged.tolist() == every[:k].tolist()


def test_parts_merge_in_rounds(spark):
    rng = np.random.default_rng(4)
    sets = {k: [sorted(rng.choice(10**6, 9, replace=False).tolist()) for _ in range(n)] for k, n in (("a", 40), ("b", 3), (None, 5))}
    parts = spark.createDataFrame([(k, s) for k, v in sets.items() for s in v], "key string, hashes array<long>")
    got = {r["key"]: r["hashes"] for r in sketch.merge_parts(parts, "key", k=16, fan_in=4).collect()}
    assert got == {k: sorted({x for s in v for x in s})[:16] for k, v in sets.items()}


def test_estimates():
    rng = np.random.default_rng(6)
    pool = np.unique(rng.integers(0, 1 << 48, 30_000, dtype=np.uint64))
    a, b = pool[rng.permutation(len(pool))[:20_000]], pool[rng.permutation(len(pool))[:20_000]]
    low = [np.sort(x)[:512] for x in (a, b)]
    both, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
    assert abs(sketch.resemblance(*low, 512) - both / union) < 0.08
    assert abs(sketch.containment(*low, 512) - both / len(a)) < 0.15
    assert abs(sketch.distinct(low[0], 512) / len(a) - 1) < 0.15
