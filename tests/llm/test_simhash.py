import re

import awkward
import numpy as np
import pytest
import xxhash
from conftest_paths import SF001

from concord.llm import simhash


def plain(text, size=4):
    """The contract's fingerprint, word by word and bit by bit."""
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + size]).encode(), 42) for i in range(max(1, len(words) - size + 1))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(prints, bits=4):
    """Root of each fingerprint by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("shard,block", [(1 << 14, 1 << 17), (16, 5)])
def test_against_brute_force(spark, shard, block, monkeypatch):
    """Also with many shards and with shards compared block by block."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(5)
    prints = [int(x) for x in rng.integers(0, 1 << 63, 60)]
    for p in prints[:40]:  # chains of near fingerprints
        for _ in range(4):
            p ^= sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False))
            prints.append(p)
    prints = sorted(set(prints))
    rows = [(int(np.uint64(p).astype(np.int64)), i, 1) for i, p in enumerate(prints)]
    edges = simhash.linked(spark.createDataFrame(rows, "fp long, rep long, n_rows long"), 4, shard)
    from concord.llm.common import components as joined
    got = {r["node"]: r["component"] for r in joined(edges).collect()}
    assert [got.get(i, i) for i in range(len(prints))] == components(prints)


def test_real_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    ids = sorted(docs)
    prints = [plain(docs[i]) for i in ids]
    roots = components(prints)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(spark.read.parquet(f"{SF001}/documents.parquet")).collect()}
    assert {i: (f"{p:016x}", ids[r]) for i, p, r in zip(ids, prints, roots)} == {
        i: (r["fingerprint"], r["component_id"]) for i, r in got.items()}
    kept = simhash.keep_one(spark.read.parquet(f"{SF001}/documents.parquet")).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({ids[r] for r in roots})
    assert all(r["text"] == docs[r["doc_id"]] for r in kept)


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    rows = docs.collect()
    got = simhash.near_duplicates(docs).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in got) == sorted(
        (str(r["doc_id"]), f"{plain(r['text']):016x}") for r in rows)
    roots = components([plain(r["text"]) for r in rows])
    groups = {}
    for r, root in zip(rows, roots):
        groups.setdefault(root, []).append(r["doc_id"])
    least = {root: min((i for i in ids if i is not None), default=None) for root, ids in groups.items()}
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == sorted(
        (str(r["doc_id"]), str(least[root])) for r, root in zip(rows, roots))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(map(str, least.values()))
    assert simhash.near_duplicates(awkward.empty(spark)).count() == 0 == simhash.keep_one(awkward.empty(spark)).count()


def test_only_null_ids(spark):
    docs = awkward.frame(spark, [(None, awkward.BASE, *[None] * 10), (None, awkward.BASE, *[None] * 10), (None, "other text here", *[None] * 10)])
    assert {r["component_id"] for r in simhash.near_duplicates(docs).collect()} == {None}
    assert sorted(r["text"] for r in simhash.keep_one(docs).collect()) == sorted([awkward.BASE, "other text here"])


def test_components_of_chains_and_hubs(spark, monkeypatch):
    from concord.llm import common
    lookup = common.lookup
    monkeypatch.setattr(common, "lookup", lambda *a, **k: lookup(*a, **k, floor=5, share=20))
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1080)] + [(5000, 1003), (3, 3), (9, 8), (8, 9)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, 5000, *range(1000, 1080)]} | {8: 8, 9: 8}
    assert got == want


def test_one_id_with_unlike_texts_is_two_groups(spark):
    """Rows 5 repeat an id; the second is near row 3 only, which row 5's other text must not join."""
    one, two = (" ".join(f"{w}{i}" for i in range(60)) for w in ("ash", "oak"))
    docs = spark.createDataFrame([(5, one), (5, two), (3, two), (4, one)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert got == [(3, 3), (4, 4), (5, 3), (5, 4)]
    assert sorted(map(tuple, simhash.keep_one(docs).collect())) == [(3, two), (4, one)]
    docs = spark.createDataFrame([(5, one), (5, two)], "doc_id long, text string")
    assert simhash.keep_one(docs).count() == 2
