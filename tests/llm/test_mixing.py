import hashlib

import awkward
import duckdb
import pytest
from conftest_paths import SF01
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from concord.llm import mixing
from concord.llm.queries import ORACLE, QUERIES


def test_query_against_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF01}/documents.parquet'")
    want = duckdb.sql(ORACLE["op9_mixing"])
    names = sorted(want.columns)
    got = QUERIES["op9_mixing"](spark, SF01).select(names).collect()
    assert sorted(map(tuple, got)) == sorted(want.select(*names).fetchall())


def water(children, total):
    """Budgets by filling in rounds: children are (name, weight, capacity)."""
    given, open_ = {n: 0.0 for n, _, _ in children}, [c for c in children if c[1] > 0 and c[2] > 0]
    left = min(total, sum(c[2] for c in open_))
    while open_ and left > 1e-9:
        unit = left / sum(w for _, w, _ in open_)
        full = [c for c in open_ if c[2] - given[c[0]] <= c[1] * unit]
        for n, w, cap in full or open_:
            add = cap - given[n] if full else w * unit
            given[n] += add
            left -= add
        open_ = [c for c in open_ if c not in full] if full else []
    return given


@pytest.mark.parametrize("seed", range(3))
def test_shortages_go_to_siblings_first(spark, seed):
    import random
    r = random.Random(seed)
    leaves = [(f"d{d}", f"l{x}", f"s{s}", r.choice([5, 50, 500, 5000])) for d in range(3) for x in range(2) for s in range(3)]
    weights = {"a": {"d0": 3, "d1": 2}, "b": {"l0": 4}, "c": {"s2": 0}}
    got = {(x["a"], x["b"], x["c"]): x["budget"] for x in mixing.plan(
        spark.createDataFrame(leaves, "a string, b string, c string, supply long"), ["a", "b", "c"], weights, 0.7, 2).collect()}

    def capacity(prefix):
        return sum(2 * x[3] for x in leaves if x[:len(prefix)] == prefix)

    def down(prefix, total):
        if len(prefix) == 3:
            if total >= 1:
                assert abs(got[prefix] - total) <= 3 and got[prefix] <= capacity(prefix)
            else:
                assert got.get(prefix, 0) <= 1
            return
        level = "abc"[len(prefix)]
        names = sorted({x[len(prefix)] for x in leaves if x[:len(prefix)] == prefix})
        for n, b in water([(n, weights[level].get(n, 1), capacity((*prefix, n))) for n in names], total).items():
            down((*prefix, n), b)

    # capacities count weight-0 sources only where nothing below them is taken, so compare without such leaves
    leaves = [x for x in leaves if x[2] != "s2"]
    got = {(x["a"], x["b"], x["c"]): x["budget"] for x in mixing.plan(
        spark.createDataFrame(leaves, "a string, b string, c string, supply long"), ["a", "b", "c"], weights, 0.7, 2).collect()}
    down((), int(sum(x[3] for x in leaves) * 0.7))


def test_prefix_of_seeded_epochs(spark):
    """The rows of one leaf, by a plain sort of each epoch's order."""
    docs = spark.createDataFrame([(i, "w " * (i % 7 + 1)) for i in range(40)], "doc_id long, text string")
    got = sorted((r["_epoch"], r["doc_id"], r["_take"]) for r in mixing.mix(
        docs, {"all": F.lit("x")}, {}, mixing.words(F.col("text")), share=2.35, max_epochs=3).collect())
    left, want = int(sum(i % 7 + 1 for i in range(40)) * 2.35), []
    for epoch in range(3):
        place = lambda i: int(hashlib.md5(f"42:{epoch}:{i}".encode()).hexdigest()[:15], 16)  # noqa: B023, E731
        for i in sorted(range(40), key=place):
            take = min(left, i % 7 + 1)
            left -= take
            want += [(epoch, i, take)] if take else []
    assert got == sorted(want)


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    got = mixing.mix(docs, mixing.tree(), mixing.WEIGHTS, mixing.words(F.col("text")), share=1.0, max_epochs=1)
    assert set(docs.columns) - {"_tokens"} < set(got.columns)
    rows = got.collect()
    total = sum(len((r["text"] or "").encode().split()) for r in docs.collect())
    assert 0 < sum(r["_take"] for r in rows) <= total
    assert sum(r["_take"] for r in rows) >= total - 40
    empty = mixing.mix(awkward.empty(spark), mixing.tree(), mixing.WEIGHTS, mixing.words(F.col("text")))
    assert empty.count() == 0


def test_repeated_keys_share_the_cut(spark):
    docs = spark.createDataFrame([(1, "a b c d")] * 5, "doc_id long, text string")
    got = [r["_take"] for r in mixing.mix(docs, {"all": F.lit("x")}, {}, mixing.words(F.col("text")), share=0.6, max_epochs=1).collect()]
    assert got == [2] * 5  # 12 of 20 tokens: each gives 12 / 20 of its 4, rounded down


@settings(max_examples=40, deadline=None)
@given(st.text(" \n\tab", max_size=30), st.integers(0, 6))
def test_first_words_pattern(text, n):
    """The split that cuts a text after words, checked with Python's equal pattern."""
    import re
    pieces = re.split(r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])", text)
    lead = 1 if re.match(r"[\x20\x09-\x0D]", text) else 0
    cut = "".join(pieces[:n + lead])
    assert text.startswith(cut) and len(cut.split()) == min(n, len(text.split()))
