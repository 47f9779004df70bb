"""Row differences from sketches: equal to the exact join, whatever differs."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from concord.functions.canonical import with_row_hash
from concord.operators import rowdiff, sketchdiff

SCHEMA = "k long, s string, x double"


def rows(n, seed=1):
    rng = random.Random(seed)
    return [(rng.choice([None, i]), rng.choice(["", "a", None, "ü"]), float(i % 7)) for i in range(n)]


def same(a, b, **kwargs):
    want = sorted(map(str, rowdiff.row_multiset_diff(a, b).collect()))
    got = sketchdiff.row_sketch_diff(a, b, **kwargs)
    assert got.columns == rowdiff.row_multiset_diff(a, b).columns
    assert sorted(map(str, got.collect())) == want
    return want


def test_duplicates_nulls_and_multiplicities(spark):
    base = rows(500)
    a = spark.createDataFrame(base + base[:40] * 3 + [(None, None, None)] * 5, SCHEMA)
    b = spark.createDataFrame(base[10:] + base[:20] * 7 + [(1, "new", 0.5)] * 4, SCHEMA)
    assert len(same(a, b)) > 20
    assert same(a, a) == []
    assert same(a, a.unionByName(a)) != []  # every multiplicity doubled


def test_empty_sides_and_retyped_columns(spark):
    a = spark.createDataFrame(rows(100), SCHEMA)
    assert same(a, a.limit(0)) and same(a.limit(0), a) and same(a.limit(0), a.limit(0)) == []
    retyped = a.select(F.col("k").cast("decimal(20,0)").alias("K"), "s", F.col("x").cast("float").alias("x"))
    assert same(a, retyped) == []
    with pytest.raises(ValueError, match="missing_target"):
        sketchdiff.row_sketch_diff(a, a.drop("x"))


def test_more_differences_than_cells(spark):
    """The first sketch cannot be decoded: the strata size the next one, or the exact join takes over."""
    a, b = spark.range(6000).select(F.col("id").alias("k")), spark.range(3000, 9000).select(F.col("id").alias("k"))
    hashed = [with_row_hash(df) for df in (a, b)]
    assert len(sketchdiff.differing_hashes(*hashed, cells=64, most_cells=1 << 13)) == 6000
    assert sketchdiff.differing_hashes(*hashed, cells=64, most_cells=256) is None
    assert len(same(a, b, cells=64, most_cells=256)) == 6000


def test_sketches_of_parts_add_up(spark):
    df = with_row_hash(spark.createDataFrame(rows(400), SCHEMA))
    one, two = df.where("pmod(_h1, 3) = 0"), df.where("pmod(_h1, 3) <> 0")
    left = sketchdiff.merged(sketchdiff.sketch(one), sketchdiff.sketch(two), sketchdiff.sketch(df, sign=-1))
    assert left.count() == 0


def test_estimate_is_near(spark):
    for n in (3000, 40000):
        left = sketchdiff.sketch(with_row_hash(spark.range(n).select(F.col("id").alias("k"))), 16).where("stratum >= 0").toPandas()
        got = sketchdiff.estimate(left["stratum"].to_numpy(), left["cell"].to_numpy(), left[sketchdiff.SUMS].to_numpy(np.int64))
        assert n / 2 < got < 2 * n


def test_only_cells_are_shuffled(spark):
    """However many rows, a map task sends at most the cells of one sketch."""
    df = with_row_hash(spark.range(0, 200_000, 1, 4).select(F.col("id").alias("k")))
    most = 3 * 64 + 3 * sketchdiff.STRATUM_CELLS * (sketchdiff.LAST_STRATUM - sketchdiff.FIRST_STRATUM + 1)
    assert sketchdiff.sketch(df, 64).count() <= most


def test_a_task_of_the_exact_join_does_not_grow_with_the_rows(spark, monkeypatch):
    """Too many differences for a sketch: hashes are counted by one aggregate over partitions by the number of rows, without a sort of both sides."""
    import re

    from concord.functions import stored

    monkeypatch.setattr(stored, "PARTITION_ROWS", 1000)
    monkeypatch.setattr(rowdiff, "BROADCAST_HASHES", 5)
    plans = []

    def seen(df, label, run=rowdiff.stored):
        if label == "rowdiff":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return run(df, label)

    monkeypatch.setattr(rowdiff, "stored", seen)
    before = dict(spark.conf.getAll)
    s = spark.range(12_000).select((F.col("id") % 9_000).alias("k"), F.when(F.col("id") % 7 != 0, F.col("id") % 9_000 * 3).alias("x"))
    t = s.where("k % 11 <> 0").unionByName(s.where("k % 13 = 0"))
    got = {(r.k, r.x): (r.source_count, r.target_count) for r in sketchdiff.row_sketch_diff(s, t, cells=64, most_cells=64).collect()}
    left, right = (Counter(map(tuple, df.collect())) for df in (s, t))
    assert got == {r: (left[r], right[r]) for r in left | right if left[r] != right[r]}
    rows = sum(left.values()) + sum(right.values())
    (plan,) = plans
    assert "SortMergeJoin" not in plan
    assert [int(n) for n in re.findall(r"hashpartitioning\(_h1#\d+L, _h2#\d+L, (\d+)\)", plan)] == [-(-rows // 1000)]
    assert dict(spark.conf.getAll) == before  # the caller's settings stay
