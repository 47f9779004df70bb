"""Hash trees of stored tables: equal to the flat comparison, reading only what changed."""

import random

import pytest
from pyspark.sql import functions as F

from concord.operators import hashtree, rowdiff

SCHEMA = "k long, s string, x double"


def stored(spark, path, rows, files=8, by="k"):
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartitionByRange(files, by).write.parquet(str(path))
    return str(path)


def some(n, seed=1):
    rng = random.Random(seed)
    return [(rng.choice([i, i, i, -i, None]), rng.choice(["a", "", None, "ü"]), float(i % 9)) for i in range(n)]


def text(df):
    return sorted(map(str, df.collect()))


def check(spark, a, b):
    flat = [spark.read.parquet(t.table) for t in (a, b)]
    want = text(rowdiff.row_multiset_diff(*flat))
    assert text(hashtree.row_diff(a, b)) == want
    assert text(hashtree.key_diff(a, b, ["x"])) == text(rowdiff.direct_key_diff(*flat, a.key, ["x"]))
    return want


@pytest.mark.parametrize("key", ["k", "s"])
def test_equal_to_the_flat_diff(spark, tmp_path, key):
    rows = some(3000)
    changed = [r for i, r in enumerate(rows) if i % 400] + [(5, "new", 1.0), (None, None, None), (10**15, "far", 2.0)]
    a = hashtree.build(spark, stored(spark, tmp_path / "a", rows), str(tmp_path / "t"), key, leaf_rows=32)
    b = hashtree.build(spark, stored(spark, tmp_path / "b", changed, 5), str(tmp_path / "t"), key, like=a, leaf_rows=32)
    assert check(spark, a, b)
    assert check(spark, a, a) == []


def test_empty_tables_and_a_dense_range(spark, tmp_path):
    dense = [(i % 4, "d", float(i)) for i in range(600)] + [(10**6 + i, "s", 0.0) for i in range(50)]
    a = hashtree.build(spark, stored(spark, tmp_path / "a", dense), str(tmp_path / "t"), "k", leaf_rows=16)
    assert a.leaves.where(F.col("part") >= 0).count() > 0  # the crowded range is split
    b = hashtree.build(spark, stored(spark, tmp_path / "b", dense[1:]), str(tmp_path / "t"), "k", like=a, leaf_rows=16)
    assert len(check(spark, a, b)) == 1
    none = hashtree.build(spark, stored(spark, tmp_path / "n", []), str(tmp_path / "t"), "k", like=a)
    assert len(check(spark, a, none)) == len(set(dense)) and len(check(spark, none, a)) == len(set(dense))


def test_refresh_reads_only_what_changed(spark, tmp_path):
    rows = [(i, "r", float(i % 9)) for i in range(4000)]
    a = hashtree.build(spark, stored(spark, tmp_path / "a", rows), str(tmp_path / "t"), "k", leaf_rows=64)
    b = hashtree.build(spark, stored(spark, tmp_path / "b", rows), str(tmp_path / "t"), "k", like=a, leaf_rows=64)
    assert a.files_read == 8 and a.rows_read == 4000
    spark.createDataFrame([(100 + i, "more", 1.0) for i in range(30)], SCHEMA).coalesce(1).write.mode("append").parquet(b.table)
    again = hashtree.refresh(b, 64)
    assert (again.files_read, again.rows_read) == (1, 30)
    assert len(check(spark, a, again)) == 30
    same = hashtree.refresh(again, 64)
    assert (same.files_read, same.rows_read) == (0, 0) and len(check(spark, a, same)) == 30
    # the differences are looked for in the files of their ranges only
    bad, n = hashtree.differing_ranges(a, again)
    part, files = hashtree.narrowed(a, bad, n)
    assert files == 1 and 30 <= part.count() < 400
    # a file that is written anew is read anew, one that is gone takes its rows along
    import os
    name = sorted(f for f in os.listdir(b.table) if f.endswith(".parquet"))[0]
    old = spark.read.parquet(f"{b.table}/{name}").collect()
    fresh = spark.createDataFrame([(r.k, "w", r.x) for r in old], SCHEMA).coalesce(1)
    fresh.write.parquet(str(tmp_path / "one"))
    made = [f for f in os.listdir(tmp_path / "one") if f.endswith(".parquet")][0]
    os.replace(tmp_path / "one" / made, f"{b.table}/{name}")
    crc = f"{b.table}/.{name}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    spark.catalog.clearCache()
    third = hashtree.refresh(again, 64)
    assert (third.files_read, third.rows_read) == (1, len(old))
    check(spark, a, third)


def test_names_that_need_encoding_and_retyped_columns(spark, tmp_path):
    rows = [(i, "r", float(i % 9)) for i in range(500)]
    a_path = stored(spark, tmp_path / "a b+c%d", rows)
    other = spark.read.parquet(a_path).select(F.col("k").cast("decimal(20,0)").alias("K"), "s", F.when(F.col("k") == 7, 0.5).otherwise(F.col("x")).alias("x"))
    other.write.parquet(str(tmp_path / "b"))
    types = {f.name: f.dataType for f in other.schema}
    a = hashtree.build(spark, a_path, str(tmp_path / "t"), "k", other=types, leaf_rows=32)
    assert hashtree.refresh(a, 32).files_read == 0
    b = hashtree.build(spark, str(tmp_path / "b"), str(tmp_path / "t"), "K", like=a, leaf_rows=32)
    assert len(check(spark, a, b)) == 2
    plain = hashtree.build(spark, a_path, str(tmp_path / "t"), "k")
    with pytest.raises(ValueError, match="no common type"):
        hashtree.build(spark, str(tmp_path / "b"), str(tmp_path / "t"), "K", like=plain)
    with pytest.raises(ValueError, match="unlike shape"):
        hashtree.differing_ranges(plain, a)
