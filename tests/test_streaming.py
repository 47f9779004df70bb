"""Incremental fingerprint: the streamed state equals the batch fingerprint after each new file."""

import os
import shutil
import tempfile

from concord.operators import fingerprint as fp
from concord.streaming.fingerprint import maintain_fingerprint, read_fingerprint

SF001 = "/root/testdata/sf0.001"


def test_stream_fingerprint_matches_batch_after_each_arrival(spark):
    base = tempfile.mkdtemp(prefix="concord-stream-", dir="/tmp")
    src, out, ckpt = os.path.join(base, "in"), os.path.join(base, "fp"), os.path.join(base, "ckpt")
    os.makedirs(src)
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    keys, cols = ["o_orderstatus"], ["o_orderkey", "o_totalprice"]
    halves = orders.randomSplit([0.5, 0.5], seed=7)
    for i, part in enumerate(halves):
        part.write.mode("overwrite").parquet(os.path.join(base, f"stage{i}"))
        for f in os.listdir(os.path.join(base, f"stage{i}")):
            if f.endswith(".parquet"):
                shutil.copy(os.path.join(base, f"stage{i}", f), os.path.join(src, f"b{i}-{f}"))
        q = maintain_fingerprint(spark, src, orders.schema, keys, cols, out, f"fp_test_{i}", checkpoint_location=ckpt)
        q.awaitTermination(120)
        seen = spark.read.parquet(*[os.path.join(base, f"stage{j}") for j in range(i + 1)])
        diffs = fp.compare_fingerprints(read_fingerprint(spark, out), fp.group_fingerprint(seen, keys, cols),
                                        "stream", "batch", keys, cols)
        assert diffs.count() == 0
    assert read_fingerprint(spark, out).count() == orders.select("o_orderstatus").distinct().count()


def test_update_mode_merges_only_changed_keys(spark):
    base = tempfile.mkdtemp(prefix="concord-stream2-", dir="/tmp")
    src, out, ckpt = os.path.join(base, "in"), os.path.join(base, "fp"), os.path.join(base, "ckpt")
    os.makedirs(src)
    orders = spark.read.parquet(f"{SF001}/orders.parquet")
    keys, cols = ["o_custkey"], ["o_totalprice"]
    parts = orders.randomSplit([0.4, 0.3, 0.3], seed=11)
    for i, part in enumerate(parts):
        stage = os.path.join(base, f"stage{i}")
        part.write.mode("overwrite").parquet(stage)
        for f in os.listdir(stage):
            if f.endswith(".parquet"):
                shutil.copy(os.path.join(stage, f), os.path.join(src, f"b{i}-{f}"))
        maintain_fingerprint(spark, src, orders.schema, keys, cols, out, f"fp_cust_{i}",
                             checkpoint_location=ckpt).awaitTermination(120)
    batch = fp.group_fingerprint(orders, keys, cols)
    assert fp.compare_fingerprints(read_fingerprint(spark, out), batch, "s", "b", keys, cols).count() == 0
    assert read_fingerprint(spark, out).count() == orders.select("o_custkey").distinct().count()


def test_a_failing_read_raises_and_a_replay_keeps_every_key(spark, tmp_path):
    import pytest

    from concord.streaming.fingerprint import latest_version

    out, src, ckpt = str(tmp_path / "fp"), tmp_path / "in", str(tmp_path / "ckpt")
    assert latest_version(spark, out) is None  # no folder yet
    src.mkdir()
    schema = "k string, v double"
    shape = spark.createDataFrame([], schema).schema

    def run(name):
        maintain_fingerprint(spark, str(src), shape, ["k"], ["v"], out, f"replay_{name}", checkpoint_location=ckpt).awaitTermination(120)

    def arrive(name, rows):
        stage = str(tmp_path / f"stage-{name}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(stage)
        for f in os.listdir(stage):
            if f.endswith(".parquet"):
                shutil.copy(os.path.join(stage, f), str(src / f"{name}-{f}"))
        run(name)

    def state():
        return {r.k: float(r._s0) for r in read_fingerprint(spark, out).collect()}

    arrive("one", [("a", 1.0), ("b", 2.0)])
    arrive("two", [("b", 3.0), ("c", 4.0)])
    assert latest_version(spark, out)[0] == 1 and latest_version(spark, out, below=1)[0] == 0
    # a version that was interrupted before it was published is not seen
    spark.range(1).write.parquet(os.path.join(out, "versions", "2-broken"))
    assert latest_version(spark, out)[0] == 1
    arrive("three", [("d", 5.0)])
    want = {"a": 1.0, "b": 5.0, "c": 4.0, "d": 5.0}
    assert state() == want and latest_version(spark, out)[0] == 2
    # the last batch was published but not committed: it runs again from the version before it
    for name in ("2", ".2.crc"):
        os.remove(os.path.join(ckpt, "commits", name))
    run("again")
    assert state() == want and latest_version(spark, out)[0] == 2
    # a reader that cannot read must not take that for "no version yet"
    folder = tmp_path / "fp" / "published" / "2"
    part = next(f for f in folder.iterdir() if f.name.startswith("part-"))
    part.write_bytes(b"not a version line\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE|not enough values|invalid literal"):
        latest_version(spark, out)
