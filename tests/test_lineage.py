"""Lineage (L1-L4) on fixed small graphs (fixed values: the tables and units of the first four tests) and on random ones."""

import random

import pytest
from pyspark.sql import functions as F

from concord.functions.stored import roomy
from concord.operators import lineage as lin


def units(spark, rows):
    return spark.createDataFrame([(str(i), i, s, t) for i, (s, t) in enumerate(rows, 1)], lin.UNITS_SCHEMA)


def stages(spark, rows):
    return {r.table_name: (r.stage, r.in_cycle) for r in lin.compute_stages(units(spark, rows)).collect()}


def test_parallel_chains(spark):
    got = stages(spark, [(["raw_a"], ["stg_a"]), (["raw_b"], ["stg_b"]), (["raw_c"], ["stg_c"])])
    assert {t: s for t, (s, _) in got.items()} == {"raw_a": 0, "raw_b": 0, "raw_c": 0, "stg_a": 1, "stg_b": 1, "stg_c": 1}


def test_multi_hop_and_fan_in(spark):
    assert {t: s for t, (s, _) in stages(spark, [(["raw"], ["stg"]), (["stg"], ["fact"])]).items()} == \
        {"raw": 0, "stg": 1, "fact": 2}
    got = stages(spark, [(["raw_orders"], ["stg_orders"]), (["raw_customers"], ["stg_customers"]),
                         (["stg_orders", "stg_customers"], ["fact_orders"])])
    assert got["fact_orders"] == (2, False)


def test_no_source_target_and_self_loop(spark):
    assert stages(spark, [([], ["standalone"])]) == {"standalone": (1, False)}
    assert stages(spark, [(["t"], ["t"])]) == {"t": (1, False)}


def test_empty_input(spark):
    assert stages(spark, []) == {}


def plain_stages(rows):
    """Stages and cycles by closing the graph in memory."""
    edges = {(a, b) for sources, targets in rows for a in sources for b in targets if a != b}
    produced = {b for _, targets in rows for b in targets}
    tables = produced | {a for sources, _ in rows for a in sources}
    reach = {t: {b for a, b in edges if a == t} for t in tables}
    changed = True
    while changed:
        changed = False
        for t in tables:
            more = set().union(*[reach[x] for x in reach[t]]) - reach[t] if reach[t] else set()
            if more:
                reach[t] |= more
                changed = True
    cycle = {t: min({t} | {x for x in reach[t] if t in reach[x]}) for t in tables if t in reach[t]}
    node = lambda t: cycle.get(t, t)
    stage = {}

    def of(n):
        if n not in stage:
            members = [t for t in tables if node(t) == n]
            before = {node(a) for a, b in edges if node(b) == n and node(a) != n}
            stage[n] = max([1 + of(x) for x in before], default=1 if produced & set(members) else 0)
        return stage[n]

    return {t: (of(node(t)), t in cycle, cycle.get(t)) for t in tables}


def staged(spark, rows):
    return {r.table_name: (r.stage, r.in_cycle, r.cycle) for r in lin.staged(units(spark, rows)).collect()}


def test_cycles_and_what_hangs_behind_them(spark):
    got = staged(spark, [(["a"], ["b"]), (["b"], ["a"]), (["root"], ["c"]), (["a", "c"], ["d"]), (["d"], ["e"])])
    assert got == {"a": (1, True, "a"), "b": (1, True, "a"), "root": (0, False, None), "c": (1, False, None),
                   "d": (2, False, None), "e": (3, False, None)}


CYCLIC = [
    [(["x"], ["y"]), (["y"], ["z"]), (["z"], ["x"]), (["r"], ["y"])],  # a ring that is fed
    [(["a"], ["b"]), (["b"], ["c"]), (["c"], ["b"]), (["c"], ["d"]), (["d"], ["e"]), (["e"], ["d"]), (["b", "e"], ["f"])],  # two in a row
    [(["m"], ["p1"]), (["p1"], ["p2"]), (["p2"], ["m"]), (["m"], ["q1"]), (["q1"], ["m"]), (["q1"], ["side"]), (["side"], ["end"])],  # two loops, one table
    [(["a", "b"], ["a", "b", "c"]), (["c"], ["c"])],  # a unit with several targets
    [([], ["n"]), (["n", "u"], ["v"]), (["v"], ["u"])],  # fed by a table made from nothing
]


@pytest.mark.parametrize("rows", CYCLIC)
def test_cyclic_graphs(spark, rows):
    assert staged(spark, rows) == plain_stages(rows)


@pytest.mark.parametrize("seed", range(2))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    names = [f"t{i:02}" for i in range(24)]
    rows = [([rng.choice(names) for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))], [rng.choice(names)]) for _ in range(30)]
    assert staged(spark, rows) == plain_stages(rows)


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """A chain of 10,000 tables, and one with a loop at its head, by pointer doubling."""
    from concord.operators import chains
    spans = []
    real = chains.stored
    monkeypatch.setattr(chains, "stored", lambda df, label: spans.append(label) or real(df, label))
    u = spark.range(10_000).select(F.col("id").cast("string").alias("unit_id"), F.col("id").alias("unit_order"),
                                   F.array(F.format_string("t%05d", "id")).alias("sources"), F.array(F.format_string("t%05d", F.col("id") + 1)).alias("targets"))
    got = lin.compute_stages(u)
    assert got.where("CAST(substr(table_name, 2) AS INT) <> stage OR in_cycle").count() == 0 and got.count() == 10_001
    assert len(spans) <= 16
    back = spark.createDataFrame([("back", 0, ["t00003"], ["t00000"])], lin.UNITS_SCHEMA)
    got = {r.table_name: (r.stage, r.in_cycle) for r in lin.compute_stages(u.unionByName(back)).collect()}
    assert got == {f"t{i:05}": (1, True) if i <= 3 else (i - 2, False) for i in range(10_001)}


def test_a_row_of_diamonds_is_contracted(spark):
    rows = []
    for i in range(40):
        rows += [([f"d{i:02}"], [f"l{i:02}"]), ([f"d{i:02}"], [f"r{i:02}"]), ([f"l{i:02}", f"r{i:02}"], [f"d{i + 1:02}"])]
    got = stages(spark, rows)
    assert all(got[f"d{i:02}"] == (2 * i, False) for i in range(41)) and got["l07"] == (15, False)


def test_edges_roots_and_unmapped(spark):
    u = units(spark, [(["raw", "raw"], ["stg"]), (["stg", "dim"], ["fact"])])
    edges = sorted((r.source, r.target, r.unit_id) for r in lin.build_edges(u).collect())
    assert edges == [("dim", "fact", "2"), ("raw", "stg", "1"), ("stg", "fact", "2")]
    assert sorted(r.table_name for r in lin.external_roots(u).collect()) == ["dim", "raw"]
    mapping = spark.createDataFrame([("raw",)], "source_table string")
    assert [r.table_name for r in lin.unmapped_sources(u, mapping).collect()] == ["dim"]
    by_stage = {r.stage: r.n_tables for r in lin.tables_by_stage(lin.compute_stages(u)).collect()}
    assert by_stage == {0: 2, 1: 1, 2: 1}


def test_a_deep_chain_is_not_a_cycle(spark):
    got = stages(spark, [([f"t{i}"], [f"t{i + 1}"]) for i in range(7)])
    assert got == {f"t{i}": (i, False) for i in range(8)}


def test_rounds_do_not_shuffle_the_edges_again(spark):
    """The edge table stays partitioned: joining it adds an exchange on the frontier's side only."""
    edges = spark.createDataFrame([("a", "b", 0), ("b", "c", 0)], "source string, table_name string, salt int")
    kept = lin._kept_partitioned(edges, "source", "salt")
    front = spark.createDataFrame([("a", 0)], "source string, salt int")
    plan = kept.join(front.hint("merge"), ["source", "salt"])._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = kept.join(front.hint("merge"), ["source", "salt"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("Exchange hashpartitioning") == 1
    joined = kept.join(front.hint("merge"), ["source", "salt"])
    assert joined.count() == 1
    joined = kept.join(front.hint("merge"), ["source", "salt"])
    joined.collect()
    final = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1


def test_stage_listing(spark):
    u = units(spark, [(["raw"], ["stg"]), (["stg", "raw"], ["fact"])])
    got = sorted(map(tuple, lin.stage_listing(u).collect()), key=repr)
    assert got == sorted([(0, "raw", None, None), (1, "stg", "raw", "1"), (2, "fact", "stg", "2"), (2, "fact", "raw", "2")], key=repr)


def test_hot_source_is_salted_and_stages_unchanged(spark):
    # one source feeds 300 of 301 tables: it is hot for any hot_share above 1
    rows = [(["hub"], [f"t{i}"]) for i in range(300)] + [(["other"], ["u"]), ([f"t{i}" for i in range(3)], ["top"])]
    u = units(spark, rows)
    got = {r.table_name: r.stage for r in lin.compute_stages(u, hot_share=10, salts=4).collect()}
    assert got["hub"] == 0 and got["t7"] == 1 and got["u"] == 1 and got["top"] == 2
    assert got == {r.table_name: r.stage for r in lin.compute_stages(u, hot_share=1, salts=1).collect()}


def test_tables_that_feed_nothing_are_peeled_before_the_rounds(spark, monkeypatch):
    """A wide graph three levels deep, with a cycle: only the cycle is left for the rounds, and the stages are those of all tables."""
    rows = [("s", 1, ["root"], ["a"]), ("x", 2, ["a", "y"], ["x"]), ("y", 3, ["x"], ["y"]), ("self", 4, ["self"], ["self"]), ("none", 5, [], ["none"]),
            ("mix", 6, ["self", "none", "root"], ["mix"])]
    for i in range(40):
        rows += [(f"m{i}", 10, ["x" if i % 2 else "a", "root"], [f"m{i}"]), (f"l{i}", 11, [f"m{i}", f"m{(i + 1) % 40}", "root"], [f"l{i}"])]
    rounds = []

    def seen(edges, *rest, run=lin.longest_paths):
        rounds.append(edges.count())
        return run(edges, *rest)

    monkeypatch.setattr(lin, "longest_paths", seen)
    got = {r["table_name"]: (r["stage"], r["cycle"]) for r in lin.staged(spark.createDataFrame(rows, lin.UNITS_SCHEMA)).collect()}
    assert max(rounds) <= 4  # of 210 edges
    want = {"root": (0, None), "a": (1, None), "x": (2, "x"), "y": (2, "x"), "self": (1, None), "none": (1, None), "mix": (2, None)}
    want |= {f"m{i}": (3 if i % 2 else 2, None) for i in range(40)} | {f"l{i}": (4, None) for i in range(40)}
    assert got == want


def test_partitions_of_shuffles_follow_the_rows(spark, monkeypatch):
    key, before = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", spark.conf.getAll
    assert roomy(spark, 10) is spark
    own = roomy(spark, 10**9)
    assert int(own.conf.get(key)) == 2000
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert spark.conf.getAll == before
