"""Property tests: the Spark operators against brute-force Python on random small tables."""

import os
from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from concord.operators import fingerprint as fp
from concord.operators import rowdiff

KEYS = st.sampled_from([None, "a", "b", "None", ""])
VALS = st.one_of(st.none(), st.integers(min_value=-50, max_value=50).map(lambda x: Decimal(x) / 4))
ROWS = st.lists(st.tuples(KEYS, VALS), max_size=12)
# Deterministic by default (same examples every run); CONCORD_EXAMPLES=N runs N random ones.
EXAMPLES = os.environ.get("CONCORD_EXAMPLES")
SETTINGS = settings(max_examples=int(EXAMPLES or 25), deadline=None, derandomize=not EXAMPLES,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_group_diffs(a, b):
    def fp_of(rows):
        g = {}
        for k, v in rows:
            n, s = g.get(k, (0, Decimal(0)))
            g[k] = (n + 1, s + (v or Decimal(0)))
        return g
    ga, gb = fp_of(a), fp_of(b)
    out = set()
    for k in set(ga) | set(gb):
        na, sa = ga.get(k, (None, None))
        nb, sb = gb.get(k, (None, None))
        if (na or 0) != (nb or 0):
            out.add(("group_count", k))
        if (sa or 0) != (sb or 0):
            out.add(("group_sum", k))
    return out


@SETTINGS
@given(ROWS, ROWS)
def test_group_differences_match_brute_force(spark, a, b):
    schema = "k string, v decimal(10,2)"
    got = fp.compare(fp.Pair("a", "b", spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)), keys=["k"])
    groups = {(r.check, r.group_key) for r in got.collect() if r.check.startswith("group_")}
    assert groups == brute_group_diffs(a, b)
    totals = {r.check for r in got.collect() if not r.check.startswith("group_")}
    assert ("count" in totals) == (len(a) != len(b))


@SETTINGS
@given(ROWS, ROWS)
def test_row_multiset_diff_matches_counter(spark, a, b):
    schema = "k string, v decimal(10,2)"
    got = {(r.k, r.v): (r.source_count, r.target_count) for r in rowdiff.row_multiset_diff(
        spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).collect()}
    ca, cb = Counter(a), Counter(b)
    want = {row: (ca[row], cb[row]) for row in set(ca) | set(cb) if ca[row] != cb[row]}
    assert got == want


def parity_split(text: str) -> list[str]:
    """Independent brute force: a ';' ends a statement when an even number of quotes precede it
    in the current statement; pieces are stripped, blanks dropped, the tail kept."""
    out, buf, quotes = [], [], 0
    for ch in text:
        if ch == ";" and quotes % 2 == 0:
            piece = "".join(buf).strip()
            if piece:
                out.append(piece)
            buf, quotes = [], 0
            continue
        buf.append(ch)
        quotes += ch == "'"
    tail = "".join(buf).strip()
    if tail:
        out.append(tail)
    return out


@SETTINGS
@given(st.text(alphabet="ab ;'\n\t", max_size=40))
def test_split_units_matches_quote_parity(spark, text):
    from concord.operators import scripts as scr
    df = spark.createDataFrame([("s", text)], "script_id string, sql string")
    got = [r.statement for r in scr.split_units(df).orderBy("unit_id").collect()]
    assert got == parity_split(text)


def brute_stages(units):
    produced = {}
    for sources, targets in units:
        for t in targets:
            produced.setdefault(t, []).extend(s for s in sources if s != t)
    tables = {x for s, t in units for x in s + t}
    memo = {}

    def stage(t):
        if t not in memo:
            memo[t] = 0 if t not in produced else max((1 + stage(s) for s in produced[t]), default=1)
        return memo[t]
    return {t: stage(t) for t in tables}


DAG_UNITS = st.lists(
    st.tuples(st.lists(st.integers(0, 9), max_size=3), st.lists(st.integers(0, 9), min_size=1, max_size=2)),
    max_size=8,
).map(lambda us: [([f"t{s}" for s in src if all(s <= t for t in tgt)], [f"t{t}" for t in tgt]) for src, tgt in us])


@SETTINGS
@given(DAG_UNITS)
def test_lineage_stages_match_brute_force(spark, units):
    from concord.operators import lineage as lin
    df = spark.createDataFrame([(str(i), i, s, t) for i, (s, t) in enumerate(units)], lin.UNITS_SCHEMA)
    got = {r.table_name: r.stage for r in lin.compute_stages(df, hot_share=2, salts=3).collect()}
    assert got == brute_stages(units)


def brute_replay(costs, outcomes, max_it, min_pct, streak):
    if outcomes[0] == "execution_failed":
        return 0, "baseline_execution_failed", costs[0]
    cur, flat = (0 if outcomes[0] == "estimate_failed" else costs[0]), 0
    last = min(max_it, len(costs) - 1)
    for i in range(1, last + 1):
        if outcomes[i] != "ok":
            return i, outcomes[i], cur
        m = (cur - costs[i]) / cur * 100 if cur > 0 else 0.0
        if costs[i] < cur:
            cur = costs[i]
        if m < min_pct:
            flat += 1
            if flat >= streak:
                return i, "diminishing_returns", cur
        else:
            flat = 0
    return last, "max_iterations", cur


HISTORY = st.lists(st.tuples(st.integers(0, 200), st.sampled_from(
    ["ok"] * 6 + ["llm_error", "estimate_failed", "execution_failed", "validation_failed"])), min_size=1, max_size=7)


@SETTINGS
@given(HISTORY, st.integers(0, 5), st.sampled_from([0.0, 2.0, 10.0]), st.integers(1, 3))
def test_history_replay_matches_the_loop_rules(spark, hist, max_it, min_pct, streak):
    from concord.operators import cost as cst
    rows = [(1, i, c, o) for i, (c, o) in enumerate(hist)]
    h = spark.createDataFrame(rows, "query_id long, iteration int, estimated_bytes long, outcome string")
    r = cst.replay_history(h, max_iterations=max_it, min_improvement_pct=min_pct, streak=streak)
    s = cst.history_summary(r).first()
    stop_it = r.first().stop_iteration
    want = brute_replay([c for c, _ in hist], [o for _, o in hist], max_it, min_pct, streak)
    assert (stop_it, s.stop_reason, s.final_bytes) == want
