"""Every registered query against its DuckDB twin at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry_mod
from oracle_check import compare, duck, type_mismatches

SF = "/root/testdata/sf0.01"
ORACLE = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    problem = compare(df, con, ORACLE[name])
    assert problem is None, f"{name}: {problem}"
    assert type_mismatches(df, con, ORACLE[name]) == []


def test_every_query_has_a_twin():
    """All but the queries of the optional parts, which are tested in a folder of their own."""
    from concord.plans import catalog
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


def test_ingest_prefix_lists_every_file(spark):
    import os

    from concord.sources.files import ingest_prefix
    got = sorted((r.relative_path, r.length) for r in ingest_prefix(spark, SF).select("relative_path", "length").collect())
    want = sorted((f, os.path.getsize(os.path.join(SF, f))) for f in os.listdir(SF))
    assert got == want


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["segment", "revenue", "order_count"]


@pytest.mark.skipif(not __import__("os").environ.get("CONCORD_ALL_SCALES"), reason="set CONCORD_ALL_SCALES=1")
@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_every_query_matches_duckdb_at_other_scales(spark, sf):
    con = duck(sf)
    bad = {}
    for name, sql in ORACLE.items():
        df = entry_mod.queries()[name](spark, sf)
        problem = compare(df, con, sql) or (type_mismatches(df, con, sql) or None)
        if problem:
            bad[name] = problem
    assert bad == {}
