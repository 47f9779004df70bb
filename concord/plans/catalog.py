"""Registered queries and their DuckDB twins.

Each entry of ``QUERIES`` takes ``(spark, sf_dir)`` and returns a lazy
DataFrame over the whole driver tables. ``ORACLE`` holds, for the same key, an
SQL text DuckDB runs on the same parquet files; column names are aliased alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.plans import workload
from concord.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


# ---------------------------------------------------------------- demo workload

@register("segment_revenue_last_day", """
WITH daily_revenue AS (
  SELECT o.o_custkey AS customer_id, c.c_mktsegment AS segment, CAST(o.o_orderdate AS DATE) AS order_day,
         SUM(COALESCE(CAST(COALESCE(o.o_totalprice, 0.0) AS DECIMAL(38,6)), 0)) AS revenue,
         COUNT(*) AS order_count
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE o.o_orderdate = (SELECT MAX(o_orderdate) FROM orders)
  GROUP BY 1, 2, 3)
SELECT segment, CAST(SUM(revenue) AS DECIMAL(38,6)) AS revenue, CAST(SUM(order_count) AS BIGINT) AS order_count
FROM daily_revenue GROUP BY segment
""")
def q_segment_revenue_last_day(spark: SparkSession, sf: str) -> DataFrame:
    return workload.segment_revenue_last_day(read_table(spark, sf, "orders"), read_table(spark, sf, "customer"))


@register("daily_revenue_stage", """
SELECT o.o_custkey AS customer_id, c.c_mktsegment AS segment, CAST(o.o_orderdate AS DATE) AS order_day,
       SUM(COALESCE(CAST(COALESCE(o.o_totalprice, 0.0) AS DECIMAL(38,6)), 0)) AS revenue,
       COUNT(*) AS order_count
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
GROUP BY 1, 2, 3
""")
def q_daily_revenue_stage(spark: SparkSession, sf: str) -> DataFrame:
    return workload.daily_revenue(read_table(spark, sf, "orders"), read_table(spark, sf, "customer"))


PARAM_FILTER_SQL = """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n_lines,
       SUM(CAST(l_quantity AS DECIMAL(38,6))) AS sum_qty,
       SUM(CAST(l_extendedprice AS DECIMAL(38,6))) AS sum_price
FROM {lineitem}
WHERE l_shipdate >= {start} AND l_discount <= {max_discount}
GROUP BY l_returnflag, l_linestatus
"""


@register("param_filter", PARAM_FILTER_SQL.format(start="TIMESTAMP '1995-01-01 00:00:00'", max_discount="0.05",
                                                  lineitem="lineitem"))
def q_param_filter(spark: SparkSession, sf: str) -> DataFrame:
    import datetime as dt
    # Named parameters keep their types; the table is bound as a DataFrame, not a global view.
    text = PARAM_FILTER_SQL.format(start=":start", max_discount=":max_discount", lineitem="{lineitem}")
    return spark.sql(text, args={"start": dt.datetime(1995, 1, 1), "max_discount": 0.05},
                     lineitem=read_table(spark, sf, "lineitem"))


# ---------------------------------------------------------------- reconciliation

from concord.operators import fingerprint as fp  # noqa: E402
from concord.functions.stored import roomy, stored, stored_path  # noqa: E402
from concord.operators import hashtree, rowdiff, sketchdiff  # noqa: E402
from concord.plans import drift, twins  # noqa: E402

ORDERS_NUM = ["o_orderkey", "o_custkey", "o_totalprice"]
LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINEITEM_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                "l_discount", "l_tax"]


def _with_drift(sql: str) -> str:
    return f"WITH {drift.DRIFT_CTES}\nSELECT * FROM (\n{sql}\n) AS q"


def _pairs(spark: SparkSession, sf: str, names: list[tuple[str, str]]) -> list[fp.Pair]:
    base = {n: read_table(spark, sf, n) for n in {"orders", "lineitem", "customer", "part", "supplier",
                                                  "nation", "region"}}
    derived = {"orders_tgt": lambda: drift.orders_tgt(base["orders"]),
               "orders_comp": lambda: drift.orders_comp(base["orders"]),
               "lineitem_tgt": lambda: drift.lineitem_tgt(base["lineitem"])}
    get = lambda n: base[n] if n in base else derived[n]()
    return [fp.Pair(s, t, get(s), get(t)) for s, t in names]


PARITY_PAIRS = [("orders", "orders_tgt"), ("lineitem", "lineitem_tgt"), ("orders", "orders_comp"),
                ("customer", "customer"), ("part", "part"), ("supplier", "supplier"), ("nation", "nation"),
                ("region", "region")]


@register("rowcount_parity", _with_drift("\nUNION ALL\n".join(
    f"SELECT '{s}' AS source, '{t}' AS target, (SELECT COUNT(*) FROM {s}) AS source_rows, "
    f"(SELECT COUNT(*) FROM {t}) AS target_rows, (SELECT COUNT(*) FROM {s}) = (SELECT COUNT(*) FROM {t}) AS matched"
    for s, t in PARITY_PAIRS)))
def q_rowcount_parity(spark: SparkSession, sf: str) -> DataFrame:
    return fp.rowcount_parity(_pairs(spark, sf, PARITY_PAIRS))


@register("numeric_sums", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null, "
    f"COALESCE(SUM(CAST({c} AS DECIMAL(38,6))), 0) AS value_sum, CAST(0 AS BIGINT) AS n_special, COUNT({c}) = 0 AS all_null "
    f"FROM lineitem"
    for c in LINEITEM_NUM))
def q_numeric_sums(spark: SparkSession, sf: str) -> DataFrame:
    return fp.numeric_sums(read_table(spark, sf, "lineitem"))


@register("group_fingerprint", "WITH g AS (" + twins.group_agg_sql("orders", ["o_orderstatus"], ORDERS_NUM, "") + ")\n"
          + "SELECT CAST(k0 AS VARCHAR) AS group_key, CAST(NULL AS VARCHAR) AS column_name, n AS row_count, "
            "CAST(n AS DECIMAL(38,6)) AS value_sum FROM g\n"
          + "".join(f"UNION ALL SELECT CAST(k0 AS VARCHAR), '{c}', n, s{i} FROM g\n" for i, c in enumerate(ORDERS_NUM)))
def q_group_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return fp.fingerprint_long(read_table(spark, sf, "orders"))


@register("fingerprint_diff", _with_drift(twins.fingerprint_diff_sql("orders", "orders_tgt", ["o_orderstatus"], ORDERS_NUM)))
def q_fingerprint_diff(spark: SparkSession, sf: str) -> DataFrame:
    return fp.compare(_pairs(spark, sf, [("orders", "orders_tgt")])[0])


def _verdict_sql(pairs: list[tuple[str, str, list[str], list[str]]]) -> str:
    counts = "\nUNION ALL\n".join(
        f"SELECT '{s}' AS source, '{t}' AS target, (SELECT COUNT(*) FROM ("
        f"{twins.fingerprint_diff_sql(s, t, k, c)}) AS d) AS n_diffs" for s, t, k, c in pairs)
    return _with_drift(
        f"SELECT source, target, n_diffs, CASE WHEN n_diffs = 0 THEN 'validated' ELSE 'flagged' END AS status,\n"
        f" CASE WHEN MAX(n_diffs) OVER () = 0 THEN 'validated' ELSE 'flagged' END AS batch_status\n"
        f"FROM (\n{counts}\n) AS v")


CLEAN_PAIR = [("orders", "orders", ["o_orderstatus"], ORDERS_NUM)]


@register("fingerprint_clean", _verdict_sql(CLEAN_PAIR))
def q_fingerprint_clean(spark: SparkSession, sf: str) -> DataFrame:
    pairs = _pairs(spark, sf, [("orders", "orders")])
    return fp.verdict(pairs, fp.reconcile(pairs))


BATCH_PAIRS = [("orders", "orders_tgt", ["o_orderstatus"], ORDERS_NUM),
               ("orders", "orders_comp", ["o_orderstatus"], ORDERS_NUM),
               ("lineitem", "lineitem_tgt", ["l_returnflag"], LINEITEM_NUM),
               ("customer", "customer", ["c_name"], ["c_custkey", "c_nationkey", "c_acctbal"]),
               ("part", "part", ["p_name"], ["p_partkey", "p_size", "p_retailprice"])]


@register("batch_verdict", _verdict_sql(BATCH_PAIRS))
def q_batch_verdict(spark: SparkSession, sf: str) -> DataFrame:
    pairs = _pairs(spark, sf, [(s, t) for s, t, _, _ in BATCH_PAIRS])
    return fp.verdict(pairs, fp.reconcile(pairs))


@register("bucket_drilldown", _with_drift(twins.key_diff_sql("orders", "orders_tgt", "o_custkey",
                                                              ["o_orderkey", "o_totalprice"])))
def q_bucket_drilldown(spark: SparkSession, sf: str) -> DataFrame:
    p = _pairs(spark, sf, [("orders", "orders_tgt")])[0]
    return rowdiff.bucket_drilldown(p.source, p.target, "o_custkey", ["o_orderkey", "o_totalprice"])


@register("row_hash_diff", _with_drift(twins.row_diff_sql("lineitem", "lineitem_tgt", LINEITEM_COLS)))
def q_row_hash_diff(spark: SparkSession, sf: str) -> DataFrame:
    p = _pairs(spark, sf, [("lineitem", "lineitem_tgt")])[0]
    return rowdiff.row_multiset_diff(p.source, p.target)


@register("row_sketch_diff", _with_drift(twins.row_diff_sql("lineitem", "lineitem_tgt", LINEITEM_COLS)))
def q_row_sketch_diff(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of ``row_hash_diff``, from sketches of the two tables."""
    p = _pairs(spark, sf, [("lineitem", "lineitem_tgt")])[0]
    return sketchdiff.row_sketch_diff(p.source, p.target)


ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("compensating_drift", _with_drift(
    "SELECT 'group_fingerprint' AS check, (SELECT COUNT(*) FROM ("
    + twins.fingerprint_diff_sql("orders", "orders_comp", ["o_orderstatus"], ORDERS_NUM) + ") AS a) AS n_diffs\n"
    "UNION ALL SELECT 'row_multiset', (SELECT COUNT(*) FROM ("
    + twins.row_diff_sql("orders", "orders_comp", ORDERS_COLS) + ") AS b)"))
def q_compensating_drift(spark: SparkSession, sf: str) -> DataFrame:
    p = _pairs(spark, sf, [("orders", "orders_comp")])[0]
    g = fp.compare(p).agg(F.count(F.lit(1)).alias("n_diffs")).select(F.lit("group_fingerprint").alias("check"), "n_diffs")
    r = rowdiff.row_multiset_diff(p.source, p.target).agg(F.count(F.lit(1)).alias("n_diffs")).select(
        F.lit("row_multiset").alias("check"), "n_diffs")
    return g.unionByName(r)


@register("sparse_sketch_diff", _with_drift(twins.row_diff_sql("orders", "orders_comp", ORDERS_COLS)))
def q_sparse_sketch_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Six changed rows in a whole table, from sketches whose size does not depend on it."""
    p = _pairs(spark, sf, [("orders", "orders_comp")])[0]
    return sketchdiff.row_sketch_diff(p.source, p.target)


def _filed(df: DataFrame, label: str) -> str:
    """Orders as Parquet files by ranges of the key."""
    path = stored_path(df.sparkSession, label)
    df.repartitionByRange(16, "o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(path)
    return path


def _orders_trees(spark: SparkSession, sf: str) -> tuple[hashtree.HashTree, hashtree.HashTree]:
    orders = read_table(spark, sf, "orders")
    trees = stored_path(spark, "trees")
    source = hashtree.build(spark, _filed(orders, "orders"), trees, "o_orderkey", leaf_rows=1 << 10)
    return source, hashtree.build(spark, _filed(drift.orders_comp(orders), "orders_comp"), trees, "o_orderkey", like=source, leaf_rows=1 << 10)


@register("tree_row_diff", _with_drift(twins.row_diff_sql("orders", "orders_comp", ORDERS_COLS)))
def q_tree_row_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Whole rows that differ between two stored tables, found down their hash trees."""
    return hashtree.row_diff(*_orders_trees(spark, sf))


_APPENDED_SQL = ("orders_more AS (SELECT * FROM orders_comp UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 5.0,\n"
                 " o_orderdate, o_orderpriority FROM orders WHERE o_custkey % 211 = 3)")


@register("tree_refresh_diff", f"WITH {drift.DRIFT_CTES},\n {_APPENDED_SQL}\nSELECT * FROM (\n"
          + twins.key_diff_sql("orders", "orders_more", "o_orderkey", ["o_custkey", "o_totalprice"]) + "\n) AS q")
def q_tree_refresh_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Per-key differences after a file was appended to one table: its tree is refreshed from that file alone."""
    source, target = _orders_trees(spark, sf)
    more = read_table(spark, sf, "orders").where("o_custkey % 211 = 3").withColumn("o_totalprice", F.col("o_totalprice") + 5.0)
    more.coalesce(1).write.mode("append").parquet(target.table)
    return hashtree.key_diff(source, hashtree.refresh(target), ["o_custkey", "o_totalprice"])


def _odd(spark: SparkSession, sf: str) -> fp.Pair:
    orders = read_table(spark, sf, "orders")
    side = lambda q: spark.sql(q.replace("FROM orders", "FROM {orders}"), orders=orders)
    return fp.Pair("odd", "odd_tgt", side(drift.ODD_SOURCE_SQL), side(drift.ODD_TARGET_SQL))


def _with_odd(sql: str) -> str:
    return f"WITH odd AS ({drift.ODD_SOURCE_SQL}),\n odd_tgt AS ({drift.ODD_TARGET_SQL})\nSELECT * FROM (\n{sql}\n) AS q"


@register("special_values_diff", _with_odd(twins.fingerprint_diff_sql(
    "odd", "odd_tgt", ["o_orderstatus"], ["o_orderkey", "o_custkey", "big_id", "x"], special=["x"])))
def q_special_values_diff(spark: SparkSession, sf: str) -> DataFrame:
    return fp.compare(_odd(spark, sf))


@register("special_drilldown", _with_odd(twins.key_diff_sql("odd", "odd_tgt", "o_custkey", ["big_id", "x"], special=["x"])))
def q_special_drilldown(spark: SparkSession, sf: str) -> DataFrame:
    p = _odd(spark, sf)
    return rowdiff.bucket_drilldown(p.source, p.target, "o_custkey", ["big_id", "x"])


@register("sparse_drilldown", _with_drift(twins.key_diff_sql("orders", "orders_comp", "o_orderkey", ["o_custkey", "o_totalprice"])))
def q_sparse_drilldown(spark: SparkSession, sf: str) -> DataFrame:
    """Six changed rows in a whole table: level 1 leaves a few of its buckets for level 2."""
    p = _pairs(spark, sf, [("orders", "orders_comp")])[0]
    return rowdiff.bucket_drilldown(p.source, p.target, "o_orderkey", ["o_custkey", "o_totalprice"])


def _retyped(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = read_table(spark, sf, "orders")
    return orders, spark.sql(drift.RETYPED_SQL.replace("FROM orders", "FROM {orders}"), orders=orders)


@register("retyped_row_diff", f"""WITH t AS ({drift.RETYPED_SQL}),
 a AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) * 100 AS price, o_orderdate,
              o_totalprice FROM orders),
 b AS (SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus,
              CAST(o_totalprice * 10000 AS BIGINT) AS price, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate FROM t),
 d AS (SELECT *, 1 AS s, 0 AS t FROM (SELECT o_orderkey, o_custkey, o_orderstatus, price, o_orderdate FROM a EXCEPT ALL SELECT * FROM b)
       UNION ALL SELECT *, 0, 1 FROM (SELECT * FROM b EXCEPT ALL SELECT o_orderkey, o_custkey, o_orderstatus, price, o_orderdate FROM a))
SELECT 'row' AS difference, CAST(NULL AS VARCHAR) AS column_name, CAST(o_orderkey AS VARCHAR) AS order_key,
       CAST(price AS DOUBLE) / 10000 AS price, CAST(s AS BIGINT) AS source_count, CAST(t AS BIGINT) AS target_count FROM d
UNION ALL SELECT 'missing_target', 'o_orderpriority', NULL, NULL, NULL, NULL
UNION ALL SELECT 'extra_target', 'o_flag', NULL, NULL, NULL, NULL""")
def q_retyped_row_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Against a copy with bigint as decimal and int, double as decimal, timestamp as date: only planted rows differ."""
    return rowdiff.row_report(*_retyped(spark, sf)).select(
        "difference", "column_name", F.get_json_object("row", "$.o_orderkey").alias("order_key"),
        F.get_json_object("row", "$.o_totalprice").cast("double").alias("price"), "source_count", "target_count")


# ---------------------------------------------------------------- schema audit

from concord.functions.types import type_family  # noqa: E402
from concord.operators import schema_audit as sa  # noqa: E402
from concord.plans import catalogs, jobs  # noqa: E402

AUDIT_COLUMNS = ["source_table", "target_table", "column_key", "source_column_name", "target_column_name",
                 "source_type_family", "target_type_family", "source_present", "target_present", "status", "severity", "notes"]


def _catalog(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace("FROM part", "FROM {part}"), part=read_table(spark, sf, "part"))


def _audit(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Catalogs held as data: information-schema rows of one table pair per part."""
    return jobs.run_catalog_audit(*[_catalog(spark, sf, q) for q in (catalogs.PAIRS_SQL, catalogs.SOURCE_SQL, catalogs.TARGET_SQL)],
                                  readable=_catalog(spark, sf, catalogs.READABLE_SQL))


@register("column_audit", f"SELECT {', '.join(AUDIT_COLUMNS)} FROM ({catalogs.AUDIT_SQL}) AS a")
def q_column_audit(spark: SparkSession, sf: str) -> DataFrame:
    return _audit(spark, sf)[0].select(*AUDIT_COLUMNS)


@register("table_verdict", f"""
SELECT source_table, target_table, COUNT(*) AS total_columns,
       COUNT(*) FILTER (WHERE severity = 'ok') AS compatible_columns,
       COUNT(*) FILTER (WHERE severity = 'warning') AS warning_columns,
       COUNT(*) FILTER (WHERE severity = 'error') AS error_columns,
       CASE WHEN COUNT(*) FILTER (WHERE severity = 'error') > 0 THEN 'blocked'
            WHEN COUNT(*) FILTER (WHERE severity = 'warning') > 0 THEN 'warning' ELSE 'compatible' END AS status
FROM ({catalogs.AUDIT_SQL}) AS a GROUP BY source_table, target_table""")
def q_table_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return _audit(spark, sf)[1]


@register("column_gate", f"""
SELECT source_table, target_table,
       COUNT(*) FILTER (WHERE status NOT IN ('compatible', 'compatible_with_warnings')) AS blocking_columns,
       COUNT(*) FILTER (WHERE status NOT IN ('compatible', 'compatible_with_warnings')) = 0 AS can_run
FROM ({catalogs.AUDIT_SQL}) AS a GROUP BY source_table, target_table""")
def q_column_gate(spark: SparkSession, sf: str) -> DataFrame:
    return sa.column_gate(_audit(spark, sf)[0])


@register("type_family_catalog", catalogs.FAMILY_SQL)
def q_type_family_catalog(spark: SparkSession, sf: str) -> DataFrame:
    rows = _catalog(spark, sf, f"{catalogs.SOURCE_SQL}\nUNION ALL\n{catalogs.TARGET_SQL}")
    return rows.select("table_ref", "column_name", type_family(F.col("data_type")).alias("type_family"))


EVENT_SAMPLE_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@register("sample_evidence", "WITH smp AS (SELECT row_number() OVER (ORDER BY event_id) AS pos, * FROM "
          "(SELECT * FROM events ORDER BY event_id LIMIT 1000)),\n long AS ("
          + "\nUNION ALL\n".join(f"SELECT pos, '{c}' AS column_key, CAST({c} AS VARCHAR) AS value FROM smp"
                                 for c in EVENT_SAMPLE_COLUMNS)
          + "),\n firsts AS (SELECT column_key, value, MIN(pos) AS pos FROM long WHERE value IS NOT NULL "
            "GROUP BY 1, 2),\n ranked AS (SELECT *, row_number() OVER (PARTITION BY column_key ORDER BY pos) AS r "
            "FROM firsts)\n"
            "SELECT c.column_key, c.non_null, COALESCE(e.example_values, '[]') AS example_values FROM "
            "(SELECT column_key, COUNT(value) AS non_null FROM long GROUP BY 1) c LEFT JOIN "
            "(SELECT column_key, CAST(to_json(list(value ORDER BY pos)) AS VARCHAR) AS example_values FROM ranked "
            "WHERE r <= 3 GROUP BY 1) e USING (column_key)")
def q_sample_evidence(spark: SparkSession, sf: str) -> DataFrame:
    return sa.sample_evidence(read_table(spark, sf, "events"), ["event_id"], 1000, 3, EVENT_SAMPLE_COLUMNS)


# ---------------------------------------------------------------- conformance

from concord.operators import conform as cf  # noqa: E402

EVENTS_LOAD_SQL = ("SELECT event_id, ts, user_id, event_type, value, props, "
                   "CAST(event_type = 'click' AS DOUBLE) AS is_click, "
                   "regexp_extract(props, '([0-9]+)', 1) AS k_text FROM {events}")
EVENTS_TARGET = [("event_id", "INTEGER"), ("ts", "DATETIME"), ("user_id", "STRING"), ("event_type", "STRING"),
                 ("value", "FLOAT"), ("is_click", "BOOL"), ("k_text", "INT64"), ("session_id", "STRING")]


@register("conform_events", f"""
SELECT TRY_CAST(event_id AS BIGINT) AS event_id, ts, CAST(user_id AS VARCHAR) AS user_id, event_type,
       CAST(value AS DOUBLE) AS value, COALESCE(is_click <> 0, false) AS is_click,
       TRY_CAST(k_text AS BIGINT) AS k_text, CAST(NULL AS VARCHAR) AS session_id
FROM ({EVENTS_LOAD_SQL.format(events="events")}) AS src""")
def q_conform_events(spark: SparkSession, sf: str) -> DataFrame:
    result = cf.conform(spark.sql(EVENTS_LOAD_SQL, events=read_table(spark, sf, "events")), EVENTS_TARGET, lenient_datetime_columns=["ts"], fill_missing=True)
    return result.frame


# One column for every rule of the conformance check.
_RULES_SQL = """SELECT event_id, value AS whole_or_not, CAST(event_type = 'click' AS DOUBLE) AS zero_one,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 2 AS DOUBLE) END AS zero_one_null,
  CAST(event_id % 3 AS DOUBLE) AS two_in_bool, event_id % 2 = 0 AS flag, event_id % 5 = 0 AS real_flag, value AS to_date, ts,
  ts AS ts_wrong, event_type, CAST(event_id AS {text}) AS id_text, value AS plain, value AS to_numeric, props, user_id AS extra
FROM {events}"""
_RULES = [("event_id", "INTEGER"), ("whole_or_not", "INTEGER"), ("zero_one", "BOOL"), ("zero_one_null", "BOOLEAN"),
          ("two_in_bool", "BOOL"), ("flag", "INT64"), ("real_flag", "BOOL"), ("to_date", "DATE"), ("ts", "DATETIME"),
          ("ts_wrong", "DATE"), ("event_type", "INT64"), ("id_text", "NUMERIC"), ("plain", "FLOAT"), ("to_numeric", "NUMERIC"),
          ("props", "STRING"), ("session_id", "STRING")]


@register("conform_report", """
WITH c AS (SELECT COUNT(*) FILTER (WHERE value <> floor(value)) AS parts, COUNT(event_type) AS words FROM events)
SELECT column_name, target_type, action, ok, CAST(n_failed AS BIGINT) AS n_failed, false AS table_ok FROM (
  SELECT 'event_id' AS column_name, 'INTEGER' AS target_type, 'cast' AS action, true AS ok, 0 AS n_failed
  UNION ALL SELECT 'whole_or_not', 'INTEGER', 'cast', true, parts FROM c
  UNION ALL SELECT 'zero_one', 'BOOL', 'cast', true, 0
  UNION ALL SELECT 'zero_one_null', 'BOOLEAN', 'cast', true, 0
  UNION ALL SELECT 'two_in_bool', 'BOOL', 'mismatch', false, 0
  UNION ALL SELECT 'flag', 'INT64', 'mismatch', false, 0
  UNION ALL SELECT 'real_flag', 'BOOL', 'keep', true, 0
  UNION ALL SELECT 'to_date', 'DATE', 'mismatch', false, 0
  UNION ALL SELECT 'ts', 'DATETIME', 'keep', true, 0
  UNION ALL SELECT 'ts_wrong', 'DATE', 'mismatch', false, 0
  UNION ALL SELECT 'event_type', 'INT64', 'cast', true, words FROM c
  UNION ALL SELECT 'id_text', 'NUMERIC', 'cast', true, 0
  UNION ALL SELECT 'plain', 'FLOAT', 'cast', true, 0
  UNION ALL SELECT 'to_numeric', 'NUMERIC', 'keep', true, 0
  UNION ALL SELECT 'props', 'STRING', 'cast', true, 0
  UNION ALL SELECT 'extra', NULL, 'drop', true, 0
  UNION ALL SELECT 'session_id', 'STRING', 'missing', true, 0)""")
def q_conform_report(spark: SparkSession, sf: str) -> DataFrame:
    events = spark.sql(_RULES_SQL.replace("{text}", "STRING"), events=read_table(spark, sf, "events"))
    return cf.conformance_audit(events, _RULES, ["ts", "ts_wrong"]).select(
        "column_name", "target_type", "action", "ok", "n_failed", "table_ok")


# ---------------------------------------------------------------- lineage

from concord.operators import lineage as lin  # noqa: E402
from concord.plans import graphs  # noqa: E402

_LINEAGE_CTES = (f"edges AS ({graphs.ENTITY_EDGES_SQL}),\n produced AS ({graphs.ENTITY_PRODUCED_SQL}),\n"
                 " tables AS (SELECT source AS t FROM edges UNION SELECT t FROM produced)")


@register("lineage_edges", f"WITH {_LINEAGE_CTES} SELECT DISTINCT source, target, unit_id FROM edges")
def q_lineage_edges(spark: SparkSession, sf: str) -> DataFrame:
    return lin.build_edges(graphs.entity_units(spark, sf)).select("source", "target", "unit_id")


@register("lineage_stages", f"""WITH RECURSIVE {_LINEAGE_CTES},
 dag AS (SELECT DISTINCT source, target FROM edges WHERE source <> target),
 walk(t, d) AS (SELECT t, 0 FROM tables WHERE t NOT IN (SELECT t FROM produced)
                UNION ALL SELECT t, 1 FROM produced
                UNION ALL SELECT dag.target, walk.d + 1 FROM walk JOIN dag ON dag.source = walk.t)
SELECT t AS table_name, CAST(MAX(d) AS INTEGER) AS stage, false AS in_cycle FROM walk GROUP BY t""")
def q_lineage_stages(spark: SparkSession, sf: str) -> DataFrame:
    return lin.compute_stages(graphs.entity_units(spark, sf))


@register("lineage_cycles", f"""WITH RECURSIVE edges AS ({graphs.CYCLIC_EDGES_SQL}), produced AS ({graphs.ENTITY_PRODUCED_SQL}),
 cycles AS ({graphs.CYCLES_SQL}),
 tables AS (SELECT source AS t FROM edges UNION SELECT t FROM produced),
 named AS (SELECT tables.t, cycle, COALESCE(cycle, tables.t) AS node FROM tables LEFT JOIN cycles ON cycles.t = tables.t),
 dag AS (SELECT DISTINCT a.node AS source, b.node AS target FROM edges JOIN named a ON a.t = source JOIN named b ON b.t = target WHERE a.node <> b.node),
 walk(t, d) AS (SELECT DISTINCT node, CASE WHEN t IN (SELECT t FROM produced) THEN 1 ELSE 0 END FROM named
                UNION SELECT dag.target, walk.d + 1 FROM walk JOIN dag ON dag.source = walk.t),
 st AS (SELECT t, CAST(MAX(d) AS INTEGER) AS stage FROM walk GROUP BY t)
SELECT named.t AS table_name, stage, cycle IS NOT NULL AS in_cycle, cycle FROM named JOIN st ON st.t = node""")
def q_lineage_cycles(spark: SparkSession, sf: str) -> DataFrame:
    """A graph with cycles of many tables and tables behind them."""
    return lin.staged(graphs.cyclic_units(spark, sf))


@register("lineage_roots", f"WITH {_LINEAGE_CTES} SELECT DISTINCT source AS table_name FROM edges "
          "WHERE source NOT IN (SELECT t FROM produced)")
def q_lineage_roots(spark: SparkSession, sf: str) -> DataFrame:
    return lin.external_roots(graphs.entity_units(spark, sf))


@register("lineage_by_stage", f"""WITH RECURSIVE {_LINEAGE_CTES},
 dag AS (SELECT DISTINCT source, target FROM edges WHERE source <> target),
 walk(t, d) AS (SELECT t, 0 FROM tables WHERE t NOT IN (SELECT t FROM produced)
                UNION ALL SELECT t, 1 FROM produced
                UNION ALL SELECT dag.target, walk.d + 1 FROM walk JOIN dag ON dag.source = walk.t),
 st AS (SELECT t, CAST(MAX(d) AS INTEGER) AS stage FROM walk GROUP BY t)
SELECT stage, COUNT(*) AS n_tables, MIN(t) AS first_table, MAX(t) AS last_table FROM st GROUP BY stage""")
def q_lineage_by_stage(spark: SparkSession, sf: str) -> DataFrame:
    return lin.tables_by_stage(lin.compute_stages(graphs.entity_units(spark, sf)))


@register("lineage_listing", f"""WITH RECURSIVE {_LINEAGE_CTES},
 dag AS (SELECT DISTINCT source, target FROM edges WHERE source <> target),
 walk(t, d) AS (SELECT t, 0 FROM tables WHERE t NOT IN (SELECT t FROM produced)
                UNION ALL SELECT t, 1 FROM produced
                UNION ALL SELECT dag.target, walk.d + 1 FROM walk JOIN dag ON dag.source = walk.t),
 st AS (SELECT t, CAST(MAX(d) AS INTEGER) AS stage FROM walk GROUP BY t),
 e AS (SELECT DISTINCT source, target, unit_id FROM edges)
SELECT stage, t AS table_name, source, unit_id FROM st LEFT JOIN e ON e.target = st.t""")
def q_lineage_listing(spark: SparkSession, sf: str) -> DataFrame:
    return lin.stage_listing(graphs.entity_units(spark, sf))


@register("unmapped_sources", f"""WITH {_LINEAGE_CTES}, m AS (SELECT 'customer_' || c_custkey AS t FROM customer WHERE c_acctbal > 0
  UNION ALL SELECT 'part_' || p_partkey FROM part)
SELECT DISTINCT source AS table_name FROM edges WHERE source NOT IN (SELECT t FROM produced) AND source NOT IN (SELECT t FROM m)""")
def q_unmapped_sources(spark: SparkSession, sf: str) -> DataFrame:
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string")).alias("source_table")
    mapping = read_table(spark, sf, "customer").where("c_acctbal > 0").select(name("customer_", "c_custkey")).unionByName(
        read_table(spark, sf, "part").select(name("part_", "p_partkey")))
    return lin.unmapped_sources(graphs.entity_units(spark, sf), mapping)


# ---------------------------------------------------------------- script corpora

from concord.operators import cost as cst  # noqa: E402
from concord.operators import script_files  # noqa: E402
from concord.operators import scripts as scr  # noqa: E402
from concord.plans import corpus  # noqa: E402


def _order_units(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders")
    orders = read_table(roomy(spark, 4 * orders.count()), sf, "orders")  # a script and its statements for each order
    pure = scr.materialize_variables(corpus.order_scripts(orders), corpus.order_variables(orders))
    return scr.build_units(pure)


@register("script_units", f"SELECT script_id, unit_id, statement, statement_type FROM ({corpus.ORDER_UNITS_SQL}) AS u")
def q_script_units(spark: SparkSession, sf: str) -> DataFrame:
    return _order_units(spark, sf).select("script_id", "unit_id", "statement", "statement_type")


@register("script_files", f"""SELECT statement, statement_type, count(*) AS occurrences, true AS numbered
FROM ({corpus.ORDER_UNITS_SQL}) AS u GROUP BY ALL""")
def q_script_files(spark: SparkSession, sf: str) -> DataFrame:
    """X1 over S11: all orders' scripts as a few dumps, split where they lie; in each file the statements are numbered without gaps."""
    orders, path = read_table(spark, sf, "orders"), stored_path(spark, "dumps")
    pure = scr.materialize_variables(corpus.order_scripts(orders), corpus.order_variables(orders))
    pure.select(F.concat("sql", F.lit(";"))).write.text(path)
    u = stored(script_files.build_file_units(spark, path, ".txt"), "dump-units")
    files = u.groupBy("file_name").agg((F.max("unit_id") == F.count_distinct("unit_id")).alias("numbered"))
    return u.join(files, "file_name").groupBy("statement", "statement_type", "numbered").agg(F.count(F.lit(1)).alias("occurrences")).select(
        "statement", "statement_type", "occurrences", "numbered")


@register("script_edges", f"""WITH u AS ({corpus.ORDER_UNITS_SQL})
SELECT script_id, unit_id, 'source' AS role, 'orders' AS table_name, 1 AS position FROM u WHERE unit_id = 1
UNION ALL SELECT script_id, unit_id, 'target', 'stg_' || o_orderkey, 1 FROM u WHERE unit_id = 1
UNION ALL SELECT script_id, unit_id, 'source', 'stg_' || o_orderkey, 1 FROM u WHERE unit_id IN (2, 3)
UNION ALL SELECT script_id, unit_id, 'source', 'customer', 2 FROM u WHERE unit_id = 2""")
def q_script_edges(spark: SparkSession, sf: str) -> DataFrame:
    u = _order_units(spark, sf)

    def refs(col: str, role: str) -> F.Column:
        return F.transform(col, lambda t, i: F.struct(F.lit(role).alias("role"), t.alias("table_name"),
                                                       (i + 1).cast("int").alias("position")))
    # one pass over the units: sources and targets as one array of (role, table, position)
    return u.select("script_id", "unit_id", F.inline(F.concat(refs("sources", "source"), refs("targets", "target"))))


@register("script_rewrite", f"""WITH u AS ({corpus.ORDER_UNITS_SQL}),
 m AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'stage_' ELSE 'stg_' END || o_orderkey AS stg FROM u)
SELECT script_id, unit_id,
  CASE unit_id
    WHEN 1 THEN 'CREATE OR REPLACE TABLE ' || stg || ' AS SELECT * FROM dw_orders WHERE o_orderkey = ' || o_orderkey
                || ' AND o_orderpriority = ''' || o_orderpriority || ';' || o_orderstatus || '''''s'''
    WHEN 2 THEN 'INSERT INTO fact_orders SELECT s.*, c.c_name FROM ' || stg || ' s JOIN dw_customer c ON c.c_custkey = '
                || o_custkey
    ELSE 'select COALESCE(o_totalprice, 0), DATE(o_orderdate) from ' || stg || ' where o_orderdate = DATE '''
         || strftime(o_orderdate, '%Y-%m-%d') || '''' END AS translated
FROM m""")
def q_script_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    u = _order_units(spark, sf)
    t = scr.translate(u, corpus.order_table_map(read_table(spark, sf, "orders")))
    return t.select("script_id", "unit_id", "translated")


@register("script_variables", """SELECT 'ord_' || o_orderkey AS script_id, 'v_day' AS var_name,
       CAST(CAST(max(o_orderdate) AS TIMESTAMP) AS VARCHAR) AS value FROM orders GROUP BY o_orderkey""")
def q_script_variables(spark: SparkSession, sf: str) -> DataFrame:
    """Every script's SELECT … INTO resolved from the orders table, all of one form by one grouped query."""
    orders = read_table(spark, sf, "orders")
    return jobs.resolve_variables(spark, corpus.order_scripts(orders), resolve=lambda name: read_table(spark, sf, name))[1]


@register("script_variables_two", """SELECT 'ord_' || o_orderkey AS script_id, v AS var_name,
       CASE v WHEN 'v_n' THEN CAST(count(l_orderkey) FILTER (WHERE l_quantity > o_orderkey % 50) AS VARCHAR)
              ELSE CAST(max(l_partkey) FILTER (WHERE l_discount <= 0.05 AND l_shipdate >= o_orderdate + INTERVAL 30 DAY) AS VARCHAR) END AS value
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey CROSS JOIN (VALUES ('v_n'), ('v_part')) AS s(v) GROUP BY o_orderkey, v""")
def q_script_variables_two(spark: SparkSession, sf: str) -> DataFrame:
    """Two assignments per order, with two and three conditions: two queries in all."""
    scripts = corpus.item_scripts(read_table(spark, sf, "orders"))
    return jobs.resolve_variables(spark, scripts, resolve=lambda name: read_table(spark, sf, name))[1]


_DOTTED = ("SELECT 'q' || o_orderkey AS script_id, 1 AS unit_id, 'select * from Demo.ord$' || o_orderkey % 500 || ' a join demo.sales b on a.k = b.sales "
           "join ord$' || o_orderkey % 500 || ' c' AS statement FROM orders")


@register("script_rewrite_dotted", """
SELECT 'q' || o_orderkey AS script_id, 1 AS unit_id,
       'select * from ' || CASE WHEN o_orderkey % 500 < 250 THEN 'wh.order_' || o_orderkey % 500
                                ELSE 'Demo.' || CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'ord$' || o_orderkey % 500 END END
       || ' a join wh.sales_all b on a.k = b.facts join '
       || CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'ord$' || o_orderkey % 500 END || ' c' AS translated FROM orders""")
def q_script_rewrite_dotted(spark: SparkSession, sf: str) -> DataFrame:
    """Names with dots and ``$``, the longest first: ``demo.ord$7`` before ``ord$7``, ``demo.sales`` before ``sales``."""
    orders = read_table(spark, sf, "orders")
    units = spark.sql(_DOTTED.replace("FROM orders", "FROM {orders}"), orders=orders)
    k = (F.col("o_orderkey") % 500).cast("string")
    names = orders.select(
        F.when(F.col("o_orderkey") % 500 < 250, F.struct(F.concat(F.lit("demo.ord$"), k).alias("a"), F.concat(F.lit("wh.order_"), k).alias("b"))).alias("long"),
        F.when(F.col("o_orderkey") % 2 == 0, F.struct(F.concat(F.lit("ORD$"), k).alias("a"), F.lit("even").alias("b"))).alias("short"))
    fixed = spark.sql("SELECT * FROM VALUES ('Demo.Sales', 'wh.sales_all'), ('sales', 'facts') AS t(source_name, target_name)")
    mapping = names.select(F.explode(F.array("long", "short")).alias("m")).where("m is not null").select(
        F.col("m.a").alias("source_name"), F.col("m.b").alias("target_name")).distinct().unionByName(fixed)
    return scr.translate(units, mapping).select("script_id", "unit_id", "translated")


# ---------------------------------------------------------------- cost and history

_SIZE_TABLES = ["orders", "customer", "lineitem", "nation", "part", "supplier", "region"]
_TEXT = {"orders": "strlen(o_orderstatus) + strlen(o_orderpriority)", "customer": "strlen(c_name) + strlen(c_mktsegment)"}
_COST = "CAST({b} AS DOUBLE) / 1099511627776::DOUBLE * 6.25::DOUBLE"


@register("cost_from_tables", f"""WITH u AS ({corpus.ORDER_UNITS_SQL}),
 z AS (SELECT (SELECT SUM(32 + {_TEXT['orders']}) FROM orders) AS all_orders, (SELECT SUM(20 + {_TEXT['customer']}) FROM customer) AS all_customers),
 e AS (SELECT script_id, unit_id, unit_id > 1 AND o_orderstatus = 'P' AS unknown, 'stg_' || o_orderkey AS stg,
         CASE unit_id WHEN 1 THEN all_orders WHEN 2 THEN all_customers + 32 + {_TEXT['orders']} ELSE 32 + {_TEXT['orders']} END AS raw
       FROM u CROSS JOIN z),
 f AS (SELECT *, CASE WHEN unknown THEN 0 ELSE raw END AS b FROM e)
SELECT script_id, unit_id, CAST(b AS BIGINT) AS estimated_bytes, {_COST.format(b='b')} AS estimated_cost_usd,
       CASE WHEN unknown THEN 'unknown table: ' || stg ELSE '' END AS error FROM f""")
def q_cost_from_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Base tables measured from their values; an order's staging table from its row, unless the order is pending."""
    sizes = cst.table_sizes({t: read_table(spark, sf, t) for t in _SIZE_TABLES})
    orders = read_table(spark, sf, "orders")
    staged = orders.where("o_orderstatus <> 'P'").select(
        F.concat(F.lit("stg_"), F.col("o_orderkey").cast("string")).alias("table_name"), cst.row_bytes(orders).alias("size_bytes"))
    return cst.scan_estimate(_order_units(spark, sf), sizes.unionByName(staged))


@register("measured_sizes", """
SELECT 'documents' AS table_name, CAST(SUM(16 + strlen(text) + strlen(lang) + strlen(source)) AS BIGINT) AS size_bytes FROM documents
UNION ALL SELECT 'lineitem', CAST(SUM(68 + strlen(l_returnflag) + strlen(l_linestatus)) AS BIGINT) FROM lineitem
UNION ALL SELECT 'events', CAST(SUM(32 + strlen(event_type) + strlen(props)) AS BIGINT) FROM events""")
def q_measured_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return cst.table_sizes({t: read_table(spark, sf, t) for t in ("documents", "lineitem", "events")})


_RANK_SQL = f"""WITH u AS ({corpus.ORDER_UNITS_SQL}),
 e AS (SELECT script_id, unit_id, statement, CAST(strlen(statement) AS BIGINT) * 1024 AS b FROM u)
SELECT script_id, unit_id, b AS estimated_bytes, {_COST.format(b='b')} AS estimated_cost_usd,
       CAST(row_number() OVER (PARTITION BY script_id ORDER BY {_COST.format(b='b')} DESC, unit_id) AS INTEGER) AS rank,
       replace(left(regexp_replace(regexp_replace(statement, '^{cst.PY_WHITESPACE}+|{cst.PY_WHITESPACE}+$', '', 'g'),
               '{cst.PY_WHITESPACE}+', ' ', 'g'), 80)
               || CASE WHEN length(regexp_replace(regexp_replace(statement, '^{cst.PY_WHITESPACE}+|{cst.PY_WHITESPACE}+$', '', 'g'),
               '{cst.PY_WHITESPACE}+', ' ', 'g')) > 80 THEN '…' ELSE '' END, '|', '\\|') AS sql_preview
FROM e"""


@register("cost_rank", _RANK_SQL)
def q_cost_rank(spark: SparkSession, sf: str) -> DataFrame:
    u = _order_units(spark, sf).where(cst.non_blank(F.col("statement")))
    b = cst.text_bytes(F.col("statement"))
    est = u.select("script_id", "unit_id", b.alias("estimated_bytes"), cst.cost_usd(b).alias("estimated_cost_usd"),
                   cst.preview(F.col("statement")).alias("sql_preview"))
    return cst.rank_costs(est, "script_id", "unit_id").select(
        "script_id", "unit_id", "estimated_bytes", "estimated_cost_usd", "rank", "sql_preview")


@register("cost_totals", f"""
SELECT lang AS script_id, COUNT(*) AS n_queries, CAST(0 AS BIGINT) AS n_failed,
       CAST(SUM(CAST(strlen('INSERT INTO docs_' || lang || ' VALUES (' || doc_id || ', ''' || replace(text, '''', '''''')
            || ''')') AS BIGINT) * 1024) AS BIGINT) AS total_bytes,
       {_COST.format(b="SUM(CAST(strlen('INSERT INTO docs_' || lang || ' VALUES (' || doc_id || ', ''' || replace(text, '''', '''''') || ''')') AS BIGINT) * 1024)")} AS total_cost_usd
FROM documents GROUP BY lang""")
def q_cost_totals(spark: SparkSession, sf: str) -> DataFrame:
    st = corpus.document_statements(read_table(spark, sf, "documents")).where(cst.non_blank(F.col("sql")))
    b = cst.text_bytes(F.col("sql"))
    est = st.select("script_id", b.alias("estimated_bytes"), F.lit("").alias("error"))
    return cst.cost_totals(est)


_REPLAY_SQL = f"""WITH h AS (SELECT * FROM ({corpus.PART_HISTORY_SQL}) AS x WHERE iteration <= 5),
 a AS (SELECT *, MIN(CASE WHEN outcome = 'ok' THEN estimated_bytes END) OVER
         (PARTITION BY query_id ORDER BY iteration ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cur FROM h),
 b AS (SELECT *, CASE WHEN outcome = 'ok' AND iteration > 0 THEN CASE WHEN cur > 0 THEN
         CAST(cur - estimated_bytes AS DOUBLE) / CAST(cur AS DOUBLE) * 100.0::DOUBLE ELSE 0.0::DOUBLE END END AS m FROM a),
 c AS (SELECT *, MAX(CASE WHEN NOT (m < 2.0::DOUBLE) OR iteration = 0 THEN iteration END) OVER
         (PARTITION BY query_id ORDER BY iteration ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_steep FROM b),
 d AS (SELECT *, CASE WHEN iteration = 0 AND outcome <> 'ok' THEN 'baseline_execution_failed'
                      WHEN iteration > 0 AND outcome <> 'ok' THEN outcome
                      WHEN m < 2.0::DOUBLE AND iteration - last_steep >= 2 THEN 'diminishing_returns' END AS reason FROM c),
 e AS (SELECT *, COALESCE(MIN(CASE WHEN reason IS NOT NULL THEN iteration END) OVER (PARTITION BY query_id),
                          MAX(iteration) OVER (PARTITION BY query_id)) AS stop_iteration FROM d),
 f AS (SELECT *, COALESCE(MAX(CASE WHEN iteration = stop_iteration THEN reason END) OVER (PARTITION BY query_id),
                          'max_iterations') AS stop_reason FROM e WHERE TRUE),
 r AS (SELECT query_id, iteration,
         CASE WHEN outcome IN ('llm_error', 'estimate_failed') THEN CAST(0 AS BIGINT) ELSE estimated_bytes END AS eb,
         CASE WHEN iteration = 0 THEN true ELSE outcome = 'ok' AND estimated_bytes < cur END AS accepted,
         CASE WHEN iteration = 0 THEN NULL WHEN outcome = 'ok' THEN true WHEN outcome = 'validation_failed' THEN false
              END AS validation_matched,
         round(m, 4) AS marginal_improvement_pct,
         CASE WHEN iteration = 0 THEN estimated_bytes
              ELSE least(cur, CASE WHEN outcome = 'ok' THEN estimated_bytes END) END AS current_bytes,
         stop_iteration, stop_reason,
         CASE WHEN iteration = 0 THEN CASE WHEN outcome <> 'execution_failed' THEN 'baseline'
                                           ELSE 'baseline_execution_failed' END
              WHEN outcome <> 'ok' THEN outcome WHEN estimated_bytes < cur THEN 'accepted'
              ELSE 'no_cost_improvement' END AS note
       FROM f WHERE iteration <= stop_iteration)"""


@register("history_replay", _REPLAY_SQL + f"""
SELECT query_id, iteration, eb AS estimated_bytes, {_COST.format(b='eb')} AS estimated_cost_usd, accepted,
       validation_matched, marginal_improvement_pct, current_bytes, stop_iteration, stop_reason, note FROM r""")
def q_history_replay(spark: SparkSession, sf: str) -> DataFrame:
    return cst.replay_history(corpus.part_histories(read_table(spark, sf, "part")))


@register("history_stop", _REPLAY_SQL + """
SELECT DISTINCT query_id, stop_iteration, stop_reason FROM r""")
def q_history_stop(spark: SparkSession, sf: str) -> DataFrame:
    return cst.replay_history(corpus.part_histories(read_table(spark, sf, "part"))).select(
        "query_id", "stop_iteration", "stop_reason").distinct()


_SUMMARY_SQL = _REPLAY_SQL + f""",
 s AS (SELECT query_id, arg_min(eb, iteration) AS baseline_bytes, arg_max(current_bytes, iteration) AS final_bytes,
              COUNT(*) AS n_iterations, MIN(stop_reason) AS stop_reason FROM r GROUP BY query_id)"""


@register("history_summary", _SUMMARY_SQL + f"""
SELECT query_id, baseline_bytes, final_bytes, {_COST.format(b='baseline_bytes')} AS baseline_cost_usd,
       {_COST.format(b='final_bytes')} AS final_cost_usd,
       round(CASE WHEN baseline_bytes > 0 THEN CAST(baseline_bytes - final_bytes AS DOUBLE) / CAST(baseline_bytes AS DOUBLE)
             * 100.0::DOUBLE ELSE 0.0::DOUBLE END, 4) AS total_improvement_pct, stop_reason, n_iterations FROM s""")
def q_history_summary(spark: SparkSession, sf: str) -> DataFrame:
    return cst.history_summary(cst.replay_history(corpus.part_histories(read_table(spark, sf, "part"))))


@register("history_totals", _SUMMARY_SQL + f"""
SELECT COUNT(*) AS n_queries, {_COST.format(b='SUM(baseline_bytes)')} AS total_baseline_cost_usd,
       {_COST.format(b='SUM(final_bytes)')} AS total_final_cost_usd,
       round(CAST(SUM(baseline_bytes) - SUM(final_bytes) AS DOUBLE) / CAST(SUM(baseline_bytes) AS DOUBLE) * 100.0::DOUBLE, 2)
         AS overall_improvement_pct FROM s""")
def q_history_totals(spark: SparkSession, sf: str) -> DataFrame:
    return cst.history_totals(cst.history_summary(cst.replay_history(corpus.part_histories(read_table(spark, sf, "part")))))


# ---------------------------------------------------------------- registry

from concord.operators import registry as reg  # noqa: E402
from concord.plans import registry_data as rd  # noqa: E402

_REG_COLS = ", ".join(reg.REGISTRY_COLUMNS)
_NOW = rd.NOW  # a literal; wrapped per call


def _base(spark: SparkSession, sf: str) -> DataFrame:
    return rd.base_registry(read_table(spark, sf, "customer"), read_table(spark, sf, "nation"))


@register("registry_upsert", f"""WITH b AS ({rd.BASE_SQL}), u AS ({rd.UPDATES_SQL})
SELECT COALESCE(u.source_schema, b.source_schema) AS source_schema, COALESCE(u.source_table, b.source_table) AS source_table,
""" + ",\n".join(f"  CASE WHEN u.source_table IS NOT NULL THEN u.{c} ELSE b.{c} END AS {c}" for c in reg.UPDATABLE) + f""",
  COALESCE(b.created_at, '{rd.NOW}') AS created_at,
  CASE WHEN u.source_table IS NOT NULL THEN '{rd.NOW}' ELSE b.updated_at END AS updated_at
FROM b FULL OUTER JOIN u ON b.source_schema = u.source_schema AND b.source_table = u.source_table""")
def q_registry_upsert(spark: SparkSession, sf: str) -> DataFrame:
    upd = rd.upsert_updates(read_table(spark, sf, "customer"), read_table(spark, sf, "supplier"))
    return reg.upsert(_base(spark, sf), upd, F.lit(_NOW))


@register("registry_seed", f"""WITH b AS ({rd.BASE_SQL}),
 m AS (SELECT 'supp_' || s_suppkey AS source_table, 'supplier_' || s_suppkey AS target_table FROM supplier
       UNION ALL SELECT 'cust_' || c_custkey, 'legacy_' || c_custkey FROM customer WHERE c_acctbal < 0)
SELECT {_REG_COLS} FROM b
UNION ALL
SELECT 'demo', m.source_table, 'wh', 'legacy', m.target_table, 'ready', false, '', false, '', '', '{rd.NOW}', '{rd.NOW}'
FROM m WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.source_schema = 'demo' AND b.source_table = m.source_table)""")
def q_registry_seed(spark: SparkSession, sf: str) -> DataFrame:
    m = rd.seed_mapping(read_table(spark, sf, "customer"), read_table(spark, sf, "supplier"))
    return reg.seed(_base(spark, sf), m, "demo", "wh", "legacy", F.lit(_NOW))


@register("registry_pending", f"""WITH b AS ({rd.BASE_SQL}), r AS ({rd.REQUIRED_SQL})
SELECT {_REG_COLS} FROM b
UNION ALL
SELECT r.source_schema, r.source_table, '', '', '', 'pending', false, '', false, '', '', '{rd.NOW}', '{rd.NOW}'
FROM r WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.source_schema = r.source_schema AND b.source_table = r.source_table)""")
def q_registry_pending(spark: SparkSession, sf: str) -> DataFrame:
    req = rd.required_tables(read_table(spark, sf, "orders"), read_table(spark, sf, "lineitem"))
    return reg.ensure_pending(_base(spark, sf), req, F.lit(_NOW))


@register("registry_reachability", f"""WITH b AS ({rd.BASE_SQL}),
 o AS (SELECT 'demo' AS source_schema, 'cust_' || c_custkey AS source_table,
              c_custkey IN (SELECT o_custkey FROM orders) AS source_probe, c_acctbal >= 3000 AS target_probe FROM customer),
 j AS (SELECT b.*, o.source_probe, o.target_probe,
              b.source_reachable OR o.source_probe AS sr, b.target_reachable OR o.target_probe AS tr
       FROM b JOIN o USING (source_schema, source_table))
SELECT source_schema, source_table, target_project, target_dataset, target_table,
       CASE WHEN target_table <> '' AND sr AND tr THEN 'ready' WHEN status = 'ready' THEN 'blocked' ELSE status END AS status,
       sr AS source_reachable, '{rd.NOW}' AS source_checked_at, tr AS target_reachable, '{rd.NOW}' AS target_checked_at,
       notes, created_at, '{rd.NOW}' AS updated_at FROM j""")
def q_registry_reachability(spark: SparkSession, sf: str) -> DataFrame:
    obs = rd.observations(read_table(spark, sf, "customer"), read_table(spark, sf, "orders"))
    return reg.update_reachability(_base(spark, sf), obs, F.lit(_NOW))


@register("registry_ready_mapping", f"""WITH b AS ({rd.BASE_SQL}),
 layers AS (
   SELECT 'supp_' || s_suppkey AS source_table, 'legacy_supplier_' || s_suppkey AS target_table, 0 AS p, 'legacy' AS layer
   FROM supplier
   UNION ALL SELECT 'cust_' || c_custkey, 'legacy_customer_' || c_custkey, 0, 'legacy' FROM customer
   UNION ALL SELECT source_table, target_table, 1, 'registry' FROM b
     WHERE status = 'ready' AND target_table <> '' AND source_reachable AND target_reachable
   UNION ALL SELECT 'stg_' || o_orderkey, 'scratch_stg_' || o_orderkey, 2, 'intermediate' FROM orders
   UNION ALL SELECT 'cust_' || c_custkey, 'scratch_cust_' || c_custkey, 2, 'intermediate' FROM customer
     WHERE c_acctbal >= 9000)
SELECT source_table, arg_max(target_table, p) AS target_table, arg_max(layer, p) AS layer FROM layers GROUP BY source_table""")
def q_registry_ready_mapping(spark: SparkSession, sf: str) -> DataFrame:
    customer, supplier = read_table(spark, sf, "customer"), read_table(spark, sf, "supplier")
    orders = read_table(spark, sf, "orders")
    k = lambda c: F.col(c).cast("string")
    legacy = supplier.select(F.concat(F.lit("supp_"), k("s_suppkey")).alias("source_table"),
                             F.concat(F.lit("legacy_supplier_"), k("s_suppkey")).alias("target_table")).unionByName(
        customer.select(F.concat(F.lit("cust_"), k("c_custkey")).alias("source_table"),
                        F.concat(F.lit("legacy_customer_"), k("c_custkey")).alias("target_table")))
    inter = orders.select(F.concat(F.lit("stg_"), k("o_orderkey")).alias("source_table"),
                          F.concat(F.lit("scratch_stg_"), k("o_orderkey")).alias("target_table")).unionByName(
        customer.where(F.col("c_acctbal") >= 9000).select(
            F.concat(F.lit("cust_"), k("c_custkey")).alias("source_table"),
            F.concat(F.lit("scratch_cust_"), k("c_custkey")).alias("target_table")))
    return reg.layered_mapping([("legacy", legacy), ("registry", reg.mapping_of(_base(spark, sf))),
                                ("intermediate", inter)])


@register("registry_replace_columns", f"""WITH c AS ({rd.COLUMN_REGISTRY_SQL}), n AS ({rd.REPLACEMENT_SQL})
SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.source_schema = c.source_schema AND n.source_table = c.source_table)
UNION ALL SELECT * FROM n""")
def q_registry_replace_columns(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation = read_table(spark, sf, "customer"), read_table(spark, sf, "nation")
    return reg.replace_columns(rd.column_registry(customer, nation), rd.replacement_columns(customer))


@register("registry_import", """
SELECT 'demo' AS source_schema, 'cust_' || c_custkey AS source_table, 'wh' AS target_project,
       'Seg_' || c_mktsegment AS target_dataset, 'customer_' || c_custkey AS target_table,
       CASE WHEN c_acctbal > 5000 THEN 'ready' ELSE 'pending' END AS status,
       c_acctbal > 500 AS source_reachable, '' AS source_checked_at, c_acctbal > 3000 AS target_reachable,
       '' AS target_checked_at, c_mktsegment AS notes
FROM customer WHERE c_acctbal >= 0""")
def q_registry_import(spark: SparkSession, sf: str) -> DataFrame:
    return reg.import_rows(rd.raw_import_rows(read_table(spark, sf, "customer")))


@register("readiness_gate", f"""WITH b AS ({rd.BASE_SQL}), r AS ({rd.REQUIRED_SQL}),
 c AS (SELECT * FROM ({rd.COLUMN_REGISTRY_SQL}) AS c0 WHERE NOT EXISTS (SELECT 1 FROM ({rd.REPLACEMENT_SQL}) AS n0
         WHERE n0.source_table = c0.source_table) UNION ALL {rd.REPLACEMENT_SQL}),
 bad AS (SELECT source_schema, source_table, COUNT(*) AS n FROM c WHERE compatibility_status <> 'compatible' GROUP BY 1, 2),
 v AS (SELECT r.source_schema, r.source_table, b.status IS NOT NULL AS registered,
         COALESCE(b.status = 'ready' AND COALESCE(b.target_table, '') <> '' AND b.source_reachable AND b.target_reachable,
                  false) AS ready,
         COALESCE(bad.n, 0) AS incompatible_columns
       FROM r LEFT JOIN b USING (source_schema, source_table) LEFT JOIN bad USING (source_schema, source_table)),
 w AS (SELECT v.*, CASE WHEN NOT registered OR COALESCE(b2.target_table, '') = '' THEN 'unknown'
                        WHEN NOT ready THEN 'blocked' WHEN incompatible_columns > 0 THEN 'schema_blocked'
                        ELSE 'ready' END AS verdict
       FROM v LEFT JOIN b AS b2 USING (source_schema, source_table))
SELECT *, COALESCE(MIN(verdict = 'ready') OVER (), true) AS can_run FROM w""")
def q_readiness_gate(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation = read_table(spark, sf, "customer"), read_table(spark, sf, "nation")
    req = rd.required_tables(read_table(spark, sf, "orders"), read_table(spark, sf, "lineitem"))
    cols = reg.replace_columns(rd.column_registry(customer, nation), rd.replacement_columns(customer))
    return reg.readiness(req, _base(spark, sf), cols)


_NOTE = """CASE c_custkey % 4 WHEN 0 THEN 'He said "' || c_mktsegment || '", ok' WHEN 1 THEN 'two' || chr(10) || 'lines, "' || c_custkey || '"'
  WHEN 2 THEN c_mktsegment ELSE '' END"""


@register("registry_csv_round_trip", f"""
SELECT source_schema, source_table, target_project, target_dataset, lower(target_table) AS target_table, status, source_reachable,
       source_checked_at, target_reachable, target_checked_at, {_NOTE} AS notes
FROM ({rd.BASE_SQL}) b JOIN customer ON 'cust_' || c_custkey = source_table""")
def q_registry_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The customer registry written as CSV to the shared folder and imported again; notes hold quotes and line breaks."""
    from concord.functions.stored import stored_path

    path = stored_path(spark, "registry-csv")
    notes = read_table(spark, sf, "customer").select(
        F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("source_table"), F.expr(_NOTE).alias("notes"))
    reg.export_csv(_base(spark, sf).drop("notes").join(notes, "source_table"), path)
    return reg.import_csv(spark, path)


@register("registry_lookup", f"""WITH b AS ({rd.BASE_SQL}), r AS (SELECT 'demo' AS source_schema, 'cust_' || o_custkey AS source_table FROM orders
  UNION SELECT 'demo', 'nation_' || n_nationkey FROM nation)
SELECT r.source_schema, r.source_table, b.target_table, b.status FROM r LEFT JOIN b USING (source_schema, source_table)""")
def q_registry_lookup(spark: SparkSession, sf: str) -> DataFrame:
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string")).alias("source_table")
    wanted = read_table(spark, sf, "orders").select(F.lit("Demo").alias("source_schema"), name("CUST_", "o_custkey")).unionByName(
        read_table(spark, sf, "nation").select(F.lit("demo").alias("source_schema"), name("nation_", "n_nationkey"))).distinct()
    return reg.lookup(wanted, _base(spark, sf)).select("source_schema", "source_table", "target_table", "status")


# ---------------------------------------------------------------- writes and filters

from concord.sources.tables import load, materialize, where_equals  # noqa: E402


@register("load_round_trip", """
SELECT o_orderstatus, CAST(COUNT(*) * 2 AS BIGINT) AS n_rows, CAST(2 * SUM(CAST(o_totalprice AS DECIMAL(38,6))) AS DECIMAL(38,6)) AS total,
       CAST((SELECT COUNT(*) FROM orders) AS BIGINT) AS loaded FROM orders GROUP BY o_orderstatus""")
def q_load_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Orders materialised to the shared folder, appended once more with a counted load, and read back."""
    from concord.functions.stored import stored_path

    path, orders = stored_path(spark, "load"), read_table(spark, sf, "orders")
    materialize(orders, path)
    loaded = load(orders, path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("o_totalprice").cast("decimal(28,6)")).cast("decimal(38,6)").alias("total"),
        F.lit(loaded).cast("long").alias("loaded"))


@register("optional_filters", """
SELECT 'both' AS filter, COUNT(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'
UNION ALL SELECT 'one', COUNT(*) FROM lineitem WHERE l_returnflag = 'R' UNION ALL SELECT 'none', COUNT(*) FROM lineitem""")
def q_optional_filters(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem")
    cases = {"both": {"l_returnflag": "R", "l_linestatus": "F"}, "one": {"l_returnflag": "R", "l_linestatus": None}, "none": {}}
    return fp.balanced_union([where_equals(lines, **c).agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("filter"), "n")
                              for k, c in cases.items()])


# ---------------------------------------------------------------- latest version per key

from concord.sources.files import latest_by  # noqa: E402


@register("latest_report", """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS e
WHERE rn = 1""")
def q_latest_report(spark: SparkSession, sf: str) -> DataFrame:
    return latest_by(read_table(spark, sf, "events"), ["user_id"], ["ts", "event_id"])


# ---------------------------------------------------------------- files that Spark derives from the driver tables

from concord.functions.types import loader_type_name  # noqa: E402
from concord.sources import files as fl  # noqa: E402
from concord.sources import tables as tb  # noqa: E402


@register("replicate_table", """SELECT l_returnflag, COUNT(*) AS n_rows, CAST(SUM(CAST(l_quantity AS DECIMAL(38,6))) AS DECIMAL(38,6)) AS quantity,
       CAST((SELECT COUNT(*) FROM lineitem) AS BIGINT) AS copied FROM lineitem GROUP BY l_returnflag""")
def q_replicate_table(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table copied to the shared folder."""
    path = stored_path(spark, "replica")
    read_table(spark, sf, "lineitem").createOrReplaceTempView("concord_lineitem")
    copied = tb.replicate(spark, "concord_lineitem", path)
    return spark.read.parquet(path).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("l_quantity").cast("decimal(28,6)")).cast("decimal(38,6)").alias("quantity"),
        F.lit(copied).cast("long").alias("copied"))


@register("pairs_from_files", """
SELECT 'S' || c_nationkey AS oracle_schema, 'T, "' || c_custkey || '"' AS oracle_table, 'p' AS bigquery_project, c_mktsegment AS bigquery_dataset,
       't_' || c_custkey AS bigquery_table FROM customer
UNION ALL SELECT 'nat', n_name, 'p', 'd', 't' || n_nationkey FROM nation""")
def q_pairs_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """A correspondence per customer as CSV under other headers (with a byte order mark, blanks, quotes and commas), one per nation as JSON."""
    csv, js = stored_path(spark, "pairs"), stored_path(spark, "pairs")
    c, n = read_table(spark, sf, "customer"), read_table(spark, sf, "nation")
    headers = {fl.BOM + "schema": "oracle_schema", "table": "oracle_table", "project": "bigquery_project", "dataset": "bigquery_dataset", "goal": "bigquery_table"}
    text = lambda *parts: F.concat(*[F.lit(x) if x in ("S", "T, \"", "\"", "t_", "t", " ") else F.col(x).cast("string") for x in parts])
    values = [text("S", "c_nationkey"), text(" ", "T, \"", "c_custkey", "\""), F.lit("p "), F.col("c_mktsegment"), text("t_", "c_custkey")]
    c.select(*[v.alias(h) for v, h in zip(values, headers)]).write.options(**fl.CSV_WRITE).csv(csv)
    rows = n.select(F.lit("nat").alias("oracle_schema"), F.col("n_name").alias("oracle_table"), F.lit("p").alias("bigquery_project"),
                    F.lit("d").alias("bigquery_dataset"), text("t", "n_nationkey").alias("bigquery_table"))
    rows.agg(F.collect_list(F.struct("*")).alias("tables")).write.json(js)  # 25 nations
    columns = {field: h.lstrip(fl.BOM) for h, field in headers.items()}
    return fl.load_table_pairs(spark, csv, "csv", columns).unionByName(fl.load_table_pairs(spark, js, "json"))


@register("report_files", """SELECT f.format, o_custkey, CAST(COUNT(*) AS BIGINT) AS n, o_orderpriority || ', "' || o_custkey || '"' || chr(10) || 'end' AS note
FROM orders CROSS JOIN (VALUES ('csv'), ('json')) AS f(format) GROUP BY ALL""")
def q_report_files(spark: SparkSession, sf: str) -> DataFrame:
    """A report per customer and priority written as CSV and as JSON; its notes hold commas, quotes and line breaks."""
    note = F.concat("o_orderpriority", F.lit(', "'), F.col("o_custkey").cast("string"), F.lit('"\nend'))
    report = read_table(spark, sf, "orders").groupBy("o_custkey", note.alias("note")).agg(F.count(F.lit(1)).alias("n"))
    schema, out = "o_custkey long, note string, n long", []
    for fmt in ("csv", "json"):
        path = stored_path(spark, "report")
        fl.write_report(report, path, fmt)
        back = spark.read.schema(schema).options(**fl.CSV_READ).csv(path) if fmt == "csv" else spark.read.schema(schema).json(path)
        out.append(back.select(F.lit(fmt).alias("format"), "*"))
    return out[0].unionByName(out[1])


@register("prefix_ingest", """SELECT 'segment=' || c_mktsegment || '/nation=' || c_nationkey AS folder, CAST(SUM(strlen(c_name) + 1) AS BIGINT) AS bytes,
       CAST(SUM(strlen(c_name) + 1) AS BIGINT) AS held FROM customer GROUP BY ALL""")
def q_prefix_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """All objects below a prefix of nested folders, with their contents."""
    path = stored_path(spark, "prefix")
    read_table(spark, sf, "customer").select("c_name", F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).write.partitionBy(
        "segment", "nation").text(path)
    found = fl.ingest_prefix(spark, path).where(F.col("relative_path").endswith(".txt"))
    return found.groupBy(F.regexp_replace("relative_path", "/[^/]+$", "").alias("folder")).agg(
        F.sum("length").alias("bytes"), F.sum(F.octet_length("content")).cast("long").alias("held"))


@register("script_listing", """SELECT 'select ' || s_suppkey || ' from supp_' || s_nationkey || ';' AS sql, true AS named,
       CAST((SELECT COUNT(*) FROM supplier) AS BIGINT) AS n_files FROM supplier""")
def q_script_listing(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of ``*.sql`` files, one per supplier, whole texts; files of another suffix and of folders below are left out."""
    path, s = stored_path(spark, "scripts"), read_table(spark, sf, "supplier")
    text = F.concat(F.lit("select "), F.col("s_suppkey").cast("string"), F.lit(" from supp_"), F.col("s_nationkey").cast("string"), F.lit(";"))
    one = s.select(text.alias("sql")).repartition(1 + s.count() // 500)  # each row is a file to be written
    # the second algorithm has tasks move their files into place, the first the driver one by one
    plain = {"maxRecordsPerFile": 1, "quote": "", "sep": "\x01", "emptyValue": "", "mapreduce.fileoutputcommitter.algorithm.version": 2}
    one.write.options(extension="sql", **plain).csv(path)
    one.write.mode("append").options(extension="txt", **plain).csv(path)
    one.limit(1).write.options(extension="sql", **plain).csv(f"{path}/below")
    found = fl.list_sql_scripts(spark, path)
    return found.select("sql", (F.concat("script_id", F.lit(".sql")) == F.col("file_name")).alias("named"),
                        F.lit(found.select("file_name").distinct().count()).cast("long").alias("n_files"))


@register("report_discovery", """SELECT 'ord_' || o_orderkey AS script_id, CAST(u AS BIGINT) AS id, 'select ' || u || ' from ' || o_orderpriority AS bq_sql, true AS ranked
FROM orders CROSS JOIN (VALUES (1), (2)) AS t(u)""")
def q_report_discovery(spark: SparkSession, sf: str) -> DataFrame:
    """Run reports in folders by pattern, one per order, as units; every report file has a place in the order of time."""
    path = stored_path(spark, "reports")
    o = read_table(spark, sf, "orders")
    unit = lambda k: F.struct(F.lit(k).alias("id"), F.concat(F.lit(f"select {k} from "), F.col("o_orderpriority")).alias("bq_sql"))
    reports = o.select(F.concat(F.lit("ord_"), F.col("o_orderkey").cast("string")).alias("script_id"), F.array(unit(1), unit(2)).alias("units"),
                       F.concat("o_orderstatus", F.lit("_bq")).alias("run"))
    reports.write.partitionBy("run").json(path)
    reports.limit(1).drop("run").write.json(f"{path}/other")
    units = fl.report_units(fl.run_reports(spark, path, "*_bq/part-*.json", lines=True))
    n = units.select("report_path").distinct().count()
    return units.select("script_id", F.col("id").cast("long").alias("id"), "bq_sql", F.col("recency").between(1, n).alias("ranked"))


_LOADED = ("customer", "orders", "lineitem", "events")


@register("loader_types", "\nUNION ALL\n".join(f"""SELECT '{t}' AS table_name, column_name, CAST(ordinal_position AS INTEGER) AS ordinal,
  CASE WHEN data_type LIKE 'TIMESTAMP%' OR data_type = 'DATE' THEN 'DATETIME' WHEN data_type = 'BOOLEAN' THEN 'BOOL'
       WHEN data_type IN ('BIGINT', 'INTEGER', 'SMALLINT', 'DOUBLE', 'FLOAT') OR data_type LIKE 'DECIMAL%' THEN 'FLOAT64' ELSE 'STRING' END AS loader_type,
  n AS n_values
FROM information_schema.columns JOIN (UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM {t}) ON COLUMNS(*) INTO NAME counted VALUE n) AS v
     ON counted = column_name WHERE table_name = '{t}'""" for t in _LOADED))
def q_loader_types(spark: SparkSession, sf: str) -> DataFrame:
    """Live schemas, the loader's type of every column and how many values it has to load."""
    out = []
    for t in _LOADED:
        schema = tb.table_schema(spark, f"{sf.rstrip('/')}/{t}.parquet", "parquet")
        kinds = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(i).alias("ordinal"), F.lit(loader_type_name(f.dataType)).alias("loader_type"),
                                   F.col(f"n{i}").alias("n_values")) for i, f in enumerate(schema, 1)])
        counts = read_table(spark, sf, t).agg(*[F.count(f.name).alias(f"n{i}") for i, f in enumerate(schema, 1)])
        out.append(counts.select(F.lit(t).alias("table_name"), F.inline(kinds)))
    return fp.balanced_union(out)


@register("readable_tables", """SELECT n_nationkey, COUNT(c_custkey) > 0 AS readable FROM nation
LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 9800 GROUP BY n_nationkey""")
def q_readable_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Q4: which nations' folders of rich customers can be read, probed at the same time."""
    path = stored_path(spark, "nations")
    read_table(spark, sf, "customer").where("c_acctbal > 9800").write.partitionBy("c_nationkey").parquet(path)
    names = {f"{path}/c_nationkey={r[0]}": r[0] for r in read_table(spark, sf, "nation").select("n_nationkey").collect()}
    keys = spark.createDataFrame([(k, v) for k, v in names.items()], "table_name string, n_nationkey long")
    found = tb.readable(spark, list(names), "parquet")
    return found.join(keys, "table_name").select(F.col("n_nationkey").cast(read_table(spark, sf, "nation").schema["n_nationkey"].dataType).alias("n_nationkey"), "readable")


@register("listed_sizes", """SELECT lower('table=' || o_orderpriority) AS table_name, CAST(SUM(strlen(CAST(o_orderkey AS VARCHAR)) + 1 + strlen(CAST(o_custkey AS VARCHAR)) + 1) AS BIGINT) AS size_bytes
FROM orders GROUP BY ALL""")
def q_listed_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of all tables below a folder from the listing of their files alone."""
    path = stored_path(spark, "warehouse")
    line = F.concat_ws("|", "o_orderkey", "o_custkey")
    read_table(spark, sf, "orders").select(line.alias("line"), F.col("o_orderpriority").alias("table")).write.partitionBy("table").text(path)
    return cst.listed_sizes(spark, path, "*.txt")


# ---------------------------------------------------------------- scripts, exports, prefixes

from concord.sources.tables import execute_script  # noqa: E402


# The reference's demo script, re-expressed as one Spark SQL script: the variable
# is DECLAREd and SET from a query (Q2), the stage-1 table is a view, and the last
# statement is the report. Statements run in order on the cluster (S3).
DEMO_SCRIPT = """
DECLARE run_day TIMESTAMP_NTZ;
SET run_day = (SELECT MAX(o_orderdate) FROM {orders});
CREATE OR REPLACE TEMPORARY VIEW concord_daily_revenue AS
  SELECT o.o_custkey AS customer_id, c.c_mktsegment AS segment, CAST(o.o_orderdate AS DATE) AS order_day,
         SUM(COALESCE(CAST(COALESCE(o.o_totalprice, 0.0) AS DECIMAL(38,6)), 0)) AS revenue, COUNT(*) AS order_count
  FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey
  WHERE o.o_orderdate = run_day
  GROUP BY o.o_custkey, c.c_mktsegment, CAST(o.o_orderdate AS DATE);
SELECT segment, CAST(SUM(revenue) AS DECIMAL(38,6)) AS revenue, CAST(SUM(order_count) AS BIGINT) AS order_count
FROM concord_daily_revenue GROUP BY segment;
"""


@register("demo_script", ORACLE["segment_revenue_last_day"])
def q_demo_script(spark: SparkSession, sf: str) -> DataFrame:
    # The script's last result (one row per segment) is returned through the driver.
    return execute_script(spark, DEMO_SCRIPT, orders=read_table(spark, sf, "orders"),
                          customer=read_table(spark, sf, "customer"))


@register("registry_export", f"""WITH b AS ({rd.BASE_SQL})
SELECT source_schema AS oracle_schema, source_table AS oracle_table, target_project AS bigquery_project,
       target_dataset AS bigquery_dataset, target_table AS bigquery_table, status,
       CASE WHEN source_reachable THEN 'true' ELSE 'false' END AS oracle_reachable, source_checked_at AS oracle_checked_at,
       CASE WHEN target_reachable THEN 'true' ELSE 'false' END AS bigquery_reachable,
       target_checked_at AS bigquery_checked_at, notes
FROM b ORDER BY oracle_schema, oracle_table""")
def q_registry_export(spark: SparkSession, sf: str) -> DataFrame:
    return reg.export_frame(_base(spark, sf))


# ---------------------------------------------------------------- streaming

STREAM_SQL = """
SELECT event_type, COUNT(*) AS row_count,
       COALESCE(SUM(COALESCE(TRY_CAST(value AS DECIMAL(38,6)), 0)), 0) AS sum_value,
       COALESCE(SUM(COALESCE(TRY_CAST(user_id AS DECIMAL(38,6)), 0)), 0) AS sum_user_id
FROM events GROUP BY event_type"""


@register("stream_fingerprint_events", STREAM_SQL)
def q_stream_fingerprint_events(spark: SparkSession, sf: str) -> DataFrame:
    """The events table streamed as files into an incremental fingerprint, then read back.

    Runs the streaming query (availableNow) when called; each call writes a new
    output and checkpoint under the session's checkpoint dir.
    """
    import posixpath
    import uuid

    from concord.session import ensure_checkpoint_dir
    from concord.streaming.fingerprint import maintain_fingerprint, read_fingerprint

    run = uuid.uuid4().hex
    base = posixpath.join(ensure_checkpoint_dir(spark), "concord-streams", run)
    schema = read_table(spark, sf, "events").schema
    # A table is one parquet file or a directory of part files; a file stream
    # needs a directory, so a single file is streamed from its folder by name.
    path = f"{sf.rstrip('/')}/events.parquet"
    listed = spark.read.format("binaryFile").load(path).select("path").limit(2).collect()  # at most 2 rows
    single = len(listed) == 1 and listed[0].path.rstrip("/").endswith("/events.parquet")
    source, options = (sf.rstrip("/"), {"pathGlobFilter": "events.parquet"}) if single else (path, {})
    q = maintain_fingerprint(spark, source, schema, ["event_type"], ["value", "user_id"],
                             posixpath.join(base, "out"), f"events_fp_{run}", posixpath.join(base, "ckpt"),
                             reader_options=options)
    q.awaitTermination()
    return read_fingerprint(spark, posixpath.join(base, "out")).select(
        "event_type", F.col("n").alias("row_count"), F.col("_s0").alias("sum_value"), F.col("_s1").alias("sum_user_id"))
