"""SQL text builders for the DuckDB twins of the reconciliation queries.

They spell out, in portable SQL, what the DataFrame operators compute, so the
driver can check the Spark results against an independent engine.
"""

from __future__ import annotations

from collections.abc import Sequence

DEC = "DECIMAL(38,6)"


def _sum(c: str) -> str:
    """Sum of the values below 1e22, as exact decimals; 0 without any."""
    return f"COALESCE(SUM(TRY_CAST({c} AS {DEC})) FILTER (WHERE abs(CAST({c} AS DOUBLE)) < 1e22), 0)"


#: What a sum leaves out, counted; out-of-range values also as a sorted list, compared as such.
SPECIAL = {"nan": "COUNT(*) FILTER (WHERE isnan({c}))", "positive_infinity": "COUNT(*) FILTER (WHERE {c} = 'Infinity'::DOUBLE)",
           "negative_infinity": "COUNT(*) FILTER (WHERE {c} = '-Infinity'::DOUBLE)",
           "out_of_range": "COUNT(*) FILTER (WHERE isfinite({c}) AND abs({c}) >= 1e22)"}


def _special_aggs(columns: Sequence[str], prefix: str) -> list[str]:
    out = []
    for i, c in enumerate(columns):
        out += [f"{e.format(c=c)} AS {prefix}x{i}{k}" for k, e in enumerate(SPECIAL.values())]
        out.append(f"list_sort(COALESCE(list({c}) FILTER (WHERE isfinite({c}) AND abs({c}) >= 1e22), [])) AS {prefix}x{i}l")
    return out


def group_agg_sql(table: str, keys: Sequence[str], columns: Sequence[str], prefix: str, special: Sequence[str] = ()) -> str:
    sums = [f"{_sum(c)} AS {prefix}s{i}" for i, c in enumerate(columns)] + _special_aggs(special, prefix)
    ks = [f"{k} AS {prefix}k{j}" for j, k in enumerate(keys)]
    by = f" GROUP BY {', '.join(str(j + 1) for j in range(len(keys)))}" if keys else ""
    return f"SELECT {', '.join([*ks, f'COUNT(*) AS {prefix}n', *sums])} FROM {table}{by}"


def _special_rows(head: str, frame: str, group_key: str, special: Sequence[str], prefix: str) -> list[str]:
    parts = []
    for i, c in enumerate(special):
        for k, check in enumerate(SPECIAL):
            s, t = f"COALESCE(sx{i}{k}, 0)", f"COALESCE(tx{i}{k}, 0)"
            differ = f"{s} <> {t}" + (f" OR COALESCE(sx{i}l, []) <> COALESCE(tx{i}l, [])" if check == "out_of_range" else "")
            parts.append(f"{head}, '{prefix}{check}', '{c}'{group_key}, CAST({s} AS {DEC}), CAST({t} AS {DEC}) FROM {frame} WHERE {differ}")
    return parts


def fingerprint_diff_sql(src: str, tgt: str, keys: Sequence[str], columns: Sequence[str],
                         tol: float = 1e-4, src_name: str | None = None, tgt_name: str | None = None,
                         special: Sequence[str] = ()) -> str:
    """Differences between two tables' fingerprints: totals from the tables themselves, groups by a full join.

    ``special`` names the columns whose NaN, infinite and out-of-range values are compared too."""
    src_name, tgt_name = src_name or src, tgt_name or tgt
    on = " AND ".join(f"s.sk{j} IS NOT DISTINCT FROM t.tk{j}" for j in range(len(keys)))
    key = lambda j: f"CAST(COALESCE(s.sk{j}, t.tk{j}) AS VARCHAR)"
    key_text = key(0) if len(keys) == 1 else "concat_ws('|', " + ", ".join(
        f"COALESCE(length({key(j)}) || ':' || {key(j)}, '␀')" for j in range(len(keys))) + ")"
    head = f"SELECT '{src_name}' AS source, '{tgt_name}' AS target"
    none = "CAST(NULL AS VARCHAR)"
    parts = [f"{head}, 'count' AS check, {none} AS column_name, {none} AS group_key, "
             f"CAST(sn AS {DEC}) AS source_value, CAST(tn AS {DEC}) AS target_value FROM tot WHERE sn <> tn"]
    for i, c in enumerate(columns):
        close = f"abs(ss{i} - ts{i}) <= greatest({tol}::DOUBLE * greatest(abs(ss{i}), abs(ts{i})), {tol}::DOUBLE)"
        parts.append(f"{head}, 'sum', '{c}', {none}, CAST(ss{i} AS {DEC}), CAST(ts{i} AS {DEC}) FROM tot WHERE NOT ({close})")
    parts += _special_rows(head, "tot", f", {none}", special, "")
    parts.append(f"{head}, 'group_count', {none}, group_key, CAST(sn AS {DEC}), CAST(tn AS {DEC}) "
                 f"FROM g WHERE COALESCE(sn, 0) <> COALESCE(tn, 0)")
    for i, c in enumerate(columns):
        parts.append(f"{head}, 'group_sum', '{c}', group_key, ss{i}, ts{i} FROM g WHERE COALESCE(ss{i}, 0) <> COALESCE(ts{i}, 0)")
    parts += _special_rows(head, "g", ", group_key", special, "group_")
    return (f"WITH s AS ({group_agg_sql(src, keys, columns, 's', special)}),\n"
            f" t AS ({group_agg_sql(tgt, keys, columns, 't', special)}),\n"
            f" g AS (SELECT {key_text} AS group_key, s.*, t.* FROM s FULL OUTER JOIN t ON {on}),\n"
            f" tot AS (SELECT * FROM ({group_agg_sql(src, [], columns, 's', special)}) CROSS JOIN ({group_agg_sql(tgt, [], columns, 't', special)}))\n"
            + "\nUNION ALL\n".join(parts))


def key_diff_sql(src: str, tgt: str, key: str, columns: Sequence[str], special: Sequence[str] = ()) -> str:
    """Per-key differences by grouping both tables whole."""
    parts = [f"SELECT {key}, 'group_count' AS check, CAST(NULL AS VARCHAR) AS column_name, "
             f"CAST(sn AS {DEC}) AS source_value, CAST(tn AS {DEC}) AS target_value FROM g "
             f"WHERE COALESCE(sn, 0) <> COALESCE(tn, 0)"]
    for i, c in enumerate(columns):
        parts.append(f"SELECT {key}, 'group_sum', '{c}', ss{i}, ts{i} FROM g WHERE COALESCE(ss{i}, 0) <> COALESCE(ts{i}, 0)")
    parts += _special_rows(f"SELECT {key}", "g", "", special, "group_")
    return (f"WITH s AS ({group_agg_sql(src, [key], columns, 's', special)}),\n t AS ({group_agg_sql(tgt, [key], columns, 't', special)}),\n"
            f" g AS (SELECT COALESCE(s.sk0, t.tk0) AS {key}, s.*, t.* FROM s FULL OUTER JOIN t "
            f"ON s.sk0 IS NOT DISTINCT FROM t.tk0)\n" + "\nUNION ALL\n".join(parts))


def row_diff_sql(src: str, tgt: str, columns: Sequence[str]) -> str:
    """Multiset difference by whole rows, as ``concord.operators.rowdiff.row_multiset_diff``."""
    cols = ", ".join(columns)
    on = " AND ".join(f"s.{c} IS NOT DISTINCT FROM t.{c}" for c in columns)
    pick = ", ".join(f"CASE WHEN s.n IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in columns)
    return (f"WITH s AS (SELECT {cols}, COUNT(*) AS n FROM {src} GROUP BY ALL),\n"
            f" t AS (SELECT {cols}, COUNT(*) AS n FROM {tgt} GROUP BY ALL)\n"
            f"SELECT {pick}, COALESCE(s.n, 0) AS source_count, COALESCE(t.n, 0) AS target_count\n"
            f"FROM s FULL OUTER JOIN t ON {on} WHERE COALESCE(s.n, 0) <> COALESCE(t.n, 0)")
