"""Information-schema rows of two catalogs, derived from the ``part`` table: one source and one target table per part.

The declared types, lengths, nullability and the tables a side can read all follow from the part's values, so that
every status and warning of the audit occurs. The same text runs on both engines.
"""

from __future__ import annotations

_HEAD = "SELECT {ref} || p_partkey AS table_ref, {name} AS column_name, {type} AS data_type, {null} AS is_nullable, " \
        "{pos} AS ordinal, {length} AS length, {precision} AS precision, {scale} AS scale FROM part{where}"


def _column(ref: str, name: str, type: str, null: str = "'YES'", pos: int = 1, length: str = "NULL", precision: str = "NULL",
            scale: str = "NULL", where: str = "") -> str:
    number = lambda x: f"CAST({x} AS INTEGER)"
    return _HEAD.format(ref=f"'{ref}'", name=f"'{name}'", type=type, null=null, pos=number(pos), length=number(length),
                        precision=number(precision), scale=number(scale), where=where)


#: Declared types of the last column, by part number; some are there for the order of the family rules.
MISC = ["NUMBER", "VARCHAR2(20)", " timestamp ", "BOOLEAN", "RAW", "STRUCT<a INT64>", "ARRAY<STRING>", "JSON", "INTERVAL", "POINT",
        "XMLTYPE", "  "]
#: Their families, as the rule's words and order give them.
MISC_FAMILY = ["numeric", "text", "temporal", "boolean", "bytes", "numeric", "text", "json", "numeric", "numeric", "xmltype", "unknown"]


def _pick(values: list[str], key: str) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


SOURCE_SQL = "\nUNION ALL\n".join([
    _column("src.part_", "id", "'NUMBER(19,0)'", "'NO'", 1),
    _column("src.part_", "name", "'VARCHAR2'", "'Y'", 2, "length(p_name) + p_size"),
    _column("src.part_", "price", "'decimal(12,4)'", "'YES'", 3),
    _column("src.part_", "made", "'DATE'", "NULL", 4),
    _column("src.part_", "note", "'CLOB'", "'YES'", 5, where=" WHERE p_size % 5 = 0"),
    _column("src.part_", "misc", _pick(MISC, "p_partkey"), "'YES'", 6)])

TARGET_SQL = "\nUNION ALL\n".join([
    _column("tgt.part_", "ID", "'INT64'", "'NO'", 1),
    _column("tgt.part_", "name", "'STRING'", "CASE WHEN p_partkey % 7 = 0 THEN 'NO' ELSE 'YES' END", 2, "length(p_name) + p_size - p_partkey % 4"),
    _column("tgt.part_", "price", _pick(["NUMERIC", "DECIMAL(10,2)", "FLOAT64", "DECIMAL(12, 4)"], "p_partkey"), "'YES'", 3),
    _column("tgt.part_", "made", "CASE WHEN p_partkey % 11 = 0 THEN 'STRING' ELSE 'TIMESTAMP' END", "'NO'", 4),
    _column("tgt.part_", "extra", "'BOOL'", "'YES'", 5, where=" WHERE p_size % 6 = 0"),
    _column("tgt.part_", "misc", _pick(MISC, "p_partkey"), "'YES'", 6)])

PAIRS_SQL = "SELECT 'src.part_' || p_partkey AS source_table, 'tgt.part_' || p_partkey AS target_table FROM part"

#: Tables that can be read: some source and some target tables cannot.
READABLE_SQL = ("SELECT 'src.part_' || p_partkey AS table_ref FROM part WHERE p_partkey % 89 <> 3\n"
                "UNION ALL SELECT 'tgt.part_' || p_partkey FROM part WHERE p_partkey % 97 <> 5")


def _family(t: str) -> str:
    """Families of the types that occur here, one by one."""
    names = {"numeric": ["NUMBER(19,0)", "DECIMAL(12,4)", "INT64", "NUMERIC", "DECIMAL(10,2)", "FLOAT64", "DECIMAL(12, 4)"],
             "text": ["VARCHAR2", "CLOB", "STRING"], "temporal": ["DATE", "TIMESTAMP"], "boolean": ["BOOL"]}
    for n, f in zip(MISC, MISC_FAMILY):
        names.setdefault(f, []).append(n.strip().upper())
    return f"CASE {t} " + " ".join(f"WHEN '{n}' THEN '{f}'" for f, all_ in names.items() for n in dict.fromkeys(all_)) + " END"


_PRECISION = ("CASE t WHEN 'NUMBER(19,0)' THEN 19 WHEN 'DECIMAL(12,4)' THEN 12 WHEN 'DECIMAL(12, 4)' THEN 12 WHEN 'DECIMAL(10,2)' THEN 10 "
              "WHEN 'VARCHAR2(20)' THEN 20 WHEN 'NUMERIC' THEN 38 WHEN 'INT64' THEN 19 END")
_SCALE = ("CASE t WHEN 'NUMBER(19,0)' THEN 0 WHEN 'DECIMAL(12,4)' THEN 4 WHEN 'DECIMAL(12, 4)' THEN 4 WHEN 'DECIMAL(10,2)' THEN 2 "
          "WHEN 'NUMERIC' THEN 9 WHEN 'INT64' THEN 0 END")


def _meta(sql: str) -> str:
    return (f"SELECT table_ref, column_name, {_family('t')} AS type_family, upper(is_nullable) IN ('YES', 'Y') AS nullable, length, "
            f"{_PRECISION} AS precision, {_SCALE} AS scale FROM (SELECT *, upper(trim(data_type)) AS t FROM ({sql}))")


#: The aligned column report, from the tables above.
AUDIT_SQL = f"""
WITH readable AS ({READABLE_SQL}),
 pairs AS (SELECT *, source_table IN (SELECT table_ref FROM readable) AS s_ok, target_table IN (SELECT table_ref FROM readable) AS t_ok
           FROM ({PAIRS_SQL})),
 s AS (SELECT p.source_table, p.target_table, lower(column_name) AS column_key, m.* EXCLUDE (table_ref) FROM pairs p
       JOIN ({_meta(SOURCE_SQL)}) m ON m.table_ref = p.source_table WHERE s_ok AND t_ok),
 t AS (SELECT p.source_table, p.target_table, lower(column_name) AS column_key, m.* EXCLUDE (table_ref) FROM pairs p
       JOIN ({_meta(TARGET_SQL)}) m ON m.table_ref = p.target_table WHERE s_ok AND t_ok),
 j AS (SELECT COALESCE(s.source_table, t.source_table) AS source_table, COALESCE(s.target_table, t.target_table) AS target_table,
         COALESCE(s.column_key, t.column_key) AS column_key, s.column_name AS source_column_name, t.column_name AS target_column_name,
         s.type_family AS sf, t.type_family AS tf, s.column_name IS NOT NULL AS sp, t.column_name IS NOT NULL AS tp,
         concat_ws('; ',
           CASE WHEN s.nullable AND NOT t.nullable THEN 'target column is required but the source column is nullable' END,
           CASE WHEN t.precision < s.precision THEN 'target precision ' || t.precision || ' is lower than source precision ' || s.precision END,
           CASE WHEN s.scale > 0 AND t.scale < s.scale THEN 'target scale ' || t.scale || ' is lower than source scale ' || s.scale END,
           CASE WHEN t.length < s.length AND t.length > 0 THEN 'target length ' || t.length || ' is lower than source length ' || s.length END) AS w
       FROM s FULL OUTER JOIN t ON s.source_table = t.source_table AND s.column_key = t.column_key),
 r AS (SELECT source_table, target_table, column_key, source_column_name, target_column_name, sf AS source_type_family,
         tf AS target_type_family, sp AS source_present, tp AS target_present,
         CASE WHEN NOT sp THEN 'extra_target' WHEN NOT tp THEN 'missing_target' WHEN sf <> tf THEN 'type_mismatch'
              WHEN w <> '' THEN 'compatible_with_warnings' ELSE 'compatible' END AS status,
         CASE WHEN NOT sp THEN 'column exists only in the target'
              WHEN NOT tp THEN 'column exists in the source but is missing from the target'
              WHEN sf <> tf THEN 'type family changed from ' || sf || ' to ' || tf ELSE w END AS notes FROM j
       UNION ALL SELECT source_table, target_table, NULL, NULL, NULL, NULL, NULL, false, false, 'metadata_error',
         CASE WHEN NOT s_ok AND NOT t_ok THEN 'not in the catalog: source, target' WHEN NOT s_ok THEN 'not in the catalog: source'
              ELSE 'not in the catalog: target' END FROM pairs WHERE NOT (s_ok AND t_ok))
SELECT *, CASE WHEN status IN ('missing_target', 'type_mismatch', 'metadata_error') THEN 'error'
               WHEN status IN ('extra_target', 'compatible_with_warnings') THEN 'warning' ELSE 'ok' END AS severity FROM r"""

FAMILY_SQL = (f"SELECT table_ref, column_name, {_family('upper(trim(data_type))')} AS type_family FROM ({SOURCE_SQL}\nUNION ALL\n{TARGET_SQL})")
