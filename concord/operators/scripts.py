"""SQL-script corpora as Spark jobs.

One row per script in, one row per statement (or per table reference) out.
Everything is a built-in SQL function (Java regex, ``posexplode``, joins); no
Python runs per row. This is an inventory, not a SQL parser: statements are
split on semicolons outside single quotes, classified by their first keyword,
and table names are found after ``FROM``/``JOIN`` and ``CREATE [OR REPLACE]
TABLE``. Comments are not recognised (as in the reference).

Splitting (X1) is linear: a statement is a maximal run of non-``;`` characters
and quoted strings, matched left to right with possessive quantifiers. A
doubled quote ``''`` inside a string toggles the state twice, which is what the
reference's escape handling amounts to, and an unterminated quote runs to the
end of the script, where the tail is kept.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.bitmaps import maybe_among
from concord.functions.stored import stored
from concord.functions.text import WS, strip_ws
from concord.operators.name_trie import replace_by_trie

BROADCAST_NAMES = 200_000  # a name and its replacement each

# Patterns of the reference's statement inventory.
UNIT_RE = r"(?:[^;']++|'[^']*+(?:'|\z))++"
SOURCE_RE = r"(?iU)\b(?:FROM|JOIN)\s+([`\"]?[a-zA-Z_][\w$.]*[`\"]?)"
TARGET_RE = r"(?iU)\bCREATE\s+(?:OR\s+REPLACE\s+)?TABLE\s+([`\"]?[a-zA-Z_][\w$.]*[`\"]?)"
PLSQL_BLOCK_RE = r"(?isU)\bDECLARE\b.*?\bEND\s*;\s*/"
NVL_RE = r"(?iU)\bNVL\s*\("
TRUNC_RE = r"(?iU)\bTRUNC\s*\("
CTAS_RE = r"(?iU)\bCREATE\s+TABLE\s+([a-zA-Z_][\w$]*)\s+AS"
INTO_RE = r"(?isU)SELECT\s+(.+?)\s+INTO\s+([a-zA-Z_][\w$]*)\s+FROM\s+([a-zA-Z_][\w$]*)(.*?);"
ISO_DATE_RE = r"^\d{4}-\d{2}-\d{2}$"
STATEMENT_KINDS = (("DDL", ("CREATE",)), ("DML", ("INSERT", "UPDATE", "DELETE", "MERGE")), ("SELECT", ("SELECT",)))


def split_units(scripts: DataFrame, text: str = "sql", keep: tuple[str, ...] = ("script_id",)) -> DataFrame:
    """``(*keep, unit_id, statement)``; units numbered from 1 after dropping blanks."""
    parts = F.filter(F.transform(F.regexp_extract_all(F.col(text), F.lit(UNIT_RE), 0), strip_ws),
                     lambda s: F.length(s) > 0)
    return scripts.select(*keep, F.posexplode(parts).alias("pos", "statement")).select(
        *keep, (F.col("pos") + 1).cast("int").alias("unit_id"), "statement")


def classify(statement: Column) -> Column:
    """DDL / DML / SELECT / SQL by the first keyword."""
    head = F.upper(F.regexp_replace(statement, rf"(?U)^{WS}+", ""))
    expr = None
    for kind, words in STATEMENT_KINDS:
        cond = None
        for w in words:
            c = head.startswith(w)
            cond = c if cond is None else cond | c
        expr = F.when(cond, F.lit(kind)) if expr is None else expr.when(cond, F.lit(kind))
    return expr.otherwise(F.lit("SQL"))


def _clean_names(found: Column) -> Column:
    # Unquote, keep the last dotted part, lower-case; array_distinct keeps first-seen order.
    return F.array_distinct(F.transform(found, lambda x: F.lower(
        F.element_at(F.split(F.regexp_replace(x, r"^[`\"]+|[`\"]+$", ""), r"\."), -1))))


def sources_of(statement: Column) -> Column:
    """Tables read (after FROM / JOIN)."""
    return _clean_names(F.regexp_extract_all(statement, F.lit(SOURCE_RE), 1))


def targets_of(statement: Column) -> Column:
    """Tables written by ``CREATE [OR REPLACE] TABLE`` (INSERT/MERGE targets are not extracted)."""
    return _clean_names(F.regexp_extract_all(statement, F.lit(TARGET_RE), 1))


def describe_units(units: DataFrame) -> DataFrame:
    """Each statement's kind and the tables that it reads and writes."""
    return units.select("*", classify(F.col("statement")).alias("statement_type"),
                        sources_of(F.col("statement")).alias("sources"), targets_of(F.col("statement")).alias("targets"))


def build_units(scripts: DataFrame, text: str = "sql", keep: tuple[str, ...] = ("script_id",)) -> DataFrame:
    """``(*keep, unit_id, statement, statement_type, sources, targets)``."""
    return describe_units(split_units(scripts, text, keep))


def strip_declare_blocks(sql: Column) -> Column:
    """Drop ``DECLARE … END; /`` blocks."""
    return F.regexp_replace(sql, PLSQL_BLOCK_RE, "")


def sql_literal(value: Column) -> Column:
    """NULL, ``DATE 'x'`` for ISO dates, else a quoted string with ``''`` escapes."""
    quoted = F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))
    return (F.when(value.isNull(), F.lit("NULL"))
            .when(value.rlike(ISO_DATE_RE), F.concat(F.lit("DATE "), quoted)).otherwise(quoted))


def _phrases(text: Column, words: int) -> Column:
    """Every distinct run of 1 to ``words`` words joined by dots or ``$`` signs, lower-cased: the names a text may hold.

    A look-ahead starts a run at every word, and one pattern per length ends it at a word's end.
    """
    found = [F.regexp_extract_all(text, F.lit(rf"(?U)\b(?=(\w+(?:[.$]+\w+){{{k}}})\b)"), 1) for k in range(words)]
    return F.array_distinct(F.transform(F.concat(*found), F.lower))


def replace_words(df: DataFrame, text: str, keys: tuple[str, ...], mapping: DataFrame,
                  map_keys: tuple[str, ...] = ()) -> DataFrame:
    """Case-insensitive replacement of whole names in ``text`` through a mapping frame, longest name first.

    ``keys`` identify a row uniquely. ``mapping`` has ``word`` (lower-case; may hold dots and ``$``), ``replacement`` and
    optionally ``map_keys`` (a subset of ``keys``) that scope a name to rows, e.g. a script's own variables. Where
    several names start at the same place the longest wins, and a replacement is not re-mapped.

    Unscoped names up to ``BROADCAST_NAMES`` are a broadcast trie (:mod:`name_trie`): one pass over each text, no shuffle. If
    the mapping holds more, only those that occur in the texts count, and a broadcast bitmap drops words that are no names. Plan of scoped names and of still more: the distinct names of all texts are counted (combined before the shuffle, so a word of every statement is
    one record per task) and joined to the mapping. What is left, names that occur and are mapped, is broadcast when
    counted small, so no exploded word is shuffled; beyond that only names that can match are, the most frequent
    ones still by broadcast. Matches are grouped back per row and applied by one alternation per row.
    """
    keys = tuple(keys)
    # One replacement per word (keys differing only in case collapse to one).
    m = mapping.where("word is not null and replacement is not null").groupBy(*map_keys, "word").agg(F.min("replacement").alias("replacement"))
    if not map_keys:
        m = stored(m, "mapping")
        if m.count() <= BROADCAST_NAMES:
            return replace_by_trie(df, text, m)
    longest = m.agg(F.max(F.size(F.regexp_extract_all(F.col("word"), F.lit(r"(?U)\w+"), 0)))).first()[0] or 1
    if not map_keys:
        # too many names to broadcast: the texts are made once, and of their words only those that may be names are kept and dealt out
        df = stored(df, "texts")
        hashed = df.select(*keys, F.explode(_phrases(F.col(text), longest)).alias("word")).withColumn("_hash", F.xxhash64("word"))
        words = stored(maybe_among(hashed, "_hash", m.select(F.xxhash64("word").alias("_hash")), m.count()).drop("_hash"), "words")
    else:
        words = df.select(*keys, F.explode(_phrases(F.col(text), longest)).alias("word"))
    seen = words.groupBy("word").agg(F.count(F.lit(1)).alias("_n"))
    live = stored(m.join(seen.hint("merge"), "word"), "names")
    n, total = live.count(), live.agg(F.sum("_n")).first()[0] or 0
    names = live.drop("_n")
    if not map_keys and n <= BROADCAST_NAMES:
        return replace_by_trie(df, text, names)
    on = [*map_keys, "word"]
    if n <= BROADCAST_NAMES:
        matched = words.join(F.broadcast(names), on)
    else:
        # names in more than 1/1000 of all places: fewer than 1000 words, each with the rows of its scopes
        often = F.broadcast(live.groupBy("word").agg(F.max("_n").alias("_n")).where(F.col("_n") > total // 1000).select("word"))
        few = names.join(often, "word", "left_semi")
        matched = words.join(often, "word", "left_semi").join(F.broadcast(few) if not map_keys else few.hint("merge"), on).unionByName(
            words.join(often, "word", "left_anti").join(names.join(often, "word", "left_anti").hint("merge"), on))
    hits = matched.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("word", "replacement"))).alias("_map"))
    j = df.join(hits.hint("merge"), list(keys), "left")
    by_length = F.array_sort(F.map_keys("_map"), lambda a, b: F.length(b) - F.length(a))
    pattern = F.concat(F.lit(r"(?iU)\b(?:"), F.array_join(F.transform(by_length, lambda w: F.concat(F.lit(r"\Q"), w, F.lit(r"\E"))), "|"),
                       F.lit(r")\b"))
    between = F.split(F.col(text), pattern, -1)
    found = F.regexp_extract_all(F.col(text), pattern, F.lit(0))
    new = F.array_join(F.transform(between, lambda part, i: F.concat(
        F.when(i > 0, F.try_element_at(F.col("_map"), F.lower(F.get(found, i - 1)))).otherwise(F.lit("")), part)), "")
    out = F.when(F.col("_map").isNull(), F.col(text)).otherwise(new)
    return j.select(*[out.alias(c) if c == text else F.col(c) for c in df.columns])


def translate(units: DataFrame, mapping: DataFrame, text: str = "statement",
              keys: tuple[str, ...] = ("script_id", "unit_id")) -> DataFrame:
    """Table names through ``mapping(source_name, target_name)``, NVL→COALESCE,
    TRUNC→DATE, ``CREATE TABLE x AS`` → ``CREATE OR REPLACE TABLE x AS`` (name lower-cased).

    Result column ``translated``. Every ``CREATE TABLE name AS`` of a statement is
    rewritten with its own (lower-cased) name.
    """
    m = mapping.select(F.lower("source_name").alias("word"), F.col("target_name").alias("replacement"))
    out = replace_words(units.withColumn("translated", F.col(text)), "translated", keys, m)
    t = F.col("translated")
    t = F.regexp_replace(t, NVL_RE, "COALESCE(")
    t = F.regexp_replace(t, TRUNC_RE, "DATE(")
    # CTAS: each distinct name gets its own replacement (lower-cased), applied in turn.
    names = F.array_distinct(F.regexp_extract_all(t, F.lit(CTAS_RE), 1))
    t = F.aggregate(names, t, lambda acc, n: F.regexp_replace(
        acc, F.concat(F.lit(r"(?iU)\bCREATE\s+TABLE\s+\Q"), n, F.lit(r"\E\s+AS")),
        F.concat(F.lit("CREATE OR REPLACE TABLE "), F.regexp_replace(F.lower(n), r"([\\$])", r"\\$1"), F.lit(" AS"))))
    return out.withColumn("translated", strip_ws(t))


def materialize_variables(scripts: DataFrame, variables: DataFrame, text: str = "sql",
                          keys: tuple[str, ...] = ("script_id",)) -> DataFrame:
    """Drop PL/SQL blocks and replace each resolved variable by its SQL literal.

    ``variables`` is ``(*keys, var_name, value)`` with ``value`` the resolved
    text (or NULL). A script's few variables are grouped into one array, joined
    to the script, and applied in order of name by ``aggregate`` with a
    whole-word, case-insensitive ``regexp_replace`` each (JVM-side, per row).
    """
    v = variables.select(*keys, F.struct(
        F.lower("var_name").alias("name"),
        F.concat(F.lit(r"(?iU)\b\Q"), F.lower("var_name"), F.lit(r"\E\b")).alias("pattern"),
        F.regexp_replace(sql_literal(F.col("value")), r"([\\$])", r"\\$1").alias("replacement")).alias("v"))
    per_script = v.groupBy(*keys).agg(F.array_sort(F.collect_list("v")).alias("_vars"))
    j = scripts.join(per_script.hint("merge"), list(keys), "left")  # both sides data-sized
    stripped = strip_declare_blocks(F.col(text))
    applied = F.aggregate(F.coalesce(F.col("_vars"), F.array().cast(per_script.schema["_vars"].dataType)), stripped,
                          lambda acc, x: F.regexp_replace(acc, x["pattern"], x["replacement"]))
    return j.select(*[strip_ws(applied).alias(c) if c == text else F.col(c) for c in scripts.columns])


def select_into(scripts: DataFrame, text: str = "sql", keys: tuple[str, ...] = ("script_id",)) -> DataFrame:
    """The ``SELECT expr INTO var FROM table tail;`` assignments as rows, to be resolved by the caller."""
    pat = INTO_RE
    found = F.regexp_extract_all(F.col(text), F.lit(pat), 0)
    one = F.col("_m")
    return scripts.select(*keys, F.explode(found).alias("_m")).select(
        *keys, F.lower(F.regexp_extract(one, pat, 2)).alias("var_name"),
        F.regexp_replace(strip_ws(F.regexp_extract(one, pat, 1)), rf"(?U){WS}+", " ").alias("expr"),
        F.lower(F.regexp_extract(one, pat, 3)).alias("table_name"), strip_ws(F.regexp_extract(one, pat, 4)).alias("tail"))


def is_aggregate(expr: str) -> bool:
    """Whether an expression starts with a call of an aggregate function."""
    return re.match(r"(?i)\s*(max|min|sum|avg|count)\s*\(", expr) is not None


#: A literal that a comparison may hold: text, DATE or TIMESTAMP text, an unsigned number that is no part of a name.
LITERAL_RE = r"(?i)(?:\b(?:DATE|TIMESTAMP)\s*)?'(?:[^']|'')*'|(?<![\w$.])(?:\d+(?:\.\d+)?|\.\d+)(?![\w$.])"
#: Stands for a literal in a template.
HOLE = "\x01"
#: Tails in which every literal is a value to compare with: conditions without a clause of their own.
LIFTED_RE = r"(?is)^WHERE\b(?!.*\b(?:SELECT|GROUP|HAVING|ORDER|LIMIT|OFFSET|FETCH|QUALIFY|WINDOW|UNION|INTERSECT|EXCEPT|MINUS|JOIN|INTERVAL|OVER)\b).*$"


def lift_literals(tail: Column) -> tuple[Column, Column, Column]:
    """A tail as ``(template, types, literals)``: its text with ``HOLE`` for each literal, and the literals' SQL types and
    values as they stand (unquoted). Tails with more than conditions are a template of their own without literals."""
    plain = F.regexp_replace(tail, r"'(?:[^']|'')*'", "''")
    liftable = plain.rlike(LIFTED_RE) & ~F.contains(tail, F.lit(HOLE))
    found = F.when(liftable, F.regexp_extract_all(tail, F.lit(LITERAL_RE), 0)).otherwise(F.array().cast("array<string>"))

    def kind(x: Column) -> Column:
        whole, part = F.length(F.regexp_extract(x, r"^0*(\d*)", 1)), F.length(F.regexp_extract(x, r"\.(\d+)$", 1))
        number = (F.when(part > 0, F.format_string("DECIMAL(%d,%d)", F.greatest(whole + part, F.lit(1)), part))
                  .when(whole <= 9, "INT").when(whole <= 18, "BIGINT").otherwise(F.format_string("DECIMAL(%d,0)", whole)))
        return F.when(x.rlike("(?i)^DATE"), "DATE").when(x.rlike("(?i)^TIMESTAMP"), "TIMESTAMP").when(x.startswith("'"), "STRING").otherwise(number)

    def value(x: Column) -> Column:
        inner = F.regexp_extract(x, r"(?s)'(.*)'$", 1)
        return F.when(F.contains(x, F.lit("'")), F.replace(inner, F.lit("''"), F.lit("'"))).otherwise(x)

    template = F.when(liftable, F.regexp_replace(tail, LITERAL_RE, HOLE)).otherwise(tail)
    return template, F.transform(found, kind), F.transform(found, value)
