"""License scan in DataFrame functions only: ordered signature rules behind a keyword prefilter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.llm.common import written

# Fixed values of the contract: base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
BASE_CONFIDENCE = 0.8

#: License families: label, the words of its name as a pattern over normalised words, a keyword every match holds
#: from a word's start,
#: the versions that get a label of their own, and the words of its identifiers (also per version).
FAMILIES = (
    ("apache", "apache (?:software )?license", "apache", ("1 0", "1 1", "2 0"), "apache"),
    ("mit", "mit license", "mit license", (), "mit"),
    ("isc", "isc license", "isc", (), "isc"),
    ("bsd", "bsd (?:style )?license", "bsd", (), "bsd"),
    ("bsd-2-clause", "(?:bsd 2 clause(?: simplified)?|simplified bsd)(?: license)?", "bsd", (), "bsd 2 clause"),
    ("bsd-2-clause", "freebsd(?: license)?", "freebsd", (), "bsd 2 clause"),
    ("bsd-3-clause", "(?:bsd 3 clause(?: new| revised)?|(?:new|revised|modified) bsd)(?: license)?", "bsd", (), "bsd 3 clause"),
    ("bsd-4-clause", "(?:bsd 4 clause|original bsd)(?: license)?", "bsd", (), "bsd 4 clause"),
    ("gnu-gpl", "gnu (?:general public license|gpl)", "gnu", ("1", "2", "3"), "gpl"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public license", "general public license", ("2", "2 1", "3"), "lgpl"),
    ("agpl", "(?:gnu )?affero general public license", "affero", ("1", "3"), "agpl"),
    ("gfdl", "(?:gnu )?free documentation license", "free documentation", ("1 1", "1 2", "1 3"), "gfdl"),
    ("mpl", "mozilla public license", "mozilla", ("1 0", "1 1", "2 0"), "mpl"),
    ("epl", "eclipse public license", "eclipse", ("1 0", "2 0"), "epl"),
    ("cpl", "common public license", "common public", ("1 0",), "cpl"),
    ("cddl", "common development and distribution license", "common development", ("1 0", "1 1"), "cddl"),
    ("artistic", "artistic license", "artistic", ("1 0", "2 0"), "artistic"),
    ("bsl", "boost software license", "boost", ("1 0",), "bsl"),
    ("busl", "business source license", "business source", ("1 1",), "busl"),
    ("sspl", "server side public license", "server side", ("1",), "sspl"),
    ("elastic", "elastic license", "elastic", ("2 0",), "elastic"),
    ("eupl", "european union public licen[cs]e", "european union", ("1 0", "1 1", "1 2"), "eupl"),
    ("osl", "open software license", "open software", ("2 0", "2 1", "3 0"), "osl"),
    ("afl", "academic free license", "academic free", ("2 0", "2 1", "3 0"), "afl"),
    ("ofl", "(?:sil )?open font license", "open font", ("1 0", "1 1"), "ofl"),
    ("odbl", "open (?:data commons open )?database license", "database license", ("1 0",), "odbl"),
    ("odc-by", "open data commons attribution license", "open data commons", ("1 0",), "odc by"),
    ("pddl", "public domain dedication and license", "public domain", ("1 0",), "pddl"),
    ("ms-pl", "microsoft public license", "microsoft", (), "ms pl"),
    ("ms-rl", "microsoft reciprocal license", "microsoft", (), "ms rl"),
    ("zlib", "zlib(?: libpng)? license", "zlib", (), "zlib"),
    ("libpng", "libpng license", "libpng", ("2 0",), "libpng"),
    ("openssl", "openssl license", "openssl", (), "openssl"),
    ("php", "php license", "php license", ("3 0", "3 01"), "php"),
    ("python", "python (?:software foundation )?license", "python", ("2 0",), "psf"),
    ("ruby", "ruby license", "ruby license", (), "ruby"),
    ("w3c", "w3c (?:software )?(?:notice and )?license", "w3c", (), "w3c"),
    ("wtfpl", "do what the fuck you want to public license", "fuck you want", ("2",), "wtfpl"),
    ("unlicense", "(?:the )?unlicense", "unlicense", (), "unlicense"),
    ("upl", "universal permissive license", "universal permissive", ("1 0",), "upl"),
    ("ncsa", "(?:university of illinois )?ncsa (?:open source )?license", "ncsa", (), "ncsa"),
    ("vim", "vim license", "vim license", (), "vim"),
    ("beerware", "beer ?ware license", "beer", (), "beerware"),
    ("postgresql", "postgresql license", "postgresql", (), "postgresql"),
    ("json", "json license", "json license", (), "json"),
    ("openrail", "(?:creativeml )?openrail(?: m)?(?: license)?", "openrail", (), "openrail"),
    ("openrail", "(?:creativeml )?open rail(?: m)?(?: license)?", "open rail", (), "openrail"),
    ("llama", "llama(?: 2| 3)? community license", "community license", (), "llama"),
)
#: Creative Commons licenses are named by element words; their labels follow from those.
COMMONS = (
    ("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nc", "attribution non ?commercial"),
    ("by-nd", "attribution no ?deriv(?:ative)?s"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
)
#: Signatures without a family: label, pattern, keyword, priority, confidence.
PHRASES = (
    ("cc0", "cc0(?: 1 0)?(?: universal)?", "cc0", 3, 0.95),
    ("cc0", "creative commons zero", "creative commons", 3, 0.95),
    ("creative-commons", "creative commons", "creative commons", 1, 0.5),
    ("public-domain", "(?:dedicated to|placed in|released into|in) the public domain", "public domain", 2, 0.8),
    ("copyright", "copyright (?:c )?(?:19|20)[0-9]{2}", "copyright", 1, 0.6),
    ("copyright", "(?:c )?copyright (?:by|held by|owned by|belongs to)", "copyright", 1, 0.5),
    ("no-warranty", "without (?:any )?warrant(?:y|ies)(?: of any kind)?", "without", 1, 0.5),
    ("permission-grant", "permission is hereby granted free of charge to any person obtaining", "permission is hereby", 3, 0.95),
    ("redistribution", "redistribution and use in source and binary forms", "redistribution and use", 3, 0.95),
    ("proprietary", "(?:proprietary and confidential|confidential and proprietary)", "confidential", 2, 0.8),
    ("proprietary", "(?:may not be|no part (?:of this )?(?:\\S+ )?may be) (?:reproduced|copied|distributed)", "may", 2, 0.7),
    ("non-commercial", "for (?:personal and )?noncommercial use(?: only)?", "noncommercial use", 2, 0.7),
    ("non-commercial", "for (?:personal and )?non commercial use(?: only)?", "non commercial use", 2, 0.7),
    ("terms-of-use", "(?:subject to|under) (?:the|our|these) terms of (?:use|service)", "terms of", 1, 0.5),
    ("license-reference", "see (?:the )?licen[cs]e (?:file )?for (?:more )?(?:details|information)", "see", 1, 0.4),
)
GRANT = "(?:licensed|released|distributed|available|published|provided|covered) (?:to you )?(?:under|by) (?:the )?(?:terms of )?(?:the )?"


def rules() -> list[tuple[str, str, str, int, float]]:
    """All signatures in order: label, pattern over normalised words, keyword, priority, confidence.

    A family gives a name rule (priority 1), a grant rule (2), a rule of each version's name (3) and grant (4), and
    identifier rules (5); a match of a higher priority suppresses those that it holds.
    """
    found = []
    for label, name, keyword, versions, ident in FAMILIES:
        found += [(label, name, keyword, 1, 0.7), (label, GRANT + name, keyword, 2, 0.9),
                  (label, f"spdx license identifier {ident}", "spdx", 4, 1.0)]
        for v in versions:
            own, tail = f"{label}-{v.replace(' ', '.')}", f"(?: v| version)? ?{v}"
            found += [(own, name + tail, keyword, 3, 0.9), (own, GRANT + name + tail, keyword, 4, 0.95),
                      (own, f"spdx license identifier {ident} {v}(?: 0)?(?: only| or later)?", "spdx", 5, 1.0)]
    for label, words in COMMONS:
        short = "cc " + label.replace("-", " ")
        found += [(f"cc-{label}", f"creative commons {words}", "creative commons", 2 + label.count("-"), 0.9),
                  (f"cc-{label}", f"{short} licen[cs]e", short, 2 + label.count("-"), 0.9),
                  (f"cc-{label}", short, short, 1 + label.count("-"), 0.8)]
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            found += [(f"cc-{label}-{v.replace(' ', '.')}", f"{short} {v}", short, 4 + label.count("-"), 0.95),
                      (f"cc-{label}-{v.replace(' ', '.')}", f"creative commons {words} {v}", "creative commons", 4 + label.count("-"), 0.95),
                      (f"cc-{label}-{v.replace(' ', '.')}", GRANT + f"{short} {v}", short, 5 + label.count("-"), 0.95)]
    return list(dict.fromkeys(found + list(PHRASES)))  # families of one label share identifiers


def _sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.translate(c, " ", ""))


def normalised(text: Column) -> Column:
    """Lower-cased (A-Z) words of the text between single spaces, with one at each end; '' without words."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(words == "", F.lit("")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License detections of every row's whole text; one row per row.

    Columns: the id, ``n_words``, ``n_base`` (places of the base phrases), ``first_word`` and ``last_word`` (their smallest
    and largest start, in words from 0, else null), ``base_labels``, ``labels`` (with those of the signature rules;
    distinct, sorted, comma-joined), ``score`` (the highest confidence, 0 without a detection).

    Signatures run only on texts that hold one of their keywords. A detection that lies within another of a higher
    priority, or within a longer one of its own priority, is suppressed; base detections always stay. Null and
    empty texts have no words and no detections; null and repeated ids are scanned like others; an empty table
    gives no rows; other columns are ignored. Texts never leave the first step; from there on only word positions
    are shuffled.
    """
    table = rules()
    rule_list = F.expr("array(" + ",".join(
        f"named_struct('rule',{k},'keyword',{_sql_text(' ' + w)},'pattern',{_sql_text(' ' + p + '(?= )')})"
        for k, (_, p, w, _, _) in enumerate(table)) + ")")
    keywords = F.expr("array(" + ",".join(sorted({_sql_text(" " + r[2]) for r in table})) + ")")
    norm = F.col("_norm")
    texts = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                        normalised(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_norm"))
    places, first, last, labels = [], [], [], []
    for phrase, label in BASE:
        held = norm.contains(f" {phrase} ")
        behind = F.reverse(norm)
        after = F.locate(f" {phrase[::-1]} ", behind)  # from the end
        places.append(F.when(held, F.regexp_count(norm, F.lit(f" {phrase}(?= )"))).otherwise(0))
        first.append(F.when(held, _spaces(F.substring(norm, F.lit(1), F.locate(f" {phrase} ", norm) - 1))))
        last.append(F.when(held, _spaces(F.substring(norm, F.lit(1), F.length(norm) - after - len(phrase) - 1))))
        labels.append(F.when(held, F.lit(label)))
    # a match and the words after it, as numbers: split at a mark put before each match (no mark occurs in words)
    marked = lambda r: F.slice(F.split(F.regexp_replace(norm, r.pattern, F.lit("\u0001$0\u0002")), "\u0001"), 1, 1 << 30)
    sizes = lambda r: F.transform(marked(r), lambda part: F.struct(
        _spaces(F.substring_index(part, "\u0002", 1)).alias("matched"), _spaces(part).alias("words")))
    found = texts.withColumn("_keys", F.when(norm != "", F.filter(keywords, lambda k: norm.contains(k))))
    hits = F.when(F.size("_keys") > 0, F.filter(F.transform(
        F.filter(rule_list, lambda r: F.array_contains(F.col("_keys"), r.keyword)),
        lambda r: F.struct(r.rule.alias("rule"), sizes(r).alias("parts"))), lambda h: F.size(h.parts) > 1))
    scanned = written(found.select(
        "id", "row", F.greatest(_spaces(norm) - 1, F.lit(0)).cast("long").alias("n_words"),
        sum(places[1:], places[0]).cast("long").alias("n_base"), F.least(*first).cast("long").alias("first_word"),
        F.greatest(*last).cast("long").alias("last_word"),
        F.array_sort(F.filter(F.array(*labels), lambda x: x.isNotNull())).alias("base"), hits.alias("hits")), "scanned")

    about = F.expr("array(" + ",".join(f"named_struct('label',{_sql_text(r[0])},'priority',{r[3]},'confidence',{r[4]}D)"
                                       for r in table) + ")")
    parts = (scanned.where(F.size("hits") > 0).select("row", F.explode("hits").alias("h"))
             .select("row", "h.rule", F.posexplode("h.parts").alias("pos", "part"))
             .select("row", "rule", "pos", "part.matched", "part.words"))
    before = Window.partitionBy("row", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    spans = parts.select("row", "rule", "pos", "matched", F.sum("words").over(before).alias("start")).where("pos > 0").select(
        "row", F.element_at(about, F.col("rule") + 1).alias("r"), "start", (F.col("start") + F.col("matched")).alias("stop")
    ).select("row", "r.*", "start", "stop").distinct()
    levels = sorted({r[3] for r in table})
    within = Window.partitionBy("row").orderBy("start", F.desc("stop"), F.desc("priority")).rowsBetween(Window.unboundedPreceding, -1)
    above = F.greatest(F.lit(-1), *[F.when(F.col("priority") < p, F.max(F.when(F.col("priority") >= p, F.col("stop"))).over(within))
                                   for p in levels[1:]])
    earlier = Window.partitionBy("row", "priority").orderBy("start").rangeBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("row", "priority", "start")
    kept = spans.select("*", above.alias("_above"), F.max("stop").over(earlier).alias("_earlier"), F.max("stop").over(same).alias("_same")).where(
        (F.col("_above") < F.col("stop")) & F.coalesce(F.col("_earlier") < F.col("stop"), F.lit(True)) & (F.col("_same") == F.col("stop")))
    added = kept.groupBy("row").agg(F.collect_set("label").alias("added"), F.max("confidence").alias("best"))
    every = F.array_sort(F.array_union("base", F.coalesce("added", F.array().cast("array<string>"))))
    return scanned.drop("hits").join(added, "row", "left").select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(BASE_CONFIDENCE)).otherwise(0.0)).alias("score"))
