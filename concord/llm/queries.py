"""Registered queries of the operators: each applies its operator to a whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import collocations, embedding_dedup, langid, license_scan, mixing, packing, quality, runs, secret_scan, simhash, sketch, token_count, toxicity
from concord.llm.common import documents, ship


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir, "doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scan(documents(spark, sf_dir, "doc_id", "text", "source"))
    digest = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")
    base = F.filter("spans", lambda s: s.kind.isin("assign", "access", "hex"))
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    of = lambda kind: count(lambda s: s.kind == kind).alias(f"n_{kind}")
    return rows.select(
        "doc_id", of("assign"), of("access"), of("hex"),
        F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"),
        count(lambda s: s.live).alias("n_live"), count(lambda s: ~s.live).alias("n_example"))


def op5_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir, "doc_id", "text", "lang"))


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprint(documents(spark, sf_dir, "doc_id", "text"))


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_texts(documents(spark, sf_dir, "doc_id", "text"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(documents(spark, sf_dir, "doc_id", "text", "lang", "source"), mixing.tree(), mixing.WEIGHTS,
                      mixing.words(F.col("text")))
    return rows.select("doc_id", *[F.col(f"_{c}").alias(c) for c in ("domain", "lang", "source")],
                       F.col("_epoch").alias("epoch"), F.col("_tokens").alias("n_tokens"), F.col("_take").alias("take_tokens"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir, "doc_id", "text"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir, "text", "lang"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = runs.periodic_runs(documents(spark, sf_dir, "doc_id", "text"), rewrite=True)
    # runs are in the order of ties, so only a greater length / period takes over
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", none, lambda top, r: F.when(
        top.isNull() | (r.length.cast("decimal(19,0)") * top.period > top.length.cast("decimal(19,0)") * r.period), r).otherwise(top))
    digest = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return rows.withColumn("top", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(digest, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {q.__name__: _shipped(q) for q in (op1_packing, op2_quality, op3_embedding_dedup, op4_secret_scan, op5_simhash_neardup,
                                          op6_language, op7_fingerprint, op8_token_count, op9_mixing,
                                          op10_license_scan, op11_toxicity, op12_collocations, op13_periodic_runs)}

def _mixing_sql(share: float = 0.8, max_epochs: int = 4, seed: int = 42) -> str:
    """The same mixture for a SQL engine: plain running sums instead of buckets, one step per level of the tree."""
    def weight(level: str) -> str:
        given = mixing.WEIGHTS.get(level)
        return f"CASE {level} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in given.items()) + " ELSE 1 END" if given else "1"

    def step(k: int, levels: list[str]) -> str:
        above, here = ", ".join(levels[:-1]) or "1", ", ".join(levels)
        parent = f"JOIN b{k - 1} USING ({above})" if k else "CROSS JOIN (SELECT CAST(floor(sum(supply) * " + str(share) + ") AS BIGINT) AS total FROM leaves) r"
        by = f"PARTITION BY {above}" if k else ""
        return f"""
        n{k} AS (SELECT {here}, CAST(sum(supply) * {max_epochs} AS BIGINT) AS capacity, {weight(levels[-1])} AS w FROM leaves GROUP BY {here}),
        l{k} AS (SELECT n{k}.*, (least(total, sum(capacity) OVER ({by}))
                 - coalesce(sum(capacity) OVER ({by} ORDER BY capacity / w, {levels[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / CAST(sum(w) OVER ({by} ORDER BY capacity / w, {levels[-1]} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
                 FROM n{k} {parent}),
        b{k} AS (SELECT {here}, CAST(least(capacity, floor(w * max(level) OVER ({by}) + 1e-6)) AS BIGINT) AS total FROM l{k})"""

    levels = ["domain", "lang", "source"]
    steps = ",".join(step(k, levels[:k + 1]) for k in range(3))
    place = f"CAST('0x' || substr(md5('{seed}:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)"
    return f"""
    WITH d AS (SELECT doc_id, CASE WHEN substr(md5(coalesce(source, '')), 1, 1) < '6' THEN 'web'
                      WHEN substr(md5(coalesce(source, '')), 1, 1) < 'b' THEN 'books' ELSE 'code' END AS domain,
                      coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS n_tokens FROM documents),
    leaves AS (SELECT domain, lang, source, sum(n_tokens) AS supply FROM d GROUP BY ALL HAVING sum(n_tokens) > 0), {steps},
    plan AS (SELECT domain, lang, source, CAST(total // supply AS INTEGER) AS epochs, CAST(total % supply AS BIGINT) AS more
             FROM leaves JOIN b2 USING (domain, lang, source)),
    p AS (SELECT d.*, epochs, more, {place} AS place FROM d JOIN plan USING (domain, lang, source)),
    u AS (SELECT domain, lang, source, place, sum(n_tokens) AS held FROM p GROUP BY ALL),
    c AS (SELECT *, coalesce(sum(held) OVER (PARTITION BY domain, lang, source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM u),
    q AS (SELECT p.*, CASE WHEN base + held < more OR (base < more AND base + held = more) THEN n_tokens
                           WHEN base < more THEN CAST(floor(n_tokens * (more - base) / held) AS BIGINT) END AS last,
                 base < more AND base + held >= more AS at_cut FROM p JOIN c USING (domain, lang, source, place))
    SELECT doc_id, domain, lang, source, CAST(e AS INTEGER) AS epoch, n_tokens, n_tokens AS take_tokens
    FROM (SELECT *, unnest(range(epochs)) AS e FROM q)
    UNION ALL
    SELECT doc_id, domain, lang, source, epochs, n_tokens, last FROM q WHERE last IS NOT NULL AND NOT (at_cut AND last = 0)"""


def _collocations_sql(least: int = 10, top: int = 2000, share: int = 50) -> str:
    """All phrases counted and scored, without bounds; products in 128 bits."""
    return rf"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
          FROM w, (VALUES (1), (2), (3)) s(k) WHERE len(w) >= k),
    f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
    n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= {least}),
    x AS (SELECT lang, phrase, c.k, a, cut, array_to_string(w[:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
          FROM c, (VALUES (1), (2)) s(cut) WHERE cut < c.k),
    y AS (SELECT x.*, h.a AS l, t.a AS r, CAST((1000000::HUGEINT * x.a * x.a) // (h.a::HUGEINT * t.a) AS BIGINT) AS score
          FROM x JOIN f h ON h.lang = x.lang AND h.phrase = head AND h.k = cut
                 JOIN f t ON t.lang = x.lang AND t.phrase = tail AND t.k = x.k - cut),
    b AS (SELECT lang, phrase, k, a, arg_min(l, score * 4 + cut) AS l, arg_min(r, score * 4 + cut) AS r, min(score) AS score
          FROM y GROUP BY lang, phrase, k, a),
    held AS (SELECT lang, part, max(a) AS most FROM (
               SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM c WHERE k = 3) GROUP BY ALL),
    s AS (SELECT b.* FROM b LEFT JOIN held ON held.lang = b.lang AND part = phrase AND b.k = 2
          WHERE most IS NULL OR 100 * most < {share} * b.a),
    z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM s)
    SELECT lang, rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= {top}"""


def _runs_sql() -> str:
    """Runs from all pairs of equal words of a document: neighbouring pairs of one distance are a stretch with that period."""
    crc_byte = "list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, {0})"
    crc = ("xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)), "
           "lambda c, b: xor(" + crc_byte.format("xor(c, b) % 256") + ", c // 256), 4294967295), 4294967295)")
    return rf"""
    WITH h AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {crc} AS h FROM documents),
    a AS (SELECT *, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS again, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS parts FROM h),
    d AS (SELECT doc_id, n, CASE WHEN again THEN list_transform(range(0, n), lambda i: CASE WHEN i < a THEN w[i + 1]
            ELSE w[a + (i - a) % (1 + (n - a) // parts) + 1] END) ELSE w END AS w FROM a),
    t AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM d),
    e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.word = y.word
          AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
    s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (
            SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e) GROUP BY doc_id, q, island
          HAVING count(*) + q >= greatest(6, 4 * q)),
    r AS (SELECT doc_id, start, length, CAST(min(q) AS BIGINT) AS period FROM s GROUP BY doc_id, start, length),
    b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS place FROM r),
    u AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
          list({{'a': start + period, 'b': start + length}}) AS spans FROM r GROUP BY doc_id),
    k AS (SELECT d.doc_id, coalesce(array_to_string([w[i + 1] FOR i IN range(0, n)
            IF len(list_filter(coalesce(spans, []), lambda v: v.a <= i AND i < v.b)) = 0], ' '), '') AS kept FROM d LEFT JOIN u ON u.doc_id = d.doc_id)
    SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
           sha256(coalesce(runs, '')) AS runs_sha256, sha256(kept) AS collapsed_sha256
    FROM d LEFT JOIN u ON u.doc_id = d.doc_id LEFT JOIN b ON b.doc_id = d.doc_id AND b.place = 1 JOIN k ON k.doc_id = d.doc_id"""


ORACLE: dict[str, str] = {"op9_mixing": _mixing_sql(), "op12_collocations": _collocations_sql(), "op13_periodic_runs": _runs_sql()}
