"""Phrase collocations: best-first branch-and-bound growth from words to phrases of two and three words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.llm.common import BROADCAST_ROWS, lean, written

#: Words with more than one in so many of all words have a bound of their own (at most as many, by counting); the others share cells.
FREQUENT = 1 << 19
CELLS = 1 << 20
#: Places of a bitmap of pairs that a scan looks for; a shared place costs counting, not results.
PAIR_CELLS = 1 << 23
#: Bytes of text whose words are counted together before they leave a task.
BLOCK = 8 << 20
#: Growth goes down these bounds of the score, of 1,000,000; the last is all there is.
LEVELS = (250_000, 31_250, 0)
SCALE = 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0: of a word, 1: blank, 2: end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2


def word_codes(data: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Of lower-cased text bytes: the distinct words, the code of every word, and whether it and the next one share a piece."""
    kind = _KIND[data]
    inside = kind == 0
    edge = np.diff(inside.view(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    coded = words.dictionary_encode()
    piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
    same = piece[1:] == piece[:-1]
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), same


def blocks(texts: list[bytes], size: int = BLOCK) -> Iterator[np.ndarray]:
    """Lower-cased bytes of all texts, a line break after each, cut at ends of pieces into blocks of about ``size``; a longer piece is whole."""
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    a = 0
    while a < len(data):
        b = a + size
        if b < len(data):
            back = np.flatnonzero(_KIND[data[a:b]] == 2)
            while not len(back) and b < len(data):
                back = np.flatnonzero(_KIND[data[b:b + size]] == 2)[:1] + (b - a)
                b += size
            b = a + int(back[-1]) + 1 if len(back) else len(data)
        yield data[a:b]
        a = b


def _scan(rows: DataFrame, count: Callable) -> DataFrame:
    """``lang``, ``phrase``, ``n``: what ``count(lang, words, codes, same)`` yields as (phrases, counts) from blocks of each language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                for data in blocks(texts):
                    words, codes, same = word_codes(data)
                    if len(codes):
                        for phrases, n in count(lang, words, codes, same):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([lang]).take(pa.array(np.zeros(len(n), np.int32))), phrases.cast(pa.string()), pa.array(n)], ["lang", "phrase", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if text:
                    held.setdefault(lang, []).append(text)
                    size += len(text)
                    if size >= BLOCK:
                        yield from flush()
                        size = 0
        yield from flush()

    return rows.mapInArrow(lean(run), "lang string, phrase string, n long")


def _total(counts: DataFrame) -> DataFrame:
    return counts.groupBy("lang", "phrase").agg(F.sum("n").alias("a"))


def _joined(words: pa.Array, *codes: np.ndarray) -> pa.Array:
    import pyarrow.compute as pc

    return pc.binary_join_element_wise(*[words.take(pa.array(c)) for c in codes], pa.scalar(" ", pa.large_string()))


def _counted(words: pa.Array, first: np.ndarray, second: np.ndarray, third: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """Distinct phrases and their counts, of the codes of their words."""
    pairs, back, n = np.unique(first * len(words) + second, return_inverse=True, return_counts=True)
    if third is None:
        return _joined(words, pairs // len(words), pairs % len(words)), n
    triples, n = np.unique(back * len(words) + third, return_counts=True)
    pair = pairs[triples // len(words)]
    return _joined(words, pair // len(words), pair % len(words), triples % len(words)), n


def word_hashes(lang: str, words: pa.Array) -> np.ndarray:
    """Spark's ``xxhash64(lang, word)`` as uint64."""
    from xxhash import xxh64_intdigest as h

    seed = h(lang, 42)
    return np.fromiter((h(w, seed) for w in words.to_pylist()), np.uint64, len(words))


def _pair_cells(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * np.uint64(0x9E3779B97F4A7C15) ^ (second + np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x165667B19E3779F9)
    return ((mixed ^ mixed >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(41)).astype(np.int64)  # 23 bits


class Bounds:
    """Least and greatest count of the words that share a hash or, among the less frequent, a cell: never on the wrong side of a
    word's count. Its size is bounded by ``FREQUENT`` and ``CELLS``, whatever the vocabulary."""

    def __init__(self, words: DataFrame, least: int):
        hashed = words.where(F.col("a") >= least).groupBy(F.xxhash64("lang", "phrase").alias("h")).agg(
            F.min("a").alias("lo"), F.max("a").alias("hi"))
        limit = max(least, (words.agg(F.sum("a")).first()[0] or 0) // FREQUENT)
        own = hashed.where(F.col("hi") > limit).toArrow()
        order = np.argsort(h := own["h"].to_numpy().view(np.uint64))
        self.h, self.own = h[order], np.stack([own["lo"].to_numpy()[order], own["hi"].to_numpy()[order]])
        rest = hashed.where(F.col("hi") <= limit).groupBy(F.col("h").bitwiseAND(CELLS - 1).cast("int").alias("cell")).agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow()
        self.cells = np.zeros((2, CELLS), np.int64)
        self.cells[:, rest["cell"].to_numpy()] = rest["lo"].to_numpy(), rest["hi"].to_numpy()

    def of(self, h: np.ndarray) -> np.ndarray:
        """Lower and upper bounds for the words of these hashes; 0 for words that are too rare to matter."""
        out = self.cells[:, (h & np.uint64(CELLS - 1)).astype(np.int64)]
        if len(self.h):
            at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
            known = self.h[at] == h
            out[:, known] = self.own[:, at[known]]
        return out


def count_words(rows: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` (one word) and its count ``a``."""
    def count(lang: str, words: pa.Array, codes: np.ndarray, same: np.ndarray):
        yield words, np.bincount(codes, minlength=len(words))

    return _total(_scan(rows, count))


def grow(rows: DataFrame, bounds, least: int, low: int, high: int) -> DataFrame:
    """Counts of all phrases of two and three words whose score is bounded, by the counts of their words, within [low, high).

    A phrase's count ``a`` is at most each of its words', and each part of a cut occurs at least ``a`` times: the lowest cut
    scores at most least word / larger of the first and the last word.
    """
    def count(lang: str, words: pa.Array, codes: np.ndarray, same: np.ndarray):
        lo, hi = bounds.value.of(word_hashes(lang, words))[:, codes].astype(float)
        pair = np.minimum(hi[:-1], hi[1:])
        bound = np.minimum(1, pair / np.maximum(1, np.maximum(lo[:-1], lo[1:])))
        at = np.flatnonzero(same & (pair >= least) & (bound >= low / SCALE) & ((bound < high / SCALE) | (high > SCALE)))
        if len(at):
            yield _counted(words, codes[at], codes[at + 1])
        triple = np.minimum(pair[:-1], hi[2:])
        bound = np.minimum(1, triple / np.maximum(1, np.maximum(lo[:-2], lo[2:])))
        at = np.flatnonzero(same[:-1] & same[1:] & (triple >= least) & (bound >= low / SCALE) & ((bound < high / SCALE) | (high > SCALE)))
        if len(at):
            yield _counted(words, codes[at], codes[at + 1], codes[at + 2])

    return _total(_scan(rows, count)).where(F.col("a") >= least)


def count_around(rows: DataFrame, parts, inner) -> DataFrame:
    """Counts of the pairs in the bitmap ``parts``, and of all phrases of three words around a pair in the bitmap ``inner``."""
    def count(lang: str, words: pa.Array, codes: np.ndarray, same: np.ndarray):
        h = word_hashes(lang, words)[codes]
        cell = _pair_cells(h[:-1], h[1:])
        at = np.flatnonzero(same & parts.value[cell])
        if len(at):
            yield _counted(words, codes[at], codes[at + 1])
        near = same & inner.value[cell]
        at = np.flatnonzero(same[:-1] & same[1:] & (near[:-1] | near[1:]))
        if len(at):
            yield _counted(words, codes[at], codes[at + 1], codes[at + 2])

    return _total(_scan(rows, count))


def _bitmap(pairs: DataFrame) -> np.ndarray:
    """Places of all pairs (``lang``, ``w1``, ``w2``); only distinct places, at most ``PAIR_CELLS``, come to the driver."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(_pair_cells(a, b).astype(np.int32))], ["cell"])

    found = pairs.select(F.xxhash64("lang", "w1").alias("a"), F.xxhash64("lang", "w2").alias("b")).mapInArrow(cells, "cell int").distinct().toArrow()
    out = np.zeros(PAIR_CELLS, bool)
    out[found["cell"].to_numpy()] = True
    return out


def _with_count(rows: DataFrame, counts: DataFrame, *columns: str) -> DataFrame:
    """The count (a) of each named phrase column as ``f_<column>``, by shuffled joins that Spark may split."""
    for c in columns:
        rows = rows.join(counts.select("lang", F.col("phrase").alias(c), F.col("a").alias(f"f_{c}")).hint("merge"), ["lang", c], "left")
    return rows


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1,000,000 a a / (left right)), exact in 38 digits."""
    wide = [c.cast("decimal(15,0)") for c in (a, left, right)]
    top, bottom = (wide[0] * wide[0]).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)"), wide[1] * wide[2]
    return F.call_function("div", top, bottom)


def _best(rows: DataFrame, k: int, column: str) -> DataFrame:
    """The first ``k`` rows of each language by key, a and phrase, numbered from 1 in ``column``; ranked within parts of a language first."""
    order = (F.desc("key"), F.desc("a"), F.asc("phrase"))
    part = Window.partitionBy("lang", "_part").orderBy(*order)
    small = (rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("_place", F.row_number().over(part))
             .where(F.col("_place") <= k).drop("_part", "_place"))
    return small.withColumn(column, F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col(column) <= k)


def _settled(frontier: DataFrame, counts_of: Callable, words: DataFrame, least: int, share: int) -> DataFrame:
    """Exact left, right and score of the frontier's phrases, without those that a longer candidate mostly holds."""
    two, three = frontier.where("w3 IS NULL"), frontier.where("w3 IS NOT NULL")
    around = counts_of(three.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"))))
                                    .alias("p")).select("lang", "p.*"), two.select("lang", "w1", "w2"))
    longer = (around.where((F.size(F.split("phrase", " ")) == 3) & (F.col("a") >= least)).withColumn("w", F.split("phrase", " "))
              .select("lang", "a", F.explode(F.array(F.concat_ws(" ", F.col("w")[0], F.col("w")[1]), F.concat_ws(" ", F.col("w")[1], F.col("w")[2]))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("holder")))
    pairs = (two.join(longer.hint("merge"), ["lang", "phrase"], "left").where(F.coalesce(F.col("holder") * 100 < F.col("a") * share, F.lit(True)))
             .select("lang", "phrase", "a", F.col("f_w1").alias("l"), F.col("f_w3").alias("r")))
    parts = three.withColumn("head", F.concat_ws(" ", "w1", "w2")).withColumn("tail", F.concat_ws(" ", "w2", "w3"))
    both = _with_count(parts, around, "head", "tail")
    first, second = _score(F.col("a"), F.col("f_w1"), F.col("f_tail")), _score(F.col("a"), F.col("f_head"), F.col("f_w3"))
    triples = both.select("lang", "phrase", "a", F.when(first <= second, F.col("f_w1")).otherwise(F.col("f_head")).alias("l"),
                          F.when(first <= second, F.col("f_tail")).otherwise(F.col("f_w3")).alias("r"))
    return pairs.unionByName(triples).withColumn("key", _score(F.col("a"), F.col("l"), F.col("r")))


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, top: int = 2000, share: int = 50,
         levels: tuple[int, ...] = LEVELS, width: int = 4) -> DataFrame:
    """The ``top`` collocations of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A-Z are lower-cased; texts are split at ``.,;:!?`` and line ends into pieces and those at blanks and tabs into words. Candidates
    are phrases of two or three words that occur ``a`` >= ``least`` times in a language; a cut after the first words scores
    floor(1,000,000 a a / (l r)) with the counts of its parts, and the lowest cut counts (ties: the earliest). Candidates inside a longer
    candidate that holds at least ``share`` percent of their occurrences are dropped. Order: score and a descending, phrase ascending.

    Growth is best first. Word counts bound the score of every phrase; a scan counts the phrases bounded by a level and more, which
    makes the frontier: exact scores of pairs, bounds a / max(first, last) of triples. Its best are expanded by a scan that counts their
    parts and the phrases around them, more of them in each step, until ``top`` surviving scores of a language stand before all that is not
    expanded; else the next level is scanned for the languages left. No phrase is lost whatever the levels: they only order the work.

    A null language is ``und``; null and empty texts have no words; repeated rows count again; other columns are ignored; a language
    without candidates has no rows; an empty table gives none. Memory is bounded by a block of text and its longest piece.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    words = written(count_words(rows), "words")
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    bounds = spark.sparkContext.broadcast(Bounds(words, least))
    frequent = words.where(F.col("a") >= least)
    pool = done = None
    open_langs = written(frequent.select("lang").distinct(), "open")

    def held(df: DataFrame, langs: DataFrame) -> DataFrame:
        few = langs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        return df.join(F.broadcast(langs) if few else langs, "lang", "left_semi")

    for low, high in zip(levels, (SCALE + 1, *levels)):
        texts = held(rows, open_langs)
        grown = grow(texts, bounds, least, low, high)
        split = grown.withColumn("w", F.split("phrase", " ")).select(
            "lang", "phrase", "a", F.col("w")[0].alias("w1"), F.col("w")[1].alias("w2"), F.try_element_at("w", F.lit(3)).alias("w3"))
        ends = split.withColumn("last", F.coalesce("w3", "w2"))
        known = _with_count(written(ends, "grown"), frequent, "w1", "last").withColumnRenamed("f_last", "f_w3").drop("last")
        bound = F.call_function("div", F.col("a").cast("decimal(15,0)") * F.lit(SCALE).cast("decimal(7,0)"), F.greatest("f_w1", "f_w3").cast("decimal(15,0)"))
        fresh = known.withColumn("key", F.when(F.col("w3").isNull(), _score(F.col("a"), F.col("f_w1"), F.col("f_w3"))).otherwise(bound))
        pool = written(fresh if pool is None else held(pool.unionByName(fresh), open_langs), "pool")
        level = pool.where((F.col("key") >= low) & (F.col("key") < high))
        taken, take = 0, width * top
        while True:
            frontier = written(_best(held(level, open_langs), taken + take, "place").where(F.col("place") > taken), "frontier")

            def counts_of(parts: DataFrame, inner: DataFrame) -> DataFrame:
                maps = [spark.sparkContext.broadcast(_bitmap(p)) for p in (parts, inner)]
                return written(count_around(held(rows, open_langs), *maps), "around")

            if not frontier.limit(1).count():
                break
            exact = _settled(frontier, counts_of, frequent, least, share)
            done = written(exact if done is None else done.unionByName(exact), "done")
            taken, take = taken + take, 4 * (taken + take)
            # a language with a full slice has more to expand, all of it after the slice's last phrase
            last = frontier.where(F.col("place") == taken).select("lang", F.col("key").alias("_k"), F.col("a").alias("_a"), F.col("phrase").alias("_p"))
            before = (F.col("key") > F.col("_k")) | ((F.col("key") == F.col("_k")) & (
                (F.col("a") > F.col("_a")) | ((F.col("a") == F.col("_a")) & (F.col("phrase") <= F.col("_p")))))
            sure = done.join(last, "lang", "left").where(F.when(F.col("_k").isNull(), F.col("key") >= low).otherwise(before))
            full = written(sure.groupBy("lang").agg(F.count("*").alias("n")).where(F.col("n") >= top).select("lang"), "full")
            open_langs = written(open_langs.join(full, "lang", "left_anti"), "open")
            more = held(last.select("lang"), open_langs).limit(1).count()
            if not more:
                break
        if not open_langs.limit(1).count():
            break
    if done is None:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    return (_best(done, top, "rank").join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("key").cast("long").alias("score")))
