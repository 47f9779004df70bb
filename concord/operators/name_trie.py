"""Names of any number replaced in one pass over each text, by a broadcast trie.

Spark cuts a text into its words and what stands between them (Java patterns, the same for every row); a small Arrow
function walks a trie whose edges are words and joints from every word on and keeps the deepest name. Texts stay in
their task: nothing is exploded, joined or shuffled, and no row compiles a pattern of its own.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_RE = r"(?U)\w+"


def name_trie(names: list[tuple[list[str], list[str], str]]) -> dict:
    """Nested dictionaries: word, joint, word, …; the key None holds the replacement of the name that ends there.

    ``names`` are (words, what stands before, between and after them, replacement), one for each name.
    """
    root: dict = {}
    for words, gaps, replacement in names:
        # names that do not start and end with a word, or are joined by other than dots and dollar signs, match nowhere
        if not words or gaps[0] or gaps[-1] or not all(re.fullmatch(r"[.$]+", g) for g in gaps[1:-1]):
            continue
        node = root.setdefault(words[0], {})
        for joint, word in zip(gaps[1:-1], words[1:]):
            node = node.setdefault(joint, {}).setdefault(word, {})
        node[None] = replacement
    return root


def parts_of(text: Column) -> tuple[Column, Column]:
    """The words of a text, and what stands before, between and after them."""
    return F.regexp_extract_all(text, F.lit(WORD_RE), 0), F.split(text, WORD_RE, -1)


def replace_by_trie(df: DataFrame, text: str, names: DataFrame) -> DataFrame:
    """``df`` with the names (``word``, lower-case, unique; ``replacement``) in ``text`` replaced, longest first, in either case.

    ``names`` is collected into the trie, so the caller has counted it. A null text stays null.
    """
    words, gaps = parts_of(F.col("word"))
    trie = name_trie([tuple(r) for r in names.where("word is not null and replacement is not null").select(words, gaps, "replacement").collect()])
    if not trie:
        return df
    shared = df.sparkSession.sparkContext.broadcast(trie)

    @F.arrow_udf("string")
    def rewritten(words, lower, gaps):
        import pyarrow as pa

        root = shared.value

        def one(words: list, lower: list, gaps: list) -> str:
            out, at, n = [gaps[0]], 0, len(words)
            while at < n:
                node, stop, new, k = root.get(lower[at]), at, words[at], at
                while node is not None:
                    if None in node:
                        stop, new = k, node[None]
                    k += 1
                    node = node.get(gaps[k], {}).get(lower[k]) if k < n else None
                out += [new, gaps[stop + 1]]
                at = stop + 1
            return "".join(out)

        return pa.array([one(w.as_py(), low.as_py(), g.as_py()) if w.is_valid else None for w, low, g in zip(words, lower, gaps)], pa.string())

    words, gaps = parts_of(F.col(text))
    return df.withColumn(text, rewritten(words, F.transform(words, F.lower), gaps))
