import random
import re
from collections import Counter

import awkward
import numpy as np
from pyspark.sql import functions as F

from concord.llm import collocations

SCHEMA = "text string, lang string"


def plain(rows, least=10, top=2000, share=50):
    """All phrases counted and scored."""
    counts, n = {}, Counter()
    for text, lang in rows:
        lang, own = lang or "und", counts.setdefault(lang or "und", Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                own.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        for w, a in f.items():
            if len(w) < 2 or a < least:
                continue
            if len(w) == 2 and any(100 * b >= share * a for x, b in f.items() if len(x) == 3 and b >= least and w in (x[:2], x[1:])):
                continue
            score, k = min((1_000_000 * a * a // (f[w[:k]] * f[w[k:]]), k) for k in range(1, len(w)))
            found.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def random_rows(seed, size=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Été", "x-y", "THE"]
    fixed = [" ".join(rng.choice(words) for _ in range(rng.randint(2, 5))) for _ in range(12)]
    rows = []
    for _ in range(size):
        parts = [rng.choice(fixed) if rng.random() < 0.5 else rng.choice(words[:int(1 + rng.paretovariate(0.5)) % 43 + 1]) for _ in range(rng.randint(0, 20))]
        rows.append(("".join(p + rng.choice([" ", " ", "\t", "  ", ", ", ".\n"]) for p in parts), rng.choice(["en", "en", "de", None])))
    return rows


def test_equal_to_counting_everything(spark):
    for seed, top, levels in ((1, 2000, collocations.LEVELS), (2, 7, (900_000, 300_000, 50_000, 0)), (3, 3, (0,))):
        rows = random_rows(seed)
        got = collocations.mine(spark.createDataFrame(rows, SCHEMA).repartition(4), top=top, levels=levels, width=1)
        assert sorted(map(tuple, got.collect())) == plain(rows, top=top)


def test_containment_at_the_share(spark):
    rows = [("a b c", "en")] * 10 + [("a b", "en")] * 10 + [("d e f", "en")] * 10 + [("d e", "en")] * 11
    got = {r["phrase"] for r in collocations.mine(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"a b c", "d e f", "d e"}  # a b: 10 of 20 within a b c; d e: 10 of 21


def test_products_beyond_64_bits(spark):
    for a, l, r in ((10**9, 10**9, 10**9), (3 * 10**12, 5 * 10**12, 7 * 10**12), (10**13 - 1, 10**13, 10**13), (10, 11, 13)):
        df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
        assert df.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 1_000_000 * a * a // (l * r)


def test_blocks_keep_pieces_whole():
    texts = [b"one two three. four five", b"x" * 50 + b" " + b"y" * 50, b"", b"six, seven"]
    parts = [bytes(b) for b in collocations.blocks(texts, 16)]
    assert b"".join(parts) == b"\n".join(texts) + b"\n" and all(p[-1:] in b".,\n" for p in parts)


def test_bounds_hold_when_cells_are_shared(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CELLS", 8)
    monkeypatch.setattr(collocations, "FREQUENT", 20)
    counts = [("en", f"w{i}", 10 + i * i) for i in range(60)] + [("en", "rare", 3)]
    bounds = collocations.Bounds(spark.createDataFrame(counts, "lang string, phrase string, a long"), 10)
    import pyarrow as pa
    lo, hi = bounds.of(collocations.word_hashes("en", pa.array([w for _, w, _ in counts])))
    n = np.array([a for _, _, a in counts])
    assert (lo <= n)[:-1].all() and (hi >= n)[:-1].all() and len(bounds.h) <= 20


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    assert sorted(map(tuple, collocations.mine(docs, least=2).collect())) == plain(rows, least=2)
    none = collocations.mine(awkward.empty(spark))
    assert none.count() == 0 and none.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {f.dataType.simpleString() for f in none.schema if f.name not in ("lang", "phrase")} == {"bigint"}
