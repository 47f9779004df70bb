import zlib

import awkward
import numpy as np
from conftest_paths import SF01

from concord.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() >= 0.97


def test_mixture_of_two_languages(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    langs, log_p = langid.train(docs.where("doc_id < 600"))
    rows = docs.where("doc_id >= 600 and n_chars between 1500 and 4000").toPandas()
    fr, de = (rows[rows.lang == x].text.iloc[0] for x in ("fr", "de"))
    share, chosen = langid.infer(fr + " " + de, log_p, 6.0)
    assert {langs[k] for k in chosen} == {"fr", "de"}
    for k, text in (("fr", fr), ("de", de)):
        want = len(text) / (len(fr) + len(de))
        assert abs(share[langs.index(k)] - want) < 0.15
    assert [langs[k] for k in langid.infer(fr, log_p, 6.0)[1]] == ["fr"]


def test_expectation_maximisation_climbs():
    rng = np.random.default_rng(3)
    p = rng.dirichlet(np.ones(50), 3).T
    n = rng.multinomial(2000, p @ [0.6, 0.3, 0.1])
    share, value = langid.mixture(p, n, steps=500, settled=1e-7)
    assert np.abs(share - [0.6, 0.3, 0.1]).max() < 0.1 and abs(share.sum() - 1) < 1e-9
    for other in rng.dirichlet(np.ones(3), 200):
        assert n @ np.log(p @ other) <= value + 1e-6


def test_counts_equal_plain_counting(spark):
    docs = awkward.frame(spark)
    langs, log_p = langid.train(docs)
    assert langs == ["de", "en"]
    for k, lang in enumerate(langs):
        counts = np.full(langid.CELLS, langid.SMOOTHING)
        for r in docs.collect():
            if r["lang"] == lang:
                np.add.at(counts, langid.trigram_cells(r["text"]), 1)
        assert np.allclose(log_p[:, k], np.log(counts / counts.sum()))


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    got = langid.identify(docs).collect()
    assert len(got) == docs.count()
    for r, text in ((r, t) for r in got for t in {d["text"] for d in docs.collect() if d["doc_id"] == r["doc_id"]}):
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or "")) or r["doc_id"] is None
    assert langid.identify(awkward.empty(spark)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}


def plain_cells(text):
    """Cells of the letter trigrams, character by character in whole numbers."""
    padded, before = [0], False
    low = (text or "").lower()
    for i, c in enumerate(low):
        if c.isalpha():
            padded.append(ord(c))
        elif before:
            padded.append(0)
        before = c.isalpha()
    if not any(padded):
        return []
    padded.append(0)
    out = []
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        h = (a * 0x9E3779B97F4A7C15 ^ b * 0xC2B2AE3D27D4EB4F ^ c * 0x165667B19E3779F9) % 2**64
        out.append((h ^ h >> 29) * 0xBF58476D1CE4E5B9 % 2**64 >> 48)
    return out


def plain_mixture(rows):
    """Shares and log likelihood of [(count, likelihoods)] by expectation-maximisation with plain sums."""
    k = len(rows[0][1])
    share = [1 / k] * k
    for _ in range(40):
        new = [0.0] * k
        for n, p in rows:
            mix = sum(a * b for a, b in zip(share, p))
            for j in range(k):
                new[j] += n * share[j] * p[j] / mix
        total = sum(n for n, _ in rows)
        new = [v / total for v in new]
        settled = max(abs(a - b) for a, b in zip(new, share)) < 1e-3
        share = new
        if settled:
            break
    return share, sum(n * np.log(sum(a * b for a, b in zip(share, p))) for n, p in rows)


def plain_language(text, langs, log_p, penalty=6.0):
    cells = plain_cells(text)
    if not cells:
        return "und", 0.0
    count = {}
    for c in cells:
        count[c] = count.get(c, 0) + 1
    # likelihoods relative to the cell's greatest
    rows = [(n, [float(np.exp(v - max(log_p[c]))) for v in log_p[c]]) for c, n in sorted(count.items())]
    share, _ = plain_mixture(rows)
    alone = [sum(n * np.log(p[k]) if p[k] > 0 else -np.inf for n, p in rows) for k in range(len(langs))]
    chosen = [int(np.argmax(alone))]
    value = alone[chosen[0]]
    for k in sorted(range(len(langs)), key=lambda k: -share[k]):
        if k in chosen:
            continue
        if share[k] < 0.01:
            break
        _, more = plain_mixture([(n, [p[j] for j in [*chosen, k]]) for n, p in rows])
        if more - value <= penalty * np.log(len(cells)):
            break
        chosen, value = [*chosen, k], more
    own = plain_mixture([(n, [p[j] for j in chosen]) for n, p in rows])[0] if len(chosen) > 1 else [1.0]
    best = chosen[int(np.argmax(own))]
    return langs[best], share[best]


def test_query_against_plain_version(spark):
    """The registered query over a whole table: counts, mixtures and the choice of languages without the operator's code."""
    from conftest_paths import SF001

    from concord.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang").collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in docs}
    langs = sorted({r["lang"] for r in docs if r["lang"] is not None and not held[r["doc_id"]] and plain_cells(r["text"])})
    counts = np.full((1 << 16, len(langs)), 0.5)
    for r in docs:
        if not held[r["doc_id"]] and r["lang"] is not None:
            for c in plain_cells(r["text"]):
                counts[c, langs.index(r["lang"])] += 1
    log_p = np.log(counts / counts.sum(0))
    got = {r["doc_id"]: r for r in QUERIES["op6_language"](spark, SF001).collect()}
    assert len(got) == len(docs)
    for r in docs:
        row = got[r["doc_id"]]
        lang, score = plain_language(r["text"], langs, log_p)
        assert (row["held_out"], row["lang_pred"]) == (held[r["doc_id"]], lang) and abs(row["score"] - score) < 1e-6
