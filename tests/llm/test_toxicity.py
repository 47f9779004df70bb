import re
import zlib

import awkward
import numpy as np
from conftest_paths import SF01

from concord.llm import toxicity


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    got = toxicity.score(docs, labels).join(docs.select("doc_id", "text"), "doc_id").join(labels, "doc_id", "left").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    held = got[got.held_out & got.toxic.notna()]
    assert held.predicted[held.toxic == 0].mean() <= 0.03
    insults = re.compile("idiot|moron|clown|stupid|scum")
    assert held.predicted[(held.toxic == 1) & held.text.map(lambda t: bool(insults.search(t.lower())))].mean() >= 0.99


def grams(text):
    plain = b" " + re.sub(b"[^0-9a-z\x80-\xff]+", b" ", text.lower()) + b" "
    plain = re.sub(b" +", b" ", plain) if text[:1].isalnum() and text[-1:].isalnum() else plain
    return {plain[i:i + n] for n in toxicity.SIZES for i in range(len(plain) - n + 1)}


def test_cells_are_those_of_the_distinct_ngrams():
    cells = toxicity.Cells()
    for text in (b"a", b"Hello, HELLO  world", b"abab" * 40, "äé ß 1\x00z".encode(), b"x" * 1000):
        got = cells.of(text)
        assert len(set(got.tolist())) == len(got)
        assert len(got) <= len(grams(text)) and len(got) >= len(grams(text)) - 2  # cells may be shared
    assert set(cells.of(b"Hello, HELLO  world").tolist()) == set(cells.of(b"hello!hello;world").tolist())
    assert set(cells.of(b"abc").tolist()) < set(cells.of(b"abc abd").tolist())
    assert cells.of(None).tolist() == cells.of(b"").tolist() == []


def test_ratios_and_fit_equal_plain_formulas(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        y = int(rng.random() < 0.3)
        words = [f"w{k}" for k in rng.integers(0, 30, 8)] + (["nasty"] if y and rng.random() < 0.9 else []) + (["calm"] if not y and rng.random() < 0.5 else [])
        rows.append((" ".join(words), y))
    train = spark.createDataFrame(rows, "text string, label int").repartition(3)
    scale, total = toxicity.log_count_ratios(train)
    c, y = toxicity.Cells(), np.array([label for _, label in rows])
    x = np.zeros((len(rows), toxicity.CELLS), np.float32)
    for i, (text, _) in enumerate(rows):
        x[i, c.of(text.encode())] = 1
    assert total.tolist() == [(y == 0).sum(), (y == 1).sum()]
    have = np.stack([x[y == k].sum(0) for k in (0, 1)]).astype(float)
    share = (have + 1) / (total[:, None] + 2)
    ratio = np.log(share[1] / share[0])
    clear = np.abs(ratio) > 3 * np.sqrt(((1 - share) / (have + 1)).sum(0))
    assert clear.any() and np.allclose(scale, np.where(clear, ratio, 0))
    model = toxicity.fit(train, penalty=0.01, steps=40)
    z = x[:, clear].astype(float) * scale[clear]
    w, b = np.zeros(z.shape[1]), 0.0
    for _ in range(60):  # Newton's method on the same loss
        p = 1 / (1 + np.exp(-(z @ w + b)))
        full = np.hstack([z, np.ones((len(z), 1))])
        g = full.T @ (p - y) / len(y) + np.append(0.01 * w, 0)
        h = (full.T * (p * (1 - p))) @ full / len(y) + np.diag(np.append(np.full(len(w), 0.01), 0))
        step = np.linalg.solve(h, g)
        w, b = w - step[:-1], b - step[-1]
    assert np.allclose(model.weights[clear], w * scale[clear], atol=0.02) and abs(model.offset - b) < 0.02


def test_awkward_rows(spark):
    docs, labels = awkward.frame(spark), awkward.labels(spark).withColumnRenamed("toxic", "_").withColumnRenamed("quality", "toxic")
    got = toxicity.score(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    empty_texts = {r["score"] for r in got if r["doc_id"] in (0, 1)}
    assert len(empty_texts) == 1
    assert toxicity.score(awkward.empty(spark), labels).count() == 0


def test_one_class_or_none(spark):
    docs, labels = awkward.frame(spark), awkward.labels(spark).select("doc_id", F_one().alias("toxic"))
    assert {r["predicted"] for r in toxicity.score(docs, labels).collect()} == {1}
    assert {round(r["score"], 6) for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.5}


def F_one():
    from pyspark.sql import functions as F
    return F.lit(1)
