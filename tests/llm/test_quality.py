import zlib

import awkward
import numpy as np
from conftest_paths import SF01
from pyspark.sql import functions as F

from concord.llm import quality


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    got = quality.score(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() >= 0.95
    assert held.predicted[held.quality == 1].mean() >= 0.98
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_fit_equals_plain_formula(spark):
    rng = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    y = rng.integers(0, 2, 400)
    x = rng.normal(size=(400, d)) * (1 + y[:, None]) + y[:, None]
    train = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y)], "stats array<double>, label int").repartition(5)
    model = quality.fit(train, 0.1, 0.02)
    pooled = sum(np.cov(x[y == c].T, bias=True) * (y == c).mean() for c in (0, 1))
    density = []
    for c in (0, 1):
        cov = 0.9 * np.cov(x[y == c].T, bias=True) + 0.1 * pooled
        cov = 0.98 * cov + 0.02 * np.trace(cov) / d * np.eye(d)
        z = x - x[y == c].mean(0)
        density.append(np.log((y == c).mean()) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (z @ np.linalg.inv(cov) * z).sum(1))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(density[0] - density[1])))


def test_awkward_rows(spark):
    docs, labels = awkward.frame(spark), awkward.labels(spark)
    got = quality.score(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    kept = quality.keep_good(docs, labels, threshold=0.0)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert quality.score(awkward.empty(spark), labels).count() == 0
    assert quality.keep_good(awkward.empty(spark), labels).count() == 0


def test_one_class_or_none(spark):
    docs, labels = awkward.frame(spark), awkward.labels(spark)
    assert {r["score"] for r in quality.score(docs, labels.where("quality = 1")).collect()} == {1.0}
    assert {r["score"] for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}


def test_contradicting_labels_are_left_out(spark):
    stats = spark.createDataFrame([(i, [0.0]) for i in range(6)], "doc_id long, stats array<double>")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)] + [(2, 1)], "doc_id long, quality int")
    used = {r["doc_id"] for r in quality.train_rows(stats, labels).collect()}
    assert used == {i for i in range(6) if i != 2 and zlib.crc32(str(i).encode()) % 5}


def plain_statistics(text):
    """The statistics of ``quality.STATISTICS`` character by character."""
    data = text.encode()
    n, words, lines = len(data), text_words(data), data.split(b"\n")

    def ratio(count, of):
        return np.log((count + 0.5) / (of + 1))

    def share(chars):
        return ratio(sum(b in chars for b in data), n)

    freq = [data.count(bytes([b])) / n for b in set(data)]
    return [np.log(1 + n), np.log((n + 1) / (len(words) + 1)), share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share(b"0123456789"),
            share(b".,;:'\"-()?"), share(b"#$%&*@^~_=+<>{}[]\\/`"), share(b"|"), share(b"!"), share(b"\n"), share(bytes(range(128, 256))),
            -sum(p * np.log(p) for p in freq), np.log((len(set(words)) + 1) / (len(words) + 1)),
            ratio(sum(words[i] == words[i + 1] for i in range(len(words) - 1)), len(words)), np.log(len(set(lines)) / len(lines)),
            ratio(sum(w[-1:] in (b".", b",") for w in words), len(words))]


def text_words(data):
    out, word = [], b""
    for b in data + b" ":
        if b in b" \t\n\r\x0b\x0c":
            out += [word] if word else []
            word = b""
        else:
            word += bytes([b])
    return out


def test_query_against_plain_version(spark):
    """The registered query over a whole table, from the texts to the predictions."""
    from conftest_paths import SF001

    from concord.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    x = np.array([plain_statistics(r["text"] or "") for r in docs])
    held = np.array([zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in docs])
    y = np.array([-1 if h or label.get(r["doc_id"]) is None else label[r["doc_id"]] for r, h in zip(docs, held)])
    cov = [np.cov(x[y == c].T, bias=True) for c in (0, 1)]
    size = [(y == c).sum() for c in (0, 1)]
    pooled = (size[0] * cov[0] + size[1] * cov[1]) / sum(size)
    density = []
    for c in (0, 1):
        own = 0.9 * cov[c] + 0.1 * pooled
        own = 0.98 * own + 0.02 * np.trace(own) / len(own) * np.eye(len(own))
        z = x - x[y == c].mean(0)
        density.append(np.log(size[c] / sum(size)) - 0.5 * np.linalg.slogdet(own)[1] - 0.5 * (z * np.linalg.solve(own, z.T).T).sum(1))
    want = 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))
    got = {r["doc_id"]: r for r in QUERIES["op2_quality"](spark, SF001).collect()}
    assert len(got) == len(docs)
    for r, h, s in zip(docs, held, want):
        row = got[r["doc_id"]]
        assert row["held_out"] == h and abs(row["score"] - s) < 1e-6 and row["predicted"] == (row["score"] >= 0.3)
