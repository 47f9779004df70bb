import corpus_pipeline
from conftest_paths import SF001
from pyspark.sql import functions as F
from test_packing import check
from test_secret_scan import base
from test_simhash import components, plain

from concord.llm import mixing, quality, secret_scan


def plain_redaction(docs):
    """Texts with live-looking values replaced: a value is live unless 3 sources and 5 documents of them hold it."""
    found = {i: secret_scan.candidates(r["text"]) for i, r in docs.items()}
    held = {}
    for i, spans in found.items():
        for s in spans:
            held.setdefault(s["hash"], set()).add((docs[i]["source"], i))
    out = {}
    for i, spans in found.items():
        live = sorted({(s["start"], s["stop"], s["kind"]) for s in spans
                       if len({o for o, _ in held[s["hash"]]}) < 3 or len(held[s["hash"]]) < 5})
        text, new, at = docs[i]["text"], "", 0
        for start, stop, kind in live:
            if stop > at:
                new += text[at:start] + f"<secret:{secret_scan.KINDS[kind]}>" if start >= at else ""
                at = stop
        out[i] = None if text is None else new + text[at:]
    return out


def test_stages_against_brute_force(spark, tmp_path):
    source = spark.read.parquet(f"{SF001}/documents.parquet")
    # secrets of one document, and one value that many documents of several sources hold
    own = F.concat(F.lit(" password = hunter"), F.col("doc_id").cast("string"), F.lit("99xyz and ghp_"), F.repeat(F.lit("aB3"), 13), F.lit(" end"))
    planted = F.when(F.col("doc_id") % 9 == 0, own).when(F.col("doc_id") % 7 == 0, F.lit(" token: EXAMPLE_0123456789 end")).otherwise(F.lit(""))
    source = source.withColumn("text", F.concat("text", planted)).withColumn("n_chars", F.length("text").cast(source.schema["n_chars"].dataType))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "secret scans", "mixing", "packing"]
    docs, after = source, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF001).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after[name] = docs.collect()
        if name != "packing":
            assert docs.columns == source.columns
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    rejected = {r["doc_id"] for r in quality.score(source, labels).where("predicted = 0").collect()}
    good = {r["doc_id"]: r for r in after["quality classifier"]}
    assert set(good) == {r["doc_id"] for r in source.collect()} - rejected
    ids = sorted(good)
    roots = components([plain(good[i]["text"]) for i in ids])
    single = {r["doc_id"]: r for r in after["SimHash near-dedup"]}
    assert set(single) == {ids[r] for r in roots}
    assert all(single[i] == good[i] for i in single)
    clean = {r["doc_id"]: r for r in after["secret scans"]}
    assert set(clean) == set(single)
    redacted = plain_redaction(single)
    for i, r in clean.items():
        assert r["text"] == redacted[i] and r["n_chars"] == len(r["text"])
        assert {k: r[k] for k in source.columns if k not in ("text", "n_chars")} == {k: single[i][k] for k in source.columns if k not in ("text", "n_chars")}
    assert any(base(single[i]["text"]) and "<secret:assign>" in clean[i]["text"] for i in clean)
    assert any("EXAMPLE_0123456789" in clean[i]["text"] for i in clean)
    whole = [r for r in after["mixing"] if r["text"] == clean[r["doc_id"]]["text"]]
    assert all(clean[r["doc_id"]]["text"].startswith(r["text"]) for r in after["mixing"])
    leaves = len({(r["lang"], r["source"]) for r in clean.values()})
    assert len(after["mixing"]) - len(whole) <= leaves
    total = sum(len(r["text"].encode().split()) for r in clean.values())
    taken = sum(len(r["text"].encode().split()) for r in after["mixing"])
    assert total * 0.9 - 2 * leaves <= taken <= total * 0.9
    assert check(after["packing"], after["mixing"]) == 0


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF001).columns[:2] == ["doc_id", "start"]


def test_cut_texts(spark):
    docs = spark.createDataFrame([(" a b  c\nd e",)], "text string")
    cuts = [docs.select(mixing.first_words(F.col("text"), F.lit(n)).alias("t")).first()["t"] for n in (1, 3, 9)]
    assert cuts == [" a ", " a b  c\n", " a b  c\nd e"]
