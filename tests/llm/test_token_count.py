import awkward
import numpy as np
import pytest
from conftest_paths import SF001
from test_packing import tokenizer

from concord.llm import token_count as tc


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    t = tokenizer()
    want = {r["doc_id"]: len(t.encode(r["text"], add_special_tokens=False).ids) for r in docs.collect()}
    got = tc.count_texts(docs).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want and len(got) == len(want)
    for a, b in zip(sorted(got, key=lambda r: (r["file"], r["document"])), sorted(got, key=lambda r: (r["file"], r["start"]))):
        assert a == b


def test_awkward_rows(spark):
    docs, t = awkward.frame(spark), tokenizer()
    want = sorted((str(r["doc_id"]), len(t.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in tc.count_texts(docs).collect()) == want
    assert tc.count_texts(awkward.empty(spark)).count() == 0


def documents_of(stream, end):
    """(start, tokens, ended) of each document of one file."""
    out, start = [], 0
    for i, x in enumerate(stream):
        if x == end:
            out.append((start, i - start, True))
            start = i + 1
    return out + ([(start, len(stream) - start, False)] if start < len(stream) else [])


@pytest.mark.parametrize("width,block", [(2, 5), (4, 3)])
def test_flat_files(spark, tmp_path, width, block, monkeypatch):
    """Raw files read back: separators at block ends, blocks without any, empty documents, an unended tail."""
    monkeypatch.setattr(tc, "GROUP", 2)
    rng = np.random.default_rng(width)
    streams = {"a": rng.choice([1, 2, 7], 103, p=[0.45, 0.45, 0.1]), "b": np.array([7, 7, 7]), "c": np.array([], int),
               "d": np.full(40, 1), "e": np.append(np.full(19, 2), 7)}
    for name, s in streams.items():
        (tmp_path / name).write_bytes(s.astype(f"<u{width}").tobytes())
    got = tc.count_documents(tc.read_flat(spark, str(tmp_path), width, block), 7, width).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["document"]):
        by.setdefault(r["file"].rsplit("/", 1)[1], []).append((r["start"], r["n_tokens"], r["ended"]))
    assert by == {k: documents_of(s, 7) for k, s in streams.items() if len(s)}


def test_block_size_does_not_hang_on_divisors(spark, tmp_path):
    """A prime number of tokens: full blocks and one shorter, whose bytes are read where they lie."""
    (tmp_path / "p").write_bytes(np.full(10_007, 3, "<u2").tobytes())
    blocks = sorted((r["block"], r["at"], r["n_bytes"]) for r in tc.read_flat(spark, str(tmp_path), 2, 4000).collect())
    assert blocks == [(0, 0, 8000), (1, 8000, 8000), (2, 16000, 4014)]


def test_files_hold_only_tokens(spark, tmp_path):
    """What the operator writes is a flat stream: ids and separators, no lengths; files that no task committed are not read."""
    docs, t = spark.createDataFrame([(i, "some words " * i) for i in range(9)], "doc_id long, text string").repartition(3), tokenizer()
    ids = tc.token_files(docs, str(tmp_path)).orderBy("file", "document").collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    by = {}
    for r in ids:
        by.setdefault(r["file"], []).extend([*t.encode(texts[r["doc"]], add_special_tokens=False).ids, 50256])
    assert {f.name: np.fromfile(f, "<u2").tolist() for f in tmp_path.iterdir()} == by


def test_files_of_failed_attempts_are_not_counted(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "some words " * i) for i in range(9)], "doc_id long, text string")
    plain = sorted(tuple(r) for r in tc.count_texts(docs).collect())
    write = tc.token_files

    def with_orphan(docs, folder, *rest):
        ids = write(docs, folder, *rest)
        system, place = tc._opened(f"{folder}/part-00000-lost")
        with system.open_output_stream(place) as f:
            f.write(b"\1\0\2\0")
        return ids

    monkeypatch.setattr(tc, "token_files", with_orphan)
    assert sorted(tuple(r) for r in tc.count_texts(docs).collect()) == plain


def test_odd_file_is_an_error(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"123")
    with pytest.raises(ValueError):
        tc.read_flat(spark, str(tmp_path))
