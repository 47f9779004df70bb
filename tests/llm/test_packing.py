import awkward
import numpy as np
from conftest_paths import SF001
from hypothesis import given, settings
from hypothesis import strategies as st

from concord.llm import packing, tokens
from concord.llm.tokens import byte_bpe, encoder


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def check(pieces, docs, window=2048):
    """Every id of every document lies in exactly one piece; sequences have no gap and fit."""
    t = tokenizer()
    by_doc, by_seq = {}, {}
    for p in pieces:
        assert p["length"] == len(p["ids"]) // 4 > 0
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
    want = {}
    for d in docs:
        want.setdefault(d["doc_id"], []).append(t.encode(d["text"] or "", add_special_tokens=False).ids + [1])
    assert set(want) == set(by_doc)
    for doc, texts in want.items():
        got = by_doc[doc]
        assert sum(p["length"] for p in got) == sum(map(len, texts))
        if len(texts) == 1:
            got = sorted(got, key=lambda p: p["start"])
            assert [p["start"] for p in got] == [0, *np.cumsum([p["length"] for p in got])[:-1].tolist()]
            assert b"".join(p["ids"] for p in got) == np.array(texts[0], "<u4").tobytes()
            assert {p["doc_tokens"] for p in got} == {len(texts[0])}
    padding = 0
    for seq in by_seq.values():
        end = 0
        for p in sorted(seq, key=lambda p: p["offset"]):
            assert p["offset"] == end
            end += p["length"]
        assert end <= window
        padding += window - end if end & (end - 1) else 0
    return padding


def test_real_documents(spark):
    docs = awkward.some(spark, SF001, 10**9)
    assert check(packing.pack(docs).collect(), docs.collect()) == 0


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    assert check(packing.pack(docs, batch_tokens=3000).collect(), docs.collect()) == 0
    assert packing.pack(awkward.empty(spark)).count() == 0


def test_same_rows_again(spark):
    docs = awkward.some(spark, SF001, 60)
    assert sorted(map(str, packing.pack(docs).collect())) == sorted(map(str, packing.pack(docs).collect()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_best_fit_is_tightest(lengths):
    """The tree finds what a plain search over all open windows finds."""
    where, offset, n = packing.best_fit(lengths, 32)
    left = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [c for c in left if c >= lengths[i]]
        if fits:
            assert 32 - offset[i] == min(fits)
            left.remove(min(fits))
            left.append(min(fits) - lengths[i])
        else:
            assert offset[i] == 0
            left.append(32 - lengths[i])
    assert n == len(left) == len(set(where))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 31), min_size=1, max_size=40))
def test_gaps_are_closed(lengths):
    rows = packing.close_gaps([(d, 0, np.full(n, d, np.uint32), n) for d, n in enumerate(lengths)], 32)
    held = {}
    for doc, start, ids, total, window, offset in rows:
        held.setdefault(window, []).append((offset, len(ids)))
    assert sum(len(r[2]) for r in rows) == sum(lengths)
    for parts in held.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end == 32 or end & (end - 1) == 0


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_those_of_tokenizers(text):
    assert encoder(byte_bpe()).ids(text).tolist() == tokenizer().encode(text, add_special_tokens=False).ids


def test_added_token_in_a_text(spark):
    """As an unchanged tokenizer gives it."""
    from public_tokenizers import path
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(path("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b", "x  <|endoftext|>  <|endoftext|> y\n", "<|endoftext", "é <|endoftext|>", "<|endoftext|>"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 50256, 65]
    assert [encoder(byte_bpe()).ids(t, added=True).tolist() for t in texts] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["doc_tokens"] for r in packing.pack(docs).collect()} == {i: len(w) + 1 for i, w in enumerate(want)}


BLANKS = [" ", "\n", "\t", "\u00a0"]


def test_long_runs_of_white_space_get_the_same_ids():
    """Two million characters of white space, of each kind and with text around, as an unchanged tokenizer has them."""
    import public_tokenizers
    from tokenizers import Tokenizer
    plain, encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), tokens.encoder(tokens.byte_bpe())
    for blank in BLANKS:
        text = "one<|endoftext|>" + blank * 2_000_000 + "two " + blank * 3
        assert encoder.ids(text, added=True).tolist() == plain.encode(text, add_special_tokens=False).ids
        assert 50256 not in encoder.ids(text)[:10]
    assert len(tokens._LONG_BLANK.findall((" " * (tokens.LONG_BLANK - 1) + "x") * 20)) == 0


def test_long_runs_of_white_space_are_packed(spark):
    from concord.llm import token_count
    rows = [(i, "a" + blank * 1_200_000 + "b") for i, blank in enumerate(BLANKS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    encoder = tokens.encoder(tokens.byte_bpe())
    want = {i: len(encoder.ids(t)) for i, t in rows}
    assert {r["doc_id"]: r["n"] - 1 for r in packing.pack(docs).groupBy("doc_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()} == want
    assert {r["doc_id"]: r["n_tokens"] for r in token_count.count_texts(docs).collect()} == want
