"""Names replaced by a broadcast trie, against the alternation of a row's own names and against plain scanning."""

import random

from pyspark.sql import functions as F

from concord.operators import scripts as scr
from concord.operators.name_trie import name_trie

NAMES = {"a": "1", "a.b": "2", "a.b.c": "three three", "b": "a", "b$c": "5", "c..a": "6", "é_x": "7", "a$": "never", ".b": "never", "a b": "never",
         "b.c$a.b": "$8\\"}


def texts(n):
    rng = random.Random(11)
    pieces = ["a", "b", "c", "A", "B", "É_x", "x", ".", "$", "..", " ", "\n", ",", "'", "a1", "_a"]
    return ["".join(rng.choices(pieces, k=rng.randrange(0, 25))) for _ in range(n)] + ["", " ", "a", "a.b.", "a.b.c.a.b.c", "b.c$a.B$c"]


def frames(spark, data, names):
    units = spark.createDataFrame(list(enumerate(data)), "unit_id int, t string")
    return units, spark.createDataFrame(list(names.items()), "word string, replacement string")


def test_equals_the_alternation(spark, monkeypatch):
    """The path of scoped names and of more names than the limit gives the same texts."""
    units, names = frames(spark, [*texts(300), None], NAMES)
    fast = {r.unit_id: r.t for r in scr.replace_words(units, "t", ("unit_id",), names).collect()}
    monkeypatch.setattr(scr, "BROADCAST_NAMES", 0)
    slow = {r.unit_id: r.t for r in scr.replace_words(units, "t", ("unit_id",), names).collect()}
    assert fast == slow and len(fast) == 307 and fast[306] is None
    assert sum(fast[i] != t for i, t in enumerate(texts(300))) > 100


def test_only_names_that_occur_count_against_the_limit(spark, monkeypatch):
    units, names = frames(spark, ["a.b x y0", "nothing here"], {"a": "1", "x": "2", **{f"n{i}": "no" for i in range(40)}})
    monkeypatch.setattr(scr, "BROADCAST_NAMES", 3)
    out = scr.replace_words(units, "t", ("unit_id",), names)
    assert [r.t for r in out.orderBy("unit_id").collect()] == ["1.b 2 y0", "nothing here"]
    assert "ArrowEvalPython" in out._jdf.queryExecution().executedPlan().toString()


def test_null_names_and_other_columns(spark):
    units = spark.createDataFrame([(1, "a b", "a", 2.0)], "unit_id int, t string, word string, _map double")
    names = spark.createDataFrame([(None, "x"), ("a", None), ("b", "c"), ("b", "d")], "word string, replacement string")
    assert [tuple(r) for r in scr.replace_words(units, "t", ("unit_id",), names).collect()] == [(1, "a c", "a", 2.0)]
    none = scr.replace_words(units, "t", ("unit_id",), names.limit(0))
    assert [tuple(r) for r in none.collect()] == [(1, "a b", "a", 2.0)]


def test_two_hundred_thousand_names_in_one_pass(spark):
    """No shuffle of the texts: the plan has one exchange-free pass."""
    names = spark.range(200_000).select(F.concat(F.lit("db.t"), F.col("id").cast("string")).alias("word"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("replacement"))
    units = spark.range(20_000).select(F.col("id").alias("unit_id"), F.concat(F.lit("select * from DB.T"), (F.col("id") * 10).cast("string"), F.lit(" join db.other o")).alias("t"))
    out = scr.replace_words(units, "t", ("unit_id",), names)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where(F.col("t") != F.concat(F.lit("select * from u"), (F.col("unit_id") * 10).cast("string"), F.lit(" join db.other o"))).count() == 0


def test_trie():
    assert name_trie([(["a", "b"], ["", ".", ""], "x"), (["a"], ["", ""], "y"), (["c"], ["-", ""], "no"), ([], [""], "no")]) == {
        "a": {".": {"b": {None: "x"}}, None: "y"}}
