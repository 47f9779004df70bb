"""Script files of any size (X1 over S11): fragments, quote states over chunks, byte ranges and files."""

import random

import pytest

from concord.operators import script_files as sf
from concord.operators import scripts as scr


def whole(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "script_id string, sql string")
    return sorted(map(tuple, scr.split_units(df).collect()))


def from_files(spark, folder, texts, suffix=".sql"):
    folder.mkdir()
    for name, text in texts.items():
        (folder / f"{name}{suffix}").write_bytes(text.encode())
    return sorted((r.script_id, r.unit_id, r.statement) for r in sf.split_files(spark, str(folder)).collect())


AWKWARD = {
    "plain": "a; b;; c", "quoted": "select 'x;y' from t; select 'it''s; ok' from u", "open": "a ';b; c", "open_end": "x; a ';b;",
    "open_two": "x; a ';b;;", "blank": "  ;\n ; ", "semi": ";", "semis": ";;;", "lone": "'", "lone_semi": "';", "lines": "a\r\n;\n'b\r;\n';\n",
    "wide": "sélect 'ü;ß'; 🙂;　 ; '🙂;'", "tail": "a; b ", "long": "select '" + "p;" * 500 + "';" * 3 + "z", "empty": ""}


@pytest.fixture
def cut(spark):
    """A session that cuts files into ranges of a few bytes."""
    child = spark.newSession()
    child.conf.set("spark.sql.files.maxPartitionBytes", "61")
    child.conf.set("spark.sql.files.openCostInBytes", "0")
    child.conf.set("spark.sql.shuffle.partitions", "4")
    return child


def test_awkward_texts(spark, tmp_path):
    assert from_files(spark, tmp_path / "s", AWKWARD) == whole(spark, AWKWARD)


def test_many_byte_ranges_and_chunks(cut, tmp_path, monkeypatch):
    """Random texts over an alphabet of quotes and semicolons, cut into ranges of 61 bytes and chunks of two fragments."""
    monkeypatch.setattr(sf, "CHUNK_BITS", 1)
    rng = random.Random(5)
    texts = {f"r{i}": "".join(rng.choices(["'", ";", "a", "select ", " ", "\n"], [2, 5, 6, 3, 3, 1], k=rng.randrange(1, 300))) for i in range(12)}
    got = from_files(cut, tmp_path / "s", texts | AWKWARD)
    assert got == whole(cut, texts | AWKWARD)
    assert sf.fragments(cut, str(tmp_path / "s")).select("path", "block").distinct().count() > 60


def test_shuffled_chunks_suffix_and_other_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sf, "BROADCAST_CHUNKS", 0)
    texts = {"A": "create table x as select * from y; select 1", "b": "select ';'; 2"}
    folder = tmp_path / "s"
    folder.mkdir()
    (folder / "A.SQL").write_text(texts["A"])
    (folder / "b.sql").write_text(texts["b"])
    (folder / "c.txt").write_text("not; listed")
    got = sf.build_file_units(spark, str(folder)).collect()
    assert sorted((r.script_id, r.unit_id, r.statement) for r in got) == whole(spark, texts)
    assert {(r.file_name, r.statement_type, *r.sources, *r.targets) for r in got if r.unit_id == 1 and r.script_id == "A"} == {("A.SQL", "DDL", "y", "x")}


def test_byte_order_mark_is_dropped(spark, tmp_path):
    folder = tmp_path / "s"
    folder.mkdir()
    (folder / "m.sql").write_bytes(b"\xef\xbb\xbfa; b ';")
    assert sorted((r.unit_id, r.statement) for r in sf.split_files(spark, str(folder)).collect()) == [(1, "a"), (2, "b ';")]


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    """A dump of 20 MB: several byte ranges, statements as a plain splitter finds them."""
    child = spark.newSession()
    child.conf.set("spark.sql.files.maxPartitionBytes", str(2 << 20))
    child.conf.set("spark.sql.files.openCostInBytes", "0")
    folder = tmp_path / "s"
    folder.mkdir()
    text = "".join(f"insert into t values ({i}, 'a;{i % 7}''{';' * (i % 3)}');\n" for i in range(400_000))
    (folder / "dump.sql").write_text(text)
    assert sf.fragments(child, str(folder)).rdd.getNumPartitions() >= 8
    got = sf.split_files(child, str(folder))
    n, first, last, ids = got.selectExpr("count(*)", "min(unit_id)", "max(unit_id)", "count(distinct unit_id)").first()
    assert (n, first, last, ids) == (400_000, 1, 400_000, 400_000)
    wrong = got.where("statement <> concat('insert into t values (', unit_id - 1, ', ''a;', (unit_id - 1) % 7, '''''', "
                      "repeat(';', CAST((unit_id - 1) % 3 AS INT)), ''')')")
    assert wrong.count() == 0
