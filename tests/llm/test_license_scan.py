import re

import awkward
import pytest
from conftest_paths import SF01

from concord.llm import license_scan
from concord.llm.license_scan import BASE, BASE_CONFIDENCE, rules

RULES = [(label, re.compile(f" {p}(?= )"), w, priority, c) for label, p, w, priority, c in rules()]


def plain(text):
    """The contract's base columns and the rules' labels, by plain loops."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, base = [], set()
    for phrase, label in BASE:
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
    line = f" {' '.join(words)} " if words else ""
    found = set()
    for label, pattern, keyword, priority, confidence in RULES:
        if " " + keyword in line:
            for m in pattern.finditer(line):
                start = line[:m.start()].count(" ")
                found.add((start, start + m[0].count(" "), priority, label, confidence))
    kept = [a for a in found if not any(
        b[0] <= a[0] and b[1] >= a[1] and (b[2] > a[2] or b[2] == a[2] and b[:2] != a[:2]) for b in found)]
    labels = base | {k[3] for k in kept}
    score = max([k[4] for k in kept] + [BASE_CONFIDENCE] * bool(base), default=0.0)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score)


def test_real_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in license_scan.scan(docs).collect()}
    assert got == {k: plain(t) for k, t in texts.items()}


CASES = [
    "Licensed under the Apache License, Version 2.0 (the License)", "SPDX-License-Identifier: Apache-2.0", "the GNU Lesser General Public License v2.1",
    "CC BY cc by CC-BY-SA 4.0 cc by", "MIT License MIT License", "released under the terms of the MIT license. All rights reserved. ALL RIGHTS RESERVED!",
    "GNU General Public License version 3 or GNU General Public License", "Creative Commons Attribution-NonCommercial 4.0", "", None,
    "Redistribution and use in source and binary forms, with or without warranties", "copyright 1999 copyright 2001 by",
    "été Ünder CC BY école", "general public  license\n\ngeneral\tpublic license", "in the public domain CC0 1.0 Universal",
    "Simplified BSD License; new BSD; BSD-3-Clause", "mit licenses ccby", "cc by nc nd 4 0 licensed under cc by nc nd 4 0",
]


def test_overlaps(spark):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    assert {r["doc_id"]: tuple(r)[1:] for r in license_scan.scan(docs).collect()} == {i: plain(t) for i, t in enumerate(CASES)}


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    got = sorted((str(tuple(r)) for r in license_scan.scan(docs).collect()))
    assert got == sorted(str((r["doc_id"], *plain(r["text"]))) for r in docs.collect())
    assert license_scan.scan(awkward.empty(spark)).count() == 0


def test_rules():
    table = rules()
    assert len(table) > 300 and len({r[0] for r in table}) > 100
    for label, pattern, keyword, priority, confidence in table:
        assert 0 < confidence <= 1 and priority >= 1 and re.compile(pattern)


@pytest.mark.parametrize("node", ["Python", "Pandas", "Arrow"])
def test_plan_is_native(spark, node, capsys):
    license_scan.scan(awkward.frame(spark)).explain()
    assert node not in capsys.readouterr().out


def strings(parsed):
    """Every string of a parsed pattern, with one character for each class and one turn for each open repeat."""
    found = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            parts = [chr(arg)]
        elif name == "IN":
            parts = [chr(v) if str(o) == "LITERAL" else "1" if str(o) == "RANGE" else "x" for o, v in arg]
        elif name == "SUBPATTERN":
            parts = strings(arg[3])
        elif name == "BRANCH":
            parts = [t for branch in arg[1] for t in strings(branch)]
        elif name == "MAX_REPEAT":
            parts = [t * n for n in {arg[0], min(arg[1], max(arg[0], 1))} for t in strings(arg[2])]
        else:
            raise ValueError(name)
        found = [a + b for a in found for b in parts]
    return found


def test_every_match_holds_its_keyword():
    for _, pattern, keyword, _, _ in rules():
        every = strings(re._parser.parse(pattern))
        assert all(re.fullmatch(pattern, t) for t in every)
        assert [t for t in every if f" {keyword}" not in f" {t}"] == []


def test_words_that_do_not_start_with_the_name(spark):
    cases = {"FreeBSD License": "bsd-2-clause", "CreativeML OpenRAIL-M": "openrail", "for noncommercial use only": "non-commercial"}
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in license_scan.scan(docs).collect()} == dict(enumerate(cases.values()))
