"""Secret scan: pattern candidates judged by how many owners in the whole corpus hold the same value."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import BROADCAST_ROWS, boxed, lean, lookup, text_key, written

# Fixed values of the contract: the base kinds in their order, and their patterns and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # 16 characters or more
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_ASSIGNED = 8
#: Characters of a part of a run that can look random; the parts of UUIDs, paths and slugs are shorter.
LEAST_PART = 16

#: Kinds that the method adds, after the base kinds: well-known formats, and any long run that looks random. Each pattern
#: is linear in the text: it starts once in a run of its characters, or cannot pass its own start again.
ADDED = {
    "forge": re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"),
    "chat": re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    "jwt": re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]+"),
    "pem": re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]+"),
    "login": re.compile(r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/@]{3,}@"),
    "random": re.compile(r"[A-Za-z0-9+/_=-]{20,}"),
}
HINTS = {"forge": "gh", "chat": "xox", "jwt": "eyJ", "pem": "PRIVATE KEY", "login": "://", "random": ""}
KINDS = ("assign", "access", "hex", *ADDED)

FOUND = "array<struct<start:long,stop:long,kind:int,hash:string>>"


def looks_random(run: str) -> bool:
    """A part of at least ``LEAST_PART`` characters between separators that words, paths and dates do not give: digits
    in several places, letters and digits (and cases, if both occur) in frequent change, 3 bits of entropy a character.

    In random runs neighbours differ in class at 0.62 (both cases) or 0.40 (one case) of the places, in identifiers
    at about half of that.
    """
    for part in re.split(r"[/_=+-]+", run):
        n = len(part)
        if n < LEAST_PART:
            continue
        kinds = "".join("0" if c.isdigit() else "A" if c.isupper() else "a" for c in part)
        both = "A" in kinds and "a" in kinds
        changes = sum(a != b for a, b in zip(kinds, kinds[1:])) / (n - 1)
        if (len(set(kinds)) > 1 and len(re.findall("0+", kinds)) >= (2 if both else 3) and changes >= (0.4 if both else 0.2)
                and -sum(k / n * math.log2(k / n) for k in Counter(part).values()) >= 3.0):
            return True
    return False


def candidates(text: str | None) -> list[dict]:
    """Spans (code points, stop exclusive) of one text with the hash of the value: base kinds as the contract has
    them, added kinds only where they overlap no base span and no added span before them."""
    if not text:
        return []
    found: list[tuple[int, int, int, str]] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text)]
    for kind, pattern in ADDED.items():
        if HINTS[kind] not in text:
            continue
        fresh, taken, k = [], sorted((a, b) for a, b, _, _ in found), 0
        for m in pattern.finditer(text):
            if kind == "random" and not looks_random(m[0]):
                continue
            while k < len(taken) and taken[k][1] <= m.start():
                k += 1
            if k == len(taken) or taken[k][0] >= m.end():
                fresh.append((m.start(), m.end(), KINDS.index(kind), m[0]))
        found += fresh
    return [{"start": a, "stop": b, "kind": k, "hash": hashlib.sha256(v.encode()).hexdigest()[:32]}
            for a, b, k, v in sorted(found)]


def _found(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` (narrow: key columns and the text) with the text replaced by its candidate spans ``found``."""
    names = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.int32()), ("hash", pa.string())]))
        for batch in batches:
            spans = []
            for a in range(0, batch.num_rows, 256):
                spans += [candidates(t) for t in batch.column(len(names)).slice(a, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(spans, kind)], [*names, "found"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names) + f", found {FOUND}"
    return docs.select(*names, F.col(text_col).cast("string")).mapInArrow(lean(run), schema)


def ownership(spans: DataFrame) -> DataFrame:
    """How widely each value is held: ``hash``, ``n_rows``, ``n_repos``, ``n_owners`` of spans (hash, owner, repo).

    Counted in three groupings that each combine before the shuffle, so a value held everywhere is one row per
    owner after the second.
    """
    repos = spans.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n_rows"))
    owners = repos.groupBy("hash", "owner").agg(F.sum("n_rows").alias("n_rows"), F.count("*").alias("n_repos"))
    return owners.groupBy("hash").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_repos").alias("n_repos"),
                                      F.count("*").alias("n_owners"))


def judged(found: DataFrame, example_owners: int, example_repos: int) -> DataFrame:
    """Spans of a written table (row, owner, repo, found), one per row, with ``live``: false for widely copied values."""
    spans = written(found.select("row", "owner", "repo", F.explode("found").alias("s")).select("row", "owner", "repo", "s.*"), "spans")
    held = ownership(spans).withColumn("live", ~((F.col("n_owners") >= example_owners) & (F.col("n_repos") >= example_repos)))
    return lookup(spans, written(held.select("hash", "n_rows", "live"), "held"), "hash")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_col: str = "doc_id", example_owners: int = 3, example_repos: int = 5) -> DataFrame:
    """Secrets of every row's whole text; one row per row.

    Candidates are found by pattern in one pass. Over the whole corpus, the hash of each value is counted by
    distinct owners and repositories (an owner's repository is the pair of both): a value with at least
    ``example_owners`` owners and ``example_repos`` repositories is a widely copied example, any other is live-looking.
    Columns: the id, ``spans`` (array of start, stop, kind, live in the order of start and kind). Spans of the base
    kinds are always listed; added kinds only if live. A null or empty text has no spans; a null owner or repository
    counts as one unknown; repeated rows are scanned each; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
                       F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"),
                       F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("_text"))
    found = written(_found(rows, "_text"), "found")
    verdicts = judged(found, example_owners, example_repos).where(F.col("live") | (F.col("kind") < 3))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    per_row = verdicts.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "stop", "live"))).alias("spans"))
    empty = F.array().cast("array<struct<start:long,kind:int,stop:long,live:boolean>>")
    return found.select("row", "id").join(per_row, "row", "left").select(
        F.col("id").alias(id_col),
        F.transform(F.coalesce("spans", empty), lambda s: F.struct(
            s.start, s.stop, F.element_at(kinds, s.kind + 1).alias("kind"), s.live)).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id",
           example_owners: int = 3, example_repos: int = 5) -> DataFrame:
    """``docs`` with every live-looking secret of any kind replaced by ``<secret:kind>``; all rows and columns stay.

    Judged as in :func:`scan`. The spans go back to the texts by a 128-bit key of the text, for equal texts have
    equal spans: they are broadcast when counted small, else joined by a shuffle. Widely copied examples stay.
    """
    rows = docs.select(F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
                       F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"), text_key(F.col(text_col)).alias("row"),
                       F.col(text_col).alias("_text"))
    found = written(_found(rows, "_text").where(F.size("found") > 0), "found")
    live = judged(found, example_owners, example_repos).where("live").select("row", "start", "stop", "kind").distinct()
    # spans do not overlap across kinds they were added to, but base kinds may: unite them from the left
    marks = written(live.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "kind"))).alias("_marks"))
                    .withColumnRenamed("row", "_key"), "marks")
    small = marks.count() <= BROADCAST_ROWS
    text = F.col("_doc")[text_col]
    joined = boxed(docs).withColumn("_key", text_key(text)).join(F.broadcast(marks) if small else marks, "_key", "left")

    names = [F.lit(f"<secret:{k}>") for k in KINDS]
    step = F.aggregate(
        "_marks", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, m: F.when(m.stop <= acc.at, acc).otherwise(F.struct(
            F.concat(acc.out, F.when(m.start >= acc.at, F.concat(
                F.substring(text, (acc.at + 1).cast("int"), (m.start - acc.at).cast("int")),
                F.element_at(F.array(*names), m.kind + 1))).otherwise(F.lit(""))).alias("out"),
            m.stop.alias("at"))))
    clean = F.when(F.col("_marks").isNull(), text).otherwise(
        F.concat(step["out"], F.substring(text, (step["at"] + 1).cast("int"), F.length(text))))
    return joined.select(*[(clean if c == text_col else F.col("_doc")[c]).alias(c) for c in docs.columns])
