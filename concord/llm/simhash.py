"""SimHash near-duplicates: exact pairs within a Hamming distance by sharded vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.blocks import block_tasks
from concord.llm.common import boxed, chunks, components, keep_ids, lean, lookup, spread, text_key, written
from concord.llm.shingles import shingle_hashes

#: Members of a shard that one task compares; larger shards are compared block by block.
BLOCK = 1 << 17
#: Fingerprints of the bounded sample from which the top of the tree is built.
SAMPLE = 1 << 14
#: Nodes of rows without an id start here.
NULL_ID = 1 << 62
#: Candidate pairs held at once.
PAIRS = 1 << 21


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the shingles of ``shingle`` words; 0 without words.

    Shingles and hashes as in :func:`shingle_hashes`; a bit is set if it is set in over half of the hashes.
    """
    count, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, shingle):
        count += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        total += len(hashes)
    return int.from_bytes(np.packbits(count * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``id`` (long), ``key`` (of the text), ``node`` (the id; above all ids where it is null), ``fp`` (the 64 bits as
    a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps: list[int] = []
            for a, b in chunks(batch.num_rows, 256):
                fps += [fingerprint(t, shingle) for t in batch.column(3).slice(a, b - a).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.array(fps, dtype=np.uint64).view(np.int64))],
                                             ["id", "key", "node", "fp"])

    own = F.col(id_col).cast("long")
    node = F.coalesce(own, F.monotonically_increasing_id() + NULL_ID)
    return docs.select(own.alias("id"), text_key(F.col(text_col)).alias("key"), node.alias("node"),
                       F.col(text_col).cast("string")).mapInArrow(lean(run), "id long, key string, node long, fp long")


def vantage_tree(sample: np.ndarray, leaves: int) -> list[tuple]:
    """The top of a vantage-point tree: nodes (vantage point, radius, inner child, outer child), children below 0
    being leaves ``-1 - child``. Each node takes, of a few candidates, the point whose distances spread most."""
    nodes: list[tuple] = []
    made = 0

    def grow(points: np.ndarray, want: int) -> int:
        nonlocal made
        if want <= 1 or len(points) < 4:
            made += 1
            return -made
        best = None
        for v in points[:: max(1, len(points) // 8)][:8]:
            d = np.bitwise_count(points ^ v)
            radius = int(np.median(d))
            if radius == d.max():  # an outer side must remain
                radius -= 1
            even = min((d <= radius).sum(), (d > radius).sum())
            near = (np.abs(d.astype(int) * 2 - 2 * radius - 1) <= 5).mean()
            if even and (best is None or near - even / len(d) < best[0]):
                best = (near - even / len(d), v, radius, d)
        if best is None:  # all points alike
            made += 1
            return -made
        _, v, radius, d = best
        at = len(nodes)
        nodes.append(())
        nodes[at] = (v, radius, grow(points[d <= radius], want - want // 2), grow(points[d > radius], want // 2))
        return at

    root = grow(sample, leaves)
    return nodes if root >= 0 else []


def route(fps: np.ndarray, nodes: list[tuple], margin: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for every leaf that the ball of ``margin`` bits around a fingerprint touches, by the triangle
    bound: the ball is inside a node's radius only up to distance ``radius + margin``, outside from
    ``radius + 1 - margin``."""
    rows, leaf = [], []
    todo = [(0 if nodes else -1, np.arange(len(fps)))]
    while todo:
        node, idx = todo.pop()
        if not len(idx):
            continue
        if node < 0:
            rows.append(idx)
            leaf.append(np.full(len(idx), -1 - node, np.int32))
            continue
        v, radius, inner, outer = nodes[node]
        d = np.bitwise_count(fps[idx] ^ v).astype(int)
        todo += [(inner, idx[d <= radius + margin]), (outer, idx[d > radius - margin])]
    return (np.concatenate(rows), np.concatenate(leaf)) if rows else (np.empty(0, int), np.empty(0, np.int32))


class Forest:
    """Union-find over positions; roots are the smallest."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        p = self.parent
        while True:
            q = p[p]
            if (q == p).all():
                return p
            p = self.parent = q

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Unite all pairs (a, b), vectorised: hook larger roots below smaller ones until nothing changes."""
        while len(a):
            p = self.roots()
            x, y = p[a], p[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))


def link_near(fps: np.ndarray, left: np.ndarray, right: np.ndarray, bits: int, forest: Forest, parts: int = 4) -> None:
    """Unite in ``forest`` all positions of ``left`` and ``right`` (into ``fps``; both may be the same) within ``bits``
    differing bits.

    Two fingerprints within ``bits`` differ by at most ``bits // parts`` bits in one of ``parts`` slices. Positions of
    ``right`` are put in buckets by a slice; each of ``left`` looks into the buckets of every value within that radius, in
    blocks of ``PAIRS`` candidates, and each candidate is compared whole. First every bucket's members are compared
    with its first; after that a position passes over the members of a bucket that are in its own tree already, so
    a dense group costs about its size, not its square.
    """
    if not len(left) or not len(right):
        return
    width, radius = 64 // parts, bits // parts
    masks = [0]
    for _ in range(radius):
        masks = sorted({m ^ (1 << i) for m in masks for i in range(width)} | set(masks))
    slices = [(fps >> np.uint64(k * width)) & np.uint64((1 << width) - 1) for k in range(parts)]
    shift = np.uint64(32)
    for cut in slices:
        by = right[np.argsort(cut[right], kind="stable")]
        starts = np.flatnonzero(np.append(True, np.diff(cut[by]) > 0))
        first = np.repeat(by[starts], np.diff(np.append(starts, len(by))))
        near = np.bitwise_count(fps[by] ^ fps[first]) <= bits
        forest.join(by[near], first[near])
    for cut in slices:
        root = forest.roots().astype(np.uint64)  # trees only grow, so a pair once in one tree stays there
        place = cut[right] << shift | root[right]
        by = right[np.argsort(place, kind="stable")]
        place = np.sort(place)
        for m in masks:
            want = cut[left] ^ np.uint64(m)
            lo, hi = np.searchsorted(place, want << shift), np.searchsorted(place, (want + np.uint64(1)) << shift)
            own = want << shift | root[left]
            own_lo, own_hi = np.searchsorted(place, own, "left"), np.searchsorted(place, own, "right")
            n = (hi - lo) - (own_hi - own_lo)
            ends = np.cumsum(n)
            total, done = int(ends[-1]), 0
            while done < total:
                stop = min(total, done + PAIRS)
                pair = np.arange(done, stop)
                i = np.searchsorted(ends, pair, "right")
                at = lo[i] + (pair - (ends[i] - n[i]))
                at += np.where(at >= own_lo[i], own_hi[i] - own_lo[i], 0)
                j = by[at]
                ok = np.bitwise_count(fps[left[i]] ^ fps[j]) <= bits
                forest.join(left[i[ok]], j[ok])
                done = stop


def linked(classes: DataFrame, bits: int, shard: int = 1 << 14) -> DataFrame:
    """Edges (a, b) between class ids that span every set of ``classes`` (fp, rep, n_rows) joined by links of at
    most ``bits`` differing bits.

    The top of a vantage-point tree, built from a bounded sample, cuts the fingerprints into shards of about
    ``shard``. A pair within ``bits`` has a point in between within ``ceil(bits / 2)`` of both, so a fingerprint
    is copied to each shard that the ball of that radius touches, and every pair meets in a shard. A shard over
    ``BLOCK`` members is compared block against block in as many tasks. Tasks return a spanning forest of the
    links they see, never the pairs.
    """
    n = classes.count()
    pick = classes.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).select("fp").toPandas()["fp"].to_numpy(np.int64)
    nodes = vantage_tree(pick.view(np.uint64), min(4096, -(-n // shard)))
    margin = -(-bits // 2)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rows, leaf = route(fps, nodes, margin)
            for a, b in chunks(len(rows), 1 << 17):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf[a:b]), batch.column(0).take(pa.array(rows[a:b])),
                     batch.column(1).take(pa.array(rows[a:b]))], ["leaf", "fp", "rep"])

    members = spread(classes.select("fp", F.col("rep").cast("long"))).mapInArrow(lean(deal), "leaf int, fp long, rep long")
    tasks = block_tasks(written(members, "shards"), "leaf", "fp", BLOCK)

    def compare(table: pa.Table) -> pa.Table:
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        fp = table["fp"].to_numpy().view(np.uint64)
        rep, own = table["rep"].to_numpy(), table["own"].to_numpy()
        order = np.argsort(rep, kind="stable")  # so that roots are smallest ids
        fp, rep, own = fp[order], rep[order], own[order]
        forest = Forest(len(fp))
        link_near(fp, np.flatnonzero(own == i), np.flatnonzero(own == j), bits, forest)
        root = forest.roots()
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": rep[moved], "b": rep[root[moved]]})

    return tasks.groupBy("leaf", "i", "j").applyInArrow(compare, "a long, b long")


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, bits: int) -> DataFrame:
    """The columns of :func:`fingerprints` with ``grp``, the smallest fingerprint that links reach, and ``component``, the
    smallest node of its rows; one row per row. Fingerprints, not ids, name the classes, for ids may repeat."""
    fps = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min("node").alias("rep"), F.count("*").alias("n_rows")), "classes")
    sets = components(linked(classes.withColumn("rep", F.col("fp")), bits))
    placed = written(classes.join(sets.select(F.col("node").alias("fp"), F.col("component").alias("grp")), "fp", "left").select(
        "fp", F.coalesce("grp", "fp").alias("grp"), "rep", "n_rows"), "placed")
    least = written(placed.groupBy("grp").agg(F.min("rep").alias("component"), F.count("*").alias("n_rows")), "least")
    known = lookup(placed.select("fp", "grp", F.col("n_rows").alias("n")), least, "grp").select(
        "fp", "grp", "component", F.col("n").alias("n_rows"))
    return lookup(fps, written(known, "known"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    bits: int = 4) -> DataFrame:
    """The id, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    ``component_id`` is the smallest id that links of at most ``bits`` differing bits reach. Ids are integers. Null
    texts count as empty; texts without words have fingerprint zero and link like any other. Rows that repeat an id
    are rows of their own. Rows with a null id link like others; a component of null ids only is null. An empty
    table gives no rows; other columns are ignored.
    """
    return grouped(docs, id_col, text_col, shingle, bits).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("component") < NULL_ID, F.col("component")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, bits: int = 4) -> DataFrame:
    """Of each near-duplicate group one row of ``docs``, with all its columns: that of the smallest id (null ids last;
    then by a hash of the text). Of rows that repeat both id and text one stays.

    Rows are found again by id and text key. The smaller of the sets that stay and that go is broadcast when
    counted small; otherwise texts are shuffled once.
    """
    same = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("key")).alias("_row")
    rows = written(grouped(docs, id_col, text_col, shingle, bits).select("grp", F.struct(
        F.when(F.col("id").isNull(), F.lit(NULL_ID)).otherwise(F.col("id")).alias("n"), "key").alias("at"), same), "groups")
    stay = written(rows.groupBy("grp").agg(F.min_by("_row", "at").alias("_row")).select("_row"), "stay")
    every = rows.groupBy("_row").agg(F.count("*").alias("n"))
    go = written(every.join(stay, "_row", "left_anti"), "go")
    again = written(every.where("n > 1").join(stay, "_row").select("_row"), "again")
    n_stay, n_go = stay.count(), go.count()
    doc = F.col("_doc")
    own = F.concat(F.coalesce(doc[id_col].cast("long").cast("string"), F.lit("")), F.lit(":"), text_key(doc[text_col]))
    marked = boxed(docs).withColumn("_row", own)
    kept = (keep_ids(marked, go.select("_row"), "_row", n_go, "left_anti") if n_go <= n_stay
            else keep_ids(marked, stay, "_row", n_stay, "left_semi"))
    n = again.count()
    if not n:
        return kept.select("_doc.*")
    once = keep_ids(kept, again, "_row", n, "left_semi").groupBy("_row").agg(F.min_by("_doc", F.xxhash64("_doc")).alias("_doc"))
    return keep_ids(kept, again, "_row", n, "left_anti").select("_doc.*").unionByName(once.select("_doc.*"))
