"""Embedding near-duplicates: spherical k-means cells and blocked cosine products within them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import BROADCAST_ROWS, chunks, components, lean, lookup, spread, written
from concord.llm.simhash import Forest

#: Numbers (vectors times dimensions) of a block, about; a cell is one block or more. Pairs of blocks are compared.
BLOCK_NUMBERS = 1 << 18
#: Bound of the sample that the centroids are fitted on, in numbers (rows times dimensions).
SAMPLE_NUMBERS = 2_000_000
#: Vectors a cell should hold at least.
LEAST_CELL = 1024


def centroids(sample: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Spherical k-means of unit rows: assign by largest cosine, move to the normalised sum, reseed empty cells."""
    rng = np.random.default_rng(seed)
    centre = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        best = (sample @ centre.T).argmax(1)
        sums = np.zeros_like(centre)
        np.add.at(sums, best, sample)
        norm = np.linalg.norm(sums, axis=1)
        empty = norm < 1e-9
        sums[empty] = sample[rng.choice(len(sample), int(empty.sum()))]
        centre = sums / np.where(empty, 1, norm)[:, None]
    return centre


def unit_rows(vectors: list[bytes], kind: str) -> np.ndarray:
    """Rows of length 1. They are first scaled by a power of two, which is exact, so that no square over- or underflows."""
    x = np.array([np.frombuffer(v, kind) for v in vectors], dtype=float)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])
    return x / np.linalg.norm(x, axis=1)[:, None]


def gaps(centre: np.ndarray) -> np.ndarray:
    """Distances of all pairs of centres."""
    square = (centre**2).sum(1)
    return np.sqrt(np.maximum(0, square[:, None] + square - 2 * centre @ centre.T))


def cells_of(unit: np.ndarray, centre: np.ndarray, gap: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home) of every cell that holds a vector: its nearest, and as a guest each one whose boundary
    plane with the nearest is at most ``margin`` away (sine of the angle); ``gap`` holds the centres' distances."""
    rows, cells, home = [], [], []
    for a, b in chunks(len(unit), 2048):
        near = unit[a:b] @ centre.T
        best = near.argmax(1)
        step = gap[best]
        far = near[np.arange(b - a), best][:, None] - near
        r, c = np.nonzero(far <= margin * step + 1e-9)
        rows.append(r + a)
        cells.append(c)
        home.append(c == best[r])
    return np.concatenate(rows), np.concatenate(cells), np.concatenate(home)


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Double vectors; None for those that link with nothing."""
    out = []
    for value in column.to_pylist():
        if value is None or any(x is None for x in value):
            out.append(None)
            continue
        v = np.array(value, dtype=np.float64) + 0.0  # -0.0 becomes 0.0
        out.append(v if len(v) and np.isfinite(v).all() and v.any() else None)
    return out


def classes_of(rows: DataFrame, id_col: str, vector_col: str, kind: str) -> DataFrame:
    """``id``, ``key`` (hash of the vector, null if it links with nothing), ``vector`` (bytes) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _vectors(batch.column(1))
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([None if v is None else hashlib.sha256(v.tobytes()).hexdigest()[:32] for v in found], pa.string()),
                pa.array([None if v is None else v.astype(kind).tobytes() for v in found], pa.binary())], ["id", "key", "vector"])

    return rows.select(F.col(id_col).cast("long"), vector_col).mapInArrow(lean(run), "id long, key string, vector binary")


def blocks_of(members: DataFrame, models: dict[int, np.ndarray], margin_of: Callable[[int], float], kind: str) -> DataFrame:
    """``members`` (dim, cell, node, n_rows, vector: a written table) as one row per block of a cell: ``dim``, ``cell``, ``sub`` (block of the
    cell), ``near`` (cells that a vector of the block may link into) and ``nodes``, ``weights`` and ``vectors`` as bytes."""
    sizes = members.groupBy("dim", "cell").agg(F.ceil(F.count("*") * F.col("dim") / F.lit(BLOCK_NUMBERS)).cast("int").alias("_blocks"))
    sizes = written(sizes, "sizes")
    cut = members.join(F.broadcast(sizes) if sizes.count() <= BROADCAST_ROWS else sizes, ["dim", "cell"]).withColumn(
        "sub", F.pmod(F.xxhash64("node"), F.greatest("_blocks", F.lit(1))).cast("int"))

    def block(table: pa.Table) -> pa.Table:
        dim, cell = table["dim"][0].as_py(), table["cell"][0].as_py()
        table = table.take(pa.array(np.argsort(table["node"].to_numpy(), kind="stable")))
        near = [cell]
        if dim in models:
            _, cells, _ = cells_of(unit_rows(table["vector"].to_pylist(), kind), models[dim], gaps(models[dim]), margin_of(dim))
            near = np.union1d(near, cells).tolist()
        return pa.table({"dim": pa.array([dim], pa.int32()), "cell": pa.array([cell], pa.int32()), "sub": pa.array([table["sub"][0].as_py()], pa.int32()),
                         "near": pa.array([near], pa.list_(pa.int32())),
                         "nodes": pa.array([table["node"].to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "weights": pa.array([table["n_rows"].to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "vectors": pa.array([b"".join(table["vector"].to_pylist())], pa.binary())})

    return spread(cut.drop("_blocks"), "dim", "cell", "sub").groupBy("dim", "cell", "sub").applyInArrow(
        block, "dim int, cell int, sub int, near array<int>, nodes binary, weights binary, vectors binary")


def near_blocks(blocks: DataFrame) -> DataFrame:
    """All pairs of blocks that may hold a link, each once (a block also with itself), side by side.

    The blocks (a written table) are read where they lie, partition by partition against partition: none is shuffled or copied to disk.
    """
    names = ["cell", "nodes", "weights", "vectors"]
    left = blocks.select(*[F.col(c).alias(f"l_{c}") for c in ("dim", "sub", "near", *names)])
    right = blocks.select(*[F.col(c).alias(f"r_{c}") for c in ("dim", "sub", "near", *names)])
    # an inequality in both directions: an equality would have the blocks of a dimension dealt to one task
    place = lambda side: F.struct(F.col(f"{side}_cell").alias("cell"), F.col(f"{side}_sub").alias("sub"))
    once = (place("l") <= place("r")) & (F.col("l_dim") <= F.col("r_dim")) & (F.col("l_dim") >= F.col("r_dim"))
    meet = once & F.array_contains("l_near", F.col("r_cell")) & F.array_contains("r_near", F.col("l_cell"))
    return left.join(right.hint("shuffle_replicate_nl"), meet).select(
        "l_dim", "l_sub", "r_sub", *[f"{side}_{c}" for c in names for side in "lr"])


def _compared(batches: Iterator[pa.RecordBatch], models: dict[int, np.ndarray], margin_of: Callable[[int], float], kind: str,
              threshold: float) -> Iterator[pa.RecordBatch]:
    """Sums of the links of each vector (``node``) of a pair of blocks, and a spanning forest of them (``a``, ``b``: a smaller node)."""
    gap = {dim: gaps(centre) for dim, centre in models.items()}
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda c: batch.column(batch.schema.get_field_index(c))[row].as_py()
            dim, sides, alone = get("l_dim"), [], (get("l_cell"), get("l_sub")) == (get("r_cell"), get("r_sub"))
            for side, other in ("lr", "rl"):
                node, weight = (np.frombuffer(get(f"{side}_{c}"), "<i8") for c in ("nodes", "weights"))
                x = np.frombuffer(get(f"{side}_vectors"), kind).reshape(-1, dim).astype(float)
                x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])  # exact, against over- and underflow
                norm = np.linalg.norm(x, axis=1)
                own, far = get(f"{side}_cell"), get(f"{other}_cell")
                if own != far:  # only vectors beside the boundary can link across it
                    across = models[dim][own] - models[dim][far]
                    take = x @ across <= norm * (margin_of(dim) * gap[dim][own, far] + 1e-9)
                    node, weight, x, norm = node[take], weight[take], x[take], norm[take]
                sides.append((node, weight, x, norm))
                if alone:
                    sides.append(sides[0])
                    break
            (node, weight, x, norm), (node_r, weight_r, y, norm_r) = sides
            if not len(x) or not len(y):
                continue
            every, place = np.unique(np.concatenate([node, node_r]), return_inverse=True)  # in order, so that roots are smallest
            p_of, q_of = place[:len(node)], place[len(node):]
            forest, links = Forest(len(every)), np.zeros(len(every), np.int64)
            for a, b in chunks(len(x), 128):
                close = (x[a:b] @ y.T) / (norm[a:b][:, None] * norm_r) >= threshold
                if alone:
                    close &= np.arange(a, b)[:, None] < np.arange(len(y))
                p, q = np.nonzero(close)
                p += a
                np.add.at(links, p_of[p], weight_r[q])
                np.add.at(links, q_of[q], weight[p])
                forest.join(p_of[p], q_of[q])
            root = forest.roots()
            out = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays([pa.array(every[out]), pa.array(links[out]), pa.array(every[out]), pa.array(every[root[out]])],
                                             ["node", "links", "a", "b"])


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95,
                    spread_sigmas: float | None = None, cell_rows: int | None = None) -> DataFrame:
    """The id, ``n_links``, ``component_id`` and ``kept`` of every vector; one row per row.

    Equal vectors are first united into one class with a count. Spherical k-means, fitted on a sample bounded by
    ``SAMPLE_NUMBERS``, cuts the classes into cells. The step between two vectors at the threshold is
    sin(acos(threshold)), so a class can link only into cells whose boundary plane is at most that far away. The
    cells are stored as blocks, a row each, and pairs of blocks that may hold a link are read side by side where they
    lie: every vector is stored once, whatever the number of blocks it meets. Of two cells the classes near
    their boundary are compared by products in double precision, so that every pair meets once and no link is
    lost. Only sums and a spanning forest of the links leave a task. ``spread_sigmas`` narrows the margin to so many
    1 / sqrt(dimension) parts of the step, and loses links wherever differences do not spread evenly over the
    dimensions.

    Vectors that are null, empty, zero or hold a null or non-finite number link with nothing, and so do rows with a
    null id; vectors link only within their dimension. Repeated rows are vectors of their own. ``component_id`` is
    the smallest id that links reach, ``kept`` is id = component_id. An empty table gives no rows; other columns
    are ignored.
    """
    step = float(np.sqrt(max(0.0, 1 - threshold**2))) if threshold > 0 else 1.0
    step += 1e-7  # what rounding may add
    kind = "<f4" if rows.schema[vector_col].dataType.elementType.typeName() == "float" else "<f8"  # exact either way
    size = np.dtype(kind).itemsize

    def margin_of(dim: int) -> float:
        return step if spread_sigmas is None else min(step, spread_sigmas * step / max(1, dim - 1) ** 0.5)

    every = written(classes_of(rows, id_col, vector_col, kind), "vectors")
    linking = every.where("key is not null and id is not null")
    # a class is a node of its own: ids may repeat with other vectors
    classes = written(linking.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("n_rows"), F.first("vector").alias("vector"))
                      .withColumn("node", F.monotonically_increasing_id()), "classes")
    shape = classes.groupBy(F.length("vector").alias("bytes")).agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(16).collect()
    models: dict[int, np.ndarray] = {}
    for r in shape:  # dimensions beyond the 16 most usual are one cell each
        dim = r["bytes"] // size
        want = -(-r["n"] // (cell_rows or max(LEAST_CELL, int(8 * r["n"] ** 0.5))))
        bound = max(64, min(r["n"], SAMPLE_NUMBERS // dim))
        if want > 1:
            pick = classes.where(F.length("vector") == r["bytes"]).orderBy("key").limit(bound).select("vector").collect()
            models[dim] = centroids(unit_rows([x[0] for x in pick], kind), want)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            dims = np.array([len(v) // size for v in vectors.to_pylist()], dtype=int)
            cell = np.zeros(len(dims), int)
            for dim in np.unique(dims).tolist():
                if dim in models:
                    at = np.flatnonzero(dims == dim)
                    for a, b in chunks(len(at), 2048):
                        cell[at[a:b]] = (unit_rows([vectors[i].as_py() for i in at[a:b].tolist()], kind) @ models[dim].T).argmax(1)
            yield pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), pa.array(cell, pa.int32()), *(batch.column(k) for k in range(3))],
                                             ["dim", "cell", "node", "n_rows", "vector"])

    members = written(spread(classes.select("node", "n_rows", "vector")).mapInArrow(
        lean(deal), "dim int, cell int, node long, n_rows long, vector binary"), "cells")
    blocks = written(blocks_of(members, models, margin_of, kind), "blocks")
    found = written(near_blocks(blocks).mapInArrow(
        lean(lambda batches: _compared(batches, models, margin_of, kind, threshold)), "node long, links long, a long, b long"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    sets = written(components(found.select("a", "b")).join(classes.select("node", "rep"), "node"), "sets")
    least = written(sets.groupBy("component").agg(F.min("rep").alias("least"), F.count("*").alias("n_rows")), "least")
    known = classes.select("key", "node", "rep", "n_rows").join(links, "node", "left").join(
        lookup(sets.select("node", "component"), least, "component").select("node", "least"), "node", "left").select(
        "key", "n_rows", (F.coalesce("links", F.lit(0)) + F.col("n_rows") - 1).alias("n_links"),
        F.coalesce("least", "rep").alias("component_id"))
    done = lookup(every.drop("vector").withColumn("_at", F.when(F.col("id").isNotNull(), F.col("key"))).drop("key"),
                  written(known, "known").withColumnRenamed("key", "_at"), "_at", "left")
    component = F.coalesce("component_id", "id")
    return done.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                       component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
