"""Row differences from two sketches of fixed size (R10): set reconciliation.

``row_multiset_diff`` shuffles every distinct row hash of both sides, however few rows differ. Here each side
is folded into a table of cells, the same number whatever its size, and only the cells are shuffled:

* **Cells** (an invertible Bloom lookup table over multisets). Every row adds its hash to three cells, one of each
  third of the table. A cell holds the number of rows and the sums of the eight 16-bit lanes of their 128-bit
  hashes and of two products of lanes. Sums are exact integers, so sketches of parts of a table add up to the
  sketch of the table, and two sketches subtract: rows that both sides hold equally often vanish.
* **Decoding.** A cell in which one row hash is left gives the hash (lane sums / number) and by how many rows the
  sides differ; it is taken out of its other cells, which frees more. A difference of up to about 0.8 hashes a
  cell decodes.
* **Strata.** Of hashes with k >= ``FIRST_STRATUM`` trailing zero bits, each k has a small table of its own. Those that
  decode tell how many hashes differ, so that a sketch that cannot be decoded is made again at the right size. Beyond
  ``MOST_CELLS`` the exact join of ``row_multiset_diff`` is used.

The rows of the decoded hashes are then read from both sides and counted, so the result is what the exact
join gives.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.operators.rowdiff import H, comparable, row_multiset_diff

#: Cells of the first sketch and of the largest that is decoded on the driver, in each third of the table.
FIRST_CELLS, MOST_CELLS = 1 << 12, 1 << 16
#: Cells of a stratum's table in each third.
STRATUM_CELLS = 1 << 5
FIRST_STRATUM, LAST_STRATUM = 4, 40

LANES = [f"l{i}" for i in range(8)]
SUMS = ["n", *LANES, "c0", "c1"]
PRIME = 65521


def _lanes() -> list[Column]:
    return [F.shiftrightunsigned(F.col(h), 16 * i).bitwiseAND(0xFFFF) for h in H for i in range(4)]


def _places(lanes: list, cells: int, bits) -> list:
    """The cell of a hash in each third (cells: a power of two), from bits of its lanes. ``bits`` combines (a, b, shift) to a xor (b >> shift)."""
    wide = [lanes[0] + lanes[1] * 65536, lanes[4] + lanes[5] * 65536, bits(lanes[2] + lanes[3] * 65536, lanes[6] + lanes[7] * 65536, 5)]
    return [w % cells + i * cells for i, w in enumerate(wide)]


def sketch(hashed: DataFrame, cells: int = FIRST_CELLS, sign: int = 1) -> DataFrame:
    """The sketch of a frame with row hashes: ``stratum`` (-1: the main table), ``cell`` and the sums, one row per used cell.

    One partial aggregate over the rows; a map task sends at most 3 x ``cells`` and the strata's cells.
    """
    low = F.col(H[1]).bitwiseAND((1 << LAST_STRATUM) - 1).bitwiseOR(1 << LAST_STRATUM)  # a bit that ends the search
    zeros = F.bit_count(low.bitwiseXOR(low - 1)).cast("int") - 1
    lanes = [F.col(x) for x in LANES]
    xor = lambda a, b, k: a.bitwiseXOR(F.shiftrightunsigned(b, k))
    main, small = _places(lanes, cells, xor), _places(lanes, STRATUM_CELLS, xor)
    at = lambda stratum, places: F.array(*[F.struct(stratum.alias("stratum"), p.cast("int").alias("cell")) for p in places])
    spots = F.when(F.col("zeros") >= FIRST_STRATUM, F.concat(at(F.lit(-1), main), at(F.col("zeros"), small))).otherwise(at(F.lit(-1), main))
    rows = (hashed.select(*[x.alias(name) for x, name in zip(_lanes(), LANES)], zeros.alias("zeros"))
            .select(*LANES, F.explode(spots).alias("at")))
    checks = [(F.col("l0") * F.col("l5") + F.col("l2")) % PRIME, (F.col("l3") * F.col("l6") + F.col("l1")) % PRIME]
    parts = [F.lit(1).cast("long"), *lanes, *checks]
    return rows.groupBy("at.stratum", "at.cell").agg(*[(F.sum(p) * sign).alias(name) for p, name in zip(parts, SUMS)])


def merged(*sketches: DataFrame) -> DataFrame:
    """The sum of sketches; cells in which nothing is left are gone."""
    every = sketches[0]
    for s in sketches[1:]:
        every = every.unionByName(s)
    total = every.groupBy("stratum", "cell").agg(*[F.sum(c).alias(c) for c in SUMS])
    return total.where(" OR ".join(f"{c} <> 0" for c in SUMS))


def _decode(cell: np.ndarray, sums: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """(lanes, row differences, complete) of a sketch's cells. Peels all cells that hold one hash, again and again."""
    table = np.zeros((3 * cells, len(SUMS)), np.int64)
    table[cell] = sums
    found: dict[tuple, int] = {}
    xor = lambda a, b, k: a ^ (b >> k)
    active = np.arange(3 * cells)
    while len(active):
        n = table[active, 0]
        once = active[(n != 0) & (table[active, 1:9] % np.where(n == 0, 1, n)[:, None] == 0).all(1)]
        n = table[once, 0]
        lanes = table[once, 1:9] // n[:, None]
        checks = np.stack([(lanes[:, 0] * lanes[:, 5] + lanes[:, 2]) % PRIME, (lanes[:, 3] * lanes[:, 6] + lanes[:, 1]) % PRIME], 1)
        places = np.stack(_places(list(lanes.T), cells, xor), 1) if len(once) else np.empty((0, 3), np.int64)
        pure = ((lanes >= 0) & (lanes < 65536)).all(1) & (table[once, 9:] == checks * n[:, None]).all(1) & (places == once[:, None]).any(1)
        if not pure.any():
            break
        # a hash that stands alone in two cells is taken out once
        lanes, at = np.unique(lanes[pure], axis=0, return_index=True)
        n, places, checks = n[pure][at], places[pure][at], checks[pure][at]
        out = np.concatenate([np.ones((len(n), 1), np.int64), lanes, checks], 1) * n[:, None]
        for third in places.T:
            np.subtract.at(table, third, out)
        for key, d in zip(map(tuple, lanes.tolist()), n.tolist()):
            found[key] = found.get(key, 0) + d
            if not found[key]:
                del found[key]
        active = np.unique(places)
    lanes = np.array(list(found), np.int64).reshape(-1, 8)
    return lanes, np.array(list(found.values()), np.int64), not table.any()


def estimate(stratum: np.ndarray, cell: np.ndarray, sums: np.ndarray) -> int:
    """How many hashes differ, from the strata that decode, the rarest first."""
    total = 0
    for k in range(LAST_STRATUM, FIRST_STRATUM - 1, -1):
        own = stratum == k
        lanes, _, complete = _decode(cell[own], sums[own], STRATUM_CELLS)
        if not complete:
            return max(total, STRATUM_CELLS) << (k + 1)
        total += len(lanes)
    return total << FIRST_STRATUM


def _hashes(lanes: np.ndarray) -> list[tuple[int, int]]:
    words = np.stack([sum(lanes[:, 4 * h + i].astype(np.uint64) << np.uint64(16 * i) for i in range(4)) for h in (0, 1)], 1) if len(lanes) else lanes[:, :2]
    return list(map(tuple, words.astype(np.uint64).view(np.int64).tolist()))


def differing_hashes(source: DataFrame, target: DataFrame, cells: int = FIRST_CELLS, most_cells: int = MOST_CELLS) -> list[tuple[int, int]] | None:
    """Row hashes whose multiplicity differs between two frames with row hashes; None if even ``most_cells`` cannot hold them.

    What comes to the driver is bounded by 3 x ``most_cells`` cells.
    """
    while True:
        left = merged(sketch(source, cells), sketch(target, cells, -1)).toArrow()
        column = {c: left[c].to_numpy() for c in left.column_names}
        main = column["stratum"] == -1
        sums = np.stack([column[c] for c in SUMS], 1).astype(np.int64) if left.num_rows else np.empty((0, len(SUMS)), np.int64)
        lanes, _, complete = _decode(column["cell"][main], sums[main], cells)
        if complete:
            return _hashes(lanes)
        differ = estimate(column["stratum"][~main], column["cell"][~main], sums[~main])
        wanted = max(2 * cells, 1 << (max(1, differ * 2 // 3) - 1).bit_length())  # half as many differences as cells
        if wanted > most_cells:
            return None
        cells = wanted


def row_sketch_diff(source: DataFrame, target: DataFrame, columns: Sequence[str] | None = None, cells: int = FIRST_CELLS,
                    most_cells: int = MOST_CELLS) -> DataFrame:
    """The result of ``row_multiset_diff``, by sketches where the differences are few: rows whose multiplicity differs.

    Rows of the decoded hashes are found by a second scan of each side, with the hashes broadcast (at most as many as a
    sketch holds), and counted; only those rows are shuffled. Columns and errors are as there.
    """
    s, t, shown = comparable(source, target, columns)
    found = differing_hashes(s, t, cells, most_cells)
    if found is None:
        return row_multiset_diff(source, target, columns)
    wanted = F.broadcast(source.sparkSession.createDataFrame(found, "_h1 long, _h2 long"))

    def counted(df: DataFrame, side: int) -> DataFrame:
        values = [F.col(c).cast(kind).alias(c) for c, kind in shown.items()]
        return df.join(wanted, H, "left_semi").select(*H, F.struct(*values).alias("row"), F.lit(side).alias("side"))

    rows = counted(s, 0).unionByName(counted(t, 1)).groupBy(*H).agg(
        F.min_by("row", "side").alias("row"), *[F.sum((F.col("side") == k).cast("long")).alias(f"{name}_count") for k, name in enumerate(("source", "target"))])
    return rows.where("source_count <> target_count").select(*[F.col("row")[c].alias(c) for c in shown], "source_count", "target_count")
