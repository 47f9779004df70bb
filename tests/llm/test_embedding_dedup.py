import numpy as np
import pytest

from concord.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<double>, label int, cell string, key string, id string"


def brute(data, threshold=0.95):
    """Links and components of (id, vector) rows by comparing all of them."""
    ok = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    n, links, parent = len(data), [0] * len(data), list(range(len(data)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = data[i][1], data[j][1]
            if None in (data[i][0], data[j][0]) or not (ok(a) and ok(b)) or len(a) != len(b):
                continue
            a, b = np.array(a), np.array(b)
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i in range(n):
        if data[i][0] is not None:
            least[find(i)] = min(least.get(find(i), data[i][0]), data[i][0])
    return sorted(((data[i][0], links[i], least.get(find(i))) for i in range(n)), key=str)


def frame(spark, data):
    return spark.createDataFrame([(i, v, 1, "c", "k", "x") for i, v in data], SCHEMA)


def result(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in rows)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in rows), key=str)


def groups(seed, n=120, dim=8):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, dim))
    data = [(i, (centre[i % 6] + rng.normal(size=dim) * 0.25).tolist()) for i in range(n)]
    return data + [(n + i, data[i][1]) for i in range(30)]  # exact copies


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(ed, "LEAST_CELL", 1)
    monkeypatch.setattr(ed, "BLOCK_NUMBERS", 7 * 8)  # cells are compared block by block
    data = groups(seed)
    assert result(ed.near_duplicates(frame(spark, data), spread_sigmas=None, cell_rows=20)) == brute(data)


def test_awkward_vectors(spark):
    data = [(0, None), (1, []), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
            (6, [1.0, 0.0]), (7, [2.0, 0.0]), (8, [1.0, 0.0]), (9, [1.0, -0.0]), (10, [1.0, 0.0, 0.0]), (8, [1.0, 0.0]),
            (None, [1.0, 0.0]), (11, [-1.0, 0.0])]
    assert result(ed.near_duplicates(frame(spark, data))) == brute(data)
    assert ed.near_duplicates(frame(spark, [])).count() == 0


def test_every_pair_at_the_threshold_meets():
    """Pairs exactly at the threshold, the hardest: with the default margin, the second vector is always held by the first one's cell."""
    rng = np.random.default_rng(0)
    for dim, n in ((64, 4000), (8, 4000), (128, 2000)):
        x = rng.normal(size=(n, dim))
        x /= np.linalg.norm(x, axis=1)[:, None]
        w = rng.normal(size=(n, dim))
        w -= (w * x).sum(1)[:, None] * x
        w /= np.linalg.norm(w, axis=1)[:, None]
        step = np.sqrt(1 - 0.95**2)
        y = 0.95 * x + step * w
        centre = ed.centroids(x, 12)
        row, cell, _ = ed.cells_of(x, centre, ed.gaps(centre), step + 1e-7)
        held = set(zip(row.tolist(), cell.tolist()))
        assert all((i, c) in held for i, c in enumerate((y @ centre.T).argmax(1).tolist()))


def test_one_id_with_unlike_vectors(spark):
    """Classes are not named by ids: rows that share one stay apart."""
    data = [(8, [1.0, 0.0]), (3, [0.999, 0.001]), (8, [0.0, 1.0]), (5, [0.0, 2.0]), (8, [-1.0, 0.0])]
    assert result(ed.near_duplicates(frame(spark, data))) == brute(data)


def test_huge_and_tiny_components(spark):
    data = [(1, [1e300, 1e300]), (2, [1.0, 1.0]), (3, [1e-300, 1.1e-300]), (4, [1e-320, 0.0]), (5, [1e308, -1e308])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in ed.near_duplicates(frame(spark, data)).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (0, 5)}


def test_distances_of_centres():
    centre = np.random.default_rng(1).normal(size=(20, 7))
    assert np.allclose(ed.gaps(centre), np.linalg.norm(centre[:, None] - centre[None], axis=2), atol=1e-6)


@pytest.mark.parametrize("dim, rank", [(96, 6), (48, 48)])
def test_default_margin_on_low_rank_vectors(spark, dim, rank, monkeypatch):
    """Pairs exactly at the threshold whose differences lie in few dimensions, in several cells, with the defaults."""
    monkeypatch.setattr(ed, "LEAST_CELL", 1)
    rng = np.random.default_rng(3)
    x, w = rng.normal(size=(2, 120, rank))
    x /= np.linalg.norm(x, axis=1)[:, None]
    w -= (w * x).sum(1)[:, None] * x
    w /= np.linalg.norm(w, axis=1)[:, None]
    cos = 0.95 + 1e-9
    turn = np.linalg.qr(rng.normal(size=(dim, rank)))[0].T
    data = list(enumerate((np.concatenate([x, cos * x + np.sqrt(1 - cos**2) * w]) @ turn).tolist()))
    assert result(ed.near_duplicates(frame(spark, data), cell_rows=16)) == brute(data)


def test_vectors_are_stored_once_however_many_blocks_they_meet(spark, monkeypatch):
    """Scattered vectors lie near all boundaries: each block meets all others, yet no table or exchange holds copies of them."""
    monkeypatch.setattr(ed, "LEAST_CELL", 1)
    monkeypatch.setattr(ed, "BLOCK_NUMBERS", 20 * 16)
    rng = np.random.default_rng(5)
    data = [(i, v) for i, v in enumerate(rng.normal(size=(300, 16)).tolist())]
    data += [(300 + i, (np.array(v) * 1.01 + rng.normal(size=16) * 0.02).tolist()) for i, v in data[:60]]
    held = {}

    def written(df, label, *rest, write=ed.written):
        out = write(df, label, *rest)
        held[label] = out
        return out

    monkeypatch.setattr(ed, "written", written)
    assert result(ed.near_duplicates(frame(spark, data), cell_rows=40)) == brute(data)
    assert held["blocks"].count() > 15
    assert sum(len(r["vectors"]) for r in held["blocks"].collect()) == len(data) * 16 * 8  # each vector once
    assert "Exchange" not in ed.near_blocks(held["blocks"])._jdf.queryExecution().executedPlan().toString()
