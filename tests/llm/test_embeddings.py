import math

import numpy as np
import pytest

from ledgerloom.llm import embeddings as E

SCHEMA = "vec_id long, embedding array<float>, label int, row string, x int"


def brute(rows):
    """vec_id -> (links, smallest id reachable), from all pairs."""
    n = len(rows)
    unit = []
    for _, v, label in rows:
        ok = label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)
        x = np.array(v, np.float32).astype(np.float64) if ok else None
        unit.append(x / np.linalg.norm(x) if ok else None)
    link = [[j for j in range(n) if j != i and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(link[i]), min(ids) if ids else None))
    return out


def near(rng, x, cosine):
    noise = rng.standard_normal(len(x))
    noise -= (noise @ x) / (x @ x) * x
    return cosine * x / np.linalg.norm(x) + math.sqrt(1 - cosine * cosine) * noise / np.linalg.norm(noise)


def run(spark, rows):
    return E.near_duplicates(spark.createDataFrame([(*r, "r", 1) for r in rows], SCHEMA)).collect()


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_against_all_pairs_with_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(E, "TILE_ROWS", 8)
    rng = np.random.default_rng(4)
    rows, nan, inf = [], float("nan"), float("inf")
    for i in range(60):
        x = rng.standard_normal(64)
        rows.append((i * 5, x.tolist(), i % 3))
        rows += [(i * 5 + k, (near(rng, x, 0.97) * 3).tolist(), (i + (k == 3)) % 3) for k in (1, 2, 3)]
    hub = rng.standard_normal(64)
    rows += [(1000 + i, near(rng, hub, 0.985).tolist(), 1) for i in range(50)] + [(2000 + i, hub.tolist(), 1) for i in range(30)]
    rows += [(3000, None, 1), (3001, [], 1), (3002, [0.0] * 64, 1), (3003, [None] + [1.0] * 63, 1), (3004, [nan] + [1.0] * 63, 1), (3005, [inf] + [1.0] * 63, 1), (3006, hub.tolist(), None)]
    rows += [(3007, [1.0, 2.0], 1), (3008, [1.0, 2.01], 1), (3009, [1.0], 1), (None, hub.tolist(), 1), (None, [9.0, -1.0], 1), (3007, [1.0, 2.0], 1)]
    got = run(spark, rows)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == sorted(brute(rows), key=key)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("filters", [1024, 16384])
def test_recall_at_the_threshold(filters):
    rng = np.random.default_rng(filters)
    words = max(512, 4 * int(filters**0.5))
    codes = [E.ProductCode(k, 64, words, words * words // filters, E.cap(filters)) for k in range(E.CODES)]
    pairs = []
    for _ in range(600):
        x = rng.standard_normal(64)
        pairs.append((x / np.linalg.norm(x), near(rng, x, 0.9301)))
    a, b = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
    met = np.zeros(len(pairs), bool)
    for code in codes:
        met |= [len(np.intersect1d(p, q)) > 0 for p, q in zip(code.decode(a), code.decode(b))]
    assert met.mean() >= 0.97


@pytest.mark.parametrize("filters, pairs", [(65_536, 1500), (1_048_576, 500)])
def test_few_pairs_are_missed_with_many_filters(filters, pairs):
    rng = np.random.default_rng(filters + 1)
    words, every = 4 * int(filters**0.5), 16
    a = rng.standard_normal((pairs, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = np.array([near(rng, x, 0.9301) for x in a])
    shared = np.zeros((E.CODES, pairs), int)
    for number in range(E.CODES):
        code = E.ProductCode(number, 64, words, every, E.cap(filters))
        shared[number] = [len(np.intersect1d(p, q)) for p, q in zip(code.decode(a), code.decode(b))]
    print(filters, (shared.sum(axis=0) == 0).mean(), shared.mean())
    assert (shared.sum(axis=0) == 0).mean() <= 0.005
    assert shared.mean() >= 0.9 * E.SHARED


def test_rotation_keeps_lengths():
    code = E.ProductCode(0, 50, 512, 16, 2.0)
    x = np.random.default_rng(0).standard_normal((5, 50))
    assert np.allclose(np.linalg.norm(code.rotate(x), axis=1), np.linalg.norm(x, axis=1))


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("size", ["sf0.001"])
def test_whole_table(spark, size):
    path = f"/root/testdata/{size}"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in E.op4_embeddings(spark, path).collect()) == sorted(brute(rows))
