import numpy as np
import pytest
from llm_docs import SF_SMALL

from tallyhouse.llm import covertree as C
from tallyhouse.llm.common import read_table


def brute(rows, threshold=0.9):
    """rows: (vec_id, vector). n_links, component_id, kept of each."""
    n = len(rows)
    near = np.zeros((n, n), dtype=bool)
    usable = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)
              for _, v in rows]
    for size in {len(v) for (_, v), u in zip(rows, usable) if u}:
        at = [k for k in range(n) if usable[k] and len(rows[k][1]) == size]
        x = np.array([rows[k][1] for k in at], dtype=np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near[np.ix_(at, at)] = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    label = np.arange(n)
    both = near | np.eye(n, dtype=bool)
    while True:
        low = np.where(both, label[None, :], n).min(axis=1)
        if (low == label).all():
            break
        label = low
    out = []
    for k in range(n):
        ids = [rows[j][0] for j in range(n) if label[j] == label[k] and rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((rows[k][0], int(near[k].sum()), c, rows[k][0] == c))
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, 3, "x") for i, v in rows],
                                 "vec_id bigint, embedding array<double>, label int, cosine double, n bigint, class string")


def clusters(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(2, n // 25), dim))
    x = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dim)) * spread
    return [(k, [float(f) for f in v]) for k, v in enumerate(x)]


@pytest.mark.parametrize("dim, spread, block, cells", [(8, 0.25, 4096, 256), (8, 0.4, 40, 4), (3, 0.3, 30, 16), (32, 0.3, 64, 8)])
def test_brute_force(spark, dim, spread, block, cells):
    rows = clusters(dim, 400, dim, spread)
    got = C.near_duplicates(frame(spark, rows), 0.9, block, cells, sample=100).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_edges(spark):
    v = [0.6, 0.8, 0.0]
    rows = [(5, v), (3, v), (4, [1.2, 1.6, 0.0]), (None, v), (6, None), (7, []), (8, [0.0, 0.0, 0.0]), (9, [1.0, None, 0.0]),
            (10, [1.0, float("nan"), 0.0]), (11, [1.0, float("inf"), 0.0]), (12, [0.6, 0.8]), (13, [0.6, 0.81]), (14, [-0.6, -0.8, 0.0]),
            (14, [0.0, 0.0, 1.0]), (15, [1e300, 1e300, 0.0]), (None, [0.0, -5.0, 0.0]), (None, None), (3, v)]
    got = C.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)
    assert C.near_duplicates(frame(spark, rows).limit(0)).collect() == []


def test_vectors_that_differ_by_a_factor(spark):
    """One direction, many classes: distances are rounding noise."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(5, 16))
    rows = [(k, [float(x) for x in base[k % 5] * rng.uniform(0.1, 9)]) for k in range(200)]
    got = C.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_table_and_pairs(spark):
    df = read_table(spark, SF_SMALL, "embeddings")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    assert sorted(map(tuple, C.near_duplicates(df).collect()), key=key) == sorted(brute(rows), key=key)
    member, pairs = C.pairs(df, 0.9, block=100, cells=4)
    ids = {r["class"]: r.vec_id for r in member.collect()}
    got = {tuple(sorted((ids[r.a], ids[r.b]))) for r in pairs.collect()}
    assert len(got) == pairs.count() == sum(n for _, n, _, _ in brute(rows)) // 2


def test_tree_bounds():
    rng = np.random.default_rng(4)
    x = C.unit(rng.normal(size=(300, 3)))
    path = C.nest(x)
    tree = C.Tree(x, path)
    for level, radius in enumerate(C.RADII):
        far = C.distance(np.einsum("ij,ij->i", x, x[path[:, level]]))
        assert (far <= radius + 1e-7).all()
        centres = np.unique(path[:, level])
        assert (path[centres, level] == centres).all()            # a centre is its own
        if level:
            assert set(np.unique(path[:, level - 1])) <= set(centres)   # and stays one below
            assert all(len(set(path[path[:, level] == c, level - 1])) == 1 for c in centres)
