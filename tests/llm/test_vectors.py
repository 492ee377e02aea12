import numpy as np
import pytest

from llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, other string"


def brute(rows, threshold=vectors.THRESHOLD):
    """Components and links of all pairs, by cosine in double precision."""
    valid = {}
    for i, v, label, _ in rows:
        if i is None or v is None or label is None or not v or any(x is None for x in v):
            continue
        x = np.array(v, dtype=np.float32).astype(np.float64)
        if np.isfinite(x).all() and x.any():
            valid.setdefault(i, []).append((label, x / np.linalg.norm(x)))
    links = set()
    items = [(i, label, x) for i, xs in valid.items() for label, x in xs]
    for n, (i, li, xi) in enumerate(items):
        for j, lj, xj in items[n + 1 :]:
            if i != j and li == lj and len(xi) == len(xj) and float(xi @ xj) >= threshold:
                links.add((min(i, j), max(i, j)))
    parent = {i: i for i, *_ in rows if i is not None}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in sorted(links):
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return links, {i: find(i) for i in parent}


def clustered(seed=7, clusters=40, size=12, dim=16, noise=0.02):
    rng = np.random.default_rng(seed)
    rows, vid = [], 0
    for c in range(clusters):
        centre = rng.standard_normal(dim)
        for _ in range(rng.integers(1, size)):
            rows.append((vid, (centre + noise * rng.standard_normal(dim)).astype(np.float32).tolist(), int(c % 3), "x"))
            vid += 1
    return rows


def test_components_equal_brute_force_and_no_false_link(spark):
    rows = clustered()
    frame = spark.createDataFrame(rows, SCHEMA)
    links = {(r.a, r.b) for r in vectors.vector_links(frame).collect()}
    truth, roots = brute(rows)
    assert links <= truth
    assert len(links) >= 0.5 * len(truth)
    got = {r.vec_id: (r.component_id, r.kept, r.n_links) for r in vectors.near_duplicate_vectors(frame).collect()}
    assert {i: g[0] for i, g in got.items()} == roots
    assert all(kept == (i == c) for i, (c, kept, _) in got.items())
    degree = {}
    for a, b in links:
        degree[a] = degree.get(a, 0) + 1
        degree[b] = degree.get(b, 0) + 1
    assert {i: g[2] for i, g in got.items()} == {i: degree.get(i, 0) for i in got}


def test_defined_edge_cases(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 0, "a"), (2, v, 0, "b"), (3, v, None, "c"), (4, None, 0, "d"), (5, [0.0, 0.0, 0.0], 0, "e"),
        (6, [1.0, None, 3.0], 0, "f"), (7, [float("nan"), 2.0, 3.0], 0, "g"), (8, [float("inf"), 2.0, 3.0], 0, "h"),
        (9, [1.0, 2.0], 0, "i"), (10, [2.0, 4.0, 6.0], 0, "j"), (11, [-1.0, -2.0, -3.0], 0, "k"), (None, v, 0, "l"),
        (12, v, 1, "m"), (12, v, 1, "n"), (13, [], 0, "o"), (14, [3.0, 2.0, 1.0], 0, "p"),
    ]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[10] == (2, 1, False)
    for lone in (3, 4, 5, 6, 7, 8, 9, 11, 13, 14):
        assert got[lone] == (0, lone, True)
    assert got[12] == (0, 12, True)
    assert got[None] == (0, None, True)


def test_empty_and_one_hot_group(spark):
    assert vectors.near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(i, [1.0, 0.5, 0.25], 4, "x") for i in range(300)] + [(1000 + i, [0.0, 1.0, float(i)], 4, "y") for i in range(30)]
    got = {r.vec_id: r.component_id for r in vectors.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == 0 for i in range(300))
    _, roots = brute(rows)
    assert got == roots


@pytest.mark.parametrize("window", [1, 3])
def test_small_window_finds_no_false_links(spark, window):
    rows = clustered(seed=3, clusters=10)
    links = {(r.a, r.b) for r in vectors.vector_links(spark.createDataFrame(rows, SCHEMA), passes=2, window=window).collect()}
    truth, _ = brute(rows)
    assert links <= truth
