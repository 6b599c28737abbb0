"""Embedding near-dedup against all pairs."""

import numpy as np
import pytest

from snapdiff.llm import QUERIES, vector_dedup
from snapdiff.llm.vector_dedup import dedup_vectors, spherical_kmeans, visited


def plain(rows, similarity=0.9):
    """`vec_id, n_links, component_id, kept` by comparing every pair of rows."""
    def usable(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [i for i, (_, v) in enumerate(rows) if usable(v)]
    vec = {i: np.ldexp(v := np.array(rows[i][1], float), -np.frexp(np.abs(v).max())[1]) for i in good}
    linked = {i: set() for i in range(len(rows))}
    for a, i in enumerate(good):
        for j in good[a + 1:]:
            x, y = vec[i], vec[j]
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= similarity:
                linked[i].add(j)
                linked[j].add(i)
    out, seen = {}, set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, queue = {i}, [i]
        while queue:
            queue.extend(new := linked[queue.pop()] - group)
            group |= new
        seen |= group
        least = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        out.update({j: (rows[j][0], len(linked[j]), least, rows[j][0] == least) for j in group})
    return sorted(map(repr, out.values()))


def got(frame, **sizes):
    return sorted(map(repr, map(tuple, dedup_vectors(frame, **sizes).select("vec_id", "n_links", "component_id", "kept").collect())))


def test_a_table(spark, sf_small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    frame = QUERIES["op11_vector_dedup"][0](spark, sf_small)
    assert sorted(map(repr, map(tuple, frame.collect()))) == plain(rows)


def copies(seed, groups, each, spread, dim=8):
    """Groups of directions that lie `spread` apart and so link in chains, shuffled."""
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((groups, dim))
    vectors = np.concatenate([c + spread * np.linalg.norm(c) * rng.standard_normal((each, dim)) for c in centers])
    return [(int(i), v.tolist()) for i, v in enumerate(vectors[rng.permutation(len(vectors))])]


@pytest.mark.parametrize("cell, block", [(4096, 4096), (20, 16), (64, 7)])
@pytest.mark.parametrize("spread", [0.05, 0.15])
def test_no_link_is_lost_between_cells_and_blocks(spark, cell, block, spread):
    rows = copies(cell, 20, 30, spread)
    assert got(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5), cell=cell, block=block) == plain(rows)


def test_a_group_of_copies_in_many_blocks(spark):
    rng = np.random.default_rng(3)
    near = [1.0, 2, 3, 4] + 0.05 * rng.standard_normal((150, 4))
    rows = [(i, v.tolist()) for i, v in enumerate([*near, *rng.standard_normal((60, 4))])] + [(1000 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(100)]
    assert got(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), cell=32, block=16) == plain(
        [(i, np.array(v, np.float32).tolist()) for i, v in rows])


def test_odd_vectors(spark):
    """Null, empty, zero, non-finite, huge and tiny vectors, two lengths, repeated rows and ids, negative zeros, other columns."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, -0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1e300, 1e300]), (8, [1e-300, 1e-300]),
            (9, [1.0, 1.0, 0.0]), (9, [1.0, 1.0, 0.0]), (10, [1.0, 0.0]), (10, [1.0, 0.001]), (None, [1.0, -0.0]), (None, [-1.0, 5.0]), (11, [0.0, -1.0]),
            (12, [-1.0, 0.0]), (None, None)]
    frame = spark.createDataFrame([(i, v, "mine", 5, i) for i, v in rows], "vec_id long, embedding array<double>, key string, n_links int, row long").repartition(4)
    assert got(frame) == plain(rows)
    assert dedup_vectors(frame).columns == ["vec_id", "embedding", "key", "row", "n_links", "component_id", "kept"]
    assert dedup_vectors(frame.limit(0)).count() == 0
    assert {r.key for r in dedup_vectors(frame).collect()} == {"mine"}


def test_a_threshold_that_is_met_exactly(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [6.0, 8.0]), (4, [0.6, 0.8000000001])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(frame, similarity=0.6) == plain(rows, 0.6)


def test_visits_are_enough():
    """Any two directions within the threshold meet in the cell of one of them."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 6))
    x = np.concatenate([x, x + 0.3 * rng.standard_normal(x.shape)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    centroids = spherical_kmeans(x, 24)
    products = x @ centroids.T
    own, cosine = products.argmax(axis=1), products.max(axis=1)
    radius = np.array([np.arccos(cosine[own == c]).max(initial=-10) for c in range(24)])
    visits = set(zip(*map(np.ndarray.tolist, visited(x, own, cosine, centroids, radius, 0.9))))
    near = np.argwhere(np.triu(x @ x.T >= 0.9, 1)).tolist()
    assert len(near) > 100 and len(visits) < 0.7 * len(x) * 24
    for i, j in near:
        assert own[i] == own[j] or (j, own[i]) in visits or (i, own[j]) in visits


def test_the_sample_does_not_decide_the_links(spark, monkeypatch):
    rows = copies(1, 10, 40, 0.1)
    monkeypatch.setattr(vector_dedup, "SAMPLE", 64)
    assert got(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), cell=50, block=30) == plain(rows)
