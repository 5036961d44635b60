import numpy as np
import pytest
from helpers import Groups

from tapelake.llm import pivot_index
from tapelake.llm.pivot_index import near_duplicates


def brute(rows):
    valid = {}
    for at, (vec, v) in enumerate(rows):
        if vec is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            valid[at] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    groups, links = Groups(), dict.fromkeys(range(len(rows)), 0)
    for a in valid:
        for b in valid:
            if a != b and len(valid[a]) == len(valid[b]) and valid[a] @ valid[b] >= 0.95:
                links[a] += 1
                groups.join(rows[a][0], rows[b][0])
    return sorted((rows[at][0], links[at], groups.find(rows[at][0]) if rows[at][0] is not None else None) for at in range(len(rows)))


def clusters(seed, size, dims=64):
    draw = np.random.default_rng(seed)
    out = []
    while len(out) < size:
        centre = draw.normal(size=dims)
        for _ in range(int(draw.choice([1, 1, 2, 5]))):
            out.append((centre + draw.normal(size=dims) * draw.choice([0.0, 0.02, 0.1])) * draw.uniform(0.1, 9))
    hot = draw.normal(size=dims)
    return out + [hot + draw.normal(size=dims) * 0.02 for _ in range(size // 3)]


@pytest.mark.parametrize("split", [4096, 16])
def test_against_all_pairs(spark, split):
    vectors = [np.float32(v).tolist() for v in clusters(split, 400)]
    rows = list(enumerate(vectors)) + [(900 + k, vectors[3]) for k in range(4)] + [(950, None), (951, [0.0] * 64), (952, [1.0, None]), (953, [float("nan")] * 64), (954, [float("inf")] * 64)]
    rows += [(955, [1.0, 2.0]), (956, [2.0, 4.0]), (957, []), (958, [-0.0, 1.0]), (959, [0.0, 1.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, node int")
    got = near_duplicates(table, split=split).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_at_the_threshold(spark):
    """Pairs of a cosine just above the threshold, the hardest ones."""
    draw = np.random.default_rng(7)
    rows = []
    for k in range(1500):
        x = draw.normal(size=64)
        x /= np.linalg.norm(x)
        other = draw.normal(size=64)
        other -= (other @ x) * x
        other /= np.linalg.norm(other)
        rows += [(2 * k, x.tolist()), (2 * k + 1, (0.951 * x + np.sqrt(1 - 0.951**2) * other).tolist())]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    found = sum(r.n_links for r in got) / 3000
    assert found >= 0.97


def test_repeated_ids_and_nulls(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (0, [1.0, 0.01])]
    got = sorted((tuple(r) for r in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()), key=str)
    assert got == sorted([(1, 2, 0, False), (1, 2, 0, False), (1, 0, 1, True), (None, 0, None, False), (0, 2, 0, True)], key=str)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_extreme_lengths():
    rows = pivot_index.unit(np.array([[1e200, 1e200], [1e-200, 0.0], [5e-324, 0.0]]))
    assert np.allclose(rows, [[0.5**0.5, 0.5**0.5], [1, 0], [1, 0]])
