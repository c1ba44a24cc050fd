from __future__ import annotations

import hashlib

import numpy as np
import pytest
from winnow.llm import heap_clusters, means_tree

SCHEMA = "vec_id long, embedding array<float>, id string, v int, h int, cluster string, score string"


def frame(spark, rows):
    """Vectors with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, x, "i", 0, 1, "c", "s") for i, x in rows], SCHEMA)


def clouds(seed: int, number: int, width: int = 64, groups: int = 12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (groups, width))
    x = centres[rng.integers(0, groups, number)] + rng.normal(0, 0.6, (number, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, [float(c) for c in row]) for i, row in enumerate(x.astype(np.float32))]


AWKWARD = [
    (100_000, None), (100_020, []), (100_040, [0.0] * 64), (100_060, [None] + [1.0] * 63),
    (100_080, [float("nan")] * 64), (100_100, [float("inf")] * 64), (None, [0.5] * 64),
]


def takes_part(x) -> bool:
    return x is not None and all(c is not None and np.isfinite(c) for c in x)


def neighbours(rows, query, top):
    def product(a, b):
        total = 0.0
        for p, q in zip(a, b):
            total += float(np.float32(p)) * float(np.float32(q))
        return total

    own = [x for i, x in rows if i == query][0]
    good = [(i, x) for i, x in rows if i is not None and i != query and takes_part(x) and any(x)]
    return sorted((-product(own, x), i) for i, x in good)[:top]


def found(spark, rows, condition="id % 20 = 0", **options):
    out: dict = {}
    for r in means_tree.search(frame(spark, rows), condition, **options).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(n) for q, n in out.items()}


def test_neighbours_reach_the_calibrated_recall_with_exact_scores(spark):
    rows = clouds(1, 3000) + AWKWARD
    mine = found(spark, rows)
    assert sorted(mine) == list(range(0, 3000, 20))
    hits = wanted = 0
    for query, near in list(mine.items())[::5]:
        truth = neighbours(rows, query, 20)
        assert [r for r, _, _ in near] == list(range(1, 21))
        assert near == sorted(near, key=lambda n: (-n[2], n[1]))
        scores = {i: -s for s, i in truth}
        assert all(s == scores[i] for _, i, s in near if i in scores)
        hits += len(scores.keys() & {i for _, i, _ in near})
        wanted += len(scores)
    assert hits >= 0.93 * wanted


def test_full_recall_is_exact_search_with_copies_and_ties(spark):
    rows = clouds(2, 200) + [(1000 + i, clouds(2, 200)[7][1]) for i in range(90)]
    rows += [(2000, [0.5, 0.25]), (2020, [3.0] + [0.0] * 63)] + AWKWARD
    mine = found(spark, rows, recall=1.0)
    queries = [i for i, x in rows if i is not None and i % 20 == 0 and takes_part(x) and any(x)]
    assert sorted(mine) == sorted(queries)
    for query in queries:
        truth = neighbours(rows, query, 20)
        assert [i for _, i, _ in mine[query]] == [i for _, i in truth]
        assert [s for _, _, s in mine[query]] == pytest.approx([-s for s, _ in truth], rel=1e-15)


def test_neighbours_of_few_vectors(spark):
    assert found(spark, []) == {}
    assert found(spark, AWKWARD[:6]) == {}
    assert found(spark, [(0, [1.0])]) == {}
    assert found(spark, [(0, [1.0]), (0, [2.0]), (1, [3.0])]) == {0: [(1, 1, 3.0), (1, 1, 6.0)]}


def test_tree_visits_best_bins_first_and_leaves_are_dealt_whole():
    x = np.array([row for _, row in clouds(3, 900)])
    tree = means_tree.fit(x)
    leaf = tree.descend(x)
    assert set(leaf.tolist()) == set(range(tree.leaves))
    order = tree.best_bins(tree.centroids @ x[0], tree.leaves)
    assert sorted(order) == list(range(tree.leaves))
    assert tree.best_bins(tree.centroids @ x[0], 3) == order[:3]
    assert means_tree.fit(np.ones((500, 4))).leaves == 1
    bins = means_tree.deal_leaves(np.array([5, 30, 4, 4, 4, 100, 1]), 10)
    assert bins.shards.tolist() == [1, 3, 1, 1, 1, 10, 1]
    used = [set(range(f, f + s)) for f, s in zip(bins.first.tolist(), bins.shards.tolist())]
    assert set().union(*used) == set(range(bins.number))
    assert all(not (used[1] & u) for i, u in enumerate(used) if i != 1)


def lloyd(rows, clusters=16, rounds=3):
    """The contract by plain integers."""
    kept = [
        (i, [int(np.floor(64 * float(np.float32(c)))) for c in x])
        for i, x in rows if takes_part(x) and len(x) == 64
    ]
    order = sorted(
        (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in kept
    )
    centres = [x for _, _, x in order[:clusters]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        of = [nearest(x)[1] for _, x in kept]
        for j in range(len(centres)):
            own = [x for (_, x), c in zip(kept, of) if c == j]
            if own:
                centres[j] = [sum(col) // len(own) for col in zip(*own)]
    last = [nearest(x) for _, x in kept]
    total = sum(d for d, _ in last)
    inertia = {j: sum(d for d, c in last if c == j) for j in range(len(centres))}
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(
        ((i, c, d, inertia[c], total, name[c]) for (i, _), (d, c) in zip(kept, last)), key=str
    )


@pytest.mark.parametrize("rounds", [1, 3, 6])
def test_clusters_agree_with_plain_rounds(spark, rounds):
    rows = clouds(4, 260) + clouds(5, 40)[:20] + AWKWARD + [(7, [1.0] * 63), (8, [1.0] * 65)]
    rows += [(3000 + i, clouds(4, 260)[3][1]) for i in range(40)] + [(5000, [1000.0] * 64)]
    mine = heap_clusters.cluster(frame(spark, rows), rounds=rounds).collect()
    assert sorted(map(tuple, mine), key=str) == lloyd(rows, rounds=rounds)


def test_clusters_of_few_equal_and_huge_vectors(spark):
    assert heap_clusters.cluster(frame(spark, [])).collect() == []
    assert heap_clusters.cluster(frame(spark, AWKWARD[:2])).collect() == []
    rows = [(i, [0.5] * 64) for i in range(20)]
    assert sorted(map(tuple, heap_clusters.cluster(frame(spark, rows)).collect()), key=str) == lloyd(rows)
    rows = clouds(6, 5) + [(None, [0.25] * 64)]
    assert sorted(map(tuple, heap_clusters.cluster(frame(spark, rows)).collect()), key=str) == lloyd(rows)
    huge = [(i, [3e38 if i % 2 else -3e38] * 64) for i in range(30)]
    far = heap_clusters.cluster(frame(spark, huge)).collect()
    assert len(far) == 30 and {r.distance for r in far} == {0}


def test_only_expired_vectors_are_compared_again(monkeypatch):
    rng = np.random.default_rng(8)
    centres = np.array([[0] * 8, [1000] * 8])
    x = np.r_[rng.integers(-20, 20, (200, 8)), rng.integers(980, 1020, (200, 8)), np.full((5, 8), 499)]
    cluster, expires = heap_clusters.scan(x, centres, np.zeros(2))
    heaps = heap_clusters.ClusterHeaps(cluster, expires, 2)
    assert not len(heaps.expired(np.zeros(2)))
    rows = heaps.expired(np.array([20.0, 20.0]))
    assert sorted(rows.tolist()) == list(range(400, 405))
    moved = np.array([[-10] * 8, [990] * 8])
    heaps.push(rows, *heap_clusters.scan(x[rows], moved, np.array([20.0, 20.0])))
    assert (heaps.state(len(x))[0] == heap_clusters.distances(x, moved).argmin(1)).all()
