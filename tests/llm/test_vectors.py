import numpy as np
from quadrille.llm import subspace_join as sj
from quadrille.llm.subspace_join import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, n long, id string"


def brute(rows):
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def ok(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    for i, (v, a) in enumerate(rows):
        for j, (w, b) in enumerate(rows[:i]):
            if a is None or a != b or not ok(v) or not ok(w) or len(v) != len(w):
                continue
            x, y = (np.array(z, np.float32).astype(float) for z in (v, w))
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                n[i] += 1
                n[j] += 1
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: (n[i], find(i), find(i) == i) for i in range(len(rows))}


def clouds(r, dims, groups, size, noise):
    out = []
    for g in range(groups):
        c = r.normal(size=dims)
        out += [((c + noise * r.normal(size=dims)).tolist(), g % 3) for _ in range(size)]
    return out


def check(spark, rows):
    frame = spark.createDataFrame([(i, v, a, 1, "x") for i, (v, a) in enumerate(rows)], SCHEMA).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in near_vectors(frame).collect()}
    assert got == brute(rows)


def test_clouds_around_the_limit(spark):
    r = np.random.default_rng(3)
    rows = clouds(r, 64, 4, 60, 0.1) + clouds(r, 64, 3, 30, 0.15) + clouds(r, 20, 3, 20, 0.1) + clouds(r, 2, 3, 20, 0.3)
    check(spark, rows)


def test_copies_and_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(v, 1)] * 300 + [([2.0, 4.0, 6.0], 1), (v, 2), (v, None), (None, 1), ([], 1), ([0.0] * 3, 1), ([1.0, None, 2.0], 1)]
    rows += [([float("nan"), 1.0, 1.0], 1), ([float("inf"), 1.0, 1.0], 1), ([1e30, 2e30, 3e30], 1), ([1e-30, 2e-30, 3e-30], 1)]
    check(spark, rows)
    check(spark, [])


def test_few_pairs_become_candidates_and_none_is_missed():
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 64))
    x[1500:1600] = x[:100] + r.normal(scale=0.01, size=(100, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turned, budget = x @ sj.rotation(64), sj._budget(64, 0.98)
    all_pairs, seen = len(x) * (len(x) - 1) // 2, set()
    for a, b in sj._bounds(64):
        own = turned[:, a:b]
        exact = np.triu(((own[:, None, :4] - own[None, :, :4]) ** 2).sum(2) <= budget, 1)
        exact &= ((own[:, None, 4:] - own[None, :, 4:]) ** 2).sum(2) + ((own[:, None, :4] - own[None, :, :4]) ** 2).sum(2) <= budget
        got = [(min(i, j), max(i, j)) for p, q in sj._close(own, own, budget, True) for i, j in zip(p.tolist(), q.tolist(), strict=True)]
        assert len(got) == len(set(got)) and set(got) == set(map(tuple, np.argwhere(exact).tolist()))
        half = [(i, j + 1500) for p, q in sj._close(own[:1500], own[1500:], budget, False) for i, j in zip(p.tolist(), q.tolist(), strict=True)]
        assert set(half) == {(i, j) for i, j in got if i < 1500 <= j}
        seen |= set(got)
    assert {(i, i + 1500) for i in range(100)} <= seen
    assert len(seen) < 0.05 * all_pairs
