import numpy as np
import pytest

from dumpmill.llm import vectors as V
from tests.llm.helpers import Groups


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, uid long, code int")


def cluster(rng, n, dim=24):
    base = rng.standard_normal((max(1, n // 6), dim))
    own = base[rng.integers(0, len(base), n)] + rng.standard_normal((n, dim)) * rng.choice([0.02, 0.1, 0.15, 0.3], (n, 1))
    return [[float(np.float32(x)) for x in v] for v in own]


def brute(rows, least=0.98):
    g, links = Groups(len(rows)), [0] * len(rows)
    x = [None if r[1] is None or r[2] is None or any(v is None or not np.isfinite(v) for v in r[1]) or not np.linalg.norm(r[1]) else np.array(r[1]) / np.linalg.norm(r[1]) for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and x[i] @ x[j] >= least:
                links[i] += 1
                links[j] += 1
                g.join(i, j)
    return [(r[0], links[i], rows[g.top(i)][0], g.top(i) == i) for i, r in enumerate(rows)]


@pytest.mark.parametrize("cell", [2048, 40, 15])
def test_recall_and_precision(spark, cell):
    rng = np.random.default_rng(3)
    rows = [(i, v, int(rng.integers(0, 3)) if i % 3 else 0, 1, 2) for i, v in enumerate(cluster(rng, 300))]
    rows += [(300 + i, rows[0][1], 0, 1, 2) for i in range(20)]
    want = brute(rows)
    got = sorted(map(tuple, V.vector_groups(table(spark, rows), cell=cell).collect()))
    links, found = sum(w[1] for w in want), sum(g[1] for g in got)
    assert links > 400 and 0.99 * links <= found <= links
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g == w for g, w in zip(got, want, strict=True)) >= 0.97 * len(want)


def test_splits_keep_recall_and_few_copies(spark):
    """64 dimensions, six splits of the one large label, none of the small one."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal((3000, 64))
    own = np.concatenate([base, base[:600] + rng.standard_normal((600, 64)) * rng.choice([0.05, 0.15, 0.19], (600, 1))])
    rows = [(i, [float(np.float32(x)) for x in v], 0 if i % 40 else 1, 1, 2) for i, v in enumerate(own)]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    want = near.sum(axis=1) - 1
    df = table(spark, rows)
    got = {r.vec_id: r.n_links for r in V.vector_groups(df, cell=60).collect()}
    found = np.array([got[i] for i in range(len(rows))])
    assert want.sum() > 600 and (found <= want).all() and found.sum() >= 0.99 * want.sum()
    distinct = df.selectExpr("vec_id as uid", "label", "embedding", "cast(1 as long) as copies")
    points = {r.label: r.medians for r in V.split_points(distinct, 60).collect()}
    assert {k: len(m) for k, m in points.items()} == {0: 6, 1: 1}
    cells = V.cell_rows(distinct.selectExpr("uid", "label", "size(embedding) as dim", "embedding", "copies").join(V.split_points(distinct, 60), ["label", "dim"], "left"))
    assert cells.where("label = 0").count() < 3 * distinct.where("label = 0").count()


def test_calibration_holds_at_the_bound():
    half, least = V.calibrated(64, 0.98, 0.999)
    rng = np.random.default_rng(1)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((4000, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    hits = (np.abs((a - b) @ V.directions(64, V.DIRECTIONS, 11)) <= half).sum(axis=1)
    assert (hits >= least).mean() > 0.99


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [1.0, 2.0, 3.0]
    rows = [(0, good, 1), (1, [2.0, 4.0, 6.0], 1), (2, good, 2), (3, good, None), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, nan, 3.0], 1), (7, [1.0, inf, 3.0], 1),
            (8, [1.0, None, 3.0], 1), (9, good, 1), (10, [], 1), (11, [1.0, 2.0], 1), (12, [1.0, 2.0, 3.0, 0.0], 1)]
    rows = [(*r, 1, 2) for r in rows]
    got = sorted(map(tuple, V.vector_groups(table(spark, rows)).collect()))
    assert got == brute(rows) and got[0][1] == 2 and got[9] == (9, 2, 0, False)
    twice = sorted(map(tuple, V.vector_groups(table(spark, [*rows, *rows[:1], (None, good, 2, 1, 2)])).collect()), key=repr)
    assert twice.count((0, 3, 0, True)) == 2 and (None, 1, 2, False) in twice
    assert V.vector_groups(table(spark, [])).count() == 0


@pytest.mark.parametrize("two", [False, True])
def test_a_cell_links_the_pairs_that_collide_often_enough(two):
    """Against a count of all pairs on all directions, pairs that just miss the count included."""
    rng = np.random.default_rng(8)
    x = np.array(cluster(rng, 700, 64))
    x[-5:] = x[:5]  # equal places on every direction
    none, part = np.zeros(len(x), np.int64), rng.integers(0, 2, len(x)) if two else np.zeros(len(x), np.int64)
    got, a, b = V.cell_links(np.arange(len(x)), x, np.ones(len(x), np.int64), none, none, part, 0.98, 0.999)
    own = x / np.linalg.norm(x, axis=1, keepdims=True)
    half, least = V.calibrated(64, 0.98, 0.999)
    place = own @ V.directions(64, V.DIRECTIONS, 11)
    hits = (np.abs(place[:, None] - place[None, :]) <= half * (1 + 1e-6) + 1e-7).sum(axis=2)
    linked = (hits >= least) & (own @ own.T >= 0.98) & ~np.eye(len(x), dtype=bool)
    if two:
        linked &= part[:, None] != part[None, :]
    assert got.tolist() == linked.sum(axis=1).tolist() and linked.sum() > 500
    want, own_groups = Groups(len(x)), Groups(len(x))
    for g, pairs in ((want, np.argwhere(linked).tolist()), (own_groups, zip(a.tolist(), b.tolist(), strict=True))):
        for i, j in pairs:
            g.join(i, j)
    assert [want.top(i) for i in range(len(x))] == [own_groups.top(i) for i in range(len(x))]
