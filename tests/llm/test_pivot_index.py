import numpy as np
import pytest

from quarterline.llm.pivot_index import embedding_links

VECS = "vec_id long, embedding array<float>, label int, key string, n long"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "k", 1) for i, v in rows],
                                 VECS.replace("float", kind))


def brute(rows, limit=0.9):
    x = []
    for _, v in rows:
        ok = v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)
        u = np.array(v, float) / max(map(abs, v)) if ok else None
        x.append(u / np.linalg.norm(u) if ok else None)
    n, low = len(rows), list(range(len(rows)))
    near = [[j for j in range(n) if j != i and x[i] is not None and x[j] is not None and len(x[i]) == len(x[j])
             and x[i] @ x[j] >= limit] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((rows[i][0], len(near[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return out, low


def cloud(seed=0):
    r = np.random.default_rng(seed)
    rows = []
    for c in range(40):
        base = r.normal(size=24)
        rows += [base + r.normal(size=24) * 0.12 for _ in range(int(r.integers(1, 12)))]
    hot = r.normal(size=24)
    rows += [hot + r.normal(size=24) * 0.1 for _ in range(150)] + [hot] * 30 + [r.normal(size=24) for _ in range(100)]
    return [(k * 3, v.astype(np.float32).tolist()) for k, v in enumerate(rows)]


@pytest.mark.parametrize("block", [40, 2048])
def test_recall_and_components(spark, block):
    rows = cloud()
    want, _ = brute(rows)
    got = {r.vec_id: r for r in embedding_links(frame(spark, rows), block=block).collect()}
    assert len(got) == len(rows)
    links = sum(n for _, n, _ in want)
    assert sum(r.n_links for r in got.values()) >= 0.9 * links
    for i, n, low in want:
        assert got[i].n_links <= n and got[i].kept == (got[i].component_id == i)
    assert sum(got[i].component_id == low for i, _, low in want) >= 0.98 * len(rows)


@pytest.mark.parametrize("n", [1_500, 15_000])
def test_recall_inside_a_dense_group(spark, n):
    r = np.random.default_rng(7)
    base, g = r.normal(size=64), n // 3
    base /= np.linalg.norm(base)
    x = np.concatenate([base + r.normal(size=(g, 64)) * 0.03, r.normal(size=(n - g, 64))]).astype(np.float32)
    got = {row.vec_id: row for row in embedding_links(frame(spark, list(enumerate(x.tolist())))).collect()}
    u = x[:g].astype(float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    want = (u @ u.T >= 0.9).sum(1) - 1
    links = np.array([got[i].n_links for i in range(g)])
    assert (links <= want).all() and links.sum() >= 0.9 * want.sum()
    assert sum(got[i].component_id == 0 for i in range(g)) >= 0.98 * g


def test_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [1.0, float("inf")]), (7, [1.0, 0.0]),
            (8, [2.0, 0.0]), (8, [2.0, 0.0]), (None, [3.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (11, [1.0, 0.1]), (None, None)]
    for kind in ("float", "double"):
        got = embedding_links(frame(spark, rows, kind)).collect()
        want, _ = brute(rows)
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == sorted(want, key=str)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_huge_doubles(spark):
    rows = [(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [1e300, -1e300])]
    got = {r.vec_id: r.n_links for r in embedding_links(frame(spark, rows, "double")).collect()}
    assert got == {1: 1, 2: 1, 3: 0}


def test_empty_table(spark):
    assert embedding_links(frame(spark, [])).count() == 0
