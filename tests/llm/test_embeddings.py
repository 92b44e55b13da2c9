import numpy as np
import pytest
from brute import components

from dimwright.llm import embeddings as E


def plain(rows, threshold=0.9):
    ok = [(i, np.array(v, float) / np.linalg.norm(np.array(v, float))) for i, v in rows
          if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, links = {i: 0 for i, _ in rows}, []
    for a in range(len(ok)):
        for b in range(a):
            if len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] >= threshold:
                links.append((ok[a][0], ok[b][0]))
                n[ok[a][0]] += 1
                n[ok[b][0]] += 1
    comp = components(list(n), links)
    return sorted((i, n[i], comp[i], comp[i] == i) for i in n)


def made(seed=0, d=32):
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=d) for _ in range(250)]
    for c in rng.normal(size=(6, d)):
        rows += [c + rng.normal(size=d) * s for s in (0.05, 0.15, 0.3, 0.35) for _ in range(15)]
    rows += [rows[0]] * 40 + [rows[0] * 3.5] * 5
    rows = [[float(x) for x in r.astype(np.float32)] for r in rows]
    rows += [None, [], [0.0] * d, [None] + [1.0] * (d - 1), [float("nan")] * d, [float("inf")] + [0.0] * (d - 1),
             [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [2.0], [3.0], [-1.0], [1e38] * 3, [1e-38] * 3]
    return list(enumerate(rows))


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' as node", "1 as unit")


def test_links_equal_all_pairs(spark):
    rows = made()
    got = sorted(tuple(r) for r in E.link_embeddings(frame(spark, rows)).collect())
    want = plain(rows)
    found = {r[0]: r for r in got}
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want)
    assert all(found[i][1] <= n for i, n, _, _ in want)
    assert sum(found[i] == (i, n, c, k) for i, n, c, k in want) >= 0.99 * len(want)


def test_small_tiles_and_full_visits_are_exact(spark, monkeypatch):
    rows = made(3)
    monkeypatch.setattr(E, "TILE", 7)
    monkeypatch.setattr(E, "RECALL", 1)  # every cell is visited
    got = sorted(tuple(r) for r in E.link_embeddings(frame(spark, rows)).collect())
    assert got == plain(rows)


def test_empty_and_null_ids(spark):
    df = frame(spark, [(None, [1.0, 0.0]), (5, [1.0, 0.01]), (5, [1.0, 0.01]), (None, [0.0, 1.0])])
    got = sorted((tuple(r) for r in E.link_embeddings(df).collect()), key=repr)
    assert got == sorted([(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (None, 0, None, True)], key=repr)
    assert E.link_embeddings(df.limit(0)).count() == 0


def test_recall_of_the_index(spark):
    """The vectors of the table (which hold no links of their own) with noisy copies of every third one."""
    import duckdb
    rows = duckdb.sql("select vec_id, embedding from '/root/testdata/sf0.1/embeddings.parquet'").fetchall()
    rng, first = np.random.default_rng(6), max(r[0] for r in rows) + 1
    rows += [(first + i, [float(c) for c in np.float32(np.array(r[1]) + rng.normal(size=len(r[1])) * s)])
             for i, (r, s) in enumerate(zip(rows[::3], rng.uniform(0.01, 0.06, len(rows))))]
    x = np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    true = (x @ x.T >= 0.9).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in E.link_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert all(got[r[0]] <= t for r, t in zip(rows, true))
    assert true.sum() > 500 and sum(got.values()) >= 0.99 * true.sum()


def test_workers_get_the_package_path(spark):
    from dimwright.llm.common import _ROOT, let_workers_import
    let_workers_import(spark)
    let_workers_import(spark)
    assert spark.sparkContext.environment["PYTHONPATH"].split(":").count(_ROOT) == 1


def grouped(seed=4, d=16):
    """A third of all vectors are tight copies of one; the others are pairs near cosine 0.9."""
    rng = np.random.default_rng(seed)
    hot, x = rng.normal(size=d), rng.normal(size=(1200, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    u = rng.normal(size=x.shape)
    u -= (u * x).sum(axis=1)[:, None] * x
    u /= np.linalg.norm(u, axis=1)[:, None]
    c = rng.uniform(0.9, 0.92, (len(x), 1))
    return np.concatenate([hot + rng.normal(size=(1200, d)) * 0.001, x, c * x + np.sqrt(1 - c * c) * u])


def test_a_hot_group_does_not_hide_small_groups(spark):
    """No link of the small groups may be lost for the many links of the hot one."""
    x = grouped()
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in E.link_embeddings(spark.createDataFrame(
        [(i, [float(c) for c in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    x = x / np.linalg.norm(x, axis=1)[:, None]
    hit = x @ x.T >= 0.9
    comp = components(list(range(len(x))), [(int(a), int(b)) for a, b in zip(*np.nonzero(hit[1200:])) for a in [a + 1200]]
                      + [(0, i) for i in range(1200)])
    assert hit[:1200, :1200].all() and hit[1200:].sum() > 3600
    assert got == {i: (int(n) - 1, comp[i]) for i, n in enumerate(hit.sum(axis=1))}


def with_partners(x, seed=6):
    """Table vectors and, for each, a partner at a cosine of 0.9 to 0.92."""
    rng = np.random.default_rng(seed)
    x = x / np.linalg.norm(x, axis=1)[:, None]
    u = rng.normal(size=x.shape)
    u -= (u * x).sum(axis=1)[:, None] * x
    u /= np.linalg.norm(u, axis=1)[:, None]
    c = rng.uniform(0.9, 0.92, (len(x), 1))
    return x, c * x + np.sqrt(1 - c * c) * u


@pytest.mark.parametrize("path,rows,most", [("sf0.1", 2000, 0.2), ("check_l", 50_000, 0.1)])
def test_few_cells_hold_the_links(path, rows, most):
    """Recall of planted partners near the threshold, and the share of the grid that a vector visits."""
    import pyarrow.parquet as pq
    x = np.array(pq.read_table(f"/root/testdata/{path}/embeddings.parquet", columns=["embedding"]).column(0).slice(0, rows).to_pylist(), float)
    x, y = with_partners(x)
    both = np.concatenate([x, y])
    index = E.MultiIndex(both[np.random.default_rng(1).permutation(len(both))[:E.SAMPLE_ROWS]], len(both), 0.9)
    found, share, at = 0, [], np.random.default_rng(2).permutation(len(x))[:2000]
    home_y = index.home(y[at])
    for lo in range(0, len(at), 200):
        home_x, visits = index.place(x[at[lo:lo + 200]])
        _, back = index.place(y[at[lo:lo + 200]])
        found += sum(home_y[lo + i] in v and home_x[i] in w for i, (v, w) in enumerate(zip(visits, back)))
        share += [len(v) / index.cells for v in visits]
    print(path, "cells", index.cells, "share visited", np.mean(share), "recall", found / len(at))
    assert found / len(at) >= 0.995 and np.mean(share) < most


def test_the_traversal_visits_nearest_cells_first():
    """The cells of a vector are those of the smallest summed half distances, its own first."""
    x, y = with_partners(grouped(5))
    index = E.MultiIndex(x[::3], len(x), 0.9)
    home, visits = index.place(x[:100])
    a, b = index.distances(x[:100])
    for i, v in enumerate(visits):
        sums = (a[i][:, None] + b[i][None, :]).ravel()
        assert home[i] == sums.argmin() and set(np.argsort(sums, kind="stable")[:len(v)]) == set(v.tolist())
