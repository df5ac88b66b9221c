"""Links of lattice hashing against all pairs, and its recall at the threshold."""

import numpy as np
import pytest

from epiframe.llm import embedding_dedup as ed

KIND = "vec_id bigint, embedding array<double>, label int, u string, node int, key string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "clash", 0, "clash", 0) for i, v in rows], KIND)


def brute(rows):
    """(vec_id, n_links, component_id, kept) of each row."""
    unit = []
    for i, v in rows:
        ok = i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        a = np.array(v) / max(map(abs, v)) if ok else None
        unit.append(a / np.linalg.norm(a) if ok else None)
    n = len(rows)
    link = [[False] * n for _ in range(n)]
    for a in range(n):
        for b in range(n):
            if a != b and unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]):
                link[a][b] = float(unit[a] @ unit[b]) >= 0.95
    least = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for a in range(n):
            for b in range(n):
                if link[a][b] and least[b] < least[a]:
                    least[a], changed = least[b], True
    return sorted(((i, sum(link[a]), least[a], i is None or i == least[a]) for a, (i, _) in enumerate(rows)), key=str)


def check(spark, rows, **options):
    got = ed.near_duplicates(frame(spark, rows), **options).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def near(rng, v, cosine):
    w = rng.normal(size=v.shape)
    w -= (w @ v) * v / (v @ v)
    return cosine * v / np.linalg.norm(v) + (1 - cosine**2) ** 0.5 * w / np.linalg.norm(w)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_groups_chains_and_others(spark, monkeypatch, levels):
    rng = np.random.default_rng(levels)
    rows, centre = [], rng.normal(size=32)
    group = [near(rng, centre, 0.99) for _ in range(90)]  # all linked, in more than one block
    chain = [rng.normal(size=32)]
    for _ in range(30):
        chain.append(near(rng, chain[-1], 0.96))  # next ones linked only
    rest = [rng.normal(size=32) for _ in range(100)]
    for i, v in enumerate(rng.permutation(np.array([*group, *[c / np.linalg.norm(c) for c in chain], *rest]))):
        rows.append((1000 - i, v.tolist()))
    monkeypatch.setattr(ed, "BLOCK", 20 * 32)
    check(spark, rows, levels=levels)


def test_vectors_that_cannot_be_compared(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(size=8).tolist()
    rows = [(1, v), (1, v), (2, [2 * x for x in v]), (3, [1e300 * x for x in v]), (4, [1e-300 * x for x in v]), (5, [-x for x in v])]
    rows += [(6, None), (7, []), (8, [0.0] * 8), (9, v[:7] + [None]), (10, v[:7] + [float("nan")]), (11, v[:7] + [float("inf")])]
    rows += [(None, v), (12, v[:5]), (13, v[:5]), (14, [1.0]), (15, [3.0]), (16, [-1.0]), (7, v)]
    check(spark, rows)
    check(spark, [(1, None)])
    assert ed.near_duplicates(frame(spark, rows).limit(0)).collect() == []


@pytest.mark.parametrize("levels", sorted(ed.SETTINGS))
@pytest.mark.parametrize("dim", [24, 64, 768])
def test_pairs_at_the_threshold_are_met(levels, dim):
    rng = np.random.default_rng(dim)
    u = rng.normal(size=(4000, dim))
    u /= np.linalg.norm(u, axis=1)[:, None]
    v = np.array([near(rng, x, 0.95) for x in u])
    scale, steps, probes, tables = ed.SETTINGS[levels]
    met = np.zeros(len(u), bool)
    for t in range(tables):
        a, b = (ed.cells(x, t, levels, tables, scale, steps, probes) for x in (u, v))
        met |= (a == b[:, :1]).any(axis=1) | (b == a[:, :1]).any(axis=1)
    assert met.mean() >= 0.999
    signs = ed.projections(dim, levels, tables)[3]
    assert ((u @ signs > 0) != (v @ signs > 0)).sum(axis=1).max() <= ed.UNEQUAL


def test_lattice_points_are_the_nearest():
    x = np.random.default_rng(0).normal(size=(200, 8)) * 3
    found = ed.decoded(x)
    around = found[:, None] + ed.neighbours()[None]
    assert len(ed.neighbours()) == 240 and ((x - found) ** 2).sum(axis=1).max() <= 1 + 1e-9
    assert (((x[:, None] - around) ** 2).sum(axis=2) >= ((x - found) ** 2).sum(axis=1)[:, None] - 1e-9).all()


def test_a_hot_group_is_paired_by_blocks(spark):
    """2,000 near copies of one vector: few pairs of blocks, and every link counted."""
    rng = np.random.default_rng(4)
    centre = rng.normal(size=64)
    rows = [(i, near(rng, centre, 0.995).tolist()) for i in range(2000)] + [(5000 + i, rng.normal(size=64).tolist()) for i in range(500)]
    got = {r.vec_id: r for r in ed.near_duplicates(frame(spark, rows)).collect()}
    u = np.array([v for _, v in rows])
    u /= np.linalg.norm(u, axis=1)[:, None]
    n = (u @ u.T >= 0.95).sum(axis=1) - 1
    assert all(got[i].n_links == n[k] for k, (i, _) in enumerate(rows))
    assert {got[i].component_id for i in range(2000)} == {0}
