"""Codes and codebooks from trees against plain rounds over all pairs, in whole numbers."""

import hashlib
import math
import random

import pytest

from epiframe.llm import vector_codes

KIND = "vec_id bigint, embedding array<double>, label int, x string, item int, code string"


def brute(rows, entries=256, rounds=4, parts=4):
    """{(vec_id, vector): (code, error)}, label errors and the digest."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept = [(i, tuple(max(-(2**63), min(2**63 - 1, math.floor(1024 * x))) for x in v), label) for i, v, label, *_ in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts

    def part(v, p):
        return v[p * width : (p + 1) * width]

    books = [[part(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(v, book):
        d = [sum((a - b) ** 2 for a, b in zip(v, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p, book in enumerate(books):
            own = {}
            for _, v, _ in kept:
                own.setdefault(near(part(v, p), book)[0], []).append(part(v, p))
            books[p] = [tuple(sum(c) // len(own[e]) for c in zip(*own[e])) if e in own else old for e, old in enumerate(book)]
    out, by_label = [], {}
    for i, v, label in kept:
        found = [near(part(v, p), books[p]) for p in range(parts)]
        error = sum(d for _, d in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{c:02x}" for c, _ in found), min(error, 2**63 - 1), label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, min(by_label[x], 2**63 - 1), digest) for i, c, e, x in out), key=str)


def check(spark, rows, **options):
    full = [(*r, "clash", 7, "clash") for r in rows]
    got = vector_codes.codes(spark.createDataFrame(full, KIND), **options).collect()
    sizes = {k: options[k] for k in ("entries", "rounds") if k in options}
    assert sorted(map(tuple, got), key=str) == brute(rows, **sizes)


def vectors(n, dim, spread, seed=0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(rng.randrange(3), spread) for _ in range(dim)], rng.choice([1, 2, None])) for i in range(n)]


@pytest.mark.parametrize("shard", [50, 4096])
def test_random_and_clustered(spark, shard):
    check(spark, vectors(700, 8, 0.05), entries=16, shard_rows=shard)
    check(spark, vectors(300, 16, 1.0, 1), entries=300 // 2, rounds=2, shard_rows=shard)


def test_ties_copies_and_equal_entries(spark):
    grid = [(i, [float(i % 3), float(i % 2), 0.0, -float(i % 5)], i % 2) for i in range(400)]
    check(spark, grid, entries=40, shard_rows=100)
    check(spark, [(i, [0.5] * 4, None) for i in range(100)], entries=8)
    check(spark, [(i // 2, [i / 7, 1.0, 2.0, 3.0], 1) for i in range(100)] * 2, entries=16)


def test_rows_that_cannot_be_coded(spark):
    rows = vectors(60, 8, 0.5)
    rows += [(100, None, 1), (101, [1.0] * 7 + [None], 1), (102, [float("nan")] * 8, 1), (103, [float("inf")] + [0.0] * 7, 1)]
    rows += [(104, [1.0] * 12, 1), (105, [], 1), (None, [0.1] * 8, None), (None, [-0.1] * 8, 1)]
    check(spark, rows, entries=256)


def test_large_components(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * 10.0 ** rng.randrange(0, 15) for _ in range(4)], 0) for i in range(60)]
    check(spark, rows, entries=8, rounds=2)


def test_lengths_and_empty_tables(spark):
    for v in (None, [], [1.0, 2.0, 3.0]):
        df = spark.createDataFrame([(1, v, 0, "", 0, "")], KIND)
        assert vector_codes.codes(df).collect() == []
    assert vector_codes.codes(df.limit(0)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_balls_hold_their_points():
    import numpy as np

    rng = np.random.default_rng(0)
    points = rng.integers(-500, 500, (1500, 5))
    points[:700] = points[0]
    tree = vector_codes.Tree(points)
    assert sorted(tree.order.tolist()) == list(range(1500))
    for n, (a, z) in enumerate(zip(tree.first, tree.last)):
        inside = points[tree.order[a:z]]
        assert (tree.sums[n] == inside.sum(axis=0)).all()
        assert vector_codes.distances(inside, tree.centre[n]).max() <= tree.radius[n] + 1e-9
        if tree.left[n] >= 0:
            l, r = tree.left[n], tree.right[n]
            assert (tree.first[l], tree.last[l], tree.last[r]) == (a, tree.first[r], z)
