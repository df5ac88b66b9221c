"""Embedding_dedup in rounds: what lies on disk, cells cut into blocks, long vectors, lattice steps."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_embedding_dedup import check, near

from epiframe.llm import embedding_dedup as ed
from epiframe.plans import shared


def crowd(rng, dim, n, cosine=0.99):
    """n near copies of one vector, as many links of a chain, and as many others."""
    chain = [rng.normal(size=dim)]
    for _ in range(n - 1):
        chain.append(near(rng, chain[-1], 0.96))
    centre = rng.normal(size=dim)
    return [near(rng, centre, cosine) for _ in range(n)] + chain + [rng.normal(size=dim) for _ in range(n)]


def numbered(rng, vectors):
    return [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(vectors)), vectors)]


def on_disk(spark):
    """Bytes of the settled tables."""
    return sum(os.path.getsize(f"{d}/{f}") for p in shared.SETTLED for d, _, fs in os.walk(p.removeprefix("file:")) for f in fs)


def test_tables_on_disk_are_no_more_than_twice_the_vectors(spark, monkeypatch):
    rng = np.random.default_rng(11)
    u = rng.normal(size=(6000, 64)).astype(np.float32)
    u[1000:2000] = u[:1000] + 0.02 * rng.normal(size=(1000, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(u)], "vec_id bigint, embedding array<float>")
    monkeypatch.setattr(shared, "SETTLED", [])
    monkeypatch.setattr(ed, "SENT", 0, raising=False)
    most, compact, compared, sent = [], ed.compact, ed.compared, []

    def watched(*args):
        out = compact(*args)
        most.append(on_disk(spark))
        return out

    def weighed(rows, *args):
        sent.append(rows)
        return compared(rows, *args)

    monkeypatch.setattr(ed, "compact", watched)
    monkeypatch.setattr(ed, "compared", weighed)
    ed.near_duplicates(df)
    left = on_disk(spark)
    assert max(most) < 2.5 * u.nbytes and left < u.nbytes  # before: most 9.0 times
    assert len(sent) == ed.SETTINGS[1][3]


def test_a_round_sends_each_vector_once_a_cell(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(500, 64)).astype(np.float32)
    rows = [(i, 1, bytearray(v.tobytes())) for i, v in enumerate(x)]
    classes = spark.createDataFrame(rows, "node bigint, weight bigint, v binary")
    packs = ed.sent(classes, 2, "f4", range(3, 4), {}, 5, 0, 1)
    assert packs.agg(F.sum(F.octet_length("pack"))).first()[0] == 2 * 500 * (28 + 256)
    halves = [ed.sent(classes, 2, "f4", range(3, 4), {}, 5, k, 2).agg(F.sum(F.octet_length("pack"))).first()[0] for k in range(2)]
    assert sum(halves) == 2 * 500 * (28 + 256) and min(halves) > 0


@pytest.mark.parametrize("levels", [1, 2])
def test_rounds_and_cut_cells_count_every_link_once(spark, monkeypatch, levels):
    """Each table in rounds of its own, its units in shares, and cells cut into up to dozens of blocks."""
    rng = np.random.default_rng(20 + levels)
    monkeypatch.setattr(ed, "SENT", 0)
    monkeypatch.setattr(ed, "BLOCK", 3 * 32)
    rows = numbered(rng, crowd(rng, 32, 60))
    rows += [(1000 + i, v) for i, v in rows[:20]] + [(i, [3 * x for x in v]) for i, v in rows[100:110]]
    check(spark, rows, levels=levels)


def test_long_vectors(spark):
    """Of more than 128 dimensions (signs first); from 169 on the cells had no hash before."""
    rng = np.random.default_rng(31)
    check(spark, numbered(rng, crowd(rng, 200, 40)) + [(900, rng.normal(size=130).tolist()), (901, None)])


def test_least_steps_are_those_of_all_steps():
    rng = np.random.default_rng(32)
    x = rng.normal(size=(3000, 8)) * 3
    home, weights = ed.decoded(x), rng.integers(1, 1 << 62, 8)
    price, step = ed.least_step((x - home).T, weights)
    costs = 2 - 2 * (x - home) @ ed.neighbours().T
    best = costs.argmin(axis=1)
    assert np.allclose(price, costs.min(axis=1))
    assert (step == (2 * ed.neighbours()[best]).astype(np.int64) @ weights).all()
