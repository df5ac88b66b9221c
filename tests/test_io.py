"""Readers, writers and streams: refusals, reports and repeats."""

import datetime
import os
import random
import re
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epiframe.operators import validate as val
from epiframe.plans import shared
from epiframe.sources import ranges, readers, sinks
from epiframe.streaming import jobs, state


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_is_typed(spark, tmp_path):
    path = write(tmp_path / "a.csv", "﻿t,v\n1,2.5\n2,\n")
    rows = readers.scan_csv(spark, path, "t BIGINT, v DOUBLE").collect()
    assert [tuple(r) for r in rows] == [(1, 2.5), (2, None)]


@pytest.mark.parametrize("text", ["t,v\n", "t,v\n1\n", "t,v\n1,2,3\n", "t,w\n1,2\n", "t,v\nx,2\n"])
def test_bad_csv_is_refused(spark, tmp_path, text):
    path = write(tmp_path / "a.csv", text)
    with pytest.raises(Exception):
        readers.scan_csv(spark, path, "t BIGINT, v DOUBLE").collect()


def test_json_objects(spark, tmp_path):
    write(tmp_path / "a.json", '{\n "status": "ok",\n "n": 3}')
    write(tmp_path / "b.json", "not json")
    schema = "status STRING, n BIGINT"
    rows = readers.scan_json_object(spark, str(tmp_path), schema, tolerant=True).collect()
    assert sorted((r.status or "", r.n) for r in rows) == [("", None), ("ok", 3)]
    with pytest.raises(Exception):
        readers.scan_json_object(spark, str(tmp_path), schema).collect()


def test_id_list_reports_lines(spark, tmp_path):
    good = "20260101_120000_1_2"
    path = write(tmp_path / "ids.txt", "\n".join([good, " " + good, "", "nope", good]) + "\n")
    listed = readers.scan_ordered_id_list(spark, path)
    rows = listed.orderBy("line").collect()
    assert [r.problem for r in rows] == [None, "untrimmed", "empty", "malformed", "duplicate"]
    with pytest.raises(ValueError, match="1 untrimmed, first in line 2"):
        readers.require_clean_list(listed)
    with pytest.raises(ValueError, match="no data rows"):
        readers.scan_ordered_id_list(spark, write(tmp_path / "none.txt", ""))


def test_lines_keep_their_order_over_splits(spark, tmp_path):
    path = write(tmp_path / "long.txt", "".join(f"line {i}\n" for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = readers.ordered_lines(spark, path, max_rows=1500).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert all(r.value == f"line {r.pos}" for r in rows) and len(rows) == 20000


def test_log_metrics(spark, tmp_path):
    text = "Step 10: lr=1, loss=9.0\nnoise\nStep 60: loss=nan\nStep 70: loss=6.5, x\n"
    lines = readers.ordered_lines(spark, write(tmp_path / "log", text))
    r = readers.scan_log_metrics(lines).first()
    assert (r.steps, r.last_step, r.last_loss, r.non_finite, r.too_high, r.traceback) == (
        3, 70, 6.5, 1, 2, False,
    )


def test_discovery_checks_the_count(spark, tmp_path):
    for name in ("a.csv", "b.csv", "c.txt"):
        write(tmp_path / name, "x")
    assert readers.discover_sources(spark, str(tmp_path), "*.csv", 2).count() == 2
    with pytest.raises(ValueError, match="expected 3"):
        readers.discover_sources(spark, str(tmp_path), "*.csv", 3)


def test_write_once(spark, tmp_path):
    path = str(tmp_path / "out")
    assert sinks.write_once(spark.range(3), path)
    assert not sinks.write_once(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3


def test_csv_round_trip_of_awkward_doubles(spark, tmp_path):
    values = [0.1 + 0.2, 1e-300, -0.0, 5e-324, 1.7976931348623157e308, 1 / 3]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    r = sinks.write_csv_exact(df, str(tmp_path / "v")).first()
    assert (r.rows, r.lost, r.gained) == (6, 0, 0)


def tree_digest(data, leaf):
    level = [sha256(data[a : a + leaf]).hexdigest() for a in range(0, max(1, len(data)), leaf)]
    while len(level) > 1:
        level = [sha256("".join(level[a : a + ranges.FAN]).encode()).hexdigest() for a in range(0, len(level), ranges.FAN)]
    return level[0]


def test_digests_of_ranges(spark, tmp_path):
    """Files of no, one and many leaves, with two levels above, in a folder with a blank."""
    root = tmp_path / "a b"
    root.mkdir()
    data = random.Random(3).randbytes(41_000)
    sizes = [1, 7, 8, 9, 8 * 1024, 8 * 1024 + 1, 41_000]
    for n in sizes:
        (root / f"{n}.parquet").write_bytes(data[:n])
    for leaf in (8, 4096, None):
        rows = sinks.file_manifest(spark, str(root), leaf=leaf).collect()
        want = {(n, tree_digest(data[:n], leaf or 1 << 20)) for n in sizes}
        assert {(r.size, r.sha256) for r in rows} == want and len(rows) == len(sizes)
    (root / "none").touch()
    none = spark.createDataFrame([(f"file:{root}/none", 0)], "path string, size bigint")
    assert ranges.tree_digests(none, 8).first().sha256 == sha256(b"").hexdigest()
    assert ranges.tree_digests(none.limit(0), 8).count() == 0


def test_a_large_file_is_verified_by_several_tasks(spark, tmp_path):
    """2.3 GB, mostly a hole; one byte changes in the middle."""
    path = tmp_path / "big.parquet"
    with path.open("wb") as f:
        f.truncate(2_300_000_000)
    leaf = 64 << 20
    files = ranges.listed(spark, str(tmp_path), "*.parquet")
    made = ranges.tree_digests(files, leaf)
    listed = spark.createDataFrame(made.collect(), made.schema)
    assert [r.verdict for r in sinks.manifest_verify(spark, listed, str(tmp_path), leaf=leaf).collect()] == ["ok"]
    with path.open("r+b") as f:
        f.seek(1_200_000_000)
        f.write(b"x")
    assert [r.verdict for r in sinks.manifest_verify(spark, listed, str(tmp_path), leaf=leaf).collect()] == ["sha256"]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    tasks = int(re.search(r"RepartitionByExpression \[[^]]*\], (\d+)", plan).group(1))
    assert tasks >= 8


def test_manifest_finds_changes(spark, tmp_path):
    root = str(tmp_path / "d")
    spark.range(10).repartition(3).write.parquet(root)
    listed = spark.createDataFrame(sinks.file_manifest(spark, root).collect())
    assert {r.verdict for r in sinks.manifest_verify(spark, listed, root).collect()} == {"ok"}
    wrong = listed.withColumn("sha256", F.lit("0")).unionByName(
        spark.createDataFrame([("file:/elsewhere/x.parquet", 1, "0")], listed.schema)
    )
    verdicts = {r.verdict for r in sinks.manifest_verify(spark, wrong, root).collect()}
    assert verdicts == {"sha256", "outside"}
    spark.range(1).coalesce(1).write.mode("append").parquet(root)
    verdicts = [r.verdict for r in sinks.manifest_verify(spark, listed, root).collect()]
    assert verdicts.count("unlisted") == 1


def test_episode_folders_are_ordered(spark, tmp_path):
    path = str(tmp_path / "e")
    df = spark.range(1000).select((F.col("id") % 3).alias("e"), F.col("id").alias("i"))
    sinks.write_episodes(df, path, "e", "i")
    back = spark.read.parquet(path)
    assert back.count() == 1000 and {r.e for r in back.select("e").distinct().collect()} == {0, 1, 2}
    with pytest.raises(Exception):
        sinks.write_episodes(df, path, "e", "i")


def test_shapes(spark):
    df = spark.createDataFrame(
        [([1.0, 2.0], [[1.0, 2.0]]), ([1.0], [[1.0, 2.0]]), ([1.0, 2.0], [[1.0]])],
        "state ARRAY<DOUBLE>, action ARRAY<ARRAY<DOUBLE>>",
    )
    out = sinks.shape_violations(df, sinks.feature_shapes(2, 1, 4, 4)).collect()
    assert {r.feature: r.violations for r in out} == {"state": 1, "action": 1}
    names = sinks.sample_schema().fieldNames()
    assert names[:3] == ["state", "action", "action_is_pad"] and len(names) == 17


def test_headers(spark):
    df = spark.range(1).select(F.lit(1).alias("a"), F.lit(2).alias("b"))
    assert val.require_columns(df, ["a"]) is df
    for bad in (["c"], ["b", "a"]):
        with pytest.raises(ValueError):
            val.require_columns(df, bad, exact=True)
    with pytest.raises(ValueError, match="duplicate"):
        val.require_columns(df.select("a", "a"), ["a"])


def test_page_bounds(spark):
    df = spark.range(30)
    rows = val.page(df, ["id"], 2, 10).collect()
    assert [r.id for r in rows] == list(range(10, 20)) and rows[0].total == 30
    assert [r.id for r in val.page_after(df, ["id"], None, 10).collect()] == list(range(10))
    assert [r.id for r in val.page_after(df, ["id"], [24], 10).collect()] == list(range(25, 30))
    for number, limit in ((0, 10), (1, 501)):
        with pytest.raises(ValueError):
            val.page(df, ["id"], number, limit)
    with pytest.raises(ValueError):
        val.search_filter(df, "odd", "", "s", F.col("id"))


def run_slices(spark, tmp_path, schema, slices, operator, mode="append"):
    """Delivers slices of rows one after the other, each to a new run of the job; yields the
    output so far and the late rows of that run."""
    src, out, mark = [str(tmp_path / n) for n in ("src", "out", "mark")]
    schema = T.StructType.fromDDL(schema)
    for rows in slices:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        stream = operator(jobs.arriving(spark, src, schema))
        late = jobs.run_available(stream, jobs.batch_writer(out), mode, mark, state.STATE)
        yield spark.read.parquet(out).drop(jobs.BATCH), late


SECOND = 1_000_000


def at(*rows):
    """(key, time in seconds, ...) rows with the time in microseconds too."""
    start = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
    return [(k, t * SECOND, start + datetime.timedelta(seconds=t), *rest) for k, t, *rest in rows]


def test_stream_asof_drops_and_counts_late_rows(spark, tmp_path):
    slices = [
        at((1, 100, 1, False), (1, 105, 2, True), (1, 130, 3, False), (2, 101, 8, True)),
        # 121 arrives late but within the delay; 90 is older than the watermark of 120
        at((1, 121, 4, False), (1, 125, 5, True), (1, 90, 6, True), (1, 160, 7, True)),
        at((None, 900, 9, False)),
    ]

    def matched(stream):
        return state.asof_backward(stream, ["k"], "at", "t", "id", F.col("q"), ["id"], "10 seconds")

    runs = run_slices(spark, tmp_path, "k INT, t BIGINT, at TIMESTAMP, id BIGINT, q BOOLEAN", slices, matched)
    got = [(sorted((r.id, r.src_id, r.src_delta) for r in out.collect()), late) for out, late in runs]
    first = [(2, 1, -5 * SECOND), (8, None, None)]
    second = [(2, 1, -5 * SECOND), (5, 4, -4 * SECOND), (8, None, None)]
    assert got[0] == (first, 0)
    assert got[1] == (second, 1)
    assert got[2] == (sorted([*second, (7, 3, -30 * SECOND)]), 0)


def test_stream_asof_keeps_ties_and_repeats_apart(spark, tmp_path):
    slices = [
        at((1, 10, 3, True), (1, 10, 1, False), (1, 10, 2, True)),  # a source at the instant of two queries
        at((1, 11, 5, False), (1, 11, 4, False), (1, 12, 6, True)),  # two sources at one instant
        at((None, 900, 9, False)),
    ]

    def matched(stream):
        return state.asof_backward(stream, ["k"], "at", "t", "id", F.col("q"), ["id"], "10 seconds")

    runs = list(run_slices(spark, tmp_path, "k INT, t BIGINT, at TIMESTAMP, id BIGINT, q BOOLEAN", slices, matched))
    assert sorted((r.id, r.src_id) for r in runs[-1][0].collect()) == [(2, 1), (3, 1), (6, 5)]


def test_stream_asof_of_keys_in_few_shards(spark, tmp_path):
    """Keys of a shard stay apart, the null key too, and whole numbers beside nulls stay exact."""
    big = (1 << 60) + 1
    keys = [None, 0, *range(big, big + 20)]
    slices = [
        at(*[(k, 10 + i, 2 * i, False, None if i == 3 else big + i) for i, k in enumerate(keys) if i != 5]),
        at(*[(k, 100, 2 * i + 1, True, None) for i, k in enumerate(keys)]),
        at((7, 90_000, 999, False, 0)),
    ]

    def matched(stream):
        return state.asof_backward(stream, ["k"], "at", "t", "id", F.col("q"), ["id", "v"], "20 seconds", shards=2)

    runs = list(run_slices(spark, tmp_path, "k BIGINT, t BIGINT, at TIMESTAMP, id BIGINT, q BOOLEAN, v BIGINT", slices, matched))
    assert [late for _, late in runs] == [0, 0, 0]
    got = {r.k: (r.id, r.src_id, r.src_v, r.src_delta) for r in runs[-1][0].collect()}
    want = {k: (2 * i + 1, 2 * i, None if i == 3 else big + i, (i - 90) * SECOND) for i, k in enumerate(keys)}
    assert got == {**want, keys[5]: (11, None, None, None)}
    # state grows with shards, not with keys: one value of last sources each
    last = spark.read.format("statestore").option("stateVarName", "last").load(str(tmp_path / "mark"))
    assert last.count() <= 3


def test_flag_runs_of_keys_in_few_shards(spark, tmp_path):
    rows = [(k, 10 + 10 * i + k % 7, 100 * k + i, (i + k) % 5 != 0, (i * k) % 11 != 3) for k in range(40) for i in range(12)]
    slices = [at(*rows[::3]), at(*rows[1::3]), at(*rows[2::3]), at((99, 9_000, 1, False, False))]

    def runs_of(shards):
        return lambda df: state.flag_runs(df, ["k"], "at", "t", "id", F.col("ok"), F.col("edge"), 25 * SECOND, "1 hour", shards=shards)

    schema = "k INT, t BIGINT, at TIMESTAMP, id BIGINT, ok BOOLEAN, edge BOOLEAN"
    *_, (out, _) = run_slices(spark, tmp_path, schema, slices, runs_of(3))
    got = sorted((r.k, r.run, r.first_row, r.last_row, r.samples) for r in out.collect())
    want = []
    for k in range(40):
        run = -1
        for i in range(12):
            ok, edge = (i + k) % 5 != 0, (i * k) % 11 != 3
            if not ok:
                continue
            if i == 0 or (i - 1 + k) % 5 == 0 or not edge:
                run += 1
                want.append([k, run, 100 * k + i, None, 0])
            want[-1][3:] = [100 * k + i, want[-1][4] + 1]
    assert got == sorted(map(tuple, want))


def test_flag_runs_with_late_rows_and_restarts(spark, tmp_path):
    slices = [
        at((1, 10, 1, True, True), (1, 30, 3, True, True), (2, 12, 1, None, True), (2, 13, 2, True, None)),
        at((1, 20, 2, True, True), (1, 40, 4, False, True), (2, 14, 3, True, False)),  # 20 and 14 come late
        at((1, 50, 5, True, True), (1, 60, 6, True, True), (1, 5, 0, True, True)),  # 5 comes too late
        at((1, 200, 7, True, True)),  # too long after 60
        at((None, 9_000, 9, False, False)),
    ]

    def runs_of(stream):
        return state.flag_runs(stream, ["k"], "at", "t", "id", F.col("ok"), F.col("edge"), 100 * SECOND, "20 seconds")

    runs = list(run_slices(spark, tmp_path, "k INT, t BIGINT, at TIMESTAMP, id BIGINT, ok BOOLEAN, edge BOOLEAN", slices, runs_of))
    assert [late for _, late in runs] == [0, 0, 1, 0, 0]
    got = sorted((r.k, r.run, r.first_row, r.last_row, r.samples, r.first_ts // SECOND, r.last_ts // SECOND) for r in runs[-1][0].collect())
    assert got == [(1, 0, 1, 3, 3, 10, 30), (1, 1, 5, 6, 2, 50, 60), (1, 2, 7, 7, 1, 200, 200), (2, 0, 2, 2, 1, 13, 13), (2, 1, 3, 3, 1, 14, 14)]


def test_complete_episodes_are_emitted_once(spark, tmp_path):
    arrivals = [
        [(1, "a", 5, 10), (2, "a", 5, 10)],
        [(1, "b", 5, 11), (2, "b", 0, 11)],
        [(3, "a", 1, 12), (1, "b", 5, 11)],
        [(1, "a", 6, 13)],
    ]

    def found(stream):
        return state.new_episodes(stream, "e", "f", "size", "at", ["a", "b"])

    runs = run_slices(spark, tmp_path, "e INT, f STRING, size BIGINT, at BIGINT", arrivals, found, "update")
    got = [sorted((r.e, r.changed_at) for r in out.collect()) for out, _ in runs]
    # the second report of episode 1 follows a change of its files, a listing without one gives none
    assert got == [[], [(1, 11)], [(1, 11)], [(1, 11), (1, 13)]]


def test_complete_episodes_of_one_shard(spark, tmp_path):
    arrivals = [
        [(e, "a", 1, 10 + (e or 0)) for e in [None, *range(30)]] + [(e, "b", 1, 5) for e in range(0, 30, 2)],
        [(e, "b", 1, 5) for e in [None, *range(0, 30, 3)]],
    ]

    def found(stream):
        return state.new_episodes(stream, "e", "f", "size", "at", ["a", "b"], shards=1)

    runs = run_slices(spark, tmp_path, "e BIGINT, f STRING, size BIGINT, at BIGINT", arrivals, found, "update")
    got = [sorted(((r.e, r.changed_at) for r in out.collect()), key=str) for out, _ in runs]
    first = [(e, 10 + e) for e in range(0, 30, 2)]
    second = [(None, 10), *[(e, 10 + e) for e in range(3, 30, 6)]]
    assert got == [sorted(first, key=str), sorted(first + second, key=str)]


def test_settled_tables_can_be_removed(spark, monkeypatch):
    monkeypatch.setattr(shared, "SETTLED", [])
    out = shared.settle(spark.range(5))
    assert out.count() == 5 and len(shared.SETTLED) == 1
    path = shared.SETTLED[0]
    assert shared.remove_settled(spark) == 1 and shared.SETTLED == [] and not os.path.exists(path)
