"""Operators over rows in time order: gaps, runs, segments, grids and samples.

Every function takes a planned ``Series`` (see ``plans.series``) and returns a ``Series``
or, for per-key reports, a DataFrame built by partial aggregation.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.operators.stats import exact_quantiles
from epiframe.plans.series import Series
from epiframe.plans.shared import settle


def frame_deltas(s: Series, frame: str, ts: str) -> Series:
    s = s.shift({"previous_frame": F.col(frame), "previous_ts": F.col(ts)})
    return s.with_columns({"dt": F.col(ts) - F.col("previous_ts")})


def monotonic_check(s: Series, ts: str, row: str, strict: bool = True) -> DataFrame:
    """Per key: rows whose clock does not exceed the previous row's, and the first of them.

    Not strict, a clock may stand still, as it does between copies of a packet.
    """
    s = s.shift({"_prev": F.col(ts)})
    back = F.col(ts) <= F.col("_prev") if strict else F.col(ts) < F.col("_prev")
    bad = F.col("_prev").isNotNull() & back
    return (
        s.frame()
        .groupBy(*s.keys)
        .agg(
            F.count_if(bad).alias("violations"),
            F.min(F.when(bad, F.col(row))).alias("first_bad_row"),
        )
        .withColumn("accepted", F.col("violations") == 0)
    )


def sequence_gaps(s: Series, frame: str, ts: str, step: int = 1, max_dt: int | None = None) -> Series:
    """Flags a break to the previous row: wrong frame step (0 disables) or too long a gap."""
    s = frame_deltas(s, frame, ts)
    has_prev = F.col("previous_ts").isNotNull()
    wrong_step = (
        (F.col(frame) - F.col("previous_frame")) != step if step else F.lit(False)
    )
    too_long = F.col("dt") > max_dt if max_dt is not None else F.lit(False)
    return s.with_columns({"discontinuous": has_prev & (wrong_step | too_long)})


def interval_discontinuity(
    s: Series, ts: str, nominal: DataFrame, floor: int = 2_000_000, share: float = 0.10
) -> Series:
    """``interval_ok`` per row against the key's nominal interval (column ``nominal``)."""
    s = s.shift({"_prev": F.col(ts)}).join_keys(nominal)
    tolerance = F.greatest(F.lit(floor), F.bround(F.col("nominal") * share).cast("bigint"))
    off = F.abs(F.col(ts) - F.col("_prev") - F.col("nominal"))
    return s.with_columns(
        {"interval_ok": F.col("_prev").isNull() | F.coalesce(off <= tolerance, F.lit(True))}
    ).map(lambda d: d.drop("_prev"))


def span_all_true(
    s: Series,
    on_grid: Column,
    row_ok: Column,
    increasing: list[str],
    name: str = "transition_valid",
    number: str | None = None,
) -> Series:
    """Grid rows only, each saying whether the span from the previous grid row is sound.

    Sound means every raw row after the previous grid row up to this one is ok and each
    ``increasing`` column grew; null is not ok. The first grid row is sound. A running count of bad rows
    replaces a scan of each span. ``number`` names a column for the position on the grid.
    """
    bad = ~F.coalesce(row_ok, F.lit(False))
    s = s.cumulate({"_bad": bad.cast("bigint")}).filter(on_grid)
    s = s.scan(
        number=number,
        previous={"_pbad": F.col("_bad"), **{f"_p_{c}": F.col(c) for c in increasing}},
    )
    grew = F.lit(True)
    for c in increasing:
        grew = grew & F.coalesce(F.col(c) > F.col(f"_p_{c}"), F.lit(False))
    sound = F.col("_pbad").isNull() | ((F.col("_bad") == F.col("_pbad")) & grew)
    drop = ["_bad", "_pbad", *[f"_p_{c}" for c in increasing]]
    return s.with_columns({name: sound}).map(lambda d: d.drop(*drop))


def valid_runs(s: Series, sample: Column, transition: Column, name: str = "run") -> Series:
    """Index of the run a row belongs to, -1 outside runs.

    A run is a maximal stretch of valid samples joined by valid transitions. A bad incoming
    edge starts a new run at that row. A null sample or transition is not valid.
    """
    transition = F.coalesce(transition, F.lit(False))
    s = s.with_columns({"_ok": F.coalesce(sample, F.lit(False))}).shift({"_prev_ok": F.col("_ok")})
    starts = F.col("_ok") & (~F.coalesce(F.col("_prev_ok"), F.lit(False)) | ~transition)
    s = s.cumulate({"_runs": starts.cast("bigint")})
    return s.with_columns(
        {name: F.when(F.col("_ok"), F.col("_runs") - 1).otherwise(F.lit(-1)).cast("bigint")}
    ).map(lambda d: d.drop("_ok", "_prev_ok", "_runs"))


def contiguous_from_zero(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """Per key: whether ``index`` takes every value from 0 up, once each."""
    n = F.count(F.lit(1))
    at = df.groupBy(*keys, index).agg(n.alias("_c")).groupBy(*keys)
    out = at.agg(
        F.sum("_c").alias("rows"), F.count(index).alias("_d"), F.min(index).alias("_lo"), F.max(index).alias("_hi")
    )
    whole = (F.col("_lo") == 0) & (F.col("_hi") == F.col("rows") - 1) & (F.col("_d") == F.col("rows"))
    return out.select(*keys, "rows", F.coalesce(whole, F.lit(False)).alias("contiguous"))


def emitted_runs(records: DataFrame, chosen: DataFrame | None, keys: list[str]) -> DataFrame:
    """Run records with ``emitted``, ``output_episode_id`` and ``discard_reason``.

    Without ``chosen`` (full mode) every run is part of its episode's output; with it, the
    rows of ``single_substantial_run``, only the chosen run is.
    """
    name = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    none = F.lit(None).cast("string")
    if chosen is None:
        facts = {"emitted": F.lit(True), "output_episode_id": name, "discard_reason": none}
        return records.withColumns(facts)
    out = records.join(chosen.select(*keys, "chosen_run", "reject_reason"), keys, "left")
    taken = F.coalesce(F.col("run") == F.col("chosen_run"), F.lit(False))
    reason = F.when(~taken, F.coalesce("reject_reason", F.lit("singleton")))
    facts = {"emitted": taken, "output_episode_id": F.when(taken, name), "discard_reason": reason}
    return out.withColumns(facts).drop("chosen_run", "reject_reason")


def run_records(df: DataFrame, keys: list[str], pos: str, facts: list[str], run: str = "run") -> DataFrame:
    """One row per run: half-open bounds, size, and first and last value of each fact."""
    first = [F.min_by(c, pos).alias(f"first_{c}") for c in facts]
    last = [F.max_by(c, pos).alias(f"last_{c}") for c in facts]
    return (
        df.filter(F.col(run) >= 0)
        .groupBy(*keys, run)
        .agg(
            F.min(pos).alias("start"),
            (F.max(pos) + 1).alias("end"),
            F.count(F.lit(1)).alias("samples"),
            *first,
            *last,
        )
    )


def single_substantial_run(
    records: DataFrame, keys: list[str], run: str = "run", episodes: DataFrame | None = None
) -> DataFrame:
    """Per key: the only run of two or more samples, or why the key is rejected.

    ``episodes`` has one row per key; those without any run are rejected with a row too.
    """
    big = F.col("samples") >= 2
    picked = F.struct(F.col(run).alias("run"), "start", "end")
    out = records.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(big).alias("substantial"),
        F.min(F.when(big, picked)).alias("_pick"),
    )
    if episodes is not None:
        out = episodes.select(*keys).join(out, keys, "left").fillna(0, ["runs", "substantial"])
    reason = F.when(F.col("runs") == 0, "no_valid_run")
    reason = reason.when(F.col("substantial") == 0, "all_singletons").when(
        F.col("substantial") > 1, "multiple_valid_runs"
    )
    one = F.when(F.col("substantial") == 1, F.col("_pick"))
    return out.select(
        *keys,
        "runs",
        "substantial",
        reason.alias("reject_reason"),
        one["run"].alias("chosen_run"),
        one["start"].alias("chosen_start"),
        one["end"].alias("chosen_end"),
    )


def dedup_keep_last(
    df: DataFrame, keys: list[str], ts: str, row: str, payload: Column, keep: list[str]
) -> DataFrame:
    """One row per instant: the latest by ``row``; ``conflict`` where payloads differ.

    A null payload differs from any other. Pure partial aggregation, so any number of copies
    of one instant is merged map-side. The order of the clock is checked apart, by
    ``monotonic_check`` with ``strict`` off.
    """
    some, all_of = F.count(payload), F.count(F.lit(1))
    return df.groupBy(*keys, ts).agg(
        F.max(row).alias(row),
        *[F.max_by(c, row).alias(c) for c in keep],
        (F.count(F.lit(1)) - 1).alias("duplicates"),
        (F.coalesce(F.min(payload) != F.max(payload), F.lit(False)) | ((some > 0) & (some < all_of))).alias("conflict"),
    )


def segment_ids(s: Series, valid: Column, declared_previous: Column, frame: str) -> Series:
    """``linked`` (row continues the previous one) and ``segment``, which grows where not."""
    s = s.shift({"_pf": F.col(frame)}).with_columns({"_first": F.col("_pf").isNull()})
    linked = ~F.col("_first") & valid & F.coalesce(declared_previous == F.col("_pf"), F.lit(False))
    s = s.with_columns({"linked": linked})
    s = s.cumulate({"segment": (~F.col("linked") & ~F.col("_first")).cast("bigint")})
    return s.map(lambda d: d.drop("_pf", "_first"))


def reuse_flag(s: Series, source: str, name: str = "reused") -> Series:
    s = s.shift({"_prev": F.col(source)})
    return s.with_columns({name: F.coalesce(F.col(source) == F.col("_prev"), F.lit(False))}).map(
        lambda d: d.drop("_prev")
    )


def edge_repeats(s: Series, value: str) -> DataFrame:
    """Per key: repeats of the first and of the last value, and whether any occur between."""
    s = s.shift({"_prev": F.col(value)})
    changed = F.col("_prev").isNotNull() & (F.col(value) != F.col("_prev"))
    s = s.cumulate({"_run": changed.cast("bigint")})
    falls = F.coalesce(F.col(value) < F.col("_prev"), F.lit(False))
    runs = (
        s.frame()
        .groupBy(*s.keys, "_run")
        .agg(F.count(F.lit(1)).alias("_n"), F.count_if(falls).alias("_falls"))
    )
    per_key = runs.groupBy(*s.keys).agg(
        F.sum("_n").alias("rows"),
        F.max("_run").alias("_last"),
        (F.min_by("_n", "_run") - 1).alias("prefix_repeats"),
        F.max_by("_n", "_run").alias("_tail"),
        F.sum(F.col("_n") - 1).alias("_repeats"),
        F.sum("_falls").alias("decreases"),
    )
    suffix = F.when(F.col("_last") == 0, F.lit(0)).otherwise(F.col("_tail") - 1).cast("bigint")
    return per_key.withColumn("suffix_repeats", suffix).select(
        *s.keys,
        "rows",
        "prefix_repeats",
        "suffix_repeats",
        (F.col("_repeats") - F.col("prefix_repeats") - F.col("suffix_repeats")).alias(
            "interior_repeats"
        ),
        "decreases",
    )


def spans(rows: DataFrame, key: str, index: str | None = None, max_rows: int | None = None) -> Series:
    """The (start, end) span of every key in a dense index across keys, as a series in key order,
    with the key's own position as ``index`` if named.

    The running total covers only one row per key; rows are never sorted globally.
    """
    lengths = settle(rows.groupBy(key).agg(F.count(F.lit(1)).alias("length")))
    s = Series.plan(lengths.withColumn("_all", F.lit(1)), ["_all"], [key], max_rows)
    s = s.scan(number=index, total={"to_index": F.col("length")})
    return s.with_columns({"from_index": F.col("to_index") - F.col("length")})


def global_index(s: Series, key: str, pos: str, max_rows: int | None = None):
    """Rows with a dense index across keys, and the (start, end) span of every key."""
    found = spans(s.frame(), key, max_rows=max_rows).frame().select(key, "length", "from_index", "to_index")
    s = s.join_keys(found.select(key, "from_index"))
    s = s.with_columns({"index": F.col("from_index") + F.col(pos)})
    return s.map(lambda d: d.drop("from_index")), found


def cfr_resample(s: Series, ts: str, period: int, row: str, rate: tuple[int, int] = (1, 1)) -> DataFrame:
    """Constant-rate timeline: for each output frame, the last source row at or before it.

    ``rate`` is the playback rate as a fraction: at (2, 1) the source runs twice as fast, so
    an output frame covers twice the source time.

    Each source row emits the frames between its own time and the next row's, so the
    timeline is made where the rows are, with no join on time. The tail lasts the median
    positive delay.
    """
    first = s.frame().groupBy(*s.keys).agg(
        F.min(ts).alias("_t0"), (F.max(ts) - F.min(ts)).alias("_span")
    )
    fast, slow = rate
    if fast < 1 or slow < 1:
        raise ValueError("rate must be positive")
    s = s.scan(previous={"_prev": F.col(ts)}, following={"_next": F.col(ts)})
    delays = s.frame().select(*s.keys, (F.col(ts) - F.col("_prev")).alias("_delay"))
    tail = exact_quantiles(delays.filter("_delay > 0"), s.keys, "_delay", {"_tail": 0.5})
    length = first.join(tail, s.keys, "left")
    tail = F.coalesce("_tail", F.lit(period * fast / slow))
    frames = F.floor((F.col("_span") + tail) * slow / (period * fast) + 0.5)
    length = length.select(*s.keys, "_t0", F.greatest(F.lit(1), frames).alias("_frames"))

    def frame_at(t: Column) -> Column:
        offset = (t - F.col("_t0")) * slow
        return F.call_function("div", offset + F.lit(period * fast - 1), F.lit(period * fast))

    s = s.join_keys(length)
    s = s.with_columns(
        {
            "_lo": frame_at(F.col(ts)),
            "_hi": F.least(frame_at(F.col("_next")), F.col("_frames")),
        }
    ).filter("_lo < _hi")
    return s.frame().select(
        *s.keys, F.explode(F.sequence(F.col("_lo"), F.col("_hi") - 1)).alias("out_frame"), row
    )


def linspace_sample(s: Series, pos: str, most: int = 64) -> Series:
    """At most ``most`` evenly spaced rows per key, positions rounded half to even.

    A row decides from its own position whether one of the evenly spaced points rounds to
    it, so no list of wanted positions is built or joined.
    """
    lengths = s.frame().groupBy(*s.keys).agg(F.count(F.lit(1)).alias("_n"))
    s = s.join_keys(lengths)
    guess = F.floor(F.col(pos) * (most - 1) / (F.col("_n") - 1))
    hit = F.lit(False)
    for step in (0, 1):
        point = (guess + step) * (F.col("_n") - 1) / F.lit(most - 1)
        inside = (guess + step) <= most - 1
        hit = hit | (inside & (F.bround(point).cast("bigint") == F.col(pos)))
    return s.filter((F.col("_n") <= most) | F.coalesce(hit, F.lit(False))).map(
        lambda d: d.drop("_n")
    )


def head_rows(s: Series, n: int) -> Series:
    return s.number("_row").filter(F.col("_row") < n).map(lambda d: d.drop("_row"))
