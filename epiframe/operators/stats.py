"""Vector statistics, exact quantiles, mergeable summaries and histograms."""

import math
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from epiframe.plans.series import Series, few
from epiframe.plans.shared import settle


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_c")
    )


def quantiles_of_counts(
    counts: DataFrame,
    keys: list[str],
    value: str,
    points: Mapping[str, float],
    max_rows: int | None = None,
) -> DataFrame:
    """Quantiles with linear interpolation from a table of distinct values and counts."""
    s = Series.plan(counts, keys, [value], max_rows).cumulate({"_upto": F.col("_c")})
    if s.hot is None:  # the total is in reach of the same exchange
        rows = s.cold.withColumn("_n", F.sum("_c").over(W.partitionBy(*keys)))
    else:
        rows = s.join_keys(s.frame().groupBy(*keys).agg(F.max("_upto").alias("_n"))).frame()
    aggs = []
    for name, q in points.items():
        at = (F.col("_n") - 1) * F.lit(float(q))
        low, high = F.floor(at), F.ceil(at)
        v = F.col(value).cast("double")
        aggs += [
            F.min(F.when(F.col("_upto") > low, v)).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_upto") > high, v)).alias(f"_hi_{name}"),
            F.first(at - low).alias(f"_w_{name}"),
        ]
    out = rows.groupBy(*keys).agg(*aggs)
    return out.select(
        *keys,
        *[
            (
                F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")
            ).alias(n)
            for n in points
        ],
    )


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    points: Mapping[str, float],
    max_rows: int | None = None,
) -> DataFrame:
    """Exact quantiles, one column per name in ``points``.

    Counts per distinct value are merged map-side, then a running count in value order
    gives the ranks. The running count is a blocked scan, so a key with any number of
    values never sits in one task or one aggregation buffer.
    """
    return quantiles_of_counts(value_counts(df, keys, value), keys, value, points, max_rows)


#: Buckets for each doubling of a value, and the shift that keeps their numbers above zero.
PER_OCTAVE = 256
ABOVE_ZERO = 300_000
#: Parts that a bucket is cut into where it holds too many rows to count its values.
CUTS = 4096
COUNTED_ROWS = 4_000_000


def value_bucket(v: Column) -> Column:
    """A number that never falls as the value grows: its sign and logarithm in 1/256 octaves,
    at most 1.1 million different ones; infinities and NaN have their own."""
    size = F.floor(F.ln(F.abs(v)) * F.lit(PER_OCTAVE / math.log(2))) + F.lit(ABOVE_ZERO)
    side = F.when(v < 0, F.lit(-1)).otherwise(F.lit(1))
    return (
        F.when(F.isnan(v), F.lit(1 << 41))
        .when(v == 0, F.lit(0))
        .when(F.abs(v) == F.lit(float("inf")), side * F.lit(1 << 40))
        .otherwise(side * size)
        .cast("bigint")
    )


def _ranked(hist: DataFrame, group: list[str], order: str, before: Column, ranks: Column) -> DataFrame:
    """Buckets (n, lo, hi in ``order``) that hold wanted ranks, with the rows before them."""
    w = W.partitionBy(*group).orderBy(order)
    upto = before + F.sum("n").over(w.rowsBetween(W.unboundedPreceding, 0))
    # proves for these data what the choice rests on: later buckets have larger values
    fine = F.coalesce(F.lag("hi").over(w) < F.col("lo"), F.lit(True))
    upto = F.when(fine, upto).otherwise(F.raise_error(F.lit("buckets out of order")).cast("bigint"))
    out = hist.withColumn("_upto", upto).withColumn("_want", ranks)
    out = out.withColumn("_want", F.filter("_want", lambda r: (r >= F.col("_upto") - F.col("n")) & (r < F.col("_upto"))))
    return out.filter(F.size("_want") > 0).withColumn("_before", F.col("_upto") - F.col("n")).drop("_upto")


def bucket_value(b: Column) -> Column:
    """A value in or next to a bucket of finite values."""
    size = F.exp((F.abs(b) - F.lit(ABOVE_ZERO)) * F.lit(math.log(2) / PER_OCTAVE))
    return F.when(b == 0, F.lit(0.0)).otherwise(F.signum(b) * size)


def selected_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    points: Mapping[str, float],
    counted_rows: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Exact quantiles, mean, population std and count for few keys with many values.

    Selection by histograms: the first pass counts values by ``value_bucket``, together with
    moments, and knows exactly which buckets hold the wanted ranks. Only rows of these buckets
    are looked at again. If they are still more than can be counted value by value, the buckets
    are cut into equal parts and counted once more; a part holds the ends of its values, so
    every round either shrinks it or ends with a single value. Nothing is estimated, and the
    order of the buckets is checked on the data.

    With ``weight``, a whole number, a row counts as so many equal rows. Squares are then taken
    about a value of the bucket, so std is right to 1e-10 of the largest magnitude.
    """
    counted_rows = counted_rows or COUNTED_ROWS
    v = F.col(value).cast("double")
    df = df.filter(v.isNotNull()).select(*keys, (v + 0.0).alias("_v"), *([weight] if weight else []))
    v, n = F.col("_v"), F.count(F.lit(1))
    moments = {"_m": F.avg(v), "_s": F.var_pop(v)}
    if weight:
        df, n, w = df.filter(F.col(weight) > 0), F.sum(weight), F.col(weight)
        off = v - bucket_value(F.col("_b"))
        moments = {"_m": F.sum(w * off) / n, "_s": F.sum(w * off * off) / n}
    size = [n.alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")]
    cut = df.withColumn("_b", value_bucket(v))
    hist = cut.groupBy(*keys, "_b").agg(*size, *[c.alias(name) for name, c in moments.items()])
    if weight:
        spread = F.greatest(F.lit(0.0), F.col("_s") - F.col("_m") * F.col("_m"))
        hist = hist.withColumns({"_s": spread, "_m": F.col("_m") + bucket_value(F.col("_b"))})
    hist = settle(hist)
    all_of = W.partitionBy(*keys)
    rows = hist.withColumn("_n", F.sum("n").over(all_of))
    rows = rows.withColumn("_mean", F.sum(F.col("n") * F.col("_m")).over(all_of) / F.col("_n"))
    second = F.sum(F.col("n") * (F.col("_s") + F.pow(F.col("_m") - F.col("_mean"), 2)))
    facts = rows.groupBy(*keys).agg(
        F.first("_mean").alias("mean"), F.sqrt(second / F.first("_n")).alias("std"), F.first("_n").alias("n")
    )

    def places(n: str) -> dict[str, Column]:
        return {name: (F.col(n) - 1) * F.lit(float(q)) for name, q in points.items()}

    at = places("n")
    ranks = F.array_distinct(F.array(*[f(a).cast("bigint") for a in places("_n").values() for f in (F.floor, F.ceil)]))
    here = _ranked(rows, keys, "_b", F.lit(0), ranks)
    here = settle(here.select(*keys, "n", "lo", "hi", "_before", "_want"))
    found = []
    while True:
        same = F.coalesce(F.col("lo") == F.col("hi"), F.lit(False))
        found.append(here.filter(same).select(*keys, F.explode("_want").alias("_r"), F.col("lo").alias("_x")))
        here = here.filter(~same)
        left = here.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("buckets")).first()
        if not left["rows"]:
            break
        targets = here.select(*keys, "lo", "hi", "_before", "_want").withColumnsRenamed({"lo": "_lo", "hi": "_hi"})
        inside = df.join(few(targets, left["buckets"]), keys).filter((v >= F.col("_lo")) & (v <= F.col("_hi")))
        few_rows = left["rows"] <= counted_rows
        part = v if few_rows else F.floor((v - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * CUTS)
        group = [*keys, "_lo"]
        hist = inside.groupBy(*group, "_before", "_want", part.alias("_b")).agg(*size)
        here = _ranked(hist, group, "_b", F.col("_before"), F.col("_want"))
        here = settle(here.select(*keys, "n", "lo", "hi", "_before", "_want"))
    values = reduce(DataFrame.unionByName, found).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_r", "_x"))).alias("_at")  # two values a point
    )
    out = facts.join(values, keys)
    low = {name: F.col("_at")[F.floor(a).cast("bigint")] for name, a in at.items()}
    high = {name: F.col("_at")[F.ceil(a).cast("bigint")] for name, a in at.items()}
    cols = {name: low[name] + (high[name] - low[name]) * (a - F.floor(a)) for name, a in at.items()}
    return out.withColumns(cols).drop("_at")


def vector_stats(df: DataFrame | Series, keys: list[str], vector: str, dims: int | None = None) -> DataFrame:
    """Long form: per key and dimension min, max, mean, population std and count.

    With the number of dimensions known, a key sends one wide row through the exchange
    and is unfolded after it. That row has eight numbers per dimension, so where the rows of a
    key lie apart it is the rows themselves that should be sent: of a series over ``keys``,
    those of ordinary keys are, and only those of hot keys are summed up before the exchange.
    """
    if isinstance(df, Series):
        out = vector_stats(df.cold.select(*keys, vector).repartition(*keys), keys, vector, dims)
        return out if df.hot is None else out.unionByName(vector_stats(df.hot, keys, vector, dims))
    if dims is None:
        flat = df.select(*keys, F.posexplode(vector).alias("dim", "x"))
        return scalar_stats(flat, [*keys, "dim"], "x")
    aggs, entries = [], []
    for i in range(dims):
        v = F.get(vector, F.lit(i)).cast("double")
        parts = {"min": F.min(v), "max": F.max(v), "mean": F.avg(v), "std": F.stddev_pop(v),
                 "n": F.count(v)}
        aggs += [a.alias(f"_{n}{i}") for n, a in parts.items()]
        entries.append(F.struct(F.lit(i).alias("dim"), *[F.col(f"_{n}{i}").alias(n) for n in parts]))
    return df.groupBy(*keys).agg(*aggs).select(*keys, F.inline(F.array(*entries)))


def scalar_stats(flat: DataFrame, keys: list[str], x: str) -> DataFrame:
    v = F.col(x).cast("double")
    return flat.groupBy(*keys).agg(
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("std"),
        F.count(v).alias("n"),
    )


def masked_vector_stats(
    rows: DataFrame,
    vectors: Mapping[str, str],
    slots: Mapping[str, tuple[str, str]],
    repeated: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Per name and dimension: mean, population std, q01 and q99, all exact, in doubles.

    ``vectors`` maps a name to a vector column. ``slots`` maps a name to an array of slot
    vectors and its padding mask; padded slots are left out. ``repeated`` maps a name to a
    vector column and a column with the number of times it counts. A NaN or infinity is an
    error. The rows are unfolded in two passes that aggregate where they are: what is shuffled does
    not grow with the horizon but for the values next to a quantile.
    """
    repeated = repeated or {}
    single = [*vectors.values(), *(v for v, _ in repeated.values())]
    masks = [F.array(F.lit(False))] * len(single) + [F.col(m) for _, m in slots.values()]
    parts = {
        "key": [F.array(F.lit(n)) for n in [*vectors, *repeated]]
        + [F.array_repeat(F.lit(n), F.size(v)) for n, (v, _) in slots.items()],
        "v": [F.array(c) for c in single] + [F.col(v) for v, _ in slots.values()],
        "pad": masks,
    }
    if repeated:
        one = F.lit(1).cast("bigint")
        parts["times"] = (
            [F.array(one)] * len(vectors)
            + [F.array(F.col(c).cast("bigint")) for _, c in repeated.values()]
            + [F.array_repeat(one, F.size(v)) for v, _ in slots.values()]
        )
    real = rows.select(F.inline(F.arrays_zip(*[F.concat(*c).alias(n) for n, c in parts.items()]))).filter(~F.col("pad"))
    times = ["times"] if repeated else []
    if repeated:
        real = real.filter("times > 0")
    flat = real.select("key", F.posexplode("v").alias("dim", "x"), *times)
    x = F.col("x").cast("double")
    finite = ~(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    checked = F.when(finite, x).otherwise(F.raise_error(F.lit("non-finite value")).cast("double"))
    keys = ["key", "dim"]
    flat = flat.select(*keys, checked.alias("x"), *times)
    return selected_quantiles(flat, keys, "x", {"q01": 0.01, "q99": 0.99}, weight=times[0] if times else None)


def future_stats(rows: DataFrame, vector: str, horizon: int, pos: str) -> DataFrame:
    """``masked_vector_stats`` of the vectors ("state") and of all real slots of their chunks of
    the next ``horizon`` vectors ("actions"), without building the chunks.

    The row at position p lies in the chunks of the min(p, horizon) rows before it, so its
    values count so often: work and storage are the same for every horizon.
    """
    if horizon < 1:
        raise ValueError("horizon must be 1 or more")
    rows = rows.withColumn("_in", F.least(F.col(pos), F.lit(horizon)))
    return masked_vector_stats(rows, {"state": vector}, {}, {"actions": (vector, "_in")})


def merge_stats(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Combine rows of (min, max, mean, std, n) into one per key.

    Squared deviations are taken about the pooled mean in a second pass over the statistics
    table, which avoids the cancellation of a difference of squares. The table is written once;
    few means are handed to its rows where they are, so no task gets all rows of a key.
    """
    stats = settle(stats)
    pooled = settle(stats.groupBy(*keys).agg((F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("_m")))
    joined = stats.join(few(pooled, pooled.count()), keys)
    second = F.col("n") * (F.col("std") * F.col("std") + F.pow(F.col("mean") - F.col("_m"), 2))
    return joined.groupBy(*keys).agg(
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.first("_m").alias("mean"),
        F.sqrt(F.sum(second) / F.sum("n")).alias("std"),
        F.sum("n").alias("n"),
    )


def build_histogram(df: DataFrame, channel: Column, level: Column) -> DataFrame:
    return df.groupBy(channel.alias("channel"), level.alias("level")).agg(
        F.count(F.lit(1)).alias("count")
    )


def histogram_stats(hist: DataFrame, scale: float = 255.0) -> DataFrame:
    """min, max, mean and centred std of level / scale, per channel, from counts alone."""
    x = F.col("level") / F.lit(scale)
    centre = hist.groupBy("channel").agg((F.sum(F.col("count") * x) / F.sum("count")).alias("mean"))
    present = F.when(F.col("count") > 0, x)
    return (
        hist.join(centre, "channel")
        .groupBy("channel")
        .agg(
            F.min(present).alias("min"),
            F.max(present).alias("max"),
            F.first("mean").alias("mean"),
            F.sqrt(
                F.sum(F.col("count") * F.pow(x - F.col("mean"), 2)) / F.sum("count")
            ).alias("std"),
            F.sum("count").alias("n"),
        )
    )


def exposure_flags(hist: DataFrame, keys: list[str]) -> DataFrame:
    """Brightness summary of a 0..255 histogram, with DARK / BRIGHT / LOW_CONTRAST flags."""
    c, v = F.col("count"), F.col("level").cast("double")
    n = F.sum(c)
    centre = hist.groupBy(*keys).agg((F.sum(c * v) / n).alias("mean"))
    out = (
        hist.join(centre, keys)
        .groupBy(*keys)
        .agg(
            F.first("mean").alias("mean"),
            F.sqrt(F.sum(c * F.pow(v - F.col("mean"), 2)) / n).alias("std"),
            (F.sum(F.when(v < 16, c).otherwise(0)) / n).alias("dark_fraction"),
            (F.sum(F.when(v >= 240, c).otherwise(0)) / n).alias("bright_fraction"),
        )
    )
    flags = F.array_compact(
        F.array(
            F.when((F.col("mean") < 35) | (F.col("dark_fraction") > 0.65), "DARK"),
            F.when((F.col("mean") > 220) | (F.col("bright_fraction") > 0.65), "BRIGHT"),
            F.when(F.col("std") < 20, "LOW_CONTRAST"),
        )
    )
    return out.withColumn("flags", flags)


def masked_mean(df: DataFrame, keys: list[str], value: Column, padded: Column) -> DataFrame:
    """Mean over unpadded slots; 0 where a group is all padding."""
    real = ~padded
    total, n = F.sum(F.when(real, value)), F.count_if(real)
    return df.groupBy(*keys).agg(
        F.coalesce(total / F.nullif(n, F.lit(0)), F.lit(0.0)).alias("masked_mean"),
        n.alias("real_slots"),
    )


def image_error(a: DataFrame, b: DataFrame, pixel: list[str], value: str, peak: float) -> DataFrame:
    """MSE, MAE and PSNR of two pixel tables joined on the pixel key; PSNR infinite if equal.

    ``one_sided`` counts pixels that one image lacks or has as null; with any, the images
    differ in shape and the errors are null.
    """
    diff = F.col(f"a.{value}") - F.col(f"b.{value}")
    pairs = a.alias("a").join(b.alias("b"), pixel, "full").select(diff.cast("double").alias("_d"))
    out = pairs.agg(
        F.count_if(F.col("_d").isNull()).alias("one_sided"),
        F.avg(F.col("_d") * F.col("_d")).alias("_mse"),
        F.avg(F.abs("_d")).alias("_mae"),
    )
    whole = F.col("one_sided") == 0
    out = out.select(
        "one_sided", F.when(whole, F.col("_mse")).alias("mse"), F.when(whole, F.col("_mae")).alias("mae")
    )
    psnr = F.when(F.col("mse") == 0, F.lit(float("inf"))).otherwise(
        F.lit(10.0) * F.log10(F.lit(peak * peak) / F.col("mse"))
    )
    return out.withColumn("psnr", psnr)
