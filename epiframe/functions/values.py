"""Small column expressions over single values, flags, packets and vectors."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The form of an episode id, and the words of a flag.
EPISODE_ID = r"\A\d{8}_\d{6}_\d+_\d+\z"
TRUE_WORDS = ("1", "true", "yes")
FALSE_WORDS = ("0", "false", "no")
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def micros(ts: Column) -> Column:
    """Integer microseconds of a zone-free timestamp, whatever the session time zone."""
    instant = F.unix_micros(ts.cast("timestamp"))
    if SparkSession.active().conf.get("spark.sql.session.timeZone") in UTC_NAMES:
        return instant
    seconds = F.unix_date(ts.cast("date")) * F.lit(86_400).cast("bigint")
    seconds = seconds + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    # zones differ by whole seconds, so the fraction may be taken in any of them
    fraction = F.pmod(instant, F.lit(1_000_000))
    return seconds * 1_000_000 + fraction


def r6(x: Column) -> Column:
    """Six decimals without negative zero, for comparing doubles across engines."""
    return F.round(x, 6) + F.lit(0.0)


def resolve_column(df: DataFrame, candidates: list[str], requested: str | None = None) -> str:
    """The requested column, or else the first candidate the table has."""
    if requested is not None:
        if requested not in df.columns:
            raise ValueError(f"column {requested!r} is missing")
        return requested
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of {candidates} is a column")


def matched_flag(df: DataFrame, mode: str, default: str = "pose_matched") -> Column:
    """``none``: all rows count as matched; ``auto``: use the flag column if present."""
    if mode == "none" or (mode == "auto" and default not in df.columns):
        return F.lit(True)
    return parse_flag(F.col(resolve_column(df, [default], None if mode == "auto" else mode)))


def first_integer(*cols: Column) -> Column:
    """First column holding an integer; blank and malformed text is skipped."""
    return F.coalesce(*[F.trim(c.cast("string")).try_cast("bigint") for c in cols])


def parse_flag(c: Column, strict: bool = True) -> Column:
    word = F.lower(F.trim(c.cast("string")))
    flag = F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    if not strict:
        return flag
    bad = F.raise_error(F.concat(F.lit("not a boolean flag: "), F.coalesce(word, F.lit("null"))))
    return flag.otherwise(bad.cast("boolean"))


def channel_of(side: Column, mapping: str) -> Column:
    """Source channel that feeds a physical side."""
    if mapping == "identity":
        return side
    if mapping == "swapped":
        return F.when(side == "left", "right").when(side == "right", "left")
    raise ValueError(f"unsupported mapping {mapping}")


def decode_packet(text: Column, arity: int = 25, keep: int = 6, divisor: float = 10.0) -> Column:
    """First ``keep`` of ``arity`` semicolon-joined integers, in degrees; error on other arity."""
    parts = F.split(text, ";")
    message = F.concat(F.lit(f"expected {arity} values: "), text)
    checked = F.when(F.size(parts) == arity, parts).otherwise(
        F.raise_error(message).cast("array<string>")
    )
    return F.transform(F.slice(checked, 1, keep), lambda x: x.cast("int") / F.lit(divisor))


def quantile_scale(x: Column, low: Column, high: Column, epsilon: float = 1e-6) -> Column:
    return F.lit(2.0) * (x - low) / (high - low + F.lit(epsilon)) - F.lit(1.0)


def quantile_unscale(y: Column, low: Column, high: Column, epsilon: float = 1e-6) -> Column:
    return (y + F.lit(1.0)) / F.lit(2.0) * (high - low + F.lit(epsilon)) + low


def state_bin(x: Column, bins: int = 256) -> Column:
    """Index of the bin of ``x`` over [-1, 1]; -1 below the range, ``bins - 1`` above."""
    half = bins // 2
    raw = F.floor(x * F.lit(float(half))) + F.lit(half)
    return F.greatest(F.lit(-1), F.least(F.lit(bins - 1), raw)).cast("bigint")


def zero_pad(v: Column, width: int) -> Column:
    return F.concat(v, F.array_repeat(F.lit(0.0), F.lit(width) - F.size(v)))


def crop_right_half(width: Column, height: Column) -> Column:
    """(x, y, w, h) of the right image of a side-by-side frame; null where it cannot be cut."""
    fits = (width > 0) & (height > 0) & (F.pmod(width, F.lit(4)) == 0) & (
        F.pmod(height, F.lit(2)) == 0
    )
    half = F.floor(width / 2)
    return F.when(
        fits,
        F.struct(
            half.alias("x"), F.lit(0).cast("bigint").alias("y"), half.alias("w"), height.alias("h")
        ),
    )


def letterbox(width: Column, height: Column, box_w: int, box_h: int) -> Column:
    """Size that fits the box at the same aspect, nearest pixel, and the padding left and top."""

    def nearest(a: Column, b: Column) -> Column:
        return F.call_function("div", a * 2 + b, b * 2)

    w = F.least(F.lit(box_w).cast("bigint"), nearest(width * box_h, height))
    h = F.least(F.lit(box_h).cast("bigint"), nearest(height * box_w, width))
    return F.struct(
        w.alias("w"),
        h.alias("h"),
        F.call_function("div", F.lit(box_w) - w, F.lit(2)).alias("pad_x"),
        F.call_function("div", F.lit(box_h) - h, F.lit(2)).alias("pad_y"),
    )


def episode_id_parts(c: Column) -> Column:
    """Date, time and the two counters of an episode id; null where the id is malformed."""
    part = [F.regexp_extract(c, r"^(\d{8})_(\d{6})_(\d+)_(\d+)$", i) for i in range(1, 5)]
    names = ("date", "time", "major", "minor")
    return F.when(c.rlike(EPISODE_ID), F.struct(*[p.alias(n) for p, n in zip(part, names)]))


def trash_name_parts(c: Column) -> Column:
    """Episode, stamp and nonce of a quarantine name; null where the name is malformed."""
    pattern = r"^(\d{8}_\d{6}_\d+_\d+)__(\d{8}T\d{6}\.\d{6}Z)__([0-9a-f]{8})$"
    part = [F.regexp_extract(c, pattern, i) for i in range(1, 4)]
    names = ("episode", "stamp", "nonce")
    return F.when(c.rlike(pattern), F.struct(*[p.alias(n) for p, n in zip(part, names)]))
