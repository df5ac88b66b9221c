"""Quality rules: plain counts and a calibrated logistic regression on hashed n-grams.

The model sees hashed words, word pairs and sequences of four code points, each as the mean
weight over its family. It is trained by one task on a bounded sample of labelled documents
(``SAMPLE`` per class, the smallest hashes of their ids), a fifth of which is held out to fit
a probability by Platt scaling, weighted to the class shares of all labels. Documents are
scored in Arrow batches; one is kept if it passes the plain rules and its probability of
being good is at least ``KEEP``.

Defined results
* A null text has no words and fails the plain rules. A null doc_id is scored like any other.
* Labels that are null or not 0/1 are ignored; with several labels for one doc_id the lowest
  counts. Without labelled documents of both classes there is no model: the plain rules
  decide and p_good is null.
* Repeated rows give repeated results, an empty table an empty one. Other columns are kept
  by ``passing`` and ignored by ``quality``.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import query, table
from epiframe.llm.scan import BLOCK, SPACE, Texts, U, as_bytes, batches, mixed, windows

SAMPLE = 1500
BITS = 17
KEEP = 0.25
BATCH = 1 << 18
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
GRAM = 4

COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[list(SYMBOLS)] = 1


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split(b"\n")
    if len(lines) == len(set(lines)):
        return 0
    return sum(n - 1 for line, n in Counter(lines).items() if n > 1 and line.strip())


def repeat_words(text: bytes) -> int:
    """Words within a window that occurs twice or more."""
    words = text.split()
    found = list(zip(*(words[i:] for i in range(WINDOW))))
    times, covered, upto = Counter(found), 0, 0
    for at, w in enumerate(found):
        if times[w] > 1:
            covered += at + WINDOW - max(at, upto)
            upto = at + WINDOW
    return covered


def inside(t: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the k-word windows that lie within one text, and that text."""
    n = max(0, len(t.start) - k + 1)
    text = np.repeat(np.arange(len(t.word) - 1, dtype=np.int32), np.diff(t.word))[:n]
    at = np.flatnonzero(np.arange(n) + k <= t.word[text + 1])
    return at, text[at]


def counts(texts: list[bytes], t: Texts, words: np.ndarray) -> list[np.ndarray]:
    """The plain counts. Windows that recur by hash are counted again on the words themselves."""
    lead = leads(t.data) & ~SPACE[t.data]
    at, text = inside(t, WINDOW)
    keys = windows(words, WINDOW)[at] ^ mixed(text.astype(U))
    order = np.argsort(keys)
    twin = np.flatnonzero(keys[order][1:] == keys[order][:-1])
    repeats = np.zeros(len(texts), np.int64)
    for i in np.unique(text[order[twin]]):
        repeats[i] = repeat_words(texts[i])
    return [
        np.diff(t.word),
        t.totals(lead),
        t.totals(_SYMBOL[t.data]),
        np.array([dup_lines(x) for x in texts], np.int64),
        repeats,
    ]


def leads(data: np.ndarray) -> np.ndarray:
    """Which bytes begin a code point."""
    return (data & 0xC0) != 0x80


def family_sizes(t: Texts) -> list[np.ndarray]:
    """Number of words, word pairs and character sequences of each text."""
    n, length = np.diff(t.word), t.totals(leads(t.data)) - 1  # without the line feed
    return [n, np.maximum(n - 1, 0), np.maximum(length - GRAM + 1, 0)]


def families(t: Texts, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(family, feature, text) of every word, word pair and character sequence, in blocks."""
    shift = U(64 - BITS)
    for k in (1, 2):
        at, text = inside(t, k)
        found = words if k == 1 else windows(words, 2)
        yield k - 1, (found[at] >> shift).astype(np.int64) + ((k - 1) << BITS), text
    for a in range(0, len(t.data), BLOCK):
        z = min(len(t.data), a + BLOCK)
        d = t.data[a : z + 4 * GRAM]  # a window that begins in the block, and the byte after it
        at = np.flatnonzero(leads(d))
        stop = np.append(at[1:], len(d))
        point = np.zeros(len(at), U)  # the bytes of each code point
        for i in range(4):
            here = np.flatnonzero(at + i < stop)
            point[here] |= d[at[here] + i].astype(U) << U(8 * i)
        n = min(int(np.searchsorted(at, z - a)), max(0, len(at) - GRAM))
        begin, end = at[:n] + a, at[GRAM : n + GRAM] + a
        text = np.searchsorted(t.first, begin, "right") - 1
        within = np.flatnonzero(end < t.first[text + 1])  # the line feed after a text may follow
        grams = windows(point, GRAM)[within]
        yield 2, (grams >> shift).astype(np.int64) + (2 << BITS), text[within]


def logits(t: Texts, words: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    sizes, z = family_sizes(t), np.full(len(t.first) - 1, bias)
    for family, feature, text in families(t, words):
        z += np.bincount(text, weights[feature], len(z)) / np.maximum(sizes[family], 1)
    return z


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(texts: list[bytes], y: np.ndarray, shares: np.ndarray, steps: int = 80, l2: float = 1e-6):
    """(weights, bias, slope, offset); every fifth text is held out to calibrate."""
    held = np.arange(len(y)) % 5 == 4
    parts = []  # (texts, row, feature, value) of each batch
    for s in batches([len(x) for x in texts], BATCH):
        t = Texts(texts[s])
        found = []
        sizes = family_sizes(t)
        for family, f, text in families(t, t.word_hashes()):
            key, times = np.unique(text.astype(np.int64) << (BITS + 2) | f, return_counts=True)
            row, feature = key >> (BITS + 2), key & ((1 << (BITS + 2)) - 1)
            found.append((row.astype(np.int32), feature.astype(np.int32), (times / sizes[family][row]).astype(np.float32)))
        parts.append((s, *map(np.concatenate, zip(*found))))
    each = np.where(held, 0, 1.0) / max(1, (~held).sum())
    w, b = np.zeros(3 << BITS), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, steps + 1):  # Adam on the whole sample
        g, gb = l2 * w, 0.0
        for s, row, feature, value in parts:
            z = np.bincount(row, w[feature] * value, s.stop - s.start) + b
            error = (sigmoid(z) - y[s]) * each[s]
            g += np.bincount(feature, error[row] * value, len(w))
            gb += error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix, fix2 = 1 - 0.9**step, 1 - 0.999**step
        w -= 0.5 * (m / fix) / (np.sqrt(v / fix2) + 1e-12)
        b -= 0.1 * (mb / fix) / (np.sqrt(vb / fix2) + 1e-12)
    z = np.concatenate([np.bincount(row, w[feature] * value, s.stop - s.start) for s, row, feature, value in parts]) + b
    check = held if len(set(y[held])) == 2 else ~held
    z, target = z[check], y[check]
    weight = np.where(target == 1, shares[1] / max(1, (target == 1).sum()), shares[0] / max(1, (target == 0).sum()))
    # Platt's targets keep the slope finite where the classes part cleanly
    soft = np.where(target == 1, ((target == 1).sum() + 1) / ((target == 1).sum() + 2), 1 / ((target == 0).sum() + 2))
    scale = max(1e-9, np.abs(z).max())
    x = np.stack([z / scale, np.ones_like(z)])
    ab = np.zeros(2)
    for _ in range(50):  # Newton
        p = sigmoid(ab @ x)
        grad = x @ (weight * (p - soft)) + 1e-9 * ab
        hess = (x * (weight * p * (1 - p))) @ x.T + 1e-9 * np.eye(2)
        ab = ab - np.clip(np.linalg.solve(hess, grad), -5, 5)
    return w.astype(np.float32), b, ab[0] / scale, ab[1]


def labelled(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, list[int]]:
    """The sample's texts with ``y``, and the number of labelled ids of each class."""
    y = F.col("quality").cast("int")
    ids = labels.filter(y.isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(y).alias("y"))
    shares = {r.y: r.n for r in ids.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("doc_id", F.lit("quality sample"))
    parts = [ids.filter(F.col("y") == k).orderBy(order, "doc_id").limit(per_class) for k in (0, 1)]
    sample = parts[0].unionByName(parts[1])  # at most 2 * per_class ids
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    return rows, [shares.get(0, 0), shares.get(1, 0)]


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE):
    """The fitted model, or None without two classes. One task fits it on the sample."""
    rows, shares = labelled(docs, labels, per_class)
    if not all(shares):
        return None

    def task(frame):
        import pandas as pd

        frame = frame.sort_values(["order", "doc_id"]).reset_index(drop=True)
        texts = [(x or "").encode() for x in frame["text"]]
        y = frame["y"].to_numpy()
        if len(set(y)) < 2:
            return pd.DataFrame({"weights": [], "rest": []})
        w, *rest = fit(texts, y, np.array(shares) / sum(shares))
        return pd.DataFrame({"weights": [w.tobytes()], "rest": [np.array(rest, float).tobytes()]})

    # one row per id before they meet, however often it is repeated
    rows = rows.groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("y").alias("y"))
    rows = rows.withColumn("order", F.xxhash64("doc_id", F.lit("order")))
    row = rows.groupBy(F.lit(0).alias("all")).applyInPandas(task, "weights binary, rest binary").first()
    return None if row is None else (np.frombuffer(row.weights, np.float32), *np.frombuffer(row.rest))


def scorer(model):
    """An Arrow function of a text column: counts and the probability of being good."""

    @F.arrow_udf(f"struct<{COUNTS.replace(' bigint', ':bigint').replace(', ', ',')},p_good:double>")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in parts:
            column = as_bytes(column)
            out = []
            for s in batches(pa.compute.binary_length(column).to_pylist(), BATCH):
                texts = column.slice(s.start, s.stop - s.start).to_pylist()
                t = Texts(texts)
                words = t.word_hashes()
                found = counts(texts, t, words)
                if model is None:
                    found.append(np.full(len(texts), np.nan))
                else:
                    weights, bias, slope, offset = model
                    found.append(sigmoid(slope * logits(t, words, weights, bias) + offset))
                out.append(found)
            columns = [np.concatenate(x) for x in zip(*out)] if out else [[]] * 6
            kinds = [pa.int64()] * 5 + [pa.float64()]
            arrays = [pa.array(c, k, from_pandas=True) for c, k in zip(columns, kinds)]
            yield pa.StructArray.from_arrays(arrays, [c.split()[0] for c in COUNTS.split(", ")] + ["p_good"])

    return score


def verdicts(s: str, keep: float) -> dict:
    n, repeats = F.col(f"{s}.n_words"), F.col(f"{s}.n_repeat_words")
    failed = (n < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n)
    return {"base_failed": failed, "kept": ~failed & (F.coalesce(F.col(f"{s}.p_good"), F.lit(1.0)) >= keep)}


def quality(docs: DataFrame, labels: DataFrame, keep: float = KEEP, per_class: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, the counts, p_good, base_failed, kept."""
    scored = docs.select("doc_id", scorer(train(docs, labels, per_class))("text").alias("s"))
    return scored.select("doc_id", "s.*", *[c.alias(n) for n, c in verdicts("s", keep).items()])


def passing(docs: DataFrame, labels: DataFrame, keep: float = KEEP, per_class: int = SAMPLE) -> DataFrame:
    """The documents that are kept, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, scorer(train(docs, labels, per_class))("text").alias("s"))
    return rows.filter(verdicts("s", keep)["kept"]).select("row.*")


@query("op4_quality_rules")
def op4_quality_rules(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
