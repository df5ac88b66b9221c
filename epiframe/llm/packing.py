"""Best-fit packing of token sequences, in rounds over a tree of partitions.

Texts are encoded in Arrow batches; only lengths and checksums leave the tasks. A document
longer than a sequence is cut into pieces of full length, all but the first, which takes the
rest; a full piece is a sequence of its own. The other pieces are dealt at random into groups
of about ``GROUP``, and each group packs its pieces best-fit, longest first. After that any
two bins of a group are too long for each other, so at most one is half full or less, and
every later merge needs such a bin. Each group therefore emits its bins, but for that one
and its ``FAN`` emptiest others; these travel up a tree as items of their own, where groups
of ``FAN`` groups are packed best-fit again, until one group is left. No task sees more than
a group's pieces or FAN * (FAN + 1) bins.

Defined results
* A null text is an empty one; its only id is the end mark, so every document has a piece.
* Repeated rows and null doc_ids are packed like any others. An empty table gives an empty
  result. Other columns are ignored.
* Special strings within a text are handled as the library does by default.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import compact, query, settle, small, table
from epiframe.llm.scan import batches
from epiframe.llm.token_counts import PIECE, pieces

LENGTH = 2048
END = 0
GROUP = 16_384
FAN = 16
NEARLY = 8
BATCH = 1 << 20
_encoders: dict = {}


def encoder(vocabulary: str = "byte_bpe_50k"):
    """A function from text to token ids, equal to the library's for ``vocabulary``.json.

    The same merges are run by the faster rank encoder where both split a text alike: in
    Latin text, whose letter, number and space classes are the same in all Unicode versions,
    and in pieces short enough for its splitting. Other pieces go to the library itself.
    """
    if vocabulary not in _encoders:
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        marks = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
        fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=marks)

        def latin(text: str) -> bool:
            return text.isascii() or int(np.frombuffer(text.encode(), np.uint8).max()) < 0xCA  # up to U+027F

        def piece(text: str) -> np.ndarray:
            if len(text) <= 2 * PIECE and latin(text):
                return fast.encode_to_numpy(text, allowed_special="all")
            return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)

        def encode(text: str) -> np.ndarray:
            parts = [piece(p) for p in pieces(text)] if text else []
            return np.concatenate([*parts, np.array([END], np.uint32)])

        _encoders[vocabulary] = encode
    return _encoders[vocabulary]


def cut(n: int, length: int = LENGTH) -> list[int]:
    """Where the pieces of n ids begin, and the end."""
    first = n % length or length
    return [0, *range(first, n + 1, length)] if n > length else [0, n]


def encoded(docs: DataFrame) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder()
        for batch in parts:
            sizes = pa.compute.binary_length(batch.column(1)).fill_null(0).to_pylist()
            for s in batches(sizes, BATCH):
                owner, rows = [], []
                for i, text in enumerate(batch.column(1).slice(s.start, s.stop - s.start).to_pylist()):
                    ids = ids_of(text or "").astype("<u4")
                    ends = cut(len(ids))
                    for k, (a, z) in enumerate(zip(ends, ends[1:])):
                        owner.append(s.start + i)
                        rows.append((k, a, z - a, zlib.crc32(ids[a:z].data)))
                piece, start, length, crc = map(list, zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def best_fit(sizes: np.ndarray, capacity: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item and the fill of each bin; longest items first, each into
    the fullest bin that takes it."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    fill: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms = 0  # bit r is set if a bin has r left
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        room -= size
        if not open_bins[room]:
            rooms |= 1 << room
        open_bins[room].append(b)
    return bins, offsets, np.array(fill, np.int64)


def travellers(fill: np.ndarray, capacity: int = LENGTH) -> np.ndarray:
    """Which bins go up the tree: those at most half full, and the FAN emptiest others."""
    out = 2 * fill <= capacity
    others = np.flatnonzero(~out & (fill < capacity - NEARLY))
    out[others[np.argsort(fill[others], kind="stable")[:FAN]]] = True
    return out


def packed_group(frame):
    bins, offsets, fill = best_fit(frame["length"].to_numpy())
    frame["bin"] = (frame.pop("g").to_numpy() << 24) + bins
    frame["at"], frame["fill"], frame["travels"] = offsets, fill[bins], travellers(fill)[bins]
    return frame


def merged_group(frame):
    """Bins as items; a merged bin takes the number of its first item."""
    import pandas as pd

    frame = frame.sort_values(["fill", "seq"], ascending=[False, True]).reset_index(drop=True)
    bins, offsets, fill = best_fit(frame["fill"].to_numpy())
    first = frame["seq"].to_numpy()[np.unique(bins, return_index=True)[1]]
    return pd.DataFrame(
        {"seq": frame["seq"], "to": first[bins], "base": offsets, "fill": fill[bins], "travels": travellers(fill)[bins]}
    )


def pack(docs: DataFrame) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = settle(encoded(docs)).withColumn("item", F.monotonically_increasing_id())
    kind = docs.schema["doc_id"].dataType.simpleString()
    full = rows.filter(F.col("length") == LENGTH)
    full = full.withColumns({"sequence_id": -1 - F.col("item"), "offset": F.lit(0).cast("long")}).drop("item")

    items = rows.filter(F.col("length") < LENGTH)
    groups = max(1, -(-items.count() // GROUP))
    items = items.withColumn("g", F.pmod(F.xxhash64("item"), F.lit(groups))).drop("item")
    local = compact(
        items.groupBy("g").applyInPandas(
            packed_group,
            f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
            "bin bigint, at bigint, fill bigint, travels boolean",
        )
    )
    # where each travelling bin ends up: its sequence and its offset there
    moving = local.filter("travels").groupBy("bin").agg(F.max("fill").alias("fill"))
    moving = compact(moving.select("bin", F.col("bin").alias("seq"), F.lit(0).cast("long").alias("base")))
    bins = compact(local.filter("travels").groupBy(F.col("bin").alias("seq")).agg(F.max("fill").alias("fill")))
    span = 1
    while groups > 1:
        groups, span = -(-groups // FAN), span * FAN
        g = F.floor(F.shiftright("seq", 24) / span).alias("g")
        moves = compact(
            bins.groupBy(g).applyInPandas(merged_group, "seq bigint, to bigint, base bigint, fill bigint, travels boolean")
        )
        step = moves.select("seq", "to", F.col("base").alias("more"))
        moving = compact(
            moving.join(step, "seq", "left").select(
                "bin", F.coalesce("to", "seq").alias("seq"), (F.col("base") + F.coalesce("more", F.lit(0))).alias("base")
            )
        )
        bins = moves.filter("travels").groupBy(F.col("to").alias("seq")).agg(F.max("fill").alias("fill"))
    out = local.join(small(moving), "bin", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("seq", "bin").alias("sequence_id"),
        (F.col("at") + F.coalesce("base", F.lit(0))).alias("offset"),
    )
    return out.unionByName(full)


@query("op9_bestfit_packing")
def op9_bestfit_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
