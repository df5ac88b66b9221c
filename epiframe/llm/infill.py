"""Fill-in-the-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of ``FRAME`` bytes. Each frame carries the
units and code points that begin before it, so a cut at a unit is found by decompressing one
frame. The transformed text is again a list of frames: whole frames move as they are, only
the cut ones are divided. Digests and the rebuilt text stream the frames in order, one at a
time, so a very long text needs its compressed form and one frame of memory.

Units are ``[A-Za-z]+|[^A-Za-z]``, matched from left to right over code points. A frame may
end inside a run of letters; the next one then says that it goes on (``open``).

Defined results
* A null text is empty; an empty text is plain, with n 0. So is a text that has one of the
  marks, and so are those that the seeded draw leaves alone.
* The draw hashes ``1:`` and the decimal doc_id, so rows with one doc_id are cut by the same
  numbers; a null doc_id draws as the empty string. Repeated rows give repeated results.
* An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import query, table
from epiframe.llm.scan import as_bytes

FRAME = 1 << 16
LEVEL = 1
PLAIN_FROM = 90
SPM_BELOW = 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)

FRAMES = "array<struct<units:bigint,chars:bigint,open:boolean,data:binary>>"
PARTS = "array<struct<n_bytes:bigint,data:binary>>"

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


def starts(data: np.ndarray, goes_on: bool) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the bytes that begin a unit, and of those that begin a code point."""
    letter, first = LETTER[data], (data & 0xC0) != 0x80
    inside = np.empty(len(data), bool)
    inside[0] = goes_on
    inside[1:] = letter[:-1]
    return first & ~(letter & inside), first


def frames_of(text: memoryview, pack: zstandard.ZstdCompressor, size: int) -> tuple[list, int]:
    """(units before, code points before, open, frame) of each frame, and the units in all."""
    out, units, chars, goes_on = [], 0, 0, False
    for at in range(0, len(text), size):
        chunk = text[at : at + size]
        data = np.frombuffer(chunk, np.uint8)
        out.append((units, chars, goes_on, pack.compress(chunk)))
        unit, first = starts(data, goes_on)
        units += int(np.count_nonzero(unit))
        chars += int(np.count_nonzero(first))
        goes_on = bool(LETTER[data[-1]])
    return out, units


def listed(rows: list[list[tuple]], kinds: list[tuple[str, pa.DataType]]) -> pa.ListArray:
    """An Arrow column of lists of structs."""
    offsets = np.cumsum([0] + [len(r) for r in rows]).astype(np.int32)
    flat = [x for r in rows for x in r]
    columns = [pa.array([x[i] for x in flat], kind) for i, (_, kind) in enumerate(kinds)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, [n for n, _ in kinds]))


_FRAME = [("units", pa.int64()), ("chars", pa.int64()), ("open", pa.bool_()), ("data", pa.binary())]
_PART = [("n_bytes", pa.int64()), ("data", pa.binary())]


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def framed(docs: DataFrame, size: int = FRAME) -> DataFrame:
    """doc_id, n (units), marked (the text has a mark), frames; one row for each row."""

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=LEVEL)
        for batch in parts:
            for some in slices(batch):
                column = as_bytes(some.column(1))
                done = [frames_of(memoryview(t.as_buffer()), zip_, size) for t in column]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([n for _, n in done], pa.int64()), some.column(2), listed([f for f, _ in done], _FRAME)],
                    ["doc_id", "n", "marked", "frames"],
                )

    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | F.coalesce(F.contains(F.col("text"), F.lit(mark.decode())), F.lit(False))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", marked.alias("marked"))
    return rows.mapInArrow(pack, f"doc_id {kind}, n bigint, marked boolean, frames {FRAMES}")


def drawn(doc_id: Column, i: int) -> Column:
    """The i-th group of eight hex digits of the document's digest, as a number."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint")


def planned(frames: DataFrame) -> DataFrame:
    """Adds form and the units before the middle (``cut``) and before the suffix (``end``)."""
    h = [drawn(F.col("doc_id"), i) for i in range(4)]
    plain = (F.col("n") == 0) | F.col("marked") | (h[2] % 100 >= PLAIN_FROM)
    form = F.when(plain, "plain").when(h[3] % 100 < SPM_BELOW, "spm").otherwise("psm")
    a, b = (h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1))
    return frames.withColumns({"form": form, "cut": F.least(a, b), "end": F.greatest(a, b)})


class Frames:
    """Random access to the frames of one text."""

    def __init__(self, units: list, chars: list, goes_on: list, data: list, n: int):
        self.units, self.chars, self.open, self.data, self.n = units, chars, goes_on, data, n
        self.unzip, self.cache = zstandard.ZstdDecompressor(), (-1, b"")

    def frame(self, i: int) -> bytes:
        if self.cache[0] != i:
            self.cache = i, self.unzip.decompress(self.data[i])
        return self.cache[1]

    def find(self, unit: int) -> tuple[int, int, int]:
        """Frame and byte in it where a unit begins, and the code points before it."""
        i = len(self.data) - 1 if unit == self.n else bisect_right(self.units, unit) - 1
        data = np.frombuffer(self.frame(i), np.uint8)
        unit_start, first = starts(data, self.open[i])
        at = len(data) if unit == self.n else int(np.flatnonzero(unit_start)[unit - self.units[i]])
        return i, at, self.chars[i] + int(np.count_nonzero(first[:at]))

    def between(self, lo: tuple, hi: tuple, mark: bytes, zip_: zstandard.ZstdCompressor) -> list[tuple[int, bytes]]:
        """(bytes, frame) of the mark and the text from one place to another; whole frames
        are taken as they are."""
        out, (i, a, _), (j, z, _) = [], lo, hi
        head = mark + (self.frame(i)[a : z if i == j else None] if a or i == j else b"")
        out.append((len(head), zip_.compress(head)))
        for k in range(i + (1 if a or i == j else 0), j):
            out.append((zstandard.frame_content_size(self.data[k]), self.data[k]))
        if j > i and z:
            tail = self.frame(j)[:z]
            out.append((z, zip_.compress(tail)))
        return out


def transformed(plans: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the transformed text as ``parts``:
    frames in order, each with its length in bytes."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for some in slices(batch):
                prefix, middle, parts = [], [], []
                col = {name: some.column(name) for name in some.schema.names}
                rows = zip(*(col[c].to_pylist() for c in ("n", "form", "cut", "end", "frames")))
                for n, form, cut, end, frames in rows:
                    if form == "plain":
                        parts.append([(zstandard.frame_content_size(f["data"]), f["data"]) for f in frames])
                        prefix.append(None), middle.append(None)
                        continue
                    text = Frames(*([f[c] for f in frames] for c in ("units", "chars", "open", "data")), n)
                    first, a, b, last = (0, 0, 0), text.find(cut), text.find(end), text.find(n)
                    pieces = [(first, a, PREFIX), (b, last, SUFFIX), (a, b, MIDDLE)]
                    if form == "spm":
                        pieces = [pieces[1], pieces[0], pieces[2]]
                    parts.append([p for lo, hi, mark in pieces for p in text.between(lo, hi, mark, zip_)])
                    prefix.append(a[2]), middle.append(b[2] - a[2])
                yield pa.RecordBatch.from_arrays(
                    [col["doc_id"], col["n"], col["form"], pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), listed(parts, _PART)],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "parts"],
                )

    kind = plans.schema["doc_id"].dataType.simpleString()
    rows = plans.select("doc_id", "n", "form", "cut", "end", "frames")
    return rows.mapInArrow(
        move, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, parts {PARTS}"
    )


def marks_of(parts: list[dict], unzip: zstandard.ZstdDecompressor, seen) -> tuple[dict[bytes, int], int]:
    """Where each mark stands first, and the length; every frame is passed to ``seen``."""
    at, found, tail = 0, {}, b""
    for part in parts:
        data = unzip.decompress(part["data"])
        seen(data)
        window = tail + data  # a mark may begin in the frame before
        for mark in MARKS:
            if mark not in found and (i := window.find(mark)) >= 0:
                found[mark] = at - len(tail) + i
        at += len(data)
        tail = window[-2:]
    return found, at


def streamed(parts: list[dict], unzip: zstandard.ZstdDecompressor, lo: int, hi: int) -> Iterator[bytes]:
    """The bytes from lo to hi; frames outside are skipped by their lengths."""
    at = 0
    for part in parts:
        end = at + part["n_bytes"]
        if at < hi and end > lo:
            yield unzip.decompress(part["data"])[max(0, lo - at) : hi - at]
        at = end


def original(parts: list[dict], form: str, unzip: zstandard.ZstdDecompressor, seen=lambda data: None) -> Iterator[bytes]:
    """The text before the transformation, from the transformed frames and the form alone."""
    found, length = marks_of(parts, unzip, seen)
    if form == "plain":
        ranges = [(0, length)]
    else:
        order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
        stops = [*(found[m] for m in order[1:]), length]
        span = {m: (found[m] + len(m), stop) for m, stop in zip(order, stops)}
        ranges = [span[PREFIX], span[MIDDLE], span[SUFFIX]]
    for lo, hi in ranges:
        yield from streamed(parts, unzip, lo, hi)


def read_back(rows: DataFrame) -> DataFrame:
    """Adds output_sha256 and restored_sha256 and drops the frames."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for some in slices(batch):
                outs, backs = [], []
                for form, parts in zip(some.column("form").to_pylist(), some.column("parts").to_pylist()):
                    out, back = hashlib.sha256(), hashlib.sha256()
                    for data in original(parts, form, unzip, out.update):
                        back.update(data)
                    outs.append(out.hexdigest()), backs.append(back.hexdigest())
                kept = [some.column(c) for c in some.schema.names if c != "parts"]
                names = [c for c in some.schema.names if c != "parts"]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(outs), pa.array(backs)], [*names, "output_sha256", "restored_sha256"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "parts")
    return rows.mapInArrow(digest, f"{kept}, output_sha256 string, restored_sha256 string")


def infill(docs: DataFrame, size: int = FRAME) -> DataFrame:
    """The transformed documents as frames, see ``transformed``."""
    return transformed(planned(framed(docs, size)))


def texts(rows: DataFrame, restored: bool = False) -> DataFrame:
    """doc_id, form, text: the transformed texts of ``infill``, or the ones they came from."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for some in slices(batch):
                out = []
                for form, parts in zip(some.column("form").to_pylist(), some.column("parts").to_pylist()):
                    if restored:
                        out.append(b"".join(original(parts, form, unzip)))
                    else:
                        out.append(b"".join(unzip.decompress(p["data"]) for p in parts))
                column = pa.array(out, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("form"), column], ["doc_id", "form", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "form", "parts").mapInArrow(unpack, f"doc_id {kind}, form string, text string")


INFILL_SQL = """WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS w, list_transform(range(4),
  lambda i: ('0x' || substr(h, (8 * i + 1)::INTEGER, 8))::BIGINT) AS r FROM d),
c AS (SELECT doc_id, text, w, len(w) AS n, r,
  least(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) AS a, greatest(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) AS b FROM u),
f AS (SELECT *, CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 90
    THEN 'plain' WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
  coalesce(array_to_string(w[1:a], ''), '') AS p, coalesce(array_to_string(w[a + 1:b], ''), '') AS m,
  coalesce(array_to_string(w[b + 1:], ''), '') AS s FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM f"""


@query("op12_infill", INFILL_SQL)
def op12_infill(spark, sf_dir):
    return read_back(infill(table(spark, sf_dir, "documents")))
