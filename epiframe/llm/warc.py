"""WARC archives with a two-level capture index.

Writing: tasks write gzip members, one per record, into archives on shared storage, and
return a capture for each: key, archive, offset, length. An archive's name is new for every
attempt of a task, and only the names in the rows of successful attempts are ever read, so a
lost executor leaves at most an unreferenced file.

Index: captures are sorted by range on the URL key with the host reversed, so hosts and
their subdomains lie together. Each range becomes one index file of compressed blocks of
``BLOCK`` lines, and ends with its directory: first key, offset and length of each block.
The top level has one row per index file.

Reading: keys are binary-searched in the top level and then, per index file, in its
directory; only the blocks found are read by range and binary-searched. The captures are
sorted by archive and offset, and the records read by range and checked against their digest.

Archives are written and read with ``pyarrow.fs``, which knows file, HDFS, S3 and GCS paths.

Defined results
* A null html is an empty payload. A null url has the empty key and no target URI.
* Equal payloads have equal SHA-1 digest and length. The record with the largest page_id is
  the response, the others revisit it. A null page_id is never the largest; if a payload has
  null ids only, all its records are responses. Rows with the same page_id and payload are
  of one type. Payloads below ``min_bytes`` are never revisits.
* Repeated rows give a record each. An empty table writes no archive and gives no rows.
"""

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import compact, new_path, query, settle, small, table

BLOCK = 3000
ARCHIVE = 256 << 20
DATE = "2024-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CAPTURE = "key string, archive string, offset bigint, length bigint"


# -- columns --------------------------------------------------------------------------


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32; five hexadecimal digits are four of base 32."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def url_key(url: Column) -> Column:
    """``com,example,www)/path?query``: host reversed and in lower case, no scheme, user, port
    or fragment."""
    url = F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)#.*$", "")
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(rest, r"^(?:[^/?@]*@)?([^/?:]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?]*(.*)$", 1)
    key = F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.", -1)), ","), F.lit(")"), path)
    return F.when(rest == "", F.lit("")).otherwise(F.regexp_replace(key, r"[\x00-\x20]", "%20"))


# -- records --------------------------------------------------------------------------


def lines(first: str, fields: dict) -> bytes:
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in fields.items()), "", ""]).encode()


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit has the HTTP head only."""
    block = lines("HTTP/1.1 200 OK", {"Content-Type": "text/html; charset=utf-8", "Content-Length": len(payload)})
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if url is not None:
        fields["WARC-Target-URI"] = url.replace("\r", "%0D").replace("\n", "%0A")
    if page_id is not None:
        fields["X-Page-Id"] = page_id
    if refers_to is None:
        block += payload
    else:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["X-Refers-To-Page-Id"] = refers_to
    fields["Content-Length"] = len(block)
    return lines("WARC/1.1", fields) + block + b"\r\n\r\n"


def head(data: bytes) -> tuple[dict, int]:
    """Fields up to the first empty line, and where the rest begins."""
    end = data.index(b"\r\n\r\n")
    rows = data[:end].decode().split("\r\n")[1:]
    return dict(r.split(": ", 1) for r in rows), end + 4


def parsed(data: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of a record."""
    fields, at = head(data)
    block = data[at : at + int(fields["Content-Length"])]
    http, body = head(block)
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(http["Content-Length"])
    if kind == "response":
        payload = block[body:]
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"damaged record of page {fields.get('X-Page-Id')}")
    return {
        "page_id": int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": int(fields["X-Refers-To-Page-Id"]) if "X-Refers-To-Page-Id" in fields else None,
    }


def shared(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


# -- writing --------------------------------------------------------------------------


def with_types(pages: DataFrame, min_bytes: int) -> DataFrame:
    """page_id, url, html, key, digest, refers_to (null for a response)."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), url_key(F.col("url")).alias("key"),
        base32_sha1(html.cast("binary")).alias("digest"),
    )
    # only payloads that several records share need a join; those are counted before it
    sizes = rows.select("page_id", "digest", F.octet_length("html").alias("size"))
    shared_by = sizes.filter(F.col("size") >= min_bytes).groupBy("digest", "size")
    shared_by = shared_by.agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared_by = small(compact(shared_by.select("digest", "size", "last")))
    rows = rows.withColumn("size", F.octet_length("html")).join(shared_by, ["digest", "size"], "left")
    again = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return rows.withColumn("refers_to", F.when(again, F.col("last"))).select(
        "page_id", "url", "html", "key", "digest", "refers_to"
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE) -> DataFrame:
    """Writes one record per row; returns the captures: key, archive, offset, length."""

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = place = name = None
        at = 0
        for batch in parts:
            found = []
            for start in range(0, batch.num_rows, 256):
                for r in batch.slice(start, 256).to_pylist():
                    if out is None:
                        place, root = shared(folder)
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, at = place.open_output_stream(f"{root}/{name}", compression=None), 0
                    data = record(r["page_id"], r["url"], r["html"].encode(), r["digest"], r["refers_to"])
                    member = gzip.compress(data, 3, mtime=0)
                    out.write(member)
                    found.append((r["key"], name, at, len(member)))
                    at += len(member)
                    if at >= archive_bytes:
                        out.close()
                        out = None
            if found:
                key, archive, offset, length = map(list, zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.string()), pa.array(archive, pa.string()), pa.array(offset, pa.int64()),
                     pa.array(length, pa.int64())],
                    ["key", "archive", "offset", "length"],
                )
        if out is not None:
            out.close()

    place, root = shared(folder)
    place.create_dir(root, recursive=True)
    return settle(with_types(pages, min_bytes).mapInArrow(write, CAPTURE))


def write_index(captures: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """Writes the index files; returns the top level: first and last key of each, name, lines."""

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, held, directory, n = None, 0, [], [], 0
        name, first, last = f"{uuid.uuid4().hex}.cdx", None, None

        def flush():
            nonlocal out, at
            if out is None:
                place, root = shared(folder)
                out = place.open_output_stream(f"{root}/{name}", compression=None)
            data = zlib.compress("\n".join(f"{k} {a} {o} {z}" for k, a, o, z in held).encode(), 6)
            out.write(data)
            directory.append((held[0][0], at, len(data)))
            at += len(data)
            held.clear()

        for batch in parts:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                first, last, n = (row[0] if first is None else first), row[0], n + 1
                held.append(row)
                if len(held) == block:
                    flush()
        if held:
            flush()
        if out is not None:
            end = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(end)
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (name, first, last, at, len(end), n)],
                ["name", "first", "last", "at", "size", "n"],
            )

    place, root = shared(folder)
    place.create_dir(root, recursive=True)
    order = ["key", "archive", "offset"]
    ranged = captures.select("key", "archive", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order)
    return compact(ranged.mapInArrow(write, "name string, first string, last string, at bigint, size bigint, n bigint"))


# -- reading --------------------------------------------------------------------------


def look_up(keys: DataFrame, top: DataFrame, folder: str) -> DataFrame:
    """The captures of the distinct values of ``key``. The top level has a row per index file,
    as many as the range partitions it was written from."""
    files = sorted(top.select("first", "last", "name", "at", "size").collect())
    firsts, lasts = [f.first for f in files], [f.last for f in files]

    def route(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            key, name = [], []
            for k in batch.column(0).to_pylist():
                # a key with many captures may run through several files
                for i in range(bisect.bisect_left(lasts, k), bisect.bisect_right(firsts, k)):
                    key.append(k)
                    name.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(name, pa.int32())], ["key", "file"])

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, root = shared(folder)
        opened = directory = block_no = block = None
        for batch in parts:
            found = []
            for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if opened is None or opened[0] != i:
                    f = place.open_input_file(f"{root}/{files[i].name}")
                    directory = json.loads(zlib.decompress(f.read_at(files[i]["size"], files[i]["at"])))
                    opened, block_no = (i, f, [d[0] for d in directory]), None
                starts = opened[2]
                b = max(0, bisect.bisect_left(starts, k) - 1)
                while b < len(starts) and starts[b] <= k:
                    if b != block_no:
                        data = zlib.decompress(opened[1].read_at(directory[b][2], directory[b][1])).decode()
                        block_no, block = b, [line.split(" ") for line in data.split("\n")]
                    at = bisect.bisect_left(block, k, key=lambda line: line[0])
                    while at < len(block) and block[at][0] == k:
                        found.append(block[at])
                        at += 1
                    b += 1
            if found:
                key, archive, offset, length = map(list, zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.string()), pa.array(archive, pa.string()),
                     pa.array(list(map(int, offset)), pa.int64()), pa.array(list(map(int, length)), pa.int64())],
                    ["key", "archive", "offset", "length"],
                )

    wanted = keys.select("key").filter("key IS NOT NULL").distinct().mapInArrow(route, "key string, file int")
    wanted = wanted.repartition("file").sortWithinPartitions("file", "key")
    return wanted.mapInArrow(read, CAPTURE)


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each capture."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, root = shared(folder)
        name = f = None
        for batch in parts:
            found = []
            for archive, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if archive != name:
                    name, f = archive, place.open_input_file(f"{root}/{archive}")
                found.append(parsed(gzip.decompress(f.read_at(length, offset))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in found], k) for n, k in zip(names, kinds)], names
            )

    # neighbours in an archive are read together; large archives are shared out among tasks
    part = F.floor(F.col("offset") / (8 << 20))
    rows = captures.select("archive", "offset", "length").repartition("archive", part)
    rows = rows.sortWithinPartitions("archive", "offset")
    return rows.mapInArrow(
        read, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    )


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes pages as archives with their index and reads every page back through it."""
    folder = new_path(pages.sparkSession, "warc")
    captures = write_archives(pages, folder, min_bytes)
    top = write_index(captures, f"{folder}/index")
    keys = pages.select(url_key(F.col("url")).alias("key"))
    return read_records(look_up(keys, top, f"{folder}/index"), folder)


@query(
    "op2_warc_index",
    """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, array_to_string(list_transform(range(32),
  lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5),
    lambda j: CASE WHEN substr(unhex(sha1(html))::BIT::VARCHAR, (5 * i + j + 1)::INTEGER, 1) = '1'
      THEN 1 << (4 - j)::INTEGER ELSE 0 END))::INTEGER, 1)), '') AS payload_digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to FROM g""",
)
def op2_warc_index(spark, sf_dir):
    return archived(table(spark, sf_dir, "pages"))
