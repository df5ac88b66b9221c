"""The fill-in-the-middle transformation against plain strings, with frames of any size."""

import hashlib
import re

import pytest
from brute import CODE, LONG
from pyspark.sql import functions as F

from epiframe.llm import infill


def brute(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in range(0, 32, 8)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(docs, rows, size):
    out = infill.infill(docs, size)
    got = infill.read_back(out).collect()
    want = {}
    for i, t in rows:
        n, form, p, m, text = brute(i, t)
        want.setdefault(i, []).append((n, form, p, m, sha(text), sha(t or "")))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append(tuple(r)[1:])
    assert {k: sorted(v, key=str) for k, v in have.items()} == {k: sorted(v, key=str) for k, v in want.items()}
    made = {(r.doc_id, r.text) for r in infill.texts(out).collect()}
    assert made == {(i, brute(i, t)[4]) for i, t in rows}
    assert {(r.doc_id, r.text) for r in infill.texts(out, True).collect()} == {(i, t or "") for i, t in rows}


@pytest.mark.parametrize("size", [1 << 16, 37, 3])
def test_edges(edge_docs, edge_rows, size):
    if size < 10:  # a frame for every few bytes: without the longest texts
        edge_docs, edge_rows = edge_docs.filter("length(text) < 5000 OR text IS NULL"), [r for r in edge_rows if len(r[1] or "") < 5000]
    check(edge_docs, [(i, t) for i, t, _ in edge_rows], size)


def test_every_form_at_frame_edges(spark):
    texts = ["ab1c", "ab cd", "éa漢b", "<P", "x<S>y", "P>a<", LONG[:100], CODE[:100] + " " + CODE[:30], "a\n\r\n b", "\U0001F600" * 9]
    rows = [(i, texts[i % len(texts)]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    for size in (1, 4, 100):
        check(docs, rows, size)
    assert {r.form for r in infill.infill(docs).select("form").collect()} == {"plain", "psm", "spm"}


def test_frames_are_independent(spark):
    docs = spark.createDataFrame([(1, LONG + "漢" + CODE)], "doc_id long, text string")
    frames = infill.framed(docs, 1000).first()["frames"]
    parts = infill.Frames(*([f[c] for f in frames] for c in ("units", "chars", "open", "data")), 0)
    text = (LONG + "漢" + CODE).encode()
    assert [parts.frame(i) for i in (7, 300, 2)] == [text[1000 * i : 1000 * i + 1000] for i in (7, 300, 2)]
    assert len(frames) == -(-len(text) // 1000)


def test_empty_table(no_docs):
    assert infill.read_back(infill.infill(no_docs)).collect() == []
    assert infill.texts(infill.infill(no_docs)).filter(F.lit(True)).collect() == []
