"""The registered queries on the smallest tables: against SQL, or against brute force."""

import zlib

import brute
import pytest
from oracle import difference, duck
from tokenizers import Tokenizer

from epiframe.llm import QUERIES, SQL
from epiframe.llm.packing import LENGTH

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert difference(df.collect(), df.columns, con, SQL[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_token_counts(spark, texts, tokenizer):
    rows = QUERIES["op3_token_counts"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)


def test_quality(spark, con, texts):
    rows = QUERIES["op4_quality_rules"](spark, SF).collect()
    assert len(rows) == len(texts)
    truth = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    right = total = 0
    for r in rows:
        counts = brute.base_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r.base_failed and r.kept)
        if r.doc_id in truth and not r.base_failed:
            total += 1
            right += r.kept == bool(truth[r.doc_id])
    assert right >= 0.9 * total


def test_shards(spark, texts):
    rows = QUERIES["op5_external_shuffle"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    by = {}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(by) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    again = QUERIES["op5_external_shuffle"](spark, SF).collect()
    assert brute.counted(rows) == brute.counted(again)


def test_personal_data(spark, texts):
    rows = QUERIES["op8_pii_sanitise"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, spans = brute.base_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == n
        assert r.base_sha256 == brute.sha256(spans) and r.spans.startswith(spans)


def packed_right(rows, texts, tokenizer):
    """Checks pieces against whole encodings and sequences for gaps; returns their number."""
    import numpy as np

    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for i, found in pieces.items():
        ids = np.array(tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [0], "<u4")
        found.sort(key=lambda r: r.piece)
        assert [r.piece for r in found] == list(range(-(-len(ids) // LENGTH)))
        at = 0
        for r in found:
            assert r.start == at and (r.piece == 0 or r.length == LENGTH)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= LENGTH
    return len(places)


def test_packing(spark, texts, tokenizer):
    rows = QUERIES["op9_bestfit_packing"](spark, SF).collect()
    n = packed_right(rows, texts, tokenizer)
    assert n <= 1.02 * -(-sum(r.length for r in rows) // LENGTH)


def test_licence_sql_knows_the_same_texts(spark):
    """Every known text as a document, and spoiled ones."""
    import duckdb

    from epiframe.llm import licenses

    known = licenses.KNOWN + licenses.whole_texts()
    rows = [(i, t) for i, (_, t) in enumerate(known)] + [(100 + i, t.upper() + " more") for i, (_, t) in enumerate(known[:4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    df = licenses.scan(docs)
    got = df.collect()
    assert difference(got, df.columns, con, SQL["op7_license_scan"]) is None
    assert sum(r.license is not None for r in got) == len(known)
