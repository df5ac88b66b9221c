"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import random

import brute
import numpy as np
import pytest
from brute import LONG
from pyspark.sql import functions as F
from test_queries import packed_right, tokenizer  # noqa: F401

import corpus_pipeline
from epiframe.llm import licenses, mixing, near_dedup, packing, pii, quality, sharding, token_counts, topk, warc


def ids(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect())


@pytest.fixture(scope="module")
def all_ids(edge_rows):
    return sorted((i is None, i or 0) for i, _, _ in edge_rows)


OPERATORS = {
    "mix": lambda d, labels: mixing.mix(d),
    "token_counts": lambda d, labels: token_counts.token_counts(d),
    "quality": lambda d, labels: quality.quality(d, labels),
    "shards": lambda d, labels: sharding.shard_table(d),
    "near_duplicates": lambda d, labels: near_dedup.near_duplicates(d),
    "licenses": lambda d, labels: licenses.scan(d),
    "pii": lambda d, labels: pii.findings(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(name, edge_docs, labels, all_ids):
    assert ids(OPERATORS[name](edge_docs, labels)) == all_ids


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, no_docs, labels):
    assert OPERATORS[name](no_docs, labels.limit(0)).collect() == []


def test_mix(edge_docs, edge_rows):
    rows = mixing.mix(edge_docs).collect()
    assert sum(r.target for r in rows if r.source_size == 0) == 0
    size = {}
    for i, t, s in edge_rows:
        size[s] = size.get(s, 0) + len(brute.words(t))
    # by code point with null last: Z a b c é None weigh 5 2 1 5 2 1
    weights = dict(zip(["Z", "a", "b", "c", "é", None], [5, 2, 1, 5, 2, 1]))
    target = {s: None for s in size}
    left, share = sum(size.values()), 0.0
    while True:
        free = [s for s in size if target[s] is None]
        share = (left - sum(t for t in target.values() if t is not None)) / sum(weights[s] for s in free)
        above = [s for s in free if share * weights[s] > 3 * size[s]]
        if not above:
            break
        target.update({s: 3 * size[s] for s in above})
    target = {s: share * weights[s] if t is None else t for s, t in target.items()}
    for r in rows:
        assert r.taken == r["size"] * r.copies and 0 <= r.copies <= 3
        assert any(abs(r.target - t) < 1e-6 and r.source_size == size[s] for s, t in target.items())
    assert mixing.mix(edge_docs).collect() and brute.counted(rows) == brute.counted(mixing.mix(edge_docs).collect())


def test_mix_meets_its_targets_and_nests(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
        F.array_join(F.array_repeat(F.lit("w"), (F.col("id") % 7 + 1).cast("int")), " ").alias("text"),
    )
    taken = mixing.mix(docs).withColumn("source", F.lit(None)).groupBy("source_size", "target").agg(F.sum("taken").alias("t"))
    rows = taken.collect()
    assert len(rows) == 5 and all(abs(r.t - r.target) <= 7 for r in rows)
    few = {r.doc_id for r in mixing.mix(docs, most=1).filter("copies > 0").collect()}
    many = {r.doc_id for r in mixing.mix(docs).filter("copies > 0").collect()}
    assert len(few) <= 20_000 and many
    assert mixing.mixed(docs).count() == mixing.mix(docs).agg(F.sum("copies")).first()[0]


def test_mix_meets_its_targets_with_null_and_repeated_ids(spark):
    docs = spark.range(10_000).select(
        F.when(F.col("id") % 5 > 1, F.col("id") % 700).alias("doc_id"),  # 40 percent null, the others repeated
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
        F.concat(F.col("id").cast("string"), F.repeat(F.lit(" w"), (F.col("id") % 7 + F.col("id") % 4).cast("int"))).alias("text"),
    )
    got = mixing.mix(docs).groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    assert len(got) == 5 and all(abs(r.t - r.target) <= 10 for r in got)


def test_token_counts(edge_docs, edge_rows, tokenizer):  # noqa: F811
    want = brute.counted(
        (i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in edge_rows
    )
    got = token_counts.token_counts(edge_docs).select("doc_id", "n_bytes", "n_tokens").collect()
    assert brute.counted(got) == want


def test_pieces_keep_the_tokens(tokenizer):  # noqa: F811
    text = "It's 12 <|endoftext|>  words,\n\n\tand  more \x1c!x 漢字 " * 40
    for most in (1, 7, 64):
        parts = list(token_counts.pieces(text, most))
        assert "".join(parts) == text
        split = [i for p in parts for i in tokenizer.encode(p, add_special_tokens=False).ids]
        assert split == tokenizer.encode(text, add_special_tokens=False).ids


def test_sentence_pieces_are_counted_too(spark):
    import public_tokenizers
    import sentencepiece

    texts = ["", "Some words of text.", "漢字 " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = token_counts.token_counts(docs, "piece_bpe_32k.model").orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == [len(model.encode(t)) for t in texts]


def test_quality(edge_docs, edge_rows, labels):
    got = quality.quality(edge_docs, labels)
    want = brute.counted((i, *brute.base_counts(t)) for i, t, _ in edge_rows)
    assert brute.counted(got.drop("p_good", "base_failed", "kept").collect()) == want
    alone = quality.quality(edge_docs, labels.limit(0)).collect()
    assert all(r.p_good is None and r.kept != r.base_failed for r in alone)
    assert quality.passing(edge_docs, labels).columns == edge_docs.columns


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality(docs, labels.filter("doc_id % 2 = 0")).filter("NOT base_failed")
    held = rows.join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    good, bad = [r for r in held if r.quality == 1], [r for r in held if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)
    assert abs(sum(r.p_good for r in held) / len(held) - len(good) / len(held)) < 0.05  # calibrated


def test_repeat_words_cover_overlaps():
    text = "a a a a a a a b c d e f a a a a a b c d e f g"
    assert quality.repeat_words(text.encode()) == brute.base_counts(text)[4]


def test_near_duplicates(edge_docs, edge_rows):
    want = brute.near_groups({(i, t) for i, t, _ in edge_rows if i is not None})
    for r in near_dedup.near_duplicates(edge_docs).collect():
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    kept = near_dedup.first_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted({c for _, c in want.values()})
    assert kept.filter("doc_id IS NULL").count() == 2


def test_texts_of_one_document_link_its_groups(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(50)) for x in "ab")
    rows = [(5, a), (3, a), (9, a), (9, b), (4, b)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.component_id for r in got} == {3}


def test_star_and_chain_of_copies(spark):
    """A centre, copies around the threshold, and copies of copies."""
    import random

    rng = random.Random(5)
    centre = [f"c{i}" for i in range(120)]
    rows = [(0, " ".join(centre))]
    last = centre
    for n in range(1, 400):
        w = list(centre if n % 4 else last)
        for k in rng.sample(range(len(w)), rng.randint(1, 6)):
            w[k] = f"x{n}_{k}"
        last = w
        rows.append((n, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == brute.near_groups(rows)


def test_estimate_follows_the_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8):
        errors = []
        for _ in range(40):
            both = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
            n = int(400 * (1 - share) / share / 2)
            sets = [np.unique(np.concatenate([both, rng.integers(0, 1 << 63, n, dtype=np.uint64)])) for _ in "ab"]
            bits, _ = near_dedup.signatures(sets)
            x = (bits[0] ^ bits[1]).view(np.uint64).reshape(near_dedup.BITS, -1)
            equal = 1 - np.bitwise_count(np.bitwise_or.reduce(x, axis=0)).sum() / near_dedup.HASHES
            chance = 1 / 2**near_dedup.BITS
            errors.append((equal - chance) / (1 - chance) - share)
        assert abs(np.mean(errors)) < 0.03


def test_licenses(spark):
    mit = licenses.KNOWN[-4][1]
    wrapped = "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(", ", ",\n").replace("SUBLICENSE", "sub-licence")
    rows = [(1, wrapped), (2, mit + " more"), (3, "a\n  # Released under the MIT licence!\nb"), (4, None), (5, "(c) 2020\n")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert [(r.license, r.notices) for r in got] == [("MIT", ""), (None, ""), (None, "MIT"), (None, ""), (None, "")]
    assert got[3].digest == got[4].digest


def test_every_known_license_finds_itself(spark):
    known = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(licenses.KNOWN)], "doc_id bigint, text string")
    for r in licenses.scan(known).collect():
        assert r.license == licenses.KNOWN[r.doc_id][0]


def test_whole_license_texts(spark):
    """Common licences are known by their whole text, also in another layout."""
    texts = licenses.whole_texts()
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0", "Unlicense"} <= {n for n, _ in texts}
    rows = [(i, t.upper().replace("\n", " \n  ") if i % 2 else t) for i, (_, t) in enumerate(texts)]
    rows.append((len(texts), texts[0][1] + " more"))
    got = {r.doc_id: r.license for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i] for i in range(len(rows))] == [n for n, _ in texts] + [None]


def test_personal_data(edge_docs, edge_rows):
    want = brute.counted((i, brute.base_spans(t)[1]) for i, t, _ in edge_rows)
    assert brute.counted(pii.findings(edge_docs).select("doc_id", "spans").collect()) == want
    out = pii.sanitised(edge_docs)
    assert out.columns == edge_docs.columns
    text = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    masked = "mail <email>, <email><email> ip <ip> 1.2.3.256 é <card> <phone>"
    assert text[11] == (masked, len(masked)) and text[1][0] is None and text[6][0] == LONG


ODD = [
    "a@b.c+d@e.f", "@a@b..c a@b.c. x@y.z-", "1.2.3.4.5.6.7.8 01.002.0003.255 256.1.1.1 1..2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1112 5500005555555559 41111111111111111111 1 2", "+1 (555) 123-4567. +1--  +12",
    "+1234567890123456 ++49 30 1234567", "4-1 1-1", "é\U0001F600 a@b.co \U0001F600 +44 20 7946 0958", "9" * 5000,
    "a" * 5000 + "@", "a@" + "b." * 5000 + "c", "+1" + " " * 5000, "1." * 3000, "x@y " * 500, "",
]


def test_odd_personal_data(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string")
    for r in pii.findings(docs).collect():
        assert (r.doc_id, r.spans) == (r.doc_id, brute.base_spans(ODD[r.doc_id])[1])


def found_terms(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    text = dict(rows)
    spans = [(r.doc_id, s) for r in pii.findings(docs, **options).collect() for s in r.spans.split(",") if s.startswith("term")]
    return sorted((i, text[i][slice(*map(int, s.split(":")[1:]))]) for i, s in spans)


def test_terms_that_give_an_entity_away(spark):
    """A nickname that goes with an address is found wherever it is; common words and copies are not."""
    rows = [(i, f"the note {i} of zorblatt, at joe@ex.org was\nthe zorblatt line") for i in range(6)]
    rows += [(10 + i, "the copied qwertz at sue@ex.org here") for i in range(6)]
    rows += [(100 + i, f"the plain note {i} was of words at large here line") for i in range(600)]
    rows += [(900, "Zorblatt alone"), (901, "the note of all")]
    text = dict(rows)
    assert found_terms(spark, rows) == sorted([(i, w) for i in range(6) for w in ("zorblatt,", "zorblatt")] + [(900, "Zorblatt")])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert out[0] == "the note 0 of <term> at <email> was\nthe <term> line" and out[10] == "the copied qwertz at <email> here"
    assert out[900] == "<term> alone"
    gone = {r.doc_id: r.text for r in pii.sanitised(docs, discloses=0.45, reveals=0.4).collect()}
    assert gone[1].startswith("the note 1 of  at <email>") and gone[101] == text[101]


def test_two_documents_are_no_evidence_at_any_size(spark):
    for n in (200, 5000):
        rows = plain_words(n) + [(i, f"é zorblatt{i} qwertz sue@ex.org {i}") for i in range(2)]
        assert found_terms(spark, rows) == []


def test_independent_words_are_hardly_ever_terms(spark):
    """Rare words and entities dealt to documents at random, the entities often and rare."""
    import random

    rng = random.Random(1)
    rows = []
    for i in range(4000):
        words = [f"w{int(rng.paretovariate(0.35)) % 10**7}" for _ in range(40)]
        entities = [f"user{int(rng.paretovariate(0.5)) % 10**6}@ex.org"] if i % 3 == 0 else []
        rows.append((i, " ".join(words + entities)))
    n_words = len({w for _, t in rows for w in t.split()})
    assert len({w for _, w in found_terms(spark, rows)}) <= n_words / 10_000


def test_many_values_in_one_text(spark):
    """50,000 addresses in one text, and pages that list the same values and words."""
    many = " ".join(f"user{i}@ex.org" for i in range(50_000))
    page = " ".join(f"p{i}@ex.org word{i}" for i in range(3_000))
    rows = [(1, many), *[(10 + i, f"{page} {i}x") for i in range(4)], *plain_words(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in pii.findings(docs).collect()}
    assert got[1].n_email == 50_000 and got[1].spans == brute.base_spans(many)[1]
    assert all(got[10 + i].n_email == got[10 + i].n_term == 3_000 for i in range(4))
    out = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert out[1] == " ".join(["<email>"] * 50_000) and out[11] == "<email> <term> " * 3_000 + "1x"
    assert all(out[i] == t for i, t in rows if i >= 1000)


def test_cuts_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(pii, "PIECE", 7)
    text = "é" * 20 + " a@b.co \U0001F600\n" * 5 + "x" * 15 + " 10.0.0.1" + "\n tail of it"
    docs = spark.createDataFrame([(1, text), (2, "a@b.co"), (3, None)], "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in pii.sanitised(docs).collect()} == {1: brute.masked(text), 2: "<email>", 3: None}


def plain_words(n):
    return [(1000 + i, "é " + " ".join(f"word{chr(97 + i // 7 ** k % 7)}{'xyz'[k % 3]}{k}" for k in range(6))) for i in range(n)]


def personal_data(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {r.doc_id: r.text for r in corpus_pipeline.personal_data(spark, docs, None).collect()}


def test_terms_are_generalised_wherever_they_occur(spark):
    """At production thresholds: also in the next line, and in a document without any value."""
    rows = plain_words(3000)
    rows += [(i, f"{rows[i][1]} sue@ex.org\n{rows[i + 9][1]} Zorblatt,\n") for i in range(12)]
    rows += [(80, f"{rows[50][1]}\n\nzorblatt {rows[51][1]}"), (90, None), (None, "zorblatt")]
    out = personal_data(spark, rows)
    text = dict(rows)
    for i in range(12):
        assert out[i] == text[i].replace("Zorblatt,", "<term>").replace("sue@ex.org", "<email>")
    assert out[80] == text[80].replace("zorblatt", "<term>") and out[90] is None and out[None] == "<term>"
    assert all(out[i] == text[i] for i in text if i and i >= 1000)


def test_handles_and_numbers_are_terms(spark):
    """Words with digits or @ count; words that overlap a base span don't."""
    rows = plain_words(3000)
    rows += [(i, f"{rows[i][1]} @jdoe, user4711 sue@ex.org/ +49 (30) 1234567 {rows[i + 9][1]}") for i in range(12)]
    rows += [(80, "é user4711"), (90, "é (30)")]
    out = personal_data(spark, rows)
    text = dict(rows)
    for i in range(12):
        assert out[i] == " ".join([text[i].split(" @")[0], "<term> <term> <email>/ <phone>", text[i].split("567 ")[1]])
    assert out[80] == "é <term>" and out[90] == text[90] and all(out[i] == text[i] for i in text if i >= 1000)


def test_free_terms(spark):
    text = "A.b@c.org: x.b@c, +1 (555) 123-4567, (555) \uE000 4111 1111 1111 1111x 1.2.3.4 1.2.3.444 @JDoe; a@b"
    got = spark.createDataFrame([(text,), (None,), ("",)], "text string").select(pii.free_terms(F.col("text")).alias("t"))
    words = "x.b@c 555 \uE000 1.2.3.444 @jdoe a@b".split()
    assert [r.t for r in got.collect()] == [words, None, []]


def test_packing(edge_docs, edge_rows, tokenizer):  # noqa: F811
    named = edge_docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {i: t for i, t, _ in edge_rows if i is not None}
    packed_right(packing.pack(named).collect(), texts, tokenizer)
    rows = packing.pack(edge_docs).collect()
    assert sum(r.doc_id is None for r in rows) == 2 and sum(r.doc_id == 11 for r in rows) == 2


def test_packing_an_empty_table(no_docs):
    assert packing.pack(no_docs).collect() == []


def test_packing_over_many_groups(spark, monkeypatch):
    """The tree of groups loses nothing and fills what groups leave."""
    monkeypatch.setattr(packing, "GROUP", 20)
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit(" a"), (F.pmod(F.xxhash64("id"), F.lit(900)) + 1).cast("int")).alias("text"),
    )
    rows = packing.pack(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    import public_tokenizers
    from tokenizers import Tokenizer

    n = packed_right(rows, texts, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    assert n <= 1.1 * -(-sum(r.length for r in rows) // packing.LENGTH)


def test_fast_encoder_equals_the_library(tokenizer):  # noqa: F811
    import random

    rng = random.Random(3)
    marks = [chr(c) for c in range(0x280)] + [" ", "\n", "'s", "<|endoftext|>", "漢", "　", "\U0001F600", "  "]
    encode = packing.encoder()
    for _ in range(500):
        text = "".join(rng.choice(marks) for _ in range(rng.randint(0, 80)))
        assert encode(text)[:-1].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_cut():
    assert packing.cut(2048) == [0, 2048] and packing.cut(2049) == [0, 1, 2049] and packing.cut(4096) == [0, 2048, 4096]


VECTORS = [
    (0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [-1.0, 0.5]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [1.0, None]),
    (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [3.0]), (200, [2.0]), (8, [0.0009, -0.0001]), (None, [5.0, 5.0]),
    (9, []), (300, []), (400, None), (10, [1e30, 1.0]),
]


def test_top_k(spark):
    import math

    rows = [(i, v, "clash", "clash") for i, v in VECTORS]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, dim string, item string")
    fine = [(i, [math.floor(1024 * x) for x in v]) for i, v in VECTORS if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = set()
    for q, v in fine:
        if q is not None and q % 100 == 0:
            found = [(i, brute.dot(v, w)) for i, w in fine if i != q and len(w) == len(v)]
            found = [(i, max(-(2**63), min(2**63 - 1, s))) for i, s in found]
            found.sort(key=lambda f: (-f[1], f[0] is None, f[0] or 0))
            want |= {(q, n + 1, i, s) for n, (i, s) in enumerate(found[:3])}
    got = topk.top_k(df, F.col("vec_id") % 100 == 0, k=3, shard_rows=4, block=2).collect()
    assert brute.counted(got) == brute.counted(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_a_candidate_takes_one_rank(spark):
    """Two vectors of one query: the better score of each candidate counts, once."""
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), *[(i, [i / 64, 1 - i / 64]) for i in range(1, 30)], (7, [7 / 64, 1 - 7 / 64])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    best = sorted(((-1024 * max(16 * i, 1024 - 16 * i), i) for i in [*range(1, 30), 7]))
    for shard_rows in (4, 4096):
        got = topk.top_k(df, F.col("vec_id") == 0, k=8, shard_rows=shard_rows).orderBy("rank").collect()
        assert [(-r.score, r.vec_id) for r in got] == best[:8]



def test_top_k_over_shards_and_ties(spark):
    df = spark.range(3000).select(
        F.col("id").alias("vec_id"), F.array(*[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(7)) - 3).cast("float") for i in range(4)]).alias("embedding")
    )
    rows = [(r.vec_id, [int(1024 * x) for x in r.embedding]) for r in df.collect()]
    got = topk.top_k(df, F.col("vec_id") % 100 == 0, shard_rows=300, block=7).collect()
    want = []
    for q, v in rows[::100]:
        found = sorted((-brute.dot(v, w), i) for i, w in rows if i != q)[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    assert brute.counted(got) == brute.counted(want)


PAGES = [
    (1, "http://User@WWW.Example.com:80/a?b#c", "<p>é</p>"), (2, "https://example.com/a b\r\nX: y", "<p>é</p>"), (3, None, None),
    (4, "", ""), (4, "", ""), (5, "no scheme", "x" * 300_000), (None, "http://a.b/", "<p>é</p>"), (None, "http://a.b/", "only null"),
    (6, "http://a.b/", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"),
]


def test_archives(spark):
    import base64
    import hashlib

    rows = [(*p, "clash", "clash") for p in PAGES]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, key string, archive string").repartition(3)
    last = {}
    for i, _, h in PAGES:
        if i is not None:
            last[h or ""] = max(last.get(h or "", 0), i)
    want = []
    for i, _, h in PAGES:
        data = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = last.get(h or "")
        again = first is not None and i != first
        want.append((i, len(data), digest, "revisit" if again else "response", first if again else None))
    assert brute.counted(warc.archived(pages).collect()) == brute.counted(want)
    assert warc.archived(pages.limit(0)).collect() == []


def test_index_finds_keys(spark, tmp_path):
    import random

    rng = random.Random(2)
    keys = [f"com,h{rng.randint(0, 30)})/{rng.randint(0, 40)}" for _ in range(2000)] + ["com,hot)/"] * 800
    rows = [(k, f"f{n % 5}", n, 10) for n, k in enumerate(keys)]
    folder = f"file://{tmp_path}/index"
    top = warc.write_index(spark.createDataFrame(rows, warc.CAPTURE), folder, block=16)
    asked = [*set(keys[::3]), "com,hot)/", "", "zz", "com,h1)/nowhere", None]
    found = warc.look_up(spark.createDataFrame([(k,) for k in asked], "key string"), top, folder)
    assert brute.counted(found.collect()) == brute.counted(r for r in rows if r[0] in set(asked))


def test_url_keys(spark):
    urls = ["http://User@WWW.Example.com:80/a?b#c", "https://example.com", "no scheme", None, ""]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key(F.col("u")).alias("k")).collect()
    assert [r.k for r in rows] == ["com,example,www)/a?b", "com,example)", "no%20scheme)", "", ""]


def test_pipeline_stages(spark, edge_docs, tmp_path):
    labels = spark.createDataFrame([(1, 0, 0), (8, 1, 0)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for case, docs in {"edges": edge_docs, "empty": edge_docs.limit(0)}.items():
        for name, stage in corpus_pipeline.STAGES:
            path = f"{tmp_path}/{case}/{name}"
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == edge_docs.columns, name


def test_pipeline(spark, tokenizer):  # noqa: F811
    """Against plain Python, but for the verdicts of the model, which are the operator's."""
    import zlib

    import numpy as np

    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in quality.quality(docs, labels).filter("kept").collect()}
    docs = {r.doc_id: (r.source, r.text) for r in docs.collect() if r.doc_id in good}
    groups = brute.near_groups([(i, t) for i, (_, t) in docs.items()])
    docs = {i: (s, brute.masked(t)) for i, (s, t) in docs.items() if groups[i][1] == i}
    copies = brute.mixed_copies([(i, s, t) for i, (s, t) in docs.items()])
    want = []
    for i, (_, text) in docs.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        ends = packing.cut(len(ids))
        rows = [(i, k, a, z - a, zlib.crc32(ids[a:z].tobytes())) for k, (a, z) in enumerate(zip(ends, ends[1:]))]
        want += rows * copies[i]
    rows = corpus_pipeline.run(spark, sf).collect()
    assert brute.counted(r[:5] for r in rows) == brute.counted(want)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in by.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    assert len(by) <= 1.05 * -(-sum(r.length for r in rows) // packing.LENGTH)


def test_second_texts_keep_their_links(spark):
    """Among many near copies, documents with two texts link what either text is near to."""
    import random

    rng = random.Random(11)
    rows = []
    for g in range(3):
        centre = [f"g{g}w{i}" for i in range(100)]
        for n in range(60):
            w = list(centre)
            for k in rng.sample(range(100), 1):
                w[k] = f"x{g}_{n}_{k}"
            rows.append((1000 * g + n, " ".join(w)))
    rows.append((2500, rows[3][1] + " tail"))  # a text near the first group
    rows.append((2500, rows[130][1] + " tail"))  # and one near the third
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    want = {}
    for g in range(3):
        own = [(i, t) for i, t in rows if i // 1000 == g and i != 2500]
        want |= {i: c for i, (_, c) in brute.near_groups(own).items()}
    first = {c for i, c in want.items() if i < 1000}
    third = {c for i, c in want.items() if i >= 2000}
    assert len(first) == len(third) == 1  # so the two groups become one through 2500
    for i, c in got.items():
        assert c == (0 if i < 1000 or i >= 2000 else want[i])


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 18])
def test_character_windows_are_code_points(monkeypatch, block):
    """Windows of four code points of one to four bytes, wherever a block ends."""
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é界😀\n ") for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += ["", "x" * 5, "界" * 3, "😀" * 4]

    def feature(window):
        points = np.array([int.from_bytes(c.encode(), "little") for c in window], np.uint64)
        return (int(quality.windows(points, 4)[0]) >> (64 - quality.BITS)) + (2 << quality.BITS)

    monkeypatch.setattr(quality, "BLOCK", block)
    t = quality.Texts([x.encode() for x in texts])
    found = [(i, f) for k, fs, of in quality.families(t, t.word_hashes()) if k == 2 for i, f in zip(of, fs)]
    assert sorted(found) == sorted((i, feature(x[j : j + 4])) for i, x in enumerate(texts) for j in range(len(x) - 3))
    assert quality.family_sizes(t)[2].tolist() == [max(0, len(x) - 3) for x in texts]
