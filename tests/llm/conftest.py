import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from brute import BASE, CLASHES, CODE, LONG, NEAR  # noqa: E402

@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text, source): nulls, empty and very long texts, ties, repeated rows."""
    return [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n\n", None),
        (4, "one two three", "b"),
        (5, "ONE two\nthree", "b"),
        (6, LONG, "b"),
        (7, CODE, "c"),
        (8, BASE, "c"),
        (9, NEAR, None),
        (10, NEAR.upper(), "a"),
        (11, "mail a.b+c@ex-1.example.com, a@b.co+d@e.org ip 10.0.0.255 1.2.3.256 é 4111-1111 1111 1111 +49 (30) 1234-567", "a"),
        (11, "mail a.b+c@ex-1.example.com, a@b.co+d@e.org ip 10.0.0.255 1.2.3.256 é 4111-1111 1111 1111 +49 (30) 1234-567", "a"),
        (12, "漢字 и текст <|endoftext|>   \U0001F600", "é"),
        (13, "same line here\nsame line here\n\n\n a b c d e a b c d e", "Z"),
        (None, "no id at all", "a"),
        (None, BASE, None),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    rows = [(i, t, "xx", s, len(t or ""), *(["clash"] * len(CLASHES))) for i, t, s in edge_rows]
    kinds = ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {kinds}")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 0, 0), (2, 0, 0), (8, 1, 0), (9, 1, 0), (9, None, 1), (None, 1, 0), (4, 7, 0)],
        "doc_id bigint, quality int, toxic int",
    )
