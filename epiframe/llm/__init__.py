"""Operators of training-data pipelines, one module each, and their queries."""

from epiframe.llm import (  # noqa: F401
    embedding_dedup, infill, licenses, mixing, near_dedup, packing, pii, quality, sharding, token_counts, topk, vector_codes, warc,
)
from epiframe.llm.common import QUERIES, SQL  # noqa: F401
