"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All but the
last return the columns of documents.
"""

from epiframe.llm.common import settle, table
from epiframe.llm.mixing import mixed
from epiframe.llm.near_dedup import first_of_each
from epiframe.llm.packing import pack
from epiframe.llm.pii import sanitised
from epiframe.llm.quality import passing


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the plain rules and the model trained on the labels."""
    return passing(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies, the one with the smallest doc_id."""
    return first_of_each(docs)


def personal_data(spark, docs, sf_dir):
    """Personal data and the terms that give it away replaced by labels."""
    return sanitised(docs)


def source_mix(spark, docs, sf_dir):
    """Each document as often as the mix takes it, possibly never."""
    return mixed(docs)


def packed_sequences(spark, docs, sf_dir):
    """Token pieces with their place in sequences."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packed_sequences", packed_sequences),
]

#: Model scores, token ids and MinHash candidates are not SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage, from the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
