"""Token counts of whole texts, by Arrow batches balanced by bytes.

Only lengths leave the tasks. Long texts are split where a word ends and white space
begins: no token of the byte-level patterns spans such a place, and no look-ahead reaches
back over it, so the counts of the pieces add up to the count of the whole.

Defined results
* A null text counts as empty: 0 bytes, 0 tokens. A null doc_id is kept.
* Special strings within a text are handled as the library does by default; no begin, end
  or other tokens are added, nothing is cut or padded.
* Repeated rows give repeated results, an empty table an empty one; other columns are ignored.
"""

import re
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import query, table, text_bytes
from epiframe.llm.scan import batches

BATCH = 1 << 20
PIECE = 1 << 16
LIMIT = 1024
_SAFE = re.compile(r"(?<=\S)(?=[ \n])")
_loaded: dict = {}


def pieces(text: str, most: int = PIECE) -> Iterator[str]:
    """The text in pieces of about ``most`` characters, cut only at safe places."""
    at = 0
    while len(text) - at > most:
        cut = _SAFE.search(text, at + most)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def lengths(name: str) -> Callable[[list[str]], list[int]]:
    """Counts the tokens of each text; ``.model`` files are not split into pieces."""
    if name not in _loaded:
        path = name if "/" in name else public_tokenizers.path(name)
        if name.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[name] = False, lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_padding(), model.no_truncation()
            split = type(model.pre_tokenizer).__name__ == "ByteLevel" and model.normalizer is None
            _loaded[name] = split, lambda texts: [
                len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)
            ]
    split, count = _loaded[name]

    def counted(texts):
        if not split:
            return count(texts)
        parts, owner = [], []
        for i, text in enumerate(texts):
            for p in pieces(text):
                parts.append(p)
                owner.append(i)
        out = [0] * len(texts)
        for s in batches([len(p) for p in parts], BATCH):
            for i, n in zip(owner[s], count(parts[s])):
                out[i] += n
        return out

    return counted


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = lengths(tokenizer)
        for batch in parts:
            n = []
            for s in batches(batch.column(1).to_pylist(), BATCH):
                texts = batch.column(2).slice(s.start, s.stop - s.start)
                n += counter([t or "" for t in texts.to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    rows = docs.select("doc_id", text_bytes(F.col("text")).alias("n_bytes"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


@query("op3_token_counts")
def op3_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))
