"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..runtime import arrow_schema

#: Vocabulary used unless another file is named; it is read on the executors and never copied.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenization pattern the vocabulary was made with.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoder(path: str = VOCABULARY):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(df: DataFrame, keep: Sequence[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``tokens``, the size of the whole text. Null text has size 0."""
    out = T.StructType([df.schema[c] for c in keep] + [T.StructField("tokens", T.LongType())])
    schema = arrow_schema(out)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = None
        for b in batches:
            enc = enc or encoder(path)
            sizes = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(i).cast(schema[i].type) for i in range(len(keep))] + [pa.array(sizes, pa.int64())], schema=schema)

    return df.select(*keep, text).mapInArrow(count, out)
