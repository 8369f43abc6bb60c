"""Sizes of texts in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How byte-level BPE cuts a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoding(path: str):
    """The encoder of a vocabulary file, loaded once in each Python worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """The number of tokens of ``text``; 0 for null and empty texts."""

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            encode = encoding(path).encode_ordinary
            yield pd.Series([len(encode(t)) if t else 0 for t in batch], dtype="int32")

    return count(text)
