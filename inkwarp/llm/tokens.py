"""Sizes of texts in tokens of a public tokenizer, whose file is a parameter."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's makers cut a text before merging bytes; a fixed value of the format.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(2)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Tokens of the whole text as a long; NULL for NULL, 0 for the empty text."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        own = encoding(path)
        return pd.Series([None if t is None else len(own.encode_ordinary(t)) for t in texts], dtype="Int64")

    return count.asNondeterministic()(text)  # else a filter on the count would count again
