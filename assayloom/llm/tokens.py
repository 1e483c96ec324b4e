"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rank file of a byte-level BPE; every executor reads it from this path.
RANKS = os.environ.get("ASSAYLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the public pre-tokenisation pattern of that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(path: str = RANKS):
    """The tokenizer of a rank file, once per process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str = RANKS) -> Column:
    """Number of tokens of a text read whole; 0 for null and empty."""

    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(path)
        for texts in parts:
            yield pd.Series([len(enc.encode_ordinary(t)) for t in texts], dtype="int64")

    return F.pandas_udf(count, T.LongType())(F.coalesce(text, F.lit("")))


_SPLIT = T.StructType().add("total", T.LongType()).add("prompt", T.LongType())


def prompt_count(text: Column, parted: str, path: str = RANKS) -> Column:
    """(total, prompt): tokens of a text read whole, and of its prompt, which ends with the first match of `parted`; 0 where none."""
    mark = re.compile(parted)

    def count(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoding(path)
        for texts in parts:
            cuts = [m.end() if (m := mark.search(t)) else 0 for t in texts]
            prompt = [len(enc.encode_ordinary(t[:c])) if c else 0 for t, c in zip(texts, cuts)]
            total = [len(enc.encode_ordinary(t)) for t in texts]
            yield pd.DataFrame({"total": total, "prompt": [min(p, n) for p, n in zip(prompt, total)]}, dtype="int64")

    return F.pandas_udf(count, _SPLIT)(F.coalesce(text, F.lit("")))
