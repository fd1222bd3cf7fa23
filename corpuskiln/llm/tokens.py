"""Text sizes in tokens of a public byte-level BPE tokenizer."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Vocabulary file; a parameter of everything that counts tokens. It must lie at this path on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoder(path: str = VOCABULARY):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Tokens of each whole text; null for null. Strings that look like special tokens are ordinary text."""

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        enc = encoder(path)
        return pd.Series([None if t is None else len(enc.encode_ordinary(t)) for t in texts], dtype="Int64")

    return count(text)
