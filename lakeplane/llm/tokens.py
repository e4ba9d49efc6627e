"""Sizes in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the vocabulary files on every machine, and the default file.
FOLDER = "/opt/tokenizers"
RANKS = "byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pattern by which the vocabulary's byte-level BPE splits text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_LOADED: dict[str, object] = {}


def encoding(path: str):
    """The tokenizer of a rank file, loaded once per process."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def with_token_counts(df: DataFrame, text: str, path: str = f"{FOLDER}/{RANKS}") -> DataFrame:
    """All columns but ``text``, and n_tokens of the whole text; null and empty texts have 0."""
    keep = [c for c in df.columns if c != text]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoding(path).encode_ordinary
        for pdf in batches:
            pdf["n_tokens"] = [len(encode(t)) if t else 0 for t in pdf.pop(text)]
            yield pdf

    schema = df.select(*keep, F.lit(0).cast("long").alias("n_tokens")).schema
    return df.select(*keep, text).mapInPandas(count, schema)
