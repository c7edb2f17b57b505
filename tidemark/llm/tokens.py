"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary is found unless a caller says otherwise: ranks (``.tiktoken``) or a whole
#: tokenizer (``.json``).
TOKENIZER = os.path.join(os.environ.get("TIDEMARK_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_50k.tiktoken")
#: The public pattern that splits text before the merges of the rank files (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LOADED: dict[tuple[str, str], Callable[[str], int]] = {}


def counter(path: str = TOKENIZER, pattern: str = PATTERN) -> Callable[[str], int]:
    """Counts the tokens of a text; the file is read once in each worker. Markers inside a text are
    ordinary text."""
    if (path, pattern) not in _LOADED:
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tool = Tokenizer.from_file(path)
            tool.encode_special_tokens = True
            _LOADED[path, pattern] = lambda text: len(tool.encode(text, add_special_tokens=False).ids)
        else:
            import tiktoken

            with open(path, "rb") as file:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            _LOADED[path, pattern] = lambda text: len(encoding.encode_ordinary(text))
    return _LOADED[path, pattern]


def with_token_counts(docs: DataFrame, text: str, into: str = "n_tokens", path: str = TOKENIZER, pattern: str = PATTERN) -> DataFrame:
    """``docs`` with the number of tokens of ``text``; null and empty texts have none."""
    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        tool = counter(path, pattern)
        return pd.Series([tool(t) if isinstance(t, str) and t else 0 for t in texts], dtype="int64")

    return docs.withColumn(into, count.asNondeterministic()(F.col(text)))
