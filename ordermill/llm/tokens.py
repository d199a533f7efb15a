"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Name of a vocabulary file as ranks, or its path.
VOCABULARY = "byte_bpe_50k.tiktoken"


@lru_cache(2)
def encoding(vocabulary: str = VOCABULARY):
    import public_tokenizers
    import tiktoken

    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(documents: DataFrame, *keep: str, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns keep and tokens: the size of each text. NULL and empty texts have 0; texts are counted whole."""
    fields = ", ".join(f"{c} {documents.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoding(vocabulary)
        for pdf in batches:
            n = [len(e.encode_ordinary(t)) if t else 0 for t in pdf["_text"]]
            yield pdf[list(keep)].assign(tokens=pd.Series(n, index=pdf.index, dtype="int64"))

    return documents.select(*keep, F.col(text).alias("_text")).mapInPandas(run, f"{fields}, tokens long")
