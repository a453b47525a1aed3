"""Sizes of texts in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog.plans.spread import spread

#: Where the vocabulary lies unless a path is given.
VOCABULARY = os.environ.get("STRATALOG_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: Fixed value: the pattern that cuts a text into pieces before byte-pair merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoder(path: str):
    """The tokenizer of a vocabulary file of base64 tokens and ranks."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_tokens(docs: DataFrame, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, the columns `keep` and n_tokens of documents whose text isn't null. Whole texts are counted."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([f"doc_id {fields['doc_id']}", *[f"`{c}` {fields[c]}" for c in keep], "n_tokens long"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(vocabulary)
        for pdf in batches:
            yield pdf.drop(columns="text").assign(n_tokens=[len(enc.encode_ordinary(t)) for t in pdf.text])

    cols = docs.select("doc_id", *keep, "text").where(F.col("text").isNotNull())
    return spread(cols, "doc_id").mapInPandas(count, schema)
