"""Token counts of whole texts, by a compiled finite-state transducer (see `transducer`).

Defined results: NULL and empty text have 0 bytes and 0 tokens; strings of special tokens inside
a text count as one token each; texts of any length are counted whole, in chunks whose
state maps are composed; repeated rows are counted each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sparkrec.llm.common import text_of
from sparkrec.llm.transducer import TokenCounter

LIMIT = 2048


@lru_cache(maxsize=2)
def _counter(vocabulary: str) -> TokenCounter:
    """One counter per Python worker, kept for all its tasks."""
    return TokenCounter(vocabulary_path(vocabulary))


def vocabulary_path(name: str) -> str:
    """Place of a vocabulary on the machine that asks; absolute paths are taken as they are."""
    if name.startswith("/"):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(vocabulary)
        for b in batches:
            yield pd.DataFrame({
                "doc_id": b["doc_id"], "n_bytes": b["n_bytes"],
                "n_tokens": [counter.count(t) for t in b["text"]]})

    read = docs.select(
        F.col("doc_id").cast("long"), F.octet_length(text_of()).cast("long").alias("n_bytes"), text_of().alias("text"))
    return read.mapInPandas(run, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
