"""Sizes of texts in tokens of a public byte-pair vocabulary, read from a file that is a parameter."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vocabulary of ranks, one "base64 rank" per line; and the pattern that splits texts before merging.
DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
DEFAULT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _counter(ranks_file: str, pattern: str):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import base64
        import sys
        import types

        import tiktoken

        # a Python worker serves many tasks: it reads the vocabulary once
        kept = sys.modules.setdefault("_gridloom_vocabularies", types.ModuleType("_gridloom_vocabularies")).__dict__
        if (ranks_file, pattern) not in kept:
            with open(ranks_file, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
            kept[ranks_file, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        encoding = kept[ranks_file, pattern]
        for batch in batches:
            sizes = [len(encoding.encode_ordinary(t.encode("utf-8", "replace").decode("utf-8"))) for t in batch["text"]]
            yield pd.DataFrame(batch.drop(columns="text").assign(n_tokens=sizes))

    return count


def token_sizes(df: DataFrame, text: str, carried: list[str], ranks_file: str = DEFAULT_RANKS, pattern: str = DEFAULT_PATTERN) -> DataFrame:
    """The ``carried`` columns and ``n_tokens``; rows without a text are left out. The text itself is not carried on."""
    rows = df.where(F.col(text).isNotNull()).select(*carried, F.col(text).alias("text"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.drop("text").dtypes)
    return rows.mapInPandas(_counter(ranks_file, pattern), f"{kinds}, n_tokens long")
