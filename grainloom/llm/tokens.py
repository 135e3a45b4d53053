"""Token counts by a public tokenizer whose file is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("GRAINLOOM_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the pre-tokenizer pattern published with the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
PIECE = 20_000  # characters encoded at once; texts are cut at line ends only


@lru_cache(maxsize=4)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str | None, path: str = VOCABULARY) -> int:
    if not text:
        return 0
    return len(encoder(path).encode_ordinary(text))


class _Sizes:
    def __init__(self, path: str):
        self.path = path

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(self.path)
        for b in batches:
            t = b.column(b.num_columns - 1).to_pylist()
            n = [len(enc.encode_ordinary(x)) if x else 0 for x in t]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*b.schema.names[:-1], "tokens"])


def with_tokens(df: DataFrame, keep: list[str], text: str, path: str = VOCABULARY) -> DataFrame:
    """``keep`` columns and ``tokens`` of each row; null and empty texts have none."""
    d = df.select(*[F.col(c) for c in keep], F.col(text).cast("string").alias("_text"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in d.drop("_text").dtypes)
    return d.mapInArrow(_Sizes(path), f"{kinds}, tokens bigint")
