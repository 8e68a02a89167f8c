"""Token counts: batch encoding in Arrow functions that return lengths only.

A batch holds texts of about the same number of bytes in total. A long text is
cut where no token can reach across, so that the parts' counts add up to its
own: between two ASCII letters or digits with one space between them. What a
piece vocabulary allows is read from its pieces when it is loaded.

Null and empty texts have no tokens. Repeated rows are counted each; other
columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import batches, vocabulary_path

BATCH_BYTES = 1 << 20
LONG_BYTES = 1 << 16
_BREAK = re.compile(rb"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")
_SPACE = "▁"  # fixed value: how piece vocabularies write a space


class Counter(Protocol):
    keeps_space: bool | None  # whether a part after a cut starts with its space; None: no cuts

    def counts(self, texts: list[str]) -> list[int]: ...


class PieceCounter:
    """A sentence piece vocabulary. A part gets the space in front back by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        crossing = any(_SPACE in piece.lstrip(_SPACE) for piece in pieces)
        one, two = self.model.encode("a"), self.model.encode("a a")
        self.keeps_space = None if crossing or two != one + one else False

    def counts(self, texts: list[str]) -> list[int]:
        return list(map(len, self.model.encode(texts, num_threads=1)))


class JsonCounter:
    """A vocabulary whose pattern ends a word before a space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        spaced = self.model.encode("a a", add_special_tokens=False).ids
        parts = [self.model.encode(x, add_special_tokens=False).ids for x in ("a", " a")]
        self.keeps_space = True if spaced == parts[0] + parts[1] else None

    def counts(self, texts: list[str]) -> list[int]:
        return [
            len(x.ids) for x in self.model.encode_batch_fast(texts, add_special_tokens=False)
        ]


@lru_cache(maxsize=4)
def counter(name: str) -> Counter:
    path = vocabulary_path(name)
    return PieceCounter(path) if path.endswith(".model") else JsonCounter(path)


def parts(text: bytes, keeps_space: bool | None, long_bytes: int = LONG_BYTES) -> Iterator[bytes]:
    """A text in parts of about `long_bytes`, cut at the next safe place."""
    start = 0
    while keeps_space is not None and len(text) - start > long_bytes:
        found = _BREAK.search(text, start + long_bytes)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start() if keeps_space else found.end()
    yield text[start:]


def count_batch(texts: list[bytes], model: Counter, long_bytes: int = LONG_BYTES) -> list[int]:
    pieces, owners = [], []
    for owner, text in enumerate(texts):
        for part in parts(text, model.keeps_space, long_bytes):
            pieces.append(part.decode("utf-8", "replace"))
            owners.append(owner)
    totals = [0] * len(texts)
    for owner, n in zip(owners, model.counts(pieces), strict=True):
        totals[owner] += n
    return totals


def token_count(text: Column, tokenizer: str) -> Column:
    """Number of tokens of a text column, as bigint."""

    @F.arrow_udf("bigint")
    def count(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = counter(tokenizer)
        for column in columns:
            lengths: list[int] = []
            for run in batches(column, BATCH_BYTES):
                lengths += count_batch(run, model)
            yield pa.array(lengths, pa.int64())

    return count(F.coalesce(text, F.lit("")))


def token_counts(
    docs: DataFrame, tokenizer: str = "piece_bpe_32k.model", limit: int = 4096
) -> DataFrame:
    """Bytes and tokens of each document, and whether it exceeds a context length."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        token_count(text, tokenizer).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
