"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsight.session import new_folder, shared_dir

#: Bytes of text that an operator works on at a time inside a task.
BLOCK_BYTES = 1 << 20


#: Bytes of words (digits, letters, all beyond ASCII) to themselves or lower case, others to a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utf8(text: str | Column) -> Column:
    """The text's bytes; NULL is the empty text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("binary"), F.lit(b""))


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a Parquet table of the shared folder, so that what follows neither computes them
    again nor depends on an executor that may be lost."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as they are now, in the shared folder; Spark removes them when nothing refers to them."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def blocks(texts: list[bytes], size: int = BLOCK_BYTES, rows: int = 1024) -> Iterator[tuple[int, int]]:
    """Ranges of up to ``rows`` texts of about ``size`` bytes; a longer text is a range of its own."""
    start = total = 0
    for i, text in enumerate(texts):
        if i > start and (total + len(text) > size or i - start == rows):
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def pieces(text: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """A long run of space-separated words in parts, cut at spaces."""
    start = 0
    while len(text) - start > size:
        end = text.find(b" ", start + size)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:]


def offsets(lengths) -> np.ndarray:
    """Where each of several runs begins, and the end of the last."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
