"""SG*: segments of at most 800 characters, split at the strongest separator that is there."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.functions.rules import PAGE_MARK
from inkmill.functions.text import strip, sub

SEPARATORS = ("\n\n", "\n", "。", "！", "？", "；", "，", " ", "")
SIZE, OVERLAP, SHORTEST = 800, 150, 50


def _packed(parts: list[str], size: int, overlap: int) -> list[str]:
    """Neighbouring parts joined up to size; each pack begins with the last parts of the one before, up to overlap."""
    packs, held, length = [], [], 0
    for part in parts:
        if length + len(part) > size:
            if held:
                packs.append("".join(held).strip())
            while held and (length > overlap or (length + len(part) > size and length > 0)):
                length -= len(held.pop(0))
        held.append(part)
        length += len(part)
    packs.append("".join(held).strip())
    return [p for p in packs if p]


def split_text(text: str, size: int = SIZE, overlap: int = OVERLAP, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """SG2: chunks of the text; a separator stays at the head of the part after it."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    mark, finer = separators[at], separators[at + 1 :]
    if mark:
        first, *rest = text.split(mark)
        parts = [p for p in (first, *(mark + x for x in rest)) if p]
    else:
        parts = list(text)
    chunks, small = [], []
    for part in parts:
        if len(part) < size:
            small.append(part)
            continue
        if small:
            chunks += _packed(small, size, overlap)
            small = []
        chunks += split_text(part, size, overlap, finer) if finer else [part]
    return chunks + (_packed(small, size, overlap) if small else [])


def segments(df: DataFrame, id_col: str, text_col: str, size: int = SIZE, overlap: int = OVERLAP, shortest: int = SHORTEST) -> DataFrame:
    """SG1-5: id, segment_no (ordinal before the length filter), content.  Row-local, one Arrow hop; null texts give none."""

    @F.pandas_udf("array<string>")
    def chunked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: None if t is None else split_text(t, size, overlap))

    pieces = df.select(id_col, F.posexplode(chunked(F.regexp_replace(text_col, "(?Ud)" + PAGE_MARK, ""))).alias("segment_no", "content"))
    return long_enough(pieces, shortest)


def long_enough(pieces: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """SG3-5: pieces with single white space, those of more than ``shortest`` characters; numbers stay as they were."""
    return pieces.withColumn("content", strip(sub(F.col("content"), r"\s+", " "))).where(F.length("content") > shortest)
