"""Problem 3: cutting oversized texts at natural boundaries, by recursive bisection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BREAK = regex.compile(r"[^\p{L}\p{N}]")
_PARAGRAPH = regex.compile(r"\n[^\S\n]*\n\s*|\r\n[^\S\n]*\r\n\s*")
_LINE = regex.compile(r"[\r\n  ]+")
_SENTENCE = regex.compile(r"[。！？!?…；;]+[”’」』）)\"']*|\.[”’)\"']*(?=\s)")
_CLAUSE = regex.compile(r"[，、：,:]")
PIECE = "array<struct<piece_no:int,start:int,core_start:int,stop:int,piece:string,forced:boolean>>"


def strengths(text: str) -> np.ndarray:
    """How natural a cut before each position is: 5 paragraph, 4 line, 3 sentence, 2 clause, 1 beside any character that is
    neither letter nor digit, 0 inside an unbroken stretch of letters and digits."""
    s = np.zeros(len(text) + 1, np.int8)
    at = np.fromiter((m.start() for m in _BREAK.finditer(text)), np.int64)
    s[at] = 1
    s[at + 1] = 1
    for level, pattern in ((2, _CLAUSE), (3, _SENTENCE), (4, _LINE), (5, _PARAGRAPH)):
        ends = np.fromiter((m.end() for m in pattern.finditer(text)), np.int64)
        s[ends] = level
    return s


def bisect(text: str, limit: int, overlap: int) -> list[tuple[int, int, int, int, str, bool]]:
    """(piece_no, start, core_start, stop, piece, forced) of each piece of text, in order.

    A span longer than limit - overlap is cut at the strongest boundary in its middle half, the one nearest the midpoint
    among equals; without one there, at the nearest boundary anywhere inside.  A span without any boundary stays whole
    up to limit and is halved beyond it; ``forced`` marks a piece that begins at such a cut.  Then every piece but the
    first is extended to the left by up to ``overlap`` characters, to a boundary where there is one, within limit.
    Cores (core_start to stop) join to the text without gap.  Texts up to limit come out as one piece; empty ones as none.
    """
    n = len(text)
    if n == 0:
        return []
    if n <= limit:
        return [(0, 0, 0, n, text, False)]
    s = strengths(text)
    natural = np.flatnonzero(s)
    target = limit - overlap
    cores: list[tuple[int, int, bool]] = []
    todo = [(0, n, False)]
    while todo:
        a, b, forced = todo.pop()
        if b - a <= target:
            cores.append((a, b, forced))
            continue
        mid, quarter = (a + b) // 2, (b - a) // 4
        lo, hi = max(a + 1, mid - quarter), min(b - 1, mid + quarter)
        window = s[lo : hi + 1]
        best = int(window.max()) if window.size else 0
        if best == 0:
            i = int(np.searchsorted(natural, mid))
            near = [int(natural[k]) for k in (i - 1, i) if 0 <= k < len(natural) and a < natural[k] < b]
            if near:
                cut, hard = min(near, key=lambda x: abs(x - mid)), False
            elif b - a <= limit:
                cores.append((a, b, forced))
                continue
            else:
                cut, hard = mid, True
        else:
            places = np.flatnonzero(window == best) + lo
            cut, hard = int(places[np.abs(places - mid).argmin()]), False
        todo += [(cut, b, hard), (a, cut, forced)]  # the left half is taken first
    out = []
    for k, (a, b, forced) in enumerate(cores):
        start = a
        if k:
            first = max(a - min(overlap, limit - (b - a)), out[-1][1] + 1, 0)
            if first < a:
                i = int(np.searchsorted(natural, first))
                clean = np.flatnonzero(s[first : first + (a - first) // 3 + 1] >= 2)  # rather after a mark than before it
                start = first + int(clean[0]) if len(clean) else int(natural[i]) if i < len(natural) and natural[i] < a else (first if forced else a)
        out.append((k, start, a, b, text[start:b], forced))
    return out


def cut_texts(df: DataFrame, text_col: str, limit: int, overlap: int, out_col: str = "pieces") -> DataFrame:
    """Add ``pieces``, an array of (piece_no, start, core_start, stop, piece, forced); null for null texts.

    Row-local: no shuffle, one Arrow hop, whole texts.  Offsets count code points.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")

    @F.pandas_udf(PIECE)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([None if t is None else [dict(zip(("piece_no", "start", "core_start", "stop", "piece", "forced"), p)) for p in bisect(t, limit, overlap)] for t in texts], dtype=object)

    return df.withColumn(out_col, run(F.col(text_col)))


def oversized_pieces(df: DataFrame, id_col: str, text_col: str, limit: int, overlap: int) -> DataFrame:
    """id, piece_no, start, core_start, stop, piece, forced of each text longer than limit; equal deliveries count once."""
    long = df.where(F.length(text_col) > limit).select(id_col, text_col).distinct()
    return cut_texts(long, text_col, limit, overlap).select(id_col, F.xxhash64(text_col).alias("content_hash"), F.inline("pieces"))
