"""Splitting long documents into overlapping chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# When a document is split, target size and overlap, and where to cut first.
SPLIT_ABOVE, CHUNK_SIZE, CHUNK_OVERLAP = 1000, 800, 100
SEPARATORS = ("\n\n", "\n", " ", "")


def split_text(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, separators=SEPARATORS) -> list[str]:
    """Chunks of at most `size` characters, cut at the coarsest separator that works.

    A separator opens the piece after it. Pieces of `size` or more are cut again at the next finer
    separator; shorter neighbours are packed, the tail of a chunk of up to `overlap` characters
    opening the next one. Outer white space is dropped.
    """
    spans = _spans(text, 0, len(text), size, overlap, separators)
    return [chunk for a, b in spans if (chunk := text[a:b].strip())]


def _spans(text, start, end, size, overlap, separators) -> Iterator[tuple[int, int]]:
    used = next((i for i, s in enumerate(separators) if not s or text.find(s, start, end) >= 0), None)
    if used is None:
        yield start, end
        return
    cuts = _cuts(text, start, end, separators[used])
    finer = separators[used + 1 :]
    run = [start]  # edges of the short pieces waiting to be packed
    for a, b in zip(cuts, cuts[1:]):
        if b - a < size:
            run.append(b)
            continue
        yield from _packed(run, size, overlap)
        if finer:
            yield from _spans(text, a, b, size, overlap, finer)
        else:
            yield a, b
        run = [b]
    yield from _packed(run, size, overlap)


def _cuts(text, start, end, separator) -> list[int]:
    if not separator:
        return list(range(start, end + 1))
    found = (m.start() for m in re.compile(re.escape(separator)).finditer(text, start, end))
    return [start, *(c for c in found if c > start), end]


def _packed(edges: list[int], size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Windows over neighbouring pieces, given their edges."""
    first = 0
    for last in range(1, len(edges)):
        if edges[last] - edges[first] > size and last - 1 > first:
            yield edges[first], edges[last - 1]
            while first < last - 1 and (
                edges[last - 1] - edges[first] > overlap or edges[last] - edges[first] > size
            ):
                first += 1
    if len(edges) - 1 > first:
        yield edges[first], edges[-1]


@F.pandas_udf(ArrayType(StringType()))
def _split(texts: pd.Series) -> pd.Series:
    return texts.map(split_text, na_action="ignore")


def chunk_documents(docs: DataFrame, text: str = "page_content", above: int = SPLIT_ABOVE) -> DataFrame:
    """One row per chunk with its `chunk` number; documents up to `above` characters stay whole.

    Only the long texts travel to Python, in Arrow batches that Spark bounds by bytes
    (`spark.sql.execution.arrow.maxBytesPerBatch`).
    """
    long_text = F.when(F.length(text) > above, F.col(text))
    pieces = F.coalesce(_split(long_text), F.array(text))
    others = [c for c in docs.columns if c != text]
    return docs.where(F.col(text).isNotNull()).select(*others, F.posexplode(pieces).alias("chunk", text))
