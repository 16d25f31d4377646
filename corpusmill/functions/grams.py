"""Counts of a text's n-grams of characters and words, without making them: one Arrow UDF.

The n-grams of characters are numbers: as many bits a character as the text's alphabet needs, several characters to a number, so that two
are equal where the numbers are. Sorted numbers that differ from the one before are the distinct ones. A text's memory is a few numbers a character.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..workers import importable

#: What ends a line of prose.
LINE_ENDS = (".", "!", "?", ";", "。", "！", "？", "；")


def ranks(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Each value's place among the distinct values, and how many these are."""
    distinct, place = np.unique(values, return_inverse=True)
    return place.astype(np.uint64), len(distinct)


def n_distinct(values: np.ndarray) -> int:
    if not len(values):
        return 0
    ordered = np.sort(values)
    return 1 + int(np.count_nonzero(ordered[1:] != ordered[:-1]))


def distinct_slices(text: str, n: int) -> int:
    """How many different strings of n characters a text has."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if len(points) < n:
        return 0
    seen = np.zeros(int(points.max()) + 1, dtype=bool)
    seen[points] = True
    codes, size = (np.cumsum(seen) - 1).astype(np.uint64)[points], int(np.count_nonzero(seen))
    grams, room, length = codes, size, 1
    while length < n:
        if room * size >= 1 << 64:
            grams, room = ranks(grams)  # no more than there are characters, so there is room for another one
        grams = grams[:-1] * np.uint64(size) + codes[length:]
        room, length = room * size, length + 1
    return n_distinct(grams)


_SCHEMA = StructType([StructField("punct_lines", DoubleType()), StructField("char_repetition", DoubleType()), *(StructField(n, LongType()) for n in ("char_grams", "distinct_char_grams", "word_grams"))])


def _of(text: str, lower: str, repeated: int, chars: int, words: int) -> tuple[float, float, int, int, int]:
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    again = (len(text) - repeated + 1 - distinct_slices(text, repeated)) if len(text) >= repeated else 0
    low = lower.strip()
    return (
        sum(x.endswith(LINE_ENDS) for x in lines) / len(lines) if lines else 0.0, min(1.0, again * repeated / len(text)) if text else 0.0,
        max(len(low) - chars + 1, 1), distinct_slices(low, chars) if len(low) >= chars else 1, max(len(text.split()) - words + 1, 0),
    )


def ngram_counts(text: Column, repeated: int = 10, chars: int = 5, words: int = 3) -> Column:
    """The figures of ``text``'s punct_lines_ratio, char_repetition, char_ngrams (their number and that of distinct ones) and word_ngrams; null counts as empty."""
    importable()

    @F.pandas_udf(_SCHEMA)
    def run(texts: pd.Series, lowers: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_of(t or "", low or "", repeated, chars, words) for t, low in zip(texts, lowers, strict=True)], columns=_SCHEMA.names)

    return run(text, F.lower(text))
