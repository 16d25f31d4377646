"""Shares of a text that repeated word n-grams cover: one Arrow UDF for all n.

The n-grams are numbers, and sorted numbers tell how often each comes. For the most frequent ones they are made of the words' places in a list,
so that equal numbers are equal n-grams; for n-grams that were seen before they are hashes of the words put together, and the strings are
looked at where hashes repeat.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..workers import importable
from . import signals
from .grams import ranks

TOP, DUP = (2, 3, 4), (5, 6, 7, 8, 9, 10)


def _codes(words: list[str], ns: tuple[int, ...]) -> Iterator[np.ndarray]:
    """For each n, ascending, a number for each n-gram of words in order, equal where the n-grams are."""
    place: defaultdict[str, int] = defaultdict()
    place.default_factory = place.__len__
    of = np.fromiter(map(place.__getitem__, words), dtype=np.uint64, count=len(words))
    out, room = of, len(place)
    for n in range(1, max(ns) + 1):
        if n > 1:
            if room * len(place) >= 1 << 64:
                out, room = ranks(out)
            out, room = out[:-1] * np.uint64(len(place)) + of[n - 1 :], room * len(place)
        if n in ns:
            yield out


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of the values are among the ordered ones, of which there is one at least."""
    return ordered[np.searchsorted(ordered, values).clip(max=len(ordered) - 1)] == values


def _top(codes: np.ndarray) -> tuple[int, int]:
    """The place where the most frequent value is first seen, the first seen of equally frequent ones, and how often it comes."""
    ordered = np.sort(codes)
    edge = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True])))
    times = np.diff(edge)
    most = int(times.max())
    return (0, 1) if most == 1 else (int(_among(codes, ordered[edge[:-1][times == most]]).argmax()), most)


def top_shares(words: list[str], ns: tuple[int, ...], size: int) -> list[float]:
    """For each n, ascending, characters of the most frequent n-gram, the first seen of equally frequent ones, times its count."""
    if not size or not words:
        return [0.0] * len(ns)
    out = []
    for n, codes in zip(ns, _codes(words, ns), strict=False):
        if len(words) < n:
            break
        at, times = _top(codes)
        out.append((sum(map(len, words[at : at + n])) + n - 1) * times / size)
    return out + [0.0] * (len(ns) - len(out))


def top_share(words: list[str], n: int, size: int) -> float:
    return top_shares(words, (n,), size)[0]


def _powers(n: int, base: int, known: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006  kept by the worker
    """base to the 0, 1, ... n - 1 or more, modulo 2^64."""
    if base not in known or len(known[base]) < n:
        factors = np.full(max(n, 1 << 14), base, dtype=np.uint64)
        factors[0] = 1
        found = np.multiply.accumulate(factors)
        if n > KEPT_POWERS:
            return found
        known[base] = found
    return known[base]


#: An odd number and its inverse modulo 2^64, and as many of their powers as a worker keeps.
_BASE = 0x9E3779B97F4A7C15
_BACK, KEPT_POWERS = pow(_BASE, -1, 1 << 64), 1 << 20


class _Joined:
    """Words put together without gaps, and hashes of stretches of them: equal for equal strings; where they are equal, the strings are compared."""

    def __init__(self, words: list[str]):
        self.text = "".join(words)
        self.start = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))))
        points = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((points + np.uint64(1)) * _powers(len(points), _BASE)[: len(points)], dtype=np.uint64)))[self.start]
        self.back = _powers(len(points) + 1, _BACK)[self.start]

    def repeated(self, n: int) -> list[int]:
        """The n-grams, by their first words, whose hash comes more than once."""
        hashes = (self.sums[n:] - self.sums[:-n]) * self.back[:-n]
        ordered = np.sort(hashes)
        same = ordered[1:] == ordered[:-1]
        return np.flatnonzero(_among(hashes, ordered[1:][same])).tolist() if same.any() else []

    def dup_share(self, n: int, size: int) -> float:
        seen: set[str] = set()
        free = covered = 0
        for i in self.repeated(n):  # no other n-gram was seen before or is seen again
            if i < free:
                continue
            gram = self.text[self.start[i] : self.start[i + n]]
            if gram in seen:
                covered, free = covered + len(gram), i + n
            seen.add(gram)
        return covered / size


def dup_shares(words: list[str], ns: tuple[int, ...], size: int) -> list[float]:
    """For each n, characters of n-grams that were seen before; behind each of them, the next n-gram that counts or is remembered begins after its words."""
    if not size or len(words) < min(ns):
        return [0.0] * len(ns)
    joined = _Joined(words)
    return [joined.dup_share(n, size) if len(words) >= n else 0.0 for n in ns]


def dup_share(words: list[str], n: int, size: int) -> float:
    return dup_shares(words, (n,), size)[0]


def fractions(text: str, top: tuple[int, ...] = TOP, dup: tuple[int, ...] = DUP) -> list[float]:
    words, size = signals.words(text), len(text)
    return [*(top_shares(words, top, size) if top else ()), *(dup_shares(words, dup, size) if dup else ())]


def ngram_fractions(text: Column, top: tuple[int, ...] = TOP, dup: tuple[int, ...] = DUP) -> Column:
    """struct<top_n, dup_n>: the shares for these n; null counts as empty."""
    importable()
    names = [f"top_{n}" for n in top] + [f"dup_{n}" for n in dup]

    @F.pandas_udf(StructType([StructField(name, DoubleType()) for name in names]))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fractions(t or "", top, dup) for t in texts], columns=names)

    return run(text)
