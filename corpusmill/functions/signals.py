"""All word and line counts that the quality rules ask for, in one pass over a text.

The expressions of ``text`` give the same counts one by one, each with passes of its own. Rules that ask for nine of them take the counts
from here: texts of an Arrow batch are one array of code points, which a table maps to classes, and words are runs in it.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..workers import importable
from . import text as T

SPACE, SYMBOL, LETTER, CJK = 1, 2, 4, 8
#: Characters that are worked on at once; a longer text is worked on by itself.
CHUNK_CHARS = 1 << 20
_CJK = re.compile(f"[{T.CJK}]".replace(r"\x{", "\\x{").replace(r"\x{20000}", "\U00020000").replace(r"\x{2A6DF}", "\U0002a6df").replace(r"\x{2A700}", "\U0002a700").replace(r"\x{2B73F}", "\U0002b73f"))
_CJK_WORD = re.compile(T.CJK_WORD)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class bits of every code point up to the last that has a letter."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for i in range(0x33480):
        kind = unicodedata.category(c := chr(i))
        out[i] = SPACE * c.isspace() | SYMBOL * (kind[0] in "PS" or i < 32 or i == 127) | LETTER * (kind[0] == "L") | CJK * bool(i > 0x2E7F and _CJK.match(c))
    return out


def cjk_words(text: str) -> list[str]:
    return [w for part in text.split() for w in (_CJK_WORD.findall(part) if _CJK.search(part) else (part,))]


def is_cjk(text: str, threshold: float = 0.3) -> bool:
    if text.isascii() or not (found := len(_CJK.findall(text))):
        return False
    letters = sum(map(str.isalpha, text))
    return letters > 0 and found / letters > threshold


def words(text: str) -> list[str]:
    return cjk_words(text) if is_cjk(text) else text.split()


NAMES = ("n_real", "real_chars", "n_words", "n_alpha", "n_hashes", "n_ellipses", "n_lines", "n_bullets", "n_ends", "n_stops")


def _of_words(found: list[str]) -> tuple[int, int, int, int]:
    table = classes()
    kinds = [table[np.frombuffer(w.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)] for w in found]
    real = [bool(((k & (SYMBOL | SPACE)) == 0).any()) for k in kinds]
    return sum(real), sum(len(w) for w, r in zip(found, real, strict=True) if r), len(found), sum(bool((k & LETTER).any()) for k in kinds)


def word_counts(texts: list[str]) -> np.ndarray:
    """The first four of ``NAMES`` for each text. Words of texts of CJK are single characters and runs of a-z."""
    out = np.zeros((len(texts), 4), dtype=np.int64)
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK_CHARS):
            size += len(texts[j])
            j += 1
        kind = classes()[np.frombuffer("".join(texts[i:j]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        at = np.r_[0, np.cumsum([len(t) for t in texts[i:j]])]
        space = (kind & SPACE) > 0
        edge = np.zeros(size + 1, dtype=bool)
        edge[at] = True
        before, after = np.r_[True, space[:-1]] if size else space, np.r_[space[1:], True] if size else space
        start = np.flatnonzero(~space & (before | edge[:-1]))
        end = np.flatnonzero(~space & (after | edge[1:])) + 1
        row = np.searchsorted(at, start, "right") - 1
        real, letter = (np.r_[0, np.cumsum(flags)] for flags in ((kind & (SPACE | SYMBOL)) == 0, (kind & LETTER) > 0))
        real, letter = real[end] > real[start], letter[end] > letter[start]
        n = j - i
        for k, (rows, weight) in enumerate(((row[real], None), (row[real], (end - start)[real]), (row, None), (row[letter], None))):
            out[i:j, k] = np.bincount(rows, weight, n)
        per = np.r_[0, np.cumsum((kind & CJK) > 0)]
        for k in np.flatnonzero(per[at[1:]] > per[at[:-1]]):
            if is_cjk(texts[i + k]):
                out[i + k] = _of_words(cjk_words(texts[i + k]))
        i = j
    return out


def counts(texts: list[str]) -> np.ndarray:
    """A row of ``NAMES`` for each text."""
    out = np.zeros((len(texts), len(NAMES)), dtype=np.int64)
    out[:, :4] = word_counts(texts)
    stops = set(T.STOP_WORDS)
    for k, t in enumerate(texts):
        lines = t.splitlines()
        out[k, 4:9] = t.count("#"), t.count("...") + t.count("…"), len(lines), sum(x.lstrip()[:1] in ("•", "-") and not x.isspace() and x != "" for x in lines), sum(x.rstrip().endswith(("...", "…")) for x in lines)
        out[k, 9] = len(stops.intersection(words(t)))
    return out


_SCHEMA = StructType([StructField(n, LongType()) for n in NAMES] + [StructField(n, DoubleType()) for n in ("bullets_ratio", "ends_ratio")])


def gopher(text: Column) -> Column:
    """``NAMES`` of a text, and the shares of its lines that begin with a bullet and that end with an ellipsis. Null counts as empty."""
    importable()

    @F.pandas_udf(_SCHEMA)
    def run(texts: pd.Series) -> pd.DataFrame:
        found = pd.DataFrame(counts([t or "" for t in texts]), columns=list(NAMES))
        lines = found["n_lines"].clip(lower=1)
        return found.assign(bullets_ratio=found["n_bullets"] / lines, ends_ratio=found["n_ends"] / lines)

    return run(text)


def real_words(text: Column) -> Column:
    """How many words are more than symbols, as ``text.word_count`` has it; null counts as empty."""
    importable()

    @F.pandas_udf(LongType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(word_counts([t or "" for t in texts])[:, 0])

    return run(text)
