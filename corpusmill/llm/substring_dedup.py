"""Substring dedup by seed and extend: texts meet on winnowed anchors, matches are extended both ways, maximal repeats are kept.

An anchor is a run of ``SEED`` words that winnowing picks; see ``repeats``. Runs of one anchor are extended to both sides as far as the
windows that have this anchor go: equal contexts at once, different ones window by window. What repeated windows cover is one maximal
repeat for each run; those of a text are merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytes_np as B
from . import repeats

#: Words of a seed, and words of a repeat at least.
SEED, LENGTH = 16, 50


def _chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, B.Roller, np.ndarray]]:
    for i, j, data, at in B.chunks(column):
        start, end, first = B.words(data, at)
        yield np.arange(i, j), np.zeros(j - i, dtype=np.int64), B.Roller(B.word_hashes(data, start, end)), first


def _cut(text: bytes):
    data = np.frombuffer(text, dtype=np.uint8)
    start, end, _ = B.words(data, np.array([0, len(data)]))
    hashes = B.word_hashes(data, start, end)
    return lambda lo, n: hashes[lo : lo + n].tobytes()


def _compare(kind: repeats.Kind, t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Extends the runs of each anchor word by word: (least, most) offset of the anchor in a repeated window, and whether there is one.

    Windows meet by a hash and are then compared word by word, as the hashes of their words.
    """
    n = len(t["h"])
    words = np.ascontiguousarray(t["data"]).view(np.uint64)
    roll = B.Roller(words)
    at, h = t["at"] // 8, B.mix(t["h"].view(np.uint64))
    least, most = np.full(n, np.iinfo(np.int32).max), np.full(n, -1)
    for o in range(int((t["reach"] - t["n"]).min(initial=0)), int(t["reach"].max(initial=-1)) + 1):
        some = np.flatnonzero((t["reach"] >= o) & (t["reach"] - t["n"] <= o))
        start = at[some] + t["reach"][some] - o
        key = B.mix(roll.of(start, start + kind.length)) ^ h[some]
        order = np.argsort(key, kind="stable")
        twice = np.flatnonzero(key[order][1:] == key[order][:-1])
        if not len(twice):
            continue
        key = key[order]
        a, b = order[twice], order[twice + 1]
        if (t["h"][some[a]] != t["h"][some[b]]).any() or not _equal_windows(words, start[a], start[b], kind.length):
            # Two windows share a hash: number the windows by what they are.
            number: dict[tuple, int] = {}
            own = [number.setdefault((int(t["h"][some[i]]), words[start[i] : start[i] + kind.length].tobytes()), len(number)) for i in range(len(some))]
            order = np.argsort(own, kind="stable")
            key = np.array(own)[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        low = np.minimum.reduceat(t["mid"][some[order]], first)
        late = np.repeat(low, np.diff(np.r_[first, len(order)])) < t["mid"][some[order]]
        hit = some[order[late]]
        least[hit], most[hit] = np.minimum(least[hit], o), o
    return least, most, most >= 0


def _equal_windows(words: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> bool:
    """Whether words[a : a + length] and words[b : b + length] are equal for all pairs, some thousand pairs at a time."""
    place = np.arange(length)
    return all((words[a[i : i + 4096, None] + place] == words[b[i : i + 4096, None] + place]).all() for i in range(0, len(a), 4096))


def kind_of(length: int = LENGTH, seed: int = SEED) -> repeats.Kind:
    if not 1 <= seed <= length:
        raise ValueError("a seed has between one word and all words of a repeat")
    return repeats.Kind(length, seed, True, _chunks, _cut, 8, _compare)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed: int = SEED, with_text: bool = False, together: int = repeats.TOGETHER) -> DataFrame:
    """One row per row of docs: id, n_words long, n_removed long, kept_sha256 string; with ``with_text`` also kept_text.

    A word goes if it lies in a window of ``length`` words whose words also begin somewhere in a text of smaller id. Windows are judged on
    the input. Kept words are joined by one blank each. A null text has no words; null ids count as the largest, and rows that share an id
    don't count against each other. Words are compared by their XXH64, windows word by word but where whole contexts have equal hashes of 128
    bits together. Very long texts are whole: their words and spans are held in one task, texts aren't. An empty table gives an empty result; other columns are ignored.
    """
    rows = repeats.keyed(docs, id_col, text_col)
    found = repeats.gathered(rows, kind_of(length, seed), together)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, digest, texts = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                words = text.as_py().split()  # at the white space of ASCII, as bytes
                kept, at, lost = [], 0, 0
                for a, b in repeats.merged(spans.as_py()):
                    kept += words[at:a]
                    at, lost = b, lost + b - a
                kept += words[at:]
                whole = b" ".join(kept)
                n.append(len(words))
                gone.append(lost)
                digest.append(hashlib.sha256(whole).hexdigest())
                texts.append(whole.decode() if with_text else None)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())]
            names = ["own_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"own_id {docs.schema[id_col].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    out = found.select("own_id", F.col("text").cast("binary").alias("text"), "spans").mapInArrow(run, schema)
    return out.withColumnRenamed("own_id", id_col)
