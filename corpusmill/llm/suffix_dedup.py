"""Suffix-array dedup of bytes.

The suffixes that are sorted are those at the anchors of repeats (see ``repeats``), about one in a hundred: every window of ``LENGTH`` bytes
holds an anchor, and equal windows hold it at the same place. Suffixes with one run of bytes around them are settled by aggregates.
The rest are dealt out by range of their leading bytes with sampled splitters (``repartitionByRange``), so that all suffixes that begin alike
are in one bucket: suffixes on the two sides of a border have fewer than ``SEED`` bytes in common, and every window has at least ``SEED``
bytes from its anchor on, so there is nothing to compare across it. Buckets are sorted locally by multikey quicksort, eight bytes a key;
the bytes before an anchor are sorted the same way, backwards. Common prefixes of neighbours then tell, for each place of a window around
its anchor, which suffixes have the same window.
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

#: Bytes of a seed, and bytes of a repeat at least.
SEED, LENGTH = 24, 200
#: Bytes of a text that are worked on at once; longer texts are cut into pieces that overlap by a window less one byte.
PIECE = 8 << 20


def _pieces(length: int):
    def chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, B.Roller, np.ndarray]]:
        for i, j, data, at in B.chunks(column, min(B.CHUNK_BYTES, PIECE)):
            if len(data) <= PIECE:
                yield np.arange(i, j), np.zeros(j - i, dtype=np.int64), B.Roller(data), at
                continue
            for a in range(0, len(data), PIECE):  # one long text
                part = data[a : a + PIECE + length - 1]
                yield np.array([i]), np.array([a]), B.Roller(part), np.array([0, len(part)])

    return chunks


def _cut(text: bytes):
    return lambda lo, n: text[lo : lo + n]


#: Rows up to which a part is sorted as it is.
SMALL = 24


def multikey_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of bytes, and bytes that each has in common with the one before it, by multikey quicksort.

    A part is split by one key, eight bytes at its depth, into rows below, at and above a pivot; those at the pivot go on with the next
    key, the others with the same one. Parts wait on a stack of their own, so depth is no matter of recursion.
    """
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), dtype=np.uint8)
    padded[:, :width] = rows
    keys = padded.view(">u8").astype(np.uint64)
    order, blob, stride = np.arange(n), padded.tobytes(), padded.shape[1]
    parts = [(0, n, 0)]
    while parts:
        low, high, depth = parts.pop()
        if high - low < 2 or depth == keys.shape[1]:
            continue
        part = order[low:high]
        if high - low <= SMALL:
            order[low:high] = sorted(part.tolist(), key=lambda i, d=8 * depth: blob[i * stride + d : (i + 1) * stride])
            continue
        key = keys[part, depth]
        pivot = sorted((key[0], key[len(key) // 2], key[-1]))[1]
        below, above = key < pivot, key > pivot
        order[low:high] = np.concatenate([part[below], part[~(below | above)], part[above]])
        a, b = low + int(below.sum()), high - int(above.sum())
        parts += [(low, a, depth), (a, b, depth + 1), (b, high, depth)]
    common = np.zeros(n, dtype=np.int64)
    for i in range(1, n, 1 << 13):
        j = min(n, i + (1 << 13))
        differ = padded[order[i:j]] != padded[order[i - 1 : j - 1]]
        common[i:j] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, np.minimum(common, width)


def _around(t: dict[str, np.ndarray], left: int, right: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes before each anchor, nearest first, and from it on; zero where the context ends."""
    n = len(t["h"])
    a, b = np.zeros((n, left), dtype=np.uint8), np.zeros((n, right), dtype=np.uint8)
    data = t["data"]
    for i in range(0, n, 2048):
        low, high = t["at"][:-1][i : i + 2048, None], t["at"][1:][i : i + 2048, None]
        anchor = low + t["reach"][i : i + 2048, None]
        before, after = anchor - 1 - np.arange(left), anchor + np.arange(right)
        a[i : i + 2048] = np.where(before >= low, data[np.maximum(before, 0)], np.uint8(0))
        b[i : i + 2048] = np.where(after < high, data[np.minimum(after, len(data) - 1)], np.uint8(0))
    return a, b


def _compare(kind: repeats.Kind, t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least, most) offset of the anchor in a repeated window of each suffix, and whether there is one.

    A window with its anchor at offset o is repeated if another suffix agrees on o bytes before the anchor and ``length - o`` from it on.
    """
    n = len(t["h"])
    least, most = np.full(n, np.iinfo(np.int32).max), np.full(n, -1)
    if n < 2:
        return least, most, most >= 0
    before, after = _around(t, kind.length - kind.seed, kind.length)
    (right, right_common), (left, left_common) = multikey_sort(after), multikey_sort(before)
    right_class, left_class = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for o in range(int((t["reach"] - t["n"]).min()), int(t["reach"].max()) + 1):
        some = np.flatnonzero((t["reach"] >= o) & (t["reach"] - t["n"] <= o))
        if len(some) < 2:
            continue
        right_class[right] = np.cumsum(right_common < kind.length - o)
        left_class[left] = np.cumsum(left_common < o)
        key = right_class[some] * (n + 1) + left_class[some]
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        if same.any():
            hit = some[order[np.r_[same, False] | np.r_[False, same]]]
            least[hit], most[hit] = np.minimum(least[hit], o), o
    return least, most, most >= 0


def kind_of(length: int = LENGTH, seed: int = SEED) -> repeats.Kind:
    if not 1 <= seed <= length:
        raise ValueError("a seed has between one byte and all bytes of a repeat")
    return repeats.Kind(length, seed, False, _pieces(length), _cut, 1, _compare)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed: int = SEED, with_bytes: bool = False, together: int = repeats.TOGETHER) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans long (maximal removed runs), kept_sha256 string; with ``with_bytes`` also kept (binary).

    A byte goes if it lies in a string of ``length`` bytes that begins anywhere else too, in the same text or another; occurrences may
    overlap, and strings are judged on the input. A null text counts as empty. Repeated rows are occurrences like any others; null ids are
    ids. Bytes are compared exactly where contexts differ; equal contexts are told by 128 bits of hashes. An empty table gives an
    empty result; other columns are ignored.
    """
    rows = repeats.keyed(docs, id_col, text_col)
    found = repeats.gathered(rows, kind_of(length, seed), together)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, count, digest, kept = [], [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                data, at, parts = text.as_py(), 0, []
                cuts = repeats.merged(spans.as_py())
                for a, b in cuts:
                    parts.append(data[at:a])
                    at = b
                parts.append(data[at:])
                whole = b"".join(parts)
                n.append(len(data))
                gone.append(len(data) - len(whole))
                count.append(len(cuts))
                digest.append(hashlib.sha256(whole).hexdigest())
                kept.append(whole if with_bytes else None)
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, gone, count)), pa.array(digest, pa.string())]
            names = ["own_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_bytes:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"own_id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    out = found.select("own_id", F.col("text").cast("binary").alias("text"), "spans").mapInArrow(run, schema)
    return out.withColumnRenamed("own_id", id_col)
