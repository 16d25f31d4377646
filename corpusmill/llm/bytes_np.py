"""Arrow string columns as byte arrays, their words, and hashes of many substrings at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text that are worked on at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 19

_MULT = np.uint64(0x9E3779B97F4A7C15)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row begins (one entry more than rows); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if offsets is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of pieces of the column of about ``limit`` bytes."""
    data, at = raw(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word, and for each row its first word's number (one entry more than rows)."""
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(start, at)


def per_row(first: np.ndarray) -> np.ndarray:
    """The row of each item, from the number of each row's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    out = np.ones(1, dtype=np.uint64)
    step = np.uint64(base)
    with np.errstate(over="ignore"):
        while len(out) < n:
            out = np.concatenate([out, out * step])
            step = step * step
    return out[:n]


class Roller:
    """Polynomial hashes of all substrings of an array, from prefix sums modulo 2 ** 64 over random values of its items.

    For substrings of under 1,024 items, as all windows and contexts here are: longer ones can collide whatever their items.
    """

    BASE = 0xD1342543DE82EF95
    _pow: np.ndarray = np.ones(1, dtype=np.uint64)
    _inv: np.ndarray = np.ones(1, dtype=np.uint64)
    _value = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)

    def __init__(self, items: np.ndarray):
        n = len(items) + 1
        if len(Roller._pow) < n:
            size = 1 << max(12, (n - 1).bit_length())
            Roller._pow = _powers(size, self.BASE)
            Roller._inv = _powers(size, pow(self.BASE, -1, 1 << 64))
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum((Roller._value[items] if items.dtype == np.uint8 else items) * Roller._pow[: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of items[start:end]; equal substrings of one length have equal hashes in every array."""
        return (self.sums[end] - self.sums[start]) * Roller._inv[start]

    def all(self, length: int) -> np.ndarray:
        """Hashes of every substring of one length, by its start."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * Roller._inv[:n] if n > 0 else np.zeros(0, dtype=np.uint64)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """XXH64 of each word. Polynomial hashes modulo 2 ** 64 won't do: some pairs of words of 1,024 bytes collide whatever the base."""
    return xxh64(data, start, end - start, seed=0)


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether data[a : a + size] and data[b : b + size] are equal, for every triple."""
    out = np.ones(len(a), dtype=bool)
    if not len(a):
        return out
    eight, low, blob = lanes(data, 8), np.minimum(size, 8), None
    mask = np.where(low == 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (8 * low % 64).astype(np.uint64)) - np.uint64(1))
    out &= ((eight[a] ^ eight[b]) & mask) == 0
    some = np.flatnonzero((size > 8) & out)
    tail = size[some] - 8
    out[some] &= eight[a[some] + tail] == eight[b[some] + tail]
    for i in np.flatnonzero((size > 16) & out):
        blob = blob or memoryview(np.ascontiguousarray(data))
        out[i] = blob[a[i] : a[i] + size[i]] == blob[b[i] : b[i] + size[i]]
    return out


def word_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each word of a chunk; numbers are equal exactly where words are: hashes, checked on the bytes of words that share one."""
    h, size = word_hashes(data, start, end), end - start
    order = np.argsort(h, kind="stable")
    a, b = order[:-1], order[1:]
    twice = h[a] == h[b]
    a, b = a[twice], b[twice]
    # Most repeats are of the word before in the order, so one look at each neighbour is enough.
    if ((size[a] != size[b]) | ~same_bytes(data, start[a], start[b], np.minimum(size[a], size[b]))).any():
        blob, seen = data.tobytes(), {}
        return np.array([seen.setdefault(blob[i:j], len(seen)) for i, j in zip(start.tolist(), end.tolist(), strict=True)], dtype=np.uint64)
    return h


def lanes(data: np.ndarray, size: int) -> np.ndarray:
    """The little-endian integer of ``size`` bytes (4 or 8) that begins at each byte; bytes after the end count as 0."""
    out = np.zeros(len(data) + 8, dtype=np.uint64)
    out[: len(data)] = data
    k = 1
    while k < size:
        out[:-k] |= out[k:] << np.uint64(8 * k)
        k *= 2
    return out[: len(data)]


def xxh64(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of data[start : start + length] for every pair. Substrings of one length are hashed together."""
    import xxhash

    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def rotl(x: np.ndarray, r: int) -> np.ndarray:
        return (x << np.uint64(r)) | (x >> np.uint64(64 - r))

    def turn(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
        return rotl(acc + lane * p2, 31) * p1

    out = np.empty(len(start), dtype=np.uint64)
    if not len(start):
        return out
    eight, low32 = lanes(data, 8), np.uint64(0xFFFFFFFF)
    order = np.argsort(np.minimum(length, 65535).astype(np.uint16), kind="stable")
    cuts = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
    with np.errstate(over="ignore"):
        for a, b in zip(cuts, cuts[1:], strict=False):
            of, size = order[a:b], int(length[order[a]])
            if size > 256 or b - a < 8:
                view = memoryview(data)
                out[of] = [xxhash.xxh64_intdigest(view[s : s + n], seed) for s, n in zip(start[of].tolist(), length[of].tolist(), strict=True)]
                continue
            at, done = start[of], 0
            if size >= 32:
                v = [np.full(len(of), np.uint64((seed + d) % (1 << 64))) for d in (int(p1) + int(p2), int(p2), 0, -int(p1))]
                while size - done >= 32:
                    v = [turn(x, eight[at + (done + 8 * k)]) for k, x in enumerate(v)]
                    done += 32
                h = rotl(v[0], 1) + rotl(v[1], 7) + rotl(v[2], 12) + rotl(v[3], 18)
                for x in v:
                    h = (h ^ turn(np.zeros_like(x), x)) * p1 + p4
            else:
                h = np.full(len(of), np.uint64((seed + int(p5)) % (1 << 64)))
            h = h + np.uint64(size)
            while size - done >= 8:
                h = rotl(h ^ turn(np.zeros_like(h), eight[at + done]), 27) * p1 + p4
                done += 8
            if size - done >= 4:
                h = rotl(h ^ ((eight[at + done] & low32) * p1), 23) * p2 + p3
                done += 4
            while done < size:
                h = rotl(h ^ (data[at + done].astype(np.uint64) * p5), 11) * p1
                done += 1
            h = (h ^ (h >> np.uint64(33))) * p2
            h = (h ^ (h >> np.uint64(29))) * p3
            out[of] = h ^ (h >> np.uint64(32))
    return out
