"""Token counts by offset-mapped attribution: a text is encoded once as a whole, and each token goes to the section that its characters lie in.

Token bytes follow one another, so running sums of their lengths are the tokens' spans; code points are counted up to each of them.
Tokens are then joined to the spans of sections, which don't overlap, by binary search. The rule for tokens across a border: the
section that holds most of a token's code points has it, the earlier of equal ones; a token that touches no section goes to ``OUTSIDE``.
A token may be part of a code point; it then counts as that whole code point.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import importable

#: Number of the section of tokens that touch none.
OUTSIDE = -1
#: Put between fields that are encoded as one text.
JOINT = "\n"

_LOADED: dict[tuple[str, str], tuple] = {}


def encoder(path: str, pattern: str) -> tuple:
    """(encode, byte lengths by id) of the ranks at path, loaded once in each Python process."""
    if (path, pattern) not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        sizes = np.zeros(1 + max(ranks.values()), dtype=np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        _LOADED[path, pattern] = tiktoken.Encoding("corpusmill", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, sizes
    return _LOADED[path, pattern]


def token_spans(text: str, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) in code points of every token of a text."""
    encode, sizes = encoder(path, pattern)
    ends = np.cumsum(sizes[np.array(encode(text), dtype=np.int64)])
    if text.isascii():
        return np.r_[np.zeros(min(1, len(ends)), dtype=np.int64), ends[:-1]], ends
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    point = np.cumsum((data & 0xC0) != 0x80)  # code points up to and with each byte
    starts = np.r_[np.zeros(min(1, len(ends)), dtype=np.int64), ends[:-1]]
    return point[starts] - 1, point[ends - 1]


def attributed(start: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The section of each token, by its place among the sections low to high, which are in order and don't overlap."""
    out = np.full(len(start), OUTSIDE)
    if not len(low) or not len(start):
        return out
    first = np.searchsorted(high, start, "right")  # the first section that ends after the token begins
    last = np.searchsorted(low, end, "left") - 1  # the last one that begins before it ends
    one = first == last
    out[one] = first[one]
    for i in np.flatnonzero(first < last):
        k = np.arange(first[i], last[i] + 1)
        held = np.minimum(high[k], end[i]) - np.maximum(low[k], start[i])
        if held.max() > 0:
            out[i] = k[int(np.argmax(held))]
    # An empty section between holds nothing.
    empty = out >= 0
    empty[empty] = np.minimum(high[out[empty]], end[empty]) <= np.maximum(low[out[empty]], start[empty])
    out[empty] = OUTSIDE
    return out


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The lines of a text, between line feeds."""
    sizes = np.array([len(x) for x in text.split("\n")])
    high = np.cumsum(sizes + 1) - 1
    return high - sizes, high


def _counted(text: str, low: np.ndarray, high: np.ndarray, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    start, end = token_spans(text, path, pattern)
    got = attributed(start, end, low, high)
    n = np.bincount(got + 1, minlength=len(low) + 1)
    inside = got >= 0
    across = np.zeros(len(low) + 1, dtype=np.int64)
    cut = inside.copy()
    cut[inside] = (start[inside] < low[got[inside]]) | (end[inside] > high[got[inside]])
    np.add.at(across, got[cut] + 1, 1)
    keep = np.r_[n[0] > 0, np.ones(len(low), dtype=bool)]
    number = np.arange(-1, len(low))
    return number[keep], np.r_[0, low][keep], np.r_[0, high][keep], n[keep], across[keep]


def _rows(batches: Iterator[pa.RecordBatch], texts_of, path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts: list[tuple] = []
        place: list[int] = []
        for text, low, high in texts_of(batch):
            found = _counted(text, low, high, path, pattern)
            parts.append(found)
            place.append(len(found[0]))
        columns = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, dtype=np.int64) for k in range(5)]
        ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(place)), place)))
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(c.astype(np.int64)) for c in columns)], ["id", "section", "start", "end", "n_tokens", "n_crossing"])


def _schema(docs: DataFrame, id_col: str) -> str:
    return f"id {docs.schema[id_col].dataType.simpleString()}, section long, start long, end long, n_tokens long, n_crossing long"


def by_lines(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each line of each row of docs: id, section (the line's number from 0), start, end (code points), n_tokens, n_crossing.

    n_tokens of a text add up to its tokens: those that touch no line have a row of section ``OUTSIDE``, where there are any. n_crossing are
    those of n_tokens that reach over the line's borders. A null or empty text has one empty line without tokens. Repeated rows give
    repeated rows, null ids stay null, an empty table gives an empty result, other columns are ignored. Nothing is shuffled.
    """
    importable(docs.sparkSession)

    def texts(batch: pa.RecordBatch):
        for t in batch.column(1).to_pylist():
            yield t or "", *line_spans(t or "")

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return rows.mapInArrow(lambda batches: _rows(batches, texts, path, pattern), _schema(docs, id_col)).withColumnRenamed("id", id_col)


def by_fields(docs: DataFrame, fields: list[str], path: str, pattern: str, id_col: str = "doc_id", joint: str = JOINT) -> DataFrame:
    """The same for fields: their texts are encoded as one, with ``joint`` between them; section is the field's number. Null fields are empty."""
    importable(docs.sparkSession)

    def texts(batch: pa.RecordBatch):
        for values in zip(*(batch.column(k + 1).to_pylist() for k in range(len(fields))), strict=True):
            values = [v or "" for v in values]
            sizes = np.array([len(v) for v in values])
            high = np.cumsum(sizes + len(joint)) - len(joint)
            yield joint.join(values), high - sizes, high

    rows = docs.select(docs[id_col].alias("id"), *(docs[f].cast("string").alias(f"f{k}") for k, f in enumerate(fields)))
    return rows.mapInArrow(lambda batches: _rows(batches, texts, path, pattern), _schema(docs, id_col)).withColumnRenamed("id", id_col)
