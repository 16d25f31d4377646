"""Windows of a fixed length that occur more than once: seeds, classes of seeds, and the spans of a text that they cover.

A text is a sequence of items (bytes, or words by their hash) and a window is ``length`` items in a row. Of the ``seed``-grams in a window
the one of smallest hash, the leftmost of equal ones, is the window's anchor. That depends on nothing but the window, so equal windows
have equal anchors at equal places. Consecutive windows with one anchor make a run; a text of n items has about 2 n / (length - seed)
of them, which is what is shuffled, in place of n windows.

A run is described by hashes of its anchor and of its context, the items that its windows span:

- an anchor found once: no window of its runs occurs twice;
- equal contexts (a class of runs): all their windows are equal in pairs, so they occur together;
- one anchor, several classes: one run stands for each class, its context is fetched, and the classes are compared window by window.

The first two cases are aggregates and joins on hashes of 64 bits for each of anchor and context, 128 together; the third moves contexts
and compares windows item by item. An anchor or class that very many runs have is joined under salts, so no task gets all of them. All
windows of a run contain its anchor, so those of them that are repeats cover one span.

``earlier``: a window counts as a repeat in texts of larger id than the smallest one that has it; else wherever it occurs again,
in the same text too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytes_np as B
from .shared import dropped, importable, scratch, staged

#: Bits of a place within a block, in the lower end of a seed's key; a block has fewer items.
PLACE_BITS = 24
BLOCK = 1 << 22
#: Classes of one anchor that are compared within one task, at most; those of anchors with more are compared by shuffled windows.
TOGETHER = 50_000
#: Contexts that are compared at once, about; those of one anchor are never parted.
AT_ONCE = 6000
#: A key with more than one row in so many is hot: there are fewer of them than that, and their rows are spread over ``SALTS`` tasks.
HOT_SHARE, SALTS = 1000, 128

RUN_SCHEMA = "h long, c long, id long, dg long, lo long, reach int, n int"


def runs(seeds: np.ndarray, at: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor) of every run. seeds: hashes of the seed-grams by start; at: where rows begin, and the end."""
    none = np.zeros(0, dtype=np.int64)
    size = np.diff(at)
    some = size >= length
    change = np.zeros(at[-1] + 1, dtype=np.int8)
    change[at[:-1][some]] = 1
    change[at[1:][some] - length + 1] -= 1
    fits = np.cumsum(change[:-1], dtype=np.int8).view(bool)
    width, out = length - seed + 1, []
    mask = np.uint64((1 << PLACE_BITS) - 1)
    for b in range(0, len(seeds), BLOCK):
        key = seeds[b : b + BLOCK + width - 1]
        if len(key) < width:
            break
        key = (key & ~mask) | np.arange(len(key), dtype=np.uint64)
        span = 1
        while 2 * span <= width:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        if span < width:
            key = np.minimum(key[: len(key) - (width - span)], key[width - span :])
        start = np.flatnonzero(fits[b : b + len(key)])
        if not len(start):
            continue
        anchor = (key[start] & mask).astype(np.int64)
        first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
        last = np.r_[first[1:] - 1, len(start) - 1]
        out.append((start[first] + b, start[last] + b, anchor[first] + b))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (none, none, none)


def described(roll: B.Roller, at: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """(anchor's hash, context's hash, row, first window in the row, anchor after the first window, further windows) of every run of a chunk."""
    seeds = B.mix(roll.all(seed))
    lo, hi, anchor = runs(seeds, at, length, seed)
    reach, n = anchor - lo, hi - lo
    context = B.mix(roll.of(lo, hi + length) + B.mix((reach * (1 << 32) + n).astype(np.uint64)))
    row = np.searchsorted(at, lo, "right") - 1
    return seeds[anchor].view(np.int64), context.view(np.int64), row, lo - at[row], reach.astype(np.int32), n.astype(np.int32)


@dataclass(frozen=True)
class Kind:
    """How a kind of items is read.

    chunks: from a text column to (rows, place of the first item in its row, rolling hashes, where rows begin) of pieces of it.
    cut: from a text's bytes to a function that gives the items of a context as bytes, by first item and count.
    lead: bytes of a context's anchor that contexts are dealt out by.
    """

    length: int
    seed: int
    earlier: bool
    chunks: Callable[[pa.Array], Iterator[tuple[np.ndarray, np.ndarray, B.Roller, np.ndarray]]]
    cut: Callable[[bytes], Callable[[int, int], bytes]]
    item_bytes: int
    compare: Callable[["Kind", dict[str, np.ndarray]], tuple[np.ndarray, np.ndarray, np.ndarray]]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, dg, text): rows of equal id and digest have equal texts, and so equal results. A null id counts as the largest."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.xxhash64(text).alias("dg"), text.alias("text"), F.col(id_col).alias("own_id"))


def run_rows(rows: DataFrame, kind: Kind) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RUN_SCHEMA.split(", ")]
        for batch in batches:
            ids, dg = (np.asarray(batch.column(i)) for i in (0, 1))
            for row, base, roll, at in kind.chunks(batch.column(2)):
                h, c, r, lo, reach, n = described(roll, at, kind.length, kind.seed)
                own = row[r]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h, c, ids[own], dg[own], lo + base[r], reach, n)], names)

    return rows.select("id", "dg", "text").mapInArrow(run, RUN_SCHEMA)


def _contexts(rows: DataFrame, classes: DataFrame, kind: Kind) -> DataFrame:
    """(h, c, mid, reach, n, ctx binary) of each class: its context, cut out of the text that stands for it."""
    asked = classes.groupBy("id", "dg").agg(F.collect_list(F.struct("h", "c", "mid", "lo", "reach", "n")).alias("asked"))
    joined = rows.select("id", "dg", "text").join(asked, ["id", "dg"]).select(F.col("text").cast("binary").alias("text"), "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for text, asked in zip(batch.column(0), batch.column(1), strict=True):
                cut = kind.cut(text.as_py())
                for a in asked.as_py():
                    ctx = cut(a["lo"], a["n"] + kind.length)
                    at = a["reach"] * kind.item_bytes
                    for k, x in enumerate((a["h"], a["c"], a["mid"], a["reach"], a["n"], ctx, ctx[at : at + kind.seed * kind.item_bytes])):
                        out[k].append(x)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], ["h", "c", "mid", "reach", "n", "ctx", "lead"])

    return joined.mapInArrow(run, "h long, c long, mid long, reach int, n int, ctx binary, lead binary")


def _table(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Columns as arrays; contexts as one array of bytes with offsets."""
    ctx = batch.column("ctx")
    _, offsets, data = ctx.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if pa.types.is_large_binary(ctx.type) else np.int32)[ctx.offset : ctx.offset + len(ctx) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return {k: np.asarray(batch.column(k)) for k in ("h", "c", "mid", "reach", "n")} | {"data": whole[at[0] : at[-1]], "at": at - at[0]}


def _compared(contexts: DataFrame, kind: Kind) -> DataFrame:
    """(h, c, a, b) of classes with repeats, from contexts of which those of one anchor lie together: items a to b of the context."""

    def judged(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = _table(batch)
        least, most, hit = kind.compare(kind, table)
        a, b = table["reach"] - most, table["reach"] - least + kind.length
        return pa.RecordBatch.from_arrays([pa.array(x[hit]) for x in (table["h"], table["c"], a.astype(np.int32), b.astype(np.int32))], ["h", "c", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(len(x) for x in held) < AT_ONCE:
                continue
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            h = np.asarray(whole.column("h"))
            last = int(np.flatnonzero(h != h[-1]).max(initial=-1)) + 1  # the last anchor may go on
            if last:
                yield judged(whole.slice(0, last))
            held = [whole.slice(last)]
        if held and sum(len(x) for x in held):
            yield judged(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return contexts.mapInArrow(run, "h long, c long, a int, b int")


def _by_windows(contexts: DataFrame, kind: Kind) -> DataFrame:
    """The same as ``_compared`` for anchors with very many classes: windows themselves are shuffled, and combined in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = kind.length * kind.item_bytes
        for batch in batches:
            for i in range(0, len(batch), 500):
                t = _table(batch.slice(i, 500))
                n = t["n"].astype(np.int64) + 1
                row = np.repeat(np.arange(len(n)), n)
                j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                blob = t["data"].tobytes()
                w = [blob[x : x + size] for x in (t["at"][row] + j * kind.item_bytes).tolist()]
                columns = [pa.array(x) for x in (t["h"][row], t["c"][row], t["mid"][row], (t["reach"][row] - j).astype(np.int32), t["reach"][row])]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(w, pa.binary())], ["h", "c", "mid", "o", "reach", "w"])

    windows = contexts.mapInArrow(run, "h long, c long, mid long, o int, reach int, w binary")
    groups = windows.groupBy("h", "o", "w").agg(F.min("mid").alias("low"), F.min("c").alias("c1"), F.max("c").alias("c2"))
    repeated = (F.col("mid") > F.col("low")) if kind.earlier else (F.col("c1") != F.col("c2"))
    found = windows.join(groups, ["h", "o", "w"]).filter(repeated)
    start = F.col("reach") - F.col("o")
    return found.groupBy("h", "c").agg(F.min(start).alias("a"), (F.max(start) + kind.length).alias("b"))


def spans(rows: DataFrame, kind: Kind, together: int = TOGETHER) -> DataFrame:
    """(id, dg, start, end) of what repeated windows cover in rows of (id, dg, text), in items; spans of one text may overlap or repeat."""
    importable(rows.sparkSession)
    found = run_rows(rows, kind)
    anchors = found.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("c").alias("c1"), F.max("c").alias("c2"), F.min("id").alias("first"), F.max("id").alias("last"))
    shared = anchors.filter(F.col("first") < F.col("last") if kind.earlier else F.col("k") > 1).select("h", "k", "first", (F.col("c1") == F.col("c2")).alias("one"))
    anchored = staged(shared, "shared-anchors")
    shared = staged(salted_join(found, anchored, ["h"]), "shared-runs")
    dropped(anchored)
    whole = ("id", "dg", F.col("lo").alias("start"), (F.col("lo") + F.col("n") + kind.length).alias("end"))
    simple = shared.filter(F.col("one") & (F.col("id") > F.col("first") if kind.earlier else F.lit(True))).select(*whole)

    several = shared.filter(~F.col("one"))
    stands = F.min(F.struct("id", "dg", "lo", "reach", "n"))
    classes = staged(several.groupBy("h", "c").agg(F.count(F.lit(1)).alias("k"), stands.alias("r")).select("h", "c", "k", "r.*", F.col("r.id").alias("mid")), "classes")
    many = staged(classes.groupBy("h").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > together).select("h"), "many-classes")
    contexts = _contexts(rows, classes.drop("k"), kind)
    crowded = not many.isEmpty()
    if crowded:
        contexts = staged(contexts, "contexts")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    calm = contexts.join(many, "h", "left_anti") if crowded else contexts
    verdicts = _compared(calm.repartitionByRange(parts, "lead").sortWithinPartitions("lead", "h", "c").drop("lead"), kind)
    if crowded:
        verdicts = verdicts.union(_by_windows(contexts.join(many, "h", "left_semi"), kind))

    of_class = staged(classes.select("h", "c", "k", "mid", (F.col("k") > 1).alias("again")).join(verdicts, ["h", "c"], "left"), "verdicts")
    joined = salted_join(several, of_class, ["h", "c"])
    settled = F.col("id") > F.col("mid") if kind.earlier else F.col("again")
    start = F.when(settled, F.col("lo")).otherwise(F.col("lo") + F.col("a"))
    end = F.when(settled, F.col("lo") + F.col("n") + kind.length).otherwise(F.col("lo") + F.col("b"))
    return simple.union(joined.filter(settled | F.col("a").isNotNull()).select("id", "dg", start.alias("start"), end.alias("end")))


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", share: int = HOT_SHARE, salt_by: tuple[str, ...] = ("id", "dg", "lo")) -> DataFrame:
    """left joined to right, which has each key once and how many rows of left have it (``k``). k is dropped.

    Hot keys are known by k and fewer than ``share``, so they are sent to every executor; there, rows of left that have one are dealt out
    by a salt of their columns ``salt_by``, and the row of right is given under every salt. right is read three times and should be a staged table.
    """
    total = right.agg(F.coalesce(F.sum("k"), F.lit(0))).first()[0]
    hot = right.filter(F.col("k") > max(1, total // share)).select(*keys, F.lit(True).alias("__hot"))
    dealt = left.join(F.broadcast(hot), keys, "left").withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*salt_by), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))).drop("__hot")
    salts = F.when(F.col("k") > max(1, total // share), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return dealt.join(right.withColumn("__salt", F.explode(salts)).drop("k"), [*keys, "__salt"], how).drop("__salt")


def gathered(rows: DataFrame, kind: Kind, together: int = TOGETHER) -> DataFrame:
    """rows with ``spans``, the list of what repeated windows cover or null. A text's list is bounded by its length."""
    with scratch() as tables:
        found = tables.keep(staged(spans(rows, kind, together).distinct(), "spans"))
    lists = found.groupBy("id", "dg").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return rows.join(lists, ["id", "dg"], "left")


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Spans in order, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


