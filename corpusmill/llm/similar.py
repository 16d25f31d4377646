"""Links between texts whose sets of word shingles have a Jaccard similarity of at least a threshold, all of them.

64-bit fingerprints can't tell such pairs: at a similarity of 0.8 they differ in about ten bits, and looking within so many bits would
compare a fixed share of all pairs. So candidates come from another use of the pigeonhole principle, on the sets themselves, which loses
none: with all shingles in one order, two sets that are so similar share one of the first n - ceil(threshold * n) + 1 shingles of each
(Chaudhuri et al., "A Primitive Operator for Similarity Joins in Data Cleaning"; Xiao et al., "Efficient Similarity Joins for Near
Duplicate Detection"). Rarer shingles come first, so that what many texts share seldom makes a candidate; how common a shingle is, is
told by a sketch of counts over all texts, whose size doesn't depend on them. Equal sets are one. Sizes and the places of the shared
shingle rule out most candidates, bitmaps of the sets most others, and what is left is verified on the sets.

Shingles that few sets share have their pairs compared one by one. The sets of fuller ones are first compared with one of them, the one
that shares most with others, as an original does with its copies. What that leaves in different components is compared in full, in
blocks of bounded size: each pair of blocks is one product of matrices, and gives no more links than it has texts. Only the texts outside
a largest component take part in that, each with all others. Blocks are those of a shingle's sets or, where that is less to send, those
of all sets that crowded shingles connect.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytes_np as B
from .components import components
from .repeats import salted_join
from .shared import dropped, importable, staged, trimmed

#: Bits of a cell's number in the sketch of counts: 4 MB for each executor and 16 MB for the driver, whatever the input.
CELL_BITS = 20
#: 64-bit words of the bitmap of a set.
BITMAP = 16
#: Candidates' ids up to which they are sent to every executor (16 MB at most); more are shuffled.
BROADCAST_ROWS = 1_000_000
#: Sets that share a shingle and are compared pair by pair, at most.
RUN = 16
#: Texts and shingles of a block, about, and shingles that are columns of one product.
BLOCK_ROWS, BLOCK_GRAMS, COLUMNS = 512, 200_000, 512
#: Sets are compared in parts, one after the other, each of which is sent one in so many of all shingles, or so many shingles if that is more.
PART_SHARE, PART_GRAMS = 8, 16_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def shingles(data: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row of each) of the n-word shingles of lower-cased texts; fewer words make one shingle, no words none."""
    data = _LOWER[data]
    start, end, first = B.words(data, at)
    if not len(start):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    roll = B.Roller(B.word_hashes(data, start, end))
    many = np.diff(first)
    count = np.where(many >= n, many - n + 1, np.minimum(many, 1))
    row = np.repeat(np.arange(len(count)), count)
    a = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    size = np.minimum(many[row], n)
    return B.mix(roll.of(a, a + size) + size.astype(np.uint64)), row


def distinct(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes of each row, in order of row and hash."""
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[new], r[new]


def _cell(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def commonness(docs: DataFrame, n: int) -> np.ndarray:
    """For each cell of hashes how often they are found in texts, over all texts. A shingle that many texts share stands out of the others of its cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, dtype=np.int64)
        for batch in batches:
            for _, _, data, at in B.chunks(batch.column(1)):
                total += np.bincount(_cell(distinct(*shingles(data, at, n))[0]), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["cell", "n"])

    cells = staged(docs.mapInArrow(trimmed(run), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")), "cells-of-shingles")
    found = cells.toArrow()
    dropped(cells)
    count = np.zeros(1 << CELL_BITS)
    count[found["cell"].to_numpy()] = found["n"].to_numpy()
    return np.minimum(count, (1 << 32) - 1).astype(np.uint32) if count.max(initial=0) < 1 << 32 else (count / (count.max() / ((1 << 32) - 1))).astype(np.uint32)


def prefixes(h: np.ndarray, row: np.ndarray, common: np.ndarray, threshold: float, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, how many of them each row has, size of each row's set): the rarest shingles of each set, of which similar sets share one."""
    size = np.bincount(row, minlength=n_rows)
    need = np.where(size > 0, size - np.ceil(threshold * size - 1e-9).astype(np.int64) + 1, 0)
    order = np.lexsort((common[_cell(h)], row))  # stable: hashes stay in order where they are as common
    place = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
    return h[order][place < need[row]], need, size


def bitmaps(h: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """For each row the bits, of 64 * ``BITMAP``, that its hashes fall on, as signed 64-bit words."""
    bits = np.zeros((n_rows, 64 * BITMAP), dtype=np.uint8)
    bits[row, (h & np.uint64(64 * BITMAP - 1)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


def _prefixed(docs: DataFrame, n: int, threshold: float) -> DataFrame:
    """(id, n, digest, bits, keys) of each row with a set that isn't empty: its size, a digest and the bitmap of the set, and its prefix in order."""
    common = docs.sparkSession.sparkContext.broadcast(commonness(docs, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in B.chunks(batch.column(1)):
                h, row = distinct(*shingles(data, at, n))
                keys, many, size = prefixes(h, row, common.value, threshold, j - i)
                some, cuts = np.flatnonzero(size), np.r_[0, np.cumsum(size)]
                digests = [hashlib.blake2b(h[cuts[k] : cuts[k + 1]], digest_size=16).digest() for k in some]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(many[some])].astype(np.int32)), pa.array(keys.view(np.int64)))
                bits = pa.ListArray.from_arrays(pa.array(np.arange(0, BITMAP * len(some) + 1, BITMAP, dtype=np.int32)), pa.array(bitmaps(h, row, j - i)[some].ravel()))
                ids = batch.column(0).slice(i, j - i).take(pa.array(some))
                yield pa.RecordBatch.from_arrays([ids, pa.array(size[some]), pa.array(digests, pa.binary()), bits, lists], ["id", "n", "digest", "bits", "keys"])

    return docs.mapInArrow(trimmed(run), "id long, n long, digest binary, bits array<long>, keys array<long>")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: list[bytes] = []
            for _, _, data, at in B.chunks(batch.column(1)):
                h, row = shingles(data, at, n)
                cuts = np.searchsorted(row, np.arange(len(at)))
                sets += [np.unique(h[a:b]).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "grams"])

    return docs.mapInArrow(trimmed(run), "id long, grams binary")


def _verified(joined: DataFrame, threshold: float) -> DataFrame:
    """(u, v) of the rows (u, v, p, q) whose sets p and q are that similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for p, q in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in (p, q))
                low, high = sorted((len(a), len(b)))
                if low < threshold * high:
                    good.append(False)
                    continue
                common = len(a) + len(b) - len(np.union1d(a, b))
                good.append(common >= threshold * (len(a) + len(b) - common) - 1e-9)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(good, pa.bool_()))

    return joined.mapInArrow(trimmed(run), "u long, v long")


def _common(row: np.ndarray, grams: np.ndarray, left: np.ndarray, right: np.ndarray, n_rows: int) -> np.ndarray:
    """How many grams each row of left has in common with each of right. Grams of one row only don't count, the others are columns of a product."""
    _, column, count = np.unique(grams, return_inverse=True, return_counts=True)
    some = count[column] > 1
    row, column = row[some], (np.cumsum(count > 1) - 1)[column[some]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (low, low + COLUMNS))
        has = np.zeros((n_rows, min(COLUMNS, int(column[b - 1]) + 1 - low)), dtype=np.float32)
        has[row[a:b], column[a:b] - low] = 1
        out += has[left] @ has[right].T
    return out


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the marked pairs (row, column), enough to connect all that they connect; no more than rows and columns together."""
    free = [np.ones(near.shape[0], dtype=bool), np.ones(near.shape[1], dtype=bool)]
    rows, columns = [], []
    for start in np.flatnonzero(near.any(axis=1)):
        if not free[0][start]:
            continue
        free[0][start], todo = False, [(0, start)]
        while todo:
            side, x = todo.pop()
            found = np.flatnonzero((near[:, x] if side else near[x]) & free[1 - side])
            free[1 - side][found] = False
            mine = np.full(len(found), x)
            rows.append(found if side else mine)
            columns.append(mine if side else found)
            todo += [(1 - side, y) for y in found]
    return tuple(np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (rows, columns))


def _across(cells: DataFrame, threshold: float) -> DataFrame:
    """Links (u, v) between the two blocks of each cell, or within its only one, that connect texts of different components."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, comp, own, i, j = (table[c].to_numpy() for c in ("id", "comp", "own", "i", "j"))
        left, right = np.flatnonzero(own == i[0]), np.flatnonzero(own == j[0])
        sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in table["grams"]]
        size = np.array([len(s) for s in sets])
        common = _common(np.repeat(np.arange(len(sets)), size), np.concatenate(sets), left, right, len(sets)).astype(np.float64)
        near = common >= threshold * (size[left][:, None] + size[right] - common) - 1e-9
        near &= (ids[left][:, None] != ids[right]) & (comp[left][:, None] != comp[right])
        a, b = _forest(near)
        return pa.table({"u": ids[left[a]], "v": ids[right[b]]})

    return cells.groupBy("key", "i", "j").applyInArrow(run, "u long, v long")


def _blocks(rows, grams):
    return F.ceil(F.greatest(rows / BLOCK_ROWS, grams / BLOCK_GRAMS))


def _grouped(crowd: DataFrame) -> DataFrame:
    """(key, id, n, comp) of groups whose sets are compared with each other, from crowd (key, id, n, comp, cluster): shingles, or clusters where that is less to send.

    A cluster is what crowded shingles connect, so it holds all pairs of its shingles, each once. A group of one component is left out.
    """
    keys = crowd.groupBy("cluster", "key").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("g"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high")
    by_keys = keys.groupBy("cluster").agg(F.sum(F.col("g") * _blocks(F.col("c"), F.col("g"))).alias("apart"))
    members = crowd.select("cluster", "id", "n", "comp").distinct()
    whole = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("g"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high")
    plan = whole.join(by_keys, "cluster").select("cluster", (F.col("g") * _blocks(F.col("c"), F.col("g")) <= F.col("apart")).alias("together"))
    apart = crowd.join(plan.filter("not together").select("cluster"), "cluster", "left_semi").select("key", "id", "n", "comp")
    together = members.join(plan.filter("together").select("cluster"), "cluster", "left_semi").select(F.xxhash64(F.lit("cluster"), "cluster").alias("key"), "id", "n", "comp")
    return apart.union(together)


def _cells(groups: DataFrame) -> DataFrame:
    """(key, i, j, own, id, n, comp): the rows of groups (key, id, n, comp) in every cell of blocks that they are compared in.

    A group whose texts are of one component has none, and of groups with the same texts one has. The largest component of a group needs no
    comparison with itself: its blocks, which come after those of the others, meet only theirs.
    """
    parts = groups.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("g"), F.bit_xor(F.xxhash64("id")).alias("mark"))
    whole = parts.groupBy("key").agg(F.max(F.struct("c", "comp", "g")).alias("main"), F.sum("c").alias("c"), F.sum("g").alias("g"), F.bit_xor("mark").alias("mark"))
    whole = whole.filter(F.col("c") > F.col("main.c")).groupBy("c", "g", "mark").agg(F.min(F.struct("key", "main")).alias("x")).select("c", "g", "x.*")
    rest, main = _blocks(F.col("c") - F.col("main.c"), F.col("g") - F.col("main.g")), _blocks(F.col("main.c"), F.col("main.g"))
    plans = whole.select("key", F.col("main.comp").alias("largest"), rest.alias("rest"), main.alias("main"))
    rows = groups.select("key", "id", "n", "comp").join(plans, "key")
    inside, salt = F.col("comp") == F.col("largest"), F.xxhash64("id")
    rows = rows.withColumn("own", F.when(inside, F.col("rest") + F.pmod(salt, "main")).otherwise(F.pmod(salt, "rest")))
    last = F.when(inside, F.col("rest")).otherwise(F.col("rest") + F.col("main")) - 1
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "n", "comp")


def _candidates(calm: DataFrame, threshold: float) -> DataFrame:
    """(id, other) of rows of calm (key, id, n, pos) that share a key and, by sizes and places, may be similar.

    Of two sets, at most as many shingles are shared as come before the key in both, the key, and those that come after it in the lesser one.
    """
    right = calm.select("key", F.col("id").alias("other"), F.col("n").alias("m"), F.col("pos").alias("at"))
    shared = F.least("pos", "at") + 1 + F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("at")) - 1
    enough = shared >= F.lit(threshold / (1 + threshold)) * (F.col("n") + F.col("m")) - 1e-6
    sizes = F.least("n", "m") >= F.lit(threshold) * F.greatest("n", "m") - 1e-6
    return calm.join(right, "key").filter((F.col("id") < F.col("other")) & sizes & enough).select("id", "other")


def _by_bitmap(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(u, v, n) of the pairs (u, v) that bitmaps don't rule out, with the shingles of both: each bit that one set has and the other hasn't is a shingle at least that isn't shared."""
    for side in "uv":
        pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"b_{side}")), side)

    def shared(a: str, b: str) -> Column:
        apart = F.zip_with(f"b_{a}", f"b_{b}", lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
        return F.col(f"n_{a}") - F.aggregate(apart, F.lit(0), lambda s, x: s + x)

    enough = F.lit(threshold / (1 + threshold)) * (F.col("n_u") + F.col("n_v")) - 1e-6
    return pairs.filter((shared("u", "v") >= enough) & (shared("v", "u") >= enough)).select("u", "v", (F.col("n_u") + F.col("n_v")).alias("n"))


def _in_parts(docs: DataFrame, shingle: int, rows: DataFrame, by: list[str], ids: list[str], most: int, compared: Callable[[DataFrame, DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The links (u, v) that ``compared`` gives of rows and their sets (id, grams), a part of the rows after the other, so that sets never fill the disk; and the last sets.

    A part is sent about ``most`` shingles, the sum of its rows' n; rows of equal ``by`` are in one part. Sets are made anew for each part of the
    texts that ``ids`` of its rows name, and gone, with what was shuffled, before the next.
    """
    grams = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n, found = max(1, math.ceil(grams / most)), []
    for k in range(n):
        if found:
            dropped(sets)
        part = rows.filter(F.pmod(F.xxhash64(*by), F.lit(n)) == k) if n > 1 else rows
        asked = part.select(F.col(ids[0]).alias("asked"))
        for name in ids[1:]:
            asked = asked.union(part.select(name))
        asked = staged(asked.distinct(), "asked")
        few = asked.count() <= BROADCAST_ROWS
        texts = docs.join(F.broadcast(asked) if few else asked, docs["id"] == asked["asked"], "left_semi").distinct()
        sets = staged(_sets(texts, shingle), "sets")
        found.append(staged(compared(part, sets), "similar"))
        dropped(asked)
    out = found[0]
    for other in found[1:]:
        out = out.union(other)
    return out, sets


def _pairwise(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    joined = pairs.join(sets.select(F.col("id").alias("u"), F.col("grams").alias("p")), "u").join(sets.select(F.col("id").alias("v"), F.col("grams").alias("q")), "v")
    return _verified(joined.select("u", "v", "p", "q"), threshold)


def links(docs: DataFrame, threshold: float = 0.8, shingle: int = 5) -> DataFrame:
    """(u, v) of ids of docs (id, text) with ids whose similarity is at least the threshold, enough to connect all such pairs.

    They are all these pairs, u < v, but for texts of equal sets, which hang on the smallest id, and for shingles that over ``RUN`` sets have
    in their prefixes. Texts without a word link nothing here. Rows that share an id are one text each, and linked as that id.
    """
    importable(docs.sparkSession)
    rows = staged(_prefixed(docs, shingle, threshold), "prefixes")
    sets = staged(rows.groupBy("digest").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("keys").alias("keys")), "distinct-sets")
    copies = staged(rows.select("id", "digest").join(sets.select("digest", F.col("id").alias("u")), "digest").filter("id <> u").select("u", F.col("id").alias("v")).distinct(), "copies")
    dropped(rows)
    every = sets.select("id", "n", F.posexplode("keys").alias("pos", "key"))
    shared = staged(every.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("key", "k", F.col("k").alias("members")), "shared-shingles")
    rows = staged(salted_join(every, shared, ["key"], salt_by=("id",)), "shared-prefixes")
    dropped(shared)
    calm, crowd = rows.filter(F.col("members") <= RUN).select("key", "id", "n", "pos"), rows.filter(F.col("members") > RUN)
    pairs = _candidates(calm, threshold)
    crowded = not crowd.isEmpty()
    if crowded:
        most = rows.groupBy("id").agg(F.sum("members").alias("common"))
        best = crowd.join(most, "id").groupBy("key").agg(F.max(F.struct("common", "id")).getField("id").alias("other"))
        stars = staged(crowd.join(best, "key").filter("id <> other").select("id", "other").distinct(), "stars")
        pairs = pairs.union(stars)
    pairs = pairs.select(F.least("id", "other").alias("u"), F.greatest("id", "other").alias("v")).distinct()
    pairs = staged(_by_bitmap(pairs, sets.select("id", "n", "bits"), threshold), "pairs")
    most = max(PART_GRAMS, (sets.agg(F.sum("n")).first()[0] or 0) // PART_SHARE)
    dropped(sets)
    found, last = _in_parts(docs, shingle, pairs, ["u"], ["u", "v"], most, lambda part, of: _pairwise(part, of, threshold))
    dropped(last)
    dropped(pairs)
    if crowded:
        comps = components(found.union(copies)).select(F.col("node").alias("id"), F.col("component").alias("comp"))
        clusters = components(stars.select(F.col("id").alias("u"), F.col("other").alias("v"))).select(F.col("node").alias("id"), F.col("component").alias("cluster"))
        named = crowd.select("key", "id", "n").join(comps, "id", "left").join(clusters, "id", "left").select("key", "id", "n", F.coalesce("comp", "id").alias("comp"), F.coalesce("cluster", "id").alias("cluster"))
        cells = staged(_cells(staged(_grouped(staged(named, "crowd")), "groups")), "cells")
        if not cells.isEmpty():
            found = found.union(_in_parts(docs, shingle, cells, ["key", "i", "j"], ["id"], most, lambda part, of: _across(part.join(of, "id"), threshold))[0])
    return found.union(copies)
