"""SimHash near-duplicates by the generalised pigeonhole principle (Qin et al., "GPH: Similarity Search in Hamming Space").

The 64 bits of a fingerprint are grouped into partitions, correlated bits together, so that what is left apart is as independent as can
be. Partition i gets its own threshold t_i >= -1 with sum(t_i + 1) = d + 1: two fingerprints within d bits agree to within t_i bits on
some partition i, so it is enough to look there. Dynamic programming allots the thresholds by the estimated number of candidates; the
estimates come from the counts of all pairs of bits over all fingerprints. Probes are the values within t_i of a fingerprint's value on
partition i. Fingerprints that share a probe are compared in full.

Equal fingerprints are one node, so copies cost nothing. Values of a partition that very many fingerprints share are not compared pair
by pair: their fingerprints are all turned into their 65 values within one bit, and two of them share such a value exactly if they are
within two bits of each other; so all that share one hang on the smallest of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytes_np as B
from . import similar
from .components import components
from .shared import importable, scratch, staged, trimmed, unused

BITS = 64
#: Words of a shingle in general use; the query has its own.
SHINGLE_WORDS = 5
#: Jaccard similarity of near-duplicates in general use.
SIMILARITY = 0.8
#: Fingerprints that share a probe and are compared pair by pair, at most; more are linked by way of their neighbours.
RUN = 128
#: Cost of one probe, which is shuffled and sorted, in comparisons.
PROBE_COST = 40.0
#: Ids up to which the near-copies that go are sent to every executor (16 MB at most).
BROADCAST_ROWS = 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)


def fingerprints_of(data: np.ndarray, at: np.ndarray, shingle: int) -> np.ndarray:
    """The fingerprint of each row of a chunk."""
    start, end, first = B.words(data, at)
    out = np.zeros(len(at) - 1, dtype=np.uint64)
    if not len(start):
        return out
    # Words joined by one blank each: every word byte, and the first space after a word.
    space = B.SPACE[data]
    keep = ~space
    keep[1:] |= ~space[:-1]
    flat = np.where(space, np.uint8(0x20), _LOWER[data])[keep]
    place = np.cumsum(keep) - 1
    size = end - start
    start = place[start]
    end = start + size
    many = np.diff(first)
    count = np.where(many >= shingle, many - shingle + 1, np.minimum(many, 1))
    row = np.repeat(np.arange(len(count)), count)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    a = first[row] + offset
    b = a + np.minimum(many[row], shingle) - 1
    hashes = B.xxh64(flat, start[a], end[b] - start[a], seed=42)
    planes = np.ascontiguousarray(hashes.astype("<u8")).view(np.uint8).reshape(-1, 8)
    cuts = np.cumsum(count)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for lo in range(0, len(out), 256):
        hi = min(lo + 256, len(out))
        i, j = cuts[lo] - count[lo], cuts[hi - 1]
        if i == j:
            continue
        key = (row[i:j, None] - lo) * 2048 + np.arange(8) * 256 + planes[i:j]
        seen = np.bincount(key.ravel(), minlength=(hi - lo) * 2048).reshape(-1, 256)
        ones = (seen @ _BYTE_BITS).reshape(hi - lo, 64)
        out[lo:hi] = ((2 * ones > count[lo:hi, None]) * weights).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, fp long): A-Z lower-cased, shingles of words hashed by XXH64, each bit by majority. No words: 0."""
    importable(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprints_of(data, at, shingle) for _, _, data, at in B.chunks(batch.column(1))]
            fp = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(trimmed(run), f"id {kind}, fp long")


@dataclass(frozen=True)
class Plan:
    """Partitions of bits and their thresholds; those of -1 are left out."""

    parts: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]
    cost: float


def pair_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and for bits i <= j how many have both, over all rows. Each task sends 2080 sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), dtype=np.int64), 0
        for batch in batches:
            fp = np.asarray(batch.column(0)).astype(np.int64).view(np.uint64)
            for i in range(0, len(fp), 1 << 16):
                part = ((fp[i : i + (1 << 16), None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
                total += (part.T @ part).astype(np.int64)
            n += len(fp)
        a, b = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *a.tolist()]), pa.array([-1, *b.tolist()]), pa.array([n, *total[a, b].tolist()])], ["a", "b", "n"])

    out, n = np.zeros((BITS, BITS)), 0
    for a, b, k in fps.select("fp").mapInArrow(trimmed(run), "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        if a < 0:
            n = k
        else:
            out[a, b] = out[b, a] = k
    return n, out


def _grouped(strength: np.ndarray, m: int) -> list[list[int]]:
    """m groups of about equal width, each grown from the bit most tied to bits that are left by the bit most tied to the group."""
    left, groups = set(range(BITS)), []
    for g in range(m):
        width = BITS // m + (g < BITS % m)
        seed = max(left, key=lambda b: (strength[b, sorted(left)].sum(), -b))
        group = [seed]
        left.remove(seed)
        while len(group) < width:
            best = max(left, key=lambda b: (strength[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def plan(n: int, both: np.ndarray, distance: int, max_parts: int = 6) -> Plan:
    """The grouping and thresholds of least estimated cost: probes of all fingerprints, and pairs that share one."""
    p = np.diag(both) / max(n, 1)
    p11 = both / max(n, 1)
    p10, p01 = p[:, None] - p11, p[None, :] - p11
    p00 = 1 - p11 - p10 - p01
    agree = p**2 + (1 - p) ** 2  # that two fingerprints agree on a bit
    agree2 = p11**2 + p10**2 + p01**2 + p00**2  # and on two bits
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    strength = np.abs(p11 - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(strength, 0)

    def candidates(bits: list[int], t: int) -> float:
        """Pairs expected to agree on the bits to within t: a tree of the strongest ties, and bits that differ as if independent."""
        chance, inside = agree[bits[0]], [bits[0]]
        for _ in bits[1:]:
            tie, b, a = max((strength[b, a], -b, a) for b in bits if b not in inside for a in inside)
            chance *= min(1.0, agree2[-b, a] / max(agree[a], 1e-12))
            inside.append(-b)
        odds, more = (1 - agree[bits]) / np.maximum(agree[bits], 1e-12), [1.0]
        for k in range(1, t + 1):  # Newton's identities for the elementary symmetric sums
            more.append(sum((-1) ** (i - 1) * more[k - i] * (odds**i).sum() for i in range(1, k + 1)) / k)
        return n * (n - 1) / 2 * chance * sum(more)

    best = None
    for m in range(1, max_parts + 1):
        groups = _grouped(strength, m)
        cost = [[0.0] + [n * PROBE_COST * sum(math.comb(len(g), k) for k in range(t + 1)) + candidates(g, t) for t in range(distance + 1)] for g in groups]
        # table[s]: least cost of the groups so far with sum(t_i + 1) = s.
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for c in cost:
            after: dict[int, tuple[float, tuple[int, ...]]] = {}
            for s, (spent, chosen) in table.items():
                for k in range(0, distance + 2 - s):
                    option = (spent + c[k], (*chosen, k - 1))
                    if s + k not in after or option < after[s + k]:
                        after[s + k] = option
            table = after
        spent, thresholds = table[distance + 1]
        if best is None or spent < best.cost:
            used = [(tuple(g), t) for g, t in zip(groups, thresholds, strict=True) if t >= 0]
            best = Plan(tuple(g for g, _ in used), tuple(t for _, t in used), spent)
    return best


def _probes(fps: DataFrame, chosen: Plan) -> DataFrame:
    """(part, key, fp, rep): each fingerprint under every value within t_i of its own on partition i."""
    fp = F.col("fp")
    tables = []
    for i, (bits, t) in enumerate(zip(chosen.parts, chosen.thresholds, strict=True)):
        mask = sum(1 << b for b in bits)
        masks, layer = [0], [(0, -1)]
        for _ in range(t):
            layer = [(x | 1 << b, b) for x, last in layer for b in bits if b > last]
            masks += [x for x, _ in layer]
        signed = [x - (1 << 64) if x >> 63 else x for x in (mask, *masks)]
        own = fp.bitwiseAND(F.lit(signed[0]))
        flips = F.explode(F.array(*(F.lit(x).cast("long") for x in signed[1:])))
        if t:
            key = fps.withColumn("flip", flips).select(F.lit(i).alias("part"), own.bitwiseXOR(F.col("flip")).alias("key"), "fp", "rep")
        else:
            key = fps.select(F.lit(i).alias("part"), own.alias("key"), "fp", "rep")
        tables.append(key)
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    return out


def _verified(rows: DataFrame, distance: int) -> DataFrame:
    """Links (u, v) within the runs of equal (part, key) of rows that lie together in their partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links(table: np.ndarray) -> pa.RecordBatch:
            part, key, fp, rep = table
            first = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (key[1:] != key[:-1])])
            size = np.diff(np.r_[first, len(part)])
            left = np.repeat(first + size, size) - np.arange(len(part))  # rows of the run from this one on
            u, v, some = [], [], np.arange(len(part))
            for step in range(1, int(size.max(initial=0))):
                some = some[left[some] > step]
                close = some[np.bitwise_count((fp[some] ^ fp[some + step]).view(np.uint64)) <= distance]
                u.append(rep[close])
                v.append(rep[close + step])
            u, v = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (u, v))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            held.append(np.stack([np.asarray(c).astype(np.int64) for c in batch.columns]))
            table = np.concatenate(held, axis=1)
            if table.shape[1] < 1 << 16:
                held = [table]
                continue
            # The last run may go on in the next batch.
            last = int(np.flatnonzero((table[0] != table[0, -1]) | (table[1] != table[1, -1])).max(initial=-1)) + 1
            held = [table[:, last:]]
            if last:
                yield links(table[:, :last])
        if held and held[0].shape[1]:
            yield links(np.concatenate(held, axis=1))

    return rows.mapInArrow(trimmed(run), "u long, v long")


def links(fps: DataFrame, distance: int = 2, run: int = RUN) -> DataFrame:
    """Links (u, v) of rep between distinct fingerprints (fp, rep) within ``distance`` bits, 1 or 2; enough of them to connect all that are.

    A probe shared by up to ``run`` fingerprints has its pairs compared. The fingerprints of fuller ones are linked by the values
    within one bit of them, which takes 65 rows for each and no pairs.
    """
    if distance not in (1, 2):
        raise ValueError("the distance is 1 or 2 bits")
    chosen = plan(*pair_counts(fps), distance)
    rows = _probes(fps, chosen)
    full = rows.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > run).select("part", "key")
    full = staged(full, "full-probes")
    calm = rows.join(full, ["part", "key"], "left_anti") if not full.isEmpty() else rows
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = _verified(calm.repartition(n, "part", "key").sortWithinPartitions("part", "key", "fp"), distance)
    if not full.isEmpty():
        crowd = rows.join(full, ["part", "key"], "left_semi").select("fp", "rep").distinct()
        bit = F.expr("shiftleft(1L, cast(b as int))")
        spread = crowd.withColumn("b", F.explode(F.sequence(F.lit(-1), F.lit(BITS - 1))))
        if distance == 2:
            keyed = spread.select(F.when(F.col("b") < 0, F.col("fp")).otherwise(F.col("fp").bitwiseXOR(bit)).alias("a"), F.lit(-1).alias("b"), "rep")
        else:  # the two ends of an edge of the cube
            keyed = spread.filter("b >= 0").select(F.col("fp").bitwiseAND(F.bitwise_not(bit)).alias("a"), "b", "rep")
        low = keyed.groupBy("a", "b").agg(F.min("rep").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "b", "low")
        found = found.union(keyed.join(low, ["a", "b"]).filter("rep <> low").select(F.col("rep").alias("u"), F.col("low").alias("v")))
    return found


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, distance: int = 2, run: int = RUN, similarity: float | None = SIMILARITY,
) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hexadecimal digits), component_id.

    Fingerprints link at ``distance`` or fewer differing bits; with ``similarity``, texts also link where the Jaccard similarity of their
    shingle sets is that or more (see ``similar``: bits are too coarse for it). component_id is the smallest id reachable over links, the
    row's own included. Null, empty and blank texts have fingerprint 0 and link like any other; fewer words than a shingle make one
    shingle. Ids are integers; rows without one link nothing and have no component. Repeated rows link to each other as copies. An empty
    table gives an empty result; other columns are ignored.
    """
    with scratch() as tables:
        prints = tables.keep(staged(fingerprints(docs, id_col, text_col, shingle).select(F.col("id").cast("long"), "fp"), "fingerprints"))
        distinct = staged(prints.filter("id is not null").groupBy("fp").agg(F.min("id").alias("rep")), "distinct")
        if similarity is None:
            comps = components(links(distinct, distance, run)) if not distinct.isEmpty() else distinct.selectExpr("rep as node", "rep as component")
            of_print = tables.keep(staged(distinct.join(comps, distinct["rep"] == comps["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id")), "components"))
        elif not distinct.isEmpty():
            rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id is not null")
            copies = prints.join(distinct, "fp").filter("id <> rep").select(F.col("rep").alias("u"), F.col("id").alias("v"))
            comps = tables.keep(staged(components(links(distinct, distance, run).union(copies).union(similar.links(rows, similarity, shingle))), "components"))
        else:
            comps = tables.keep(staged(distinct.selectExpr("rep as node", "rep as component"), "components"))
    if similarity is None:
        named = prints.join(of_print, "fp", "left")
    else:
        named = prints.join(comps, prints["id"] == comps["node"], "left").select("id", "fp", F.coalesce("component", "id").alias("component_id"))
    own = F.when(F.col("id").isNotNull(), F.col("component_id"))
    return named.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), own.alias("component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, distance: int = 2, run: int = RUN, similarity: float | None = SIMILARITY) -> DataFrame:
    """The rows of docs that stay, with all their columns, whatever their names: of each group of near-duplicates those of the smallest id, and those without an id.

    Null, empty and blank texts have fingerprint 0, and so are one group. Rows that share the staying id all stay. An empty table gives an
    empty result. Only the ids that go are joined to the rows; they are sent to every executor if few, else shuffled.
    """
    with scratch() as tables:
        found = near_duplicates(docs, id_col, text_col, shingle, distance, run, similarity)
        gone = tables.keep(staged(found.filter(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("gone_id")).distinct(), "near-copies"))
    few = gone.count() <= BROADCAST_ROWS
    mark = unused(docs.columns, "gone_id")
    gone = gone.withColumnRenamed("gone_id", mark)
    return docs.join(F.broadcast(gone) if few else gone, F.col(id_col) == F.col(mark), "left_anti")
