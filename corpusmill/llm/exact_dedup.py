"""Exact dedup: a log-structured merge index of text digests.

Rows of (digest, id, n_chars) fill a memtable of bounded size, in which rows of one digest are one entry: the row that stays (most code
points, then smallest id) and how many there are. A full memtable is flushed as a run, Parquet files sorted by digest, with a filter of
its digests. ``FANOUT`` runs of one level are compacted into a run of the next, entries of one digest becoming one. A manifest names the
runs; it is replaced as a whole, so that an index opens again as it was after its last finished step, whatever was lost.

Look-ups ask each run's filter first, and only a run whose filter says that some digest may be there is opened, for these digests alone.
A filter is a table of blocks of 256 bits, one bit in each of a block's four words for each digest: it is made by one aggregate and
asked by one join, without any UDF. Hits are verified on the bytes of the normalised texts.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .shared import new_path, scratch, staged, unused

#: White space that does not count when texts are compared.
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
#: Rows up to which the digests of hits are sent to every executor (about 100 bytes each, so 50 MB at most); more are shuffled.
BROADCAST_ROWS = 500_000
#: Bytes of digest files of one memtable, about, and memtables of a corpus at least.
MEMTABLE_BYTES, LEAST_MEMTABLES = 2 << 30, 4
#: Runs of one level that become one of the next.
FANOUT = 4
#: Bits of a run's filter for each digest.
FILTER_BITS = 16


def normalised(text: Column) -> Column:
    """The text without its white space; null counts as empty. Plain replacements: each is one pass without a regular expression."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


@dataclass(frozen=True)
class Run:
    """A sorted run: its folder, its level, how many digests it has, how many blocks its filter has, and the type of its ids."""

    path: str
    level: int
    digests: int
    blocks: int
    id_type: str

    def entries(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"digest binary, keep_id {self.id_type}, n_chars long, group_size long").parquet(f"{self.path}/data")

    def filter(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("block long, w0 long, w1 long, w2 long, w3 long").parquet(f"{self.path}/filter")


def _entries(rows: DataFrame) -> DataFrame:
    """One entry for each digest of rows (digest, keep_id, n_chars, group_size). Rows of one digest are combined in each task first."""
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("keep_id").isNull().alias("none"), F.col("keep_id").alias("id")))
    per = rows.groupBy("digest").agg(best.alias("best"), F.sum("group_size").alias("group_size"))
    return per.select("digest", F.col("best.id").alias("keep_id"), (-F.col("best.less")).alias("n_chars"), "group_size")


def _all(tables: Iterable[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.union, tables)


def _place(blocks: int) -> Column:
    return F.xxhash64("digest").bitwiseAND(F.lit(blocks - 1))


def _bit(word: int) -> Column:
    return F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(digest, 1), {6 * word}) & 63 as int))")


class DigestIndex:
    """Runs of (digest, keep_id, n_chars, group_size) in a shared folder, by level, and a manifest that names them.

    ``append`` flushes a batch as a run and compacts what is due, ``lookup`` finds the entries of digests, ``close`` deletes the index. An
    interrupted step leaves only folders that no manifest names, so it can be repeated; with the path of an index it opens that index.
    ``opened`` and ``skipped`` count the runs that look-ups have opened, and those that their filters kept shut.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = FANOUT):
        self.spark, self.path, self.fanout = spark, path or new_path(spark, "digests"), fanout
        self.opened = self.skipped = 0
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.step, self.runs = self._newest()

    def _newest(self) -> tuple[int, list[Run]]:
        where = self._hadoop(f"{self.path}/manifest")
        if not self._fs.exists(where):
            return 0, []
        steps = [int(s.getPath().getName()[:-5]) for s in self._fs.listStatus(where) if s.getPath().getName().endswith(".json")]
        if not steps:
            return 0, []
        text = self.spark.read.text(f"{self.path}/manifest/{max(steps):012d}.json", wholetext=True).first()[0]
        return max(steps), [Run(**r) for r in json.loads(text)]

    def _commit(self, runs: list[Run]) -> None:
        """Writes the next manifest under another name and renames it, which is done whole or not at all. Older ones go."""
        step = self.step + 1
        part, whole = (self._hadoop(f"{self.path}/manifest/{step:012d}.{kind}") for kind in ("part", "json"))
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps([asdict(r) for r in runs]).encode()))
        out.close()
        if not self._fs.rename(part, whole):
            raise OSError(f"{whole.toString()} couldn't be written")
        if self.step:
            self._fs.delete(self._hadoop(f"{self.path}/manifest/{self.step:012d}.json"), False)
        gone = {r.path for r in self.runs} - {r.path for r in runs}
        self.step, self.runs = step, runs
        for path in gone:
            self._fs.delete(self._hadoop(path), True)

    def _flush(self, entries: DataFrame, level: int) -> Run:
        where, seen = f"{self.path}/runs/{level}-{uuid.uuid4().hex}", Observation()
        entries.observe(seen, F.count(F.lit(1)).alias("n")).sortWithinPartitions("digest").write.parquet(f"{where}/data")
        n = seen.get["n"]
        run = Run(where, level, n, 1 << max(0, (n * FILTER_BITS // 256).bit_length()), entries.schema["keep_id"].dataType.simpleString())
        words = [F.bit_or(_bit(w)).alias(f"w{w}") for w in range(4)]
        run.entries(self.spark).groupBy(_place(run.blocks).alias("block")).agg(*words).write.parquet(f"{where}/filter")
        return run

    def append(self, rows: DataFrame) -> DataFrame:
        """Flushes rows of (digest binary, id, n_chars) as a run. Returns the digests of rows that aren't the only ones of theirs, each once."""
        entries = _entries(rows.select("digest", F.col("id").alias("keep_id"), "n_chars", F.lit(1).cast("long").alias("group_size")))
        run = self._flush(entries, 0)
        own = run.entries(self.spark)
        again = own.filter("group_size > 1").select("digest").union(self.lookup(own.select("digest")).select("digest"))
        hits = staged(again.distinct(), "hits")
        self._commit([*self.runs, run])
        self.compact()
        return hits

    def compact(self) -> None:
        """Merges the runs of each level that has ``fanout`` of them into one of the next level."""
        level = 0
        while any(r.level >= level for r in self.runs):
            due = [r for r in self.runs if r.level == level]
            if len(due) >= self.fanout:
                merged = self._flush(_entries(_all(r.entries(self.spark) for r in due)), level + 1)
                self._commit([*(r for r in self.runs if r.level != level), merged])
            level += 1

    def candidates(self, digests: DataFrame, run: Run) -> DataFrame:
        """Of digests, each once, those that the run's filter doesn't rule out."""
        asked = digests.withColumn("block", _place(run.blocks)).join(run.filter(self.spark), "block")
        for w in range(4):
            asked = asked.filter(F.col(f"w{w}").bitwiseAND(_bit(w)) != 0)
        return asked.select("digest")

    def lookup(self, digests: DataFrame) -> DataFrame:
        """(digest, keep_id, n_chars, group_size) of those of digests, each once, that the index has, over all its runs."""
        if not self.runs:
            # createDataFrame would start Python workers of another kind, with a daemon that stays.
            return self.spark.range(0).selectExpr("cast(null as binary) as digest", "id as keep_id", "id as n_chars", "id as group_size")
        maybe = staged(_all(self.candidates(digests, r).withColumn("run", F.lit(k)) for k, r in enumerate(self.runs)), "candidates")
        n = {r["run"]: r["count"] for r in maybe.groupBy("run").count().collect()}
        self.opened, self.skipped = self.opened + len(n), self.skipped + len(self.runs) - len(n)
        found = []
        for k, run in enumerate(self.runs):
            if k in n:
                asked = maybe.filter(F.col("run") == k).select("digest")
                found.append(run.entries(self.spark).join(F.broadcast(asked) if n[k] <= BROADCAST_ROWS else asked, "digest"))
        return _entries(_all(found)) if found else self.runs[0].entries(self.spark).limit(0)

    def close(self) -> None:
        self._fs.delete(self._hadoop(self.path), True)


def _memtables(rows: DataFrame) -> list[DataFrame]:
    """A staged table in parts of whole files, each of about ``MEMTABLE_BYTES`` at most, ``LEAST_MEMTABLES`` of them if there are as many files."""
    spark, path = rows.sparkSession, rows.staged_path
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = sorted((s.getPath().toString(), s.getLen()) for s in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where) if s.getPath().getName().endswith(".parquet"))
    whole = sum(n for _, n in files)
    n_parts = max(LEAST_MEMTABLES, -(-whole // MEMTABLE_BYTES))
    parts: dict[int, list[str]] = {}
    before = 0
    for name, n in files:  # a file goes to the part that its middle lies in
        parts.setdefault(int((before + n / 2) * n_parts // max(whole, 1)), []).append(name)
        before += n
    return [spark.read.schema(rows.schema).parquet(*p) for p in parts.values()]


@dataclass(frozen=True)
class Found:
    """rows: (id, digest, n_chars) of every row. hits: (digest, keep_id, n_chars, group_size) of the digests of several rows; few: may be broadcast."""

    rows: DataFrame
    hits: DataFrame
    few: bool


def indexed(docs: DataFrame, id_col: str, text_col: str, broadcast_rows: int = BROADCAST_ROWS) -> Found | None:
    """Builds an index of docs, verifies its hits on the texts, and deletes it. None where a digest has two texts."""
    texts = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"), F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars"))
    keyed = texts.withColumn("digest", F.unhex(F.sha2(F.col("norm"), 256)))
    with scratch() as tables:
        rows = tables.keep(staged(keyed.select("digest", "id", "n_chars"), "digests"))
        index, again = DigestIndex(rows.sparkSession), None
        for memtable in _memtables(rows):
            some = index.append(memtable)
            again = some if again is None else again.union(some)
        hits = tables.keep(staged(index.lookup(rows.select("digest") if again is None else again.distinct()), "repeated"))
        index.close()
        few = hits.limit(broadcast_rows + 1).count() <= broadcast_rows
        asked = hits.select("digest")
        copies = keyed.select("digest", "norm").join(F.broadcast(asked) if few else asked, "digest", "left_semi")
        clash = copies.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("n")).groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
        return Found(rows, hits, few) if clash.isEmpty() else None


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size long, kept boolean, text_sha256 string.

    Texts are equal when identical without the characters of ``SPACES``; null counts as empty, so null, empty and blank texts form one
    group. Of equal texts the row with most code points in the original text stays, then the smallest id (null ids last). Rows that
    share their id and text are told apart by nothing: all of them count in group_size, and all have ``kept`` of their id. An empty
    table gives an empty result; other columns are ignored.

    The runs hold 32-byte digests, so two texts of one digest that differ would be a SHA-256 collision. Hits are nevertheless verified:
    they are grouped by digest and text, which compares whole texts and is combined in each task first. A digest with two texts makes
    the operator fall back to grouping by text.
    """
    found = indexed(docs, id_col, text_col, broadcast_rows)
    if found is None:
        texts = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("norm"), F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars"))
        groups = _entries(texts.select(F.col("norm").alias("digest"), F.col("id").alias("keep_id"), "n_chars", F.lit(1).cast("long").alias("group_size"))).withColumnRenamed("digest", "norm").drop("n_chars")
        rows = texts.join(groups, "norm").select("id", "keep_id", "group_size", F.unhex(F.sha2("norm", 256)).alias("digest"))
    else:
        hits = found.hits.select("digest", "keep_id", "group_size")
        rows = found.rows.join(F.broadcast(hits) if found.few else hits, "digest", "left")
        alone = F.col("group_size").isNull()
        rows = rows.select("id", F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "digest")
    return rows.select(
        F.col("id").alias(id_col), F.col("keep_id"), F.col("group_size"), F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns, whatever their names: one of each group of equal texts.

    Equality and what stays are those of ``exact_groups``: null, empty and blank texts are one group of which one row stays; null ids come
    last. Of rows that share the staying id and text, any one stays, whatever their other columns hold. An empty table gives an empty
    result. Only digests are joined to the rows, sent to every executor if few; the texts of groups whose staying row comes several times
    are shuffled, no others.
    """
    found = indexed(docs, id_col, text_col)
    own, of, keep, chars = (unused(docs.columns, x) for x in ("digest", "of_digest", "keep_id", "most_chars"))
    if found is None:
        rows = docs.withColumn(own, normalised(F.col(text_col)))
        best = F.min(F.struct((-F.length(F.coalesce(F.col(text_col), F.lit("")))).alias("n"), F.col(id_col).isNull().alias("x"), F.col(id_col).alias("i")))
        hits = rows.groupBy(own).agg(best.alias("b"), F.count(F.lit(1)).alias("k")).filter("k > 1").select(F.col(own).alias(of), F.col("b.i").alias(keep), (-F.col("b.n")).alias(chars))
        few = False
    else:
        rows, few = docs.withColumn(own, digest_of(F.col(text_col))), found.few
        hits = found.hits.select(F.col("digest").alias(of), F.col("keep_id").alias(keep), F.col("n_chars").alias(chars))
    joined = rows.join(F.broadcast(hits) if few else hits, F.col(own) == F.col(of), "left")
    stays = F.col(id_col).eqNullSafe(F.col(keep)) & (F.length(F.coalesce(F.col(text_col), F.lit(""))) == F.col(chars))
    alone = joined.filter(F.col(of).isNull()).select(*docs.columns)
    return alone.union(joined.filter(F.col(of).isNotNull() & stays).dropDuplicates([own]).select(*docs.columns))
