"""Exact, version and MinHash dedup, all of which keep a first row by an explicit order."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from ..functions import text as T
from ..workers import importable


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where spark.checkpoint.dir is unset, a temporary one, on a local master only, deleted at the end."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    return _own_folder(spark.sparkContext.applicationId)


@lru_cache
def _own_folder(application: str) -> str:
    folder = tempfile.mkdtemp(prefix=f"corpusmill-{application}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again, which ends its lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.saved_path = path
    return found


def unsaved(*tables: DataFrame) -> None:
    """Deletes saved tables that no later plan reads."""
    for df in tables:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.saved_path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


#: Rows of a small side that are sent to every executor, at most.
BROADCAST_ROWS = 500_000


def _small(df: DataFrame) -> DataFrame:
    """df, to be broadcast where it is small: its rows are counted up to the bound."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def exact(df: DataFrame, order: str = "doc_id", text_field: str = "text") -> DataFrame:
    """df with ``hash``, ``first`` (the smallest order of its hash) and ``is_duplicate``. Rows that share hash and order are decided alike; ``first_rows`` tells them apart.

    Only hashes and orders are aggregated, a hash of very many rows combined in each task first. Hashes of one row are joined to nothing: what
    is joined, and sent to every executor if small, are the hashes that several rows have.
    """
    rows = df.withColumn("hash", T.sha256(T.text_of(text_field)))
    again = rows.groupBy("hash").agg(F.min(order).alias("__first"), F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(F.col("hash").alias("__hash"), "__first")
    joined = rows.join(_small(again), F.col("hash") == F.col("__hash"), "left").withColumn("first", F.coalesce("__first", order))
    return joined.withColumn("is_duplicate", F.col(order) != F.col("first")).select(*df.columns, "hash", "first", "is_duplicate")


def first_rows(df: DataFrame, order: str = "doc_id", text_field: str = "text") -> DataFrame:
    """The first row of each text by order, one of them where several share the smallest order. Only texts of rows that aren't alone are shuffled."""
    marked = exact(df, order, text_field)
    shared = saved(marked.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"), "shared-hashes")
    few = _small(shared)
    alone = marked.join(few, "hash", "left_anti")
    several = marked.join(few, "hash", "left_semi").filter("not is_duplicate").dropDuplicates(["hash"])
    return alone.select(*df.columns).union(several.select(*df.columns))


def exact_stats(df: DataFrame, text_field: str = "text") -> DataFrame:
    """One row: total, unique, duplicates and their rate."""
    per = df.groupBy(T.sha256(T.text_of(text_field)).alias("hash")).agg(F.count(F.lit(1)).alias("n"))
    total, unique = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return per.agg(total.alias("total_docs"), unique.alias("unique_docs"), (total - unique).alias("duplicate_docs"), F.round(T.ratio(total - unique, total), 4).alias("dedup_rate"))


def latest_version(df: DataFrame, key: Column, version: Column, order: str) -> DataFrame:
    """df with ``is_latest``: per key the row of greatest version as a string, of equal ones the last by order. Rows that share all three are decided alike.

    Keys of one row are joined to nothing.
    """
    rows = df.withColumns({"__key": key, "__version": F.coalesce(version, F.lit("v0"))})
    best = rows.groupBy("__key").agg(F.max(F.struct("__version", F.col(order).alias("__order"))).alias("__best"), F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    best = best.withColumnRenamed("__key", "__of")
    joined = rows.join(_small(best), F.col("__key").eqNullSafe(F.col("__of")), "left")
    latest = F.col("__best").isNull() | ((F.col("__version") == F.col("__best.__version")) & F.col(order).eqNullSafe(F.col("__best.__order")))
    return joined.withColumn("is_latest", latest).select(*df.columns, "is_latest")


PRIME = (1 << 31) - 1


def signature(text: Column, num_perm: int = 112, ngram: int = 5, seed: int = 1) -> Column:
    """MinHash values of a text's character n-grams, lower-cased and stripped, under num_perm functions (a * h + b) mod a prime, h of 31 bits.

    An Arrow UDF over arrays: the least of each function over all n-grams of a text, a block of n-grams at a time.
    """
    importable()
    rng = np.random.default_rng(seed)
    a, b = rng.integers(1, PRIME, num_perm, dtype=np.uint64), rng.integers(0, PRIME, num_perm, dtype=np.uint64)
    step = rng.integers(1, 1 << 62, ngram, dtype=np.uint64) | np.uint64(1)

    def one(value: str) -> list[int]:
        t = np.frombuffer(value.lower().strip().encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        n = max(1, len(t) - ngram + 1)
        h = np.full(n, len(t) if len(t) < ngram else 0, dtype=np.uint64)
        for k in range(min(ngram, len(t))):
            h = (h + t[k : k + n]) * step[k]
        h = np.unique(((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(33)) % np.uint64(PRIME)
        least = np.full(num_perm, PRIME, dtype=np.uint64)
        for i in range(0, len(h), 512):  # both factors are under 2 ** 31; the prime is one less than a power of two, so folding takes remainders
            x = h[i : i + 512, None] * a + b
            for _ in range(2):
                x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
            least = np.minimum(least, x.min(axis=0))
        return least.astype(np.int64).tolist()

    @F.pandas_udf(ArrayType(LongType()))
    def signatures(values: pd.Series) -> pd.Series:
        return values.map(one)

    return signatures(text)


def minhash(df: DataFrame, order: str = "doc_id", text_field: str = "text", num_perm: int = 112, bands: int = 14, rows: int = 8, ngram: int = 5, max_rounds: int = 200) -> DataFrame:
    """df with ``is_duplicate``: rows in order stay unless a row that stays before them shares a band of ``rows`` MinHash values.

    Rows of equal signatures are one node. A node stays once all its smaller neighbours are gone, and goes once one of them stays; each round decides
    every node it can, so the rounds grow with the longest chain of decisions, not with the rows. Neighbourship is kept as (node, band value)
    rows and decided by aggregates per band value, so no pairs are made however many rows share one.
    """
    if bands * rows > num_perm:
        raise ValueError("bands * rows is more than num_perm")
    signed = df.select(F.col(order).alias("o"), signature(T.text_of(text_field), num_perm, ngram).alias("sig"))
    signed = saved(signed, "raw-signatures")
    tables = [signed]
    keys = F.array(*(F.xxhash64(F.lit(b), F.slice("sig", b * rows + 1, rows)) for b in range(bands)))
    signed = saved(signed.select("o", F.xxhash64("sig").alias("same"), keys.alias("keys")), "signatures")
    tables.append(signed)
    nodes = signed.groupBy("same").agg(F.min("o").alias("node"), F.first("keys").alias("keys"))
    member = saved(nodes.select("node", F.explode("keys").alias("band")), "bands")
    tables.append(member)
    shared = member.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("band")
    member = saved(member.join(shared, "band"), "shared-bands")
    tables.append(member)
    state = saved(member.select("node").distinct().withColumn("stays", F.lit(None).cast("boolean")), "state")
    for _ in range(max_rounds):
        open_ = member.join(state, "node")
        # In each band value: the smallest node that stays, and the smallest that is open.
        per = open_.groupBy("band").agg(F.min(F.when(F.col("stays"), F.col("node"))).alias("kept"), F.min(F.when(F.col("stays").isNull(), F.col("node"))).alias("first_open"))
        seen = open_.filter("stays is null").join(per, "band")
        verdict = seen.groupBy("node").agg(F.max(F.coalesce(F.col("kept") < F.col("node"), F.lit(False))).alias("goes"), F.min(F.col("first_open") == F.col("node")).alias("first"))
        decided = verdict.select(F.col("node").alias("of"), F.when(F.col("goes"), False).when(F.col("first"), True).alias("now"))
        before, state = state, saved(state.join(decided, state["node"] == decided["of"], "left").select("node", F.coalesce("stays", "now").alias("stays")), "state")
        unsaved(before)
        if state.filter("stays is null").isEmpty():
            break
    else:
        raise RuntimeError(f"undecided after {max_rounds} rounds")
    tables.append(state)
    verdicts = signed.join(nodes.select("same", "node"), "same").join(state, "node", "left")
    # Only orders of rows that go, each once, are joined to the rows; rows that share an order are decided alike.
    goes = (F.col("o") != F.col("node")) | ~F.coalesce("stays", F.lit(True))
    gone = saved(verdicts.groupBy("o").agg(F.min(goes).alias("goes")).filter("goes").select(F.col("o").alias("__o")), "near-copies")
    unsaved(*tables)
    marked = df.join(_small(gone), df[order] == gone["__o"], "left")
    return marked.select(*df.columns, F.col("__o").isNotNull().alias("is_duplicate"))


def seeded_order(key: str, seed: int = 42) -> list[Column]:
    """An order that looks random and is the same every time."""
    return [F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.col(key)]


def sampled(df: DataFrame, n: int, key: str = "doc_id", seed: int = 42) -> DataFrame:
    return df.orderBy(*seeded_order(key, seed)).limit(n)


def stratified(df: DataFrame, by: str, k: int, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """k rows of each stratum."""
    w = Window.partitionBy(by).orderBy(*seeded_order(key, seed))
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= k).drop("__rank")
