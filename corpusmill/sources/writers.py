"""Writers: plain formats, zstd shards with a manifest, and tar archives of samples."""

from __future__ import annotations

import datetime
import hashlib
import json
import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workers import importable

#: Uncompressed bytes of a shard, about.
SHARD_BYTES = 1 << 30


def write_docs(df: DataFrame, path: str) -> None:
    """By suffix: .parquet, .csv, else JSON lines (gzipped where the name ends in .gz). Spark's commit leaves no part of a failed write."""
    low = path.lower()
    if low.endswith(".parquet"):
        df.write.option("compression", "zstd").parquet(path)
    elif low.endswith(".csv"):
        df.write.option("header", True).option("escape", '"').csv(path)
    else:
        df.write.option("compression", "gzip" if low.endswith(".gz") else "none").json(path)


def _line(df: DataFrame) -> Column:
    return F.to_json(F.struct(*df.columns))


def sharded(df: DataFrame, sort_by: str = "id", target: int = SHARD_BYTES, ties: str | None = None) -> DataFrame:
    """(shard, place, line): JSON lines in the order of ``sort_by``, cut where a shard's lines reach the target.

    Lines are ordered by range over the cluster. Their bytes are summed in two levels: partitions first, then the few sums of partitions, so
    that no task sees more than its part. A partition begins in the shard that the bytes before it lead to.
    """
    lines = df.select(F.coalesce(F.col(sort_by).cast("string"), F.lit("")).alias("k"), (F.col(ties) if ties else F.lit(0)).alias("t"), _line(df).alias("line"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = lines.repartitionByRange(n, "k", "t").sortWithinPartitions("k", "t", "line").withColumn("part", F.spark_partition_id()).withColumn("size", F.octet_length("line") + 1)
    from ..operators.dedup import saved

    parts = saved(parts.withColumn("row", F.monotonically_increasing_id()), "lines")
    sums = parts.groupBy("part").agg(F.sum("size").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over partitions, not rows
    offsets = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inner = Window.partitionBy("part").orderBy("row")
    rows = parts.join(offsets, "part").withColumn("upto", F.col("offset") + F.sum("size").over(inner) - F.col("size"))
    return rows.select(F.floor(F.col("upto") / target).cast("int").alias("shard"), F.col("row").alias("place"), "line")


MANIFEST = "path string, num_documents long, bytes long, compressed_bytes long, sha256 string"


def _place_of(folder: str):
    """(file system, path) of a folder: of a URI by its scheme, else of a folder that all executors have mounted."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


class _ShardFile:
    """One shard as it is written: to another name, and renamed when whole, so that a repeated task leaves one file."""

    def __init__(self, folder: str, number: int):
        import uuid

        import zstandard

        self.fs, base = _place_of(folder)
        self.fs.create_dir(base, recursive=True)
        self.name = f"shard-{number:05d}.jsonl.zst"
        self.path, self.part = f"{base}/{self.name}", f"{base}/.{self.name}.{uuid.uuid4().hex}"
        self.raw = self.fs.open_output_stream(self.part, compression=None)
        self.out, self.digest, self.rows, self.size = zstandard.ZstdCompressor(level=3).stream_writer(self.raw, closefd=False), hashlib.sha256(), 0, 0

    def add(self, lines: list[str]) -> None:
        data = "".join(x + "\n" for x in lines).encode()
        self.digest.update(data)
        self.rows, self.size = self.rows + len(lines), self.size + len(data)
        self.out.write(data)

    def done(self) -> tuple:
        self.out.close()
        self.raw.close()
        self.fs.move(self.part, self.path)
        return self.name, self.rows, self.size, self.fs.get_file_info(self.path).size, self.digest.hexdigest()


def write_shards(df: DataFrame, folder: str, sort_by: str = "id", target: int = SHARD_BYTES, ties: str | None = None, version: str = "1.0") -> DataFrame:
    """Writes shard-NNNNN.jsonl.zst files (level 3) and manifest.json to a folder: a URI, or one that all executors have mounted. Returns the manifest's rows.

    Each shard is written by one task, which sees its lines in order, a batch at a time.
    """
    rows = sharded(df, sort_by, target, ties)
    importable()

    def write(batches):
        file, number, found = None, None, []
        for batch in batches:
            shards, lines = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            low = 0
            while low < len(shards):
                high = low
                while high < len(shards) and shards[high] == shards[low]:
                    high += 1
                if shards[low] != number:
                    if file:
                        found.append(file.done())
                    number = shards[low]
                    file = _ShardFile(folder, number)
                file.add(lines[low:high])
                low = high
        if file:
            found.append(file.done())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found, strict=True)], ["path", "num_documents", "bytes", "compressed_bytes", "sha256"])

    from ..operators.dedup import saved

    dealt = rows.repartition("shard").sortWithinPartitions("shard", "place").select("shard", "line")
    found = saved(dealt.mapInArrow(write, MANIFEST), "manifest")
    write_manifest(found, folder, version)
    return found


def manifest(shards: DataFrame, version: str = "1.0") -> dict:
    """The manifest of written shards; its rows are one for each file."""
    rows = [r.asDict() for r in shards.orderBy("path").collect()]
    return {
        "version": version, "created_at": datetime.datetime.now(datetime.timezone.utc).isoformat(), "num_shards": len(rows), "total_documents": sum(r["num_documents"] for r in rows),
        "shards": [{k: r[k] for k in ("path", "num_documents", "compressed_bytes", "sha256")} for r in rows],
    }


def write_manifest(shards: DataFrame, folder: str, version: str = "1.0") -> None:
    fs, base = _place_of(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/manifest.json", compression=None) as f:
        f.write(json.dumps(manifest(shards, version), indent=2).encode())


def write_webdataset(df: DataFrame, folder: str, per_tar: int = 1000, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Tar archives of per_tar samples each: key.txt, key.json with the other fields, key.fig_NN.ext for figures with bytes; / in a key becomes _.

    Samples are numbered in the order of their ids by the places of ``sharded`` lines, two levels of counts, not one ordered task.
    """
    from ..operators.dedup import saved

    importable()
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = saved(df.repartitionByRange(n, id_col).sortWithinPartitions(id_col).withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id()), "samples")
    counts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__offset"))
    place = F.col("__offset") + F.row_number().over(Window.partitionBy("__part").orderBy("__row")) - 1
    rows = rows.join(offsets, "__part").withColumn("__tar", F.floor(place / per_tar))
    figures = "figures" in df.columns
    rest = [c for c in df.columns if c not in (text_col, "figures")]
    packed = rows.select("__tar", "__row", F.replace(F.col(id_col).cast("string"), F.lit("/"), F.lit("_")).alias("key"), F.col(text_col).alias("text"), F.to_json(F.struct(*rest)).alias("meta"), *(["figures"] if figures else []))

    def write(key, pdf):
        import io
        import tarfile
        import uuid

        import pandas as pd

        fs, base = _place_of(folder)
        fs.create_dir(base, recursive=True)
        name = f"shard-{int(key[0]):05d}.tar"
        tmp = f"{base}/.{name}.{uuid.uuid4().hex}"
        with fs.open_output_stream(tmp, compression=None) as raw, tarfile.open(fileobj=raw, mode="w|") as tar:
            def add(member: str, data: bytes) -> None:
                info = tarfile.TarInfo(member)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))

            for r in pdf.sort_values("__row").to_dict("records"):
                add(f"{r['key']}.txt", (r["text"] or "").encode())
                add(f"{r['key']}.json", r["meta"].encode())
                figs = r.get("figures")
                for i, fig in enumerate([] if figs is None else figs):
                    if fig["bytes"] is not None:
                        add(f"{r['key']}.fig_{i:02d}{os.path.splitext(fig['name'] or '')[1] or '.bin'}", fig["bytes"])
        fs.move(tmp, f"{base}/{name}")
        return pd.DataFrame([[name, len(pdf)]], columns=["path", "num_documents"])

    return saved(packed.groupBy("__tar").applyInPandas(write, "path string, num_documents long"), "tars")
