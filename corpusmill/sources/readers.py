"""Readers by format, shard folders, and the registry of sources."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as T


def read_docs(spark: SparkSession, path: str, schema: StructType | str | None = None, limit: int | None = None) -> DataFrame:
    """A file or folder by its suffix: .parquet, .csv (all strings), .jsonl.zst (malformed lines skipped), else JSON lines (malformed ones raise)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    low = path.rstrip("/").lower()
    if low.endswith(".parquet"):
        df = spark.read.parquet(path)
    elif low.endswith(".csv"):
        df = reader.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"').csv(path)
    else:
        df = reader.option("mode", "DROPMALFORMED" if low.endswith(".zst") else "FAILFAST").json(path)
    return df if limit is None else df.limit(limit)


#: Bytes of input for each core under which rows are dealt out anew.
LEAST_BYTES = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """A table so small that its files may have fewer parts than there are cores, dealt out to all cores; any other as it is, so that nothing large is shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * LEAST_BYTES else df


def read_shards(spark: SparkSession, folder: str, schema: StructType | str | None = None) -> DataFrame:
    """All *.jsonl.zst of a folder, else its *.jsonl, with ``shard``, the file's name, which sorts them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [f.getPath().getName() for f in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)]
    glob = "*.jsonl.zst" if any(n.endswith(".jsonl.zst") for n in names) else "*.jsonl"
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("pathGlobFilter", glob).json(folder).withColumn("shard", F.col("_metadata.file_name"))


def read_any(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A file by its suffix, or a folder: of shards if it holds JSON lines, else as Parquet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if path.rstrip("/").lower().endswith((".parquet", ".csv", ".json", ".jsonl", ".zst", ".gz")) or not files.isDirectory(where):
        return read_docs(spark, path, schema)
    names = [f.getPath().getName() for f in files.listStatus(where)]
    return read_shards(spark, path, schema) if any(n.endswith((".jsonl", ".jsonl.zst")) for n in names) else spark.read.parquet(path)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df, which reads files, with ``name``: the place of each row by file and then by place in the file, from 0 on.

    Rows of one split of a file are read in order by one task, so they are numbered there; the splits' counts, one row for each, give what
    comes before. Numbers are unique and don't depend on which task reads what.
    """
    from ..operators.dedup import saved

    rows = saved(df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__row")), "numbered")
    splits = rows.groupBy("__file", "__block").agg(F.min("__row").alias("__low"), F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)  # over splits, not rows
    offsets = splits.select(F.col("__file").alias("__f"), F.col("__block").alias("__b"), (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__low")).alias("__offset"))
    joined = rows.join(offsets, (F.col("__file") == F.col("__f")) & (F.col("__block") == F.col("__b")))
    return joined.withColumn(name, F.col("__offset") + F.col("__row")).select(*df.columns, name)


def numbered_rows(df: DataFrame) -> DataFrame:
    """df with ``__n``, a number of its own for each row; df is written first, so that the numbers stay."""
    from ..operators.dedup import saved

    return saved(df.withColumn("__n", F.monotonically_increasing_id()), "numbered")


def count_lines(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).filter(F.trim("value") != "").count()


@dataclass(frozen=True)
class Source:
    """A way to get documents (id, text, source, metadata). params: declared options and their types."""

    name: str
    read: Callable[..., DataFrame]
    domain: str = "general"
    priority: int = 0
    params: dict[str, type] = field(default_factory=dict)

    def __call__(self, spark: SparkSession, **options) -> DataFrame:
        if unknown := set(options) - set(self.params):
            raise ValueError(f"source {self.name} has no options {sorted(unknown)}")
        return self.read(spark, **{k: self.params[k](v) if v is not None else None for k, v in options.items()})


_SOURCES: dict[str, Source] = {}


def register_source(name: str, **about):
    def add(read: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        _SOURCES[name] = Source(name, read, **about)
        return read

    return add


def get_source(name: str) -> Source:
    if name not in _SOURCES:
        raise ValueError(f"unknown source {name!r}; known: {', '.join(sorted(_SOURCES))}")
    return _SOURCES[name]


def sources(domain: str | None = None) -> list[Source]:
    return sorted((s for s in _SOURCES.values() if domain in (None, s.domain)), key=lambda s: (-s.priority, s.name))


@register_source("local_file", params={"path": str, "text_field": str, "source": str})
def local_file(spark: SparkSession, path: str, text_field: str = "text", source: str = "local_file") -> DataFrame:
    """A file's rows with text, their own id or local_{n} by their place among them, and the other columns as metadata."""
    df = read_docs(spark, path)
    rest = [c for c in df.columns if c not in ("id", "text", "source", "metadata", text_field)]
    rows = df.withColumn("__text", T.text_of(text_field)).filter(F.col("__text") != "")
    rows = numbered(rows, "__n") if "id" not in df.columns else rows
    own = F.col("id").cast("string") if "id" in df.columns else F.concat(F.lit("local_"), F.col("__n").cast("string"))
    meta = F.to_json(F.struct(*rest)) if rest else F.lit("{}")
    return rows.select(own.alias("id"), F.col("__text").alias("text"), F.lit(source).alias("source"), meta.alias("metadata"))


def merged_instruction(df: DataFrame, fields: tuple[str, ...] = ("instruction", "input", "output")) -> Column:
    """Instruction, input and output that aren't blank, one below the other."""
    return F.array_join(F.filter(F.array(*(F.coalesce(F.col(c), F.lit("")) for c in fields if c in df.columns)), lambda x: T.strip(x) != ""), "\n")


# Fields that hold a benchmark item's text, by preference, and that tell instruction data.
BENCHMARK_FIELDS = ("text", "question", "prompt", "content", "input")
SFT_FIELDS = ("instruction", "prompt", "input", "question", "query", "human", "conversations")


def read_benchmark(spark: SparkSession, name: str, path: str) -> DataFrame:
    """(benchmark, text): JSON lines by the first of the known fields, any other file by its lines."""
    if path.endswith((".jsonl", ".json")):
        df = spark.read.json(path)
        there = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in BENCHMARK_FIELDS if c in df.columns]
        text = F.coalesce(*there) if there else F.lit(None).cast("string")
    else:
        df, text = spark.read.text(path), F.col("value")
    return df.select(F.lit(name).alias("benchmark"), text.alias("text")).filter(T.strip(T.text_of("text")) != "")


# Benchmarks known by name, with the dataset, configuration and split that hold them and the field of their texts.
BENCHMARKS = {
    "mmlu": ("cais/mmlu", "all", "test", "question"), "hellaswag": ("Rowan/hellaswag", None, "validation", "ctx"), "arc": ("allenai/ai2_arc", "ARC-Challenge", "test", "question"),
    "truthfulqa": ("truthfulqa/truthful_qa", "multiple_choice", "validation", "question"), "gsm8k": ("openai/gsm8k", "main", "test", "question"), "humaneval": ("openai/openai_humaneval", None, "test", "prompt"),
}


def named_benchmarks(spark: SparkSession, names: list[str], mirror: str | None = None) -> DataFrame:
    """(benchmark, text, ord) of benchmarks given by file or by a known name, in the order given.

    Known names are looked up in ``mirror``, a folder with a copy of each dataset under its own name (``mirror/cais/mmlu/all/test.parquet``,
    without the configuration's folder where there is none), as nothing is fetched from a network.
    """
    out = None
    for k, name in enumerate(names):
        known = BENCHMARKS.get(name.lower())
        if known and mirror:
            data, config, split, column = known
            path = "/".join(x for x in (mirror.rstrip("/"), data, config, f"{split}.parquet") if x)
            df = spark.read.parquet(path).select(F.lit(name.lower()).alias("benchmark"), F.col(column).cast("string").alias("text")).filter(T.strip(T.text_of("text")) != "")
        elif known or "://" not in name and "/" not in name and "." not in name:
            raise ValueError(f"benchmark {name!r} needs a mirror folder; known names: {', '.join(sorted(BENCHMARKS))}; or give a file")
        else:
            df = read_benchmark(spark, name.rstrip("/").rsplit("/", 1)[-1].split(".")[0], name)
        df = df.withColumn("ord", F.lit(k))
        out = df if out is None else out.union(df)
    if out is None:
        raise ValueError("no benchmarks")
    return out


def data_type(df: DataFrame) -> str:
    """sft if over half of ten rows have a field of instruction data, else pretrain. Ten rows are what is looked at, by definition."""
    there = [c for c in SFT_FIELDS if c in df.columns]
    if not there:
        return "pretrain"
    rows = df.select(F.greatest(*(F.col(c).isNotNull().cast("int") for c in there), F.lit(0)).alias("x")).limit(10).collect()
    return "sft" if sum(r.x for r in rows) * 2 > len(rows) else "pretrain"


def arxiv_id(name: Column) -> Column:
    """A paper's id from a member's name: 2401.01234 from new names, hep-th/9901001 from old ones; null for others."""
    base = F.regexp_extract(name, r"([^/]*)$", 1)
    new = F.regexp_extract(base, r"^(\d{4}\.\d{4,5})(?:v\d+)?(?:\.[a-z.]+)?$", 1)
    old = F.regexp_replace(F.regexp_extract(base, r"^([a-z-]+\d{7})(?:v\d+)?(?:\.[a-z.]+)?$", 1), r"^([a-z-]+)(\d{7})$", "$1/$2")
    return F.coalesce(F.nullif(new, F.lit("")), F.nullif(old, F.lit("")))


def arxiv_month(paper: Column) -> Column:
    """YYMM of a paper's id."""
    return F.coalesce(F.nullif(F.regexp_extract(paper, r"^(\d{4})\.", 1), F.lit("")), F.nullif(F.regexp_extract(paper, r"/(\d{4})\d{3}", 1), F.lit("")))


def papers_of(bulk: DataFrame, ids: DataFrame, id_col: str = "arxiv_id") -> DataFrame:
    """Rows of a bulk table partitioned by yymm for the wanted ids: whole partitions are left out where no id is of their month."""
    wanted = ids.select(F.col(id_col)).distinct()
    months = wanted.select(arxiv_month(F.col(id_col)).alias("yymm")).distinct()
    return bulk.join(months, "yymm", "left_semi").join(wanted, id_col, "left_semi")


def tar_members(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(archive, member, body) of every file in the tar archives at a path. One archive is read by one task, its members one at a time.

    Archives on a mounted folder are read from the file as they are unpacked; others come through Spark as one value, of 2 GB at most.
    """
    import io
    import os
    import tarfile

    import pandas as pd

    def members(name: str, file):
        with tarfile.open(fileobj=file, mode="r|*") as tar:
            for m in tar:
                if m.isfile():
                    yield pd.DataFrame({"archive": [name], "member": [m.name], "body": [tar.extractfile(m).read()]})

    def unpack(batches):
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                yield from members(name, io.BytesIO(content))

    def unpack_mounted(batches):
        for batch in batches:
            for name in batch["path"]:
                with open(name.removeprefix("file:").replace("///", "/"), "rb") as f:
                    yield from members(name, f)

    files = spark.read.format("binaryFile").load(path)
    schema = "archive string, member string, body binary"
    first = path if isinstance(path, str) else path[0]
    if os.path.exists(first.removeprefix("file:")) and spark.sparkContext.master.startswith("local["):
        return files.select("path").mapInPandas(unpack_mounted, schema)
    return files.select("path", "content").mapInPandas(unpack, schema)


@register_source("arxiv_tar", domain="papers", priority=5, params={"path": str, "ids": list, "months": list})
def arxiv_tar(spark: SparkSession, path: str, ids: list[str] | None = None, months: list[str] | None = None) -> DataFrame:
    """Papers in tar archives of gzipped sources, by ids or months where given: the text is the merged TeX."""
    from ..operators.extract import merged_source

    rows = tar_members(spark, path).withColumn("paper", arxiv_id(F.col("member"))).filter("paper is not null")
    if ids is not None:
        rows = rows.join(F.broadcast(spark.createDataFrame([(i,) for i in ids], "paper string")), "paper", "left_semi")  # the caller's own list
    elif months is not None:
        rows = rows.filter(arxiv_month(F.col("paper")).isin(*months))
    text = merged_source(F.col("body"))
    return rows.select(F.col("paper").alias("id"), text.alias("text"), F.lit("arxiv_tar").alias("source"), F.to_json(F.struct(F.col("paper").alias("arxiv_id"))).alias("metadata")).filter("text <> ''")


#: Characters that a paper's text has at least.
LEAST_PAPER = 200


def _papers(rows: DataFrame, source: str, ids: list[str] | None, about: DataFrame | None = None) -> DataFrame:
    """rows of (paper, text) as documents, of wanted ids where given, with what ``about`` (arxiv_id, title, categories) says of them, if it does."""
    if ids is not None:
        # The caller's own list; Spark broadcasts it where it is small.
        rows = rows.join(rows.sparkSession.createDataFrame([(i,) for i in ids], "paper string").distinct(), "paper", "left_semi")
    rows = rows.filter(F.length("text") >= LEAST_PAPER)
    heading = F.when(F.startswith("text", F.lit("#")), T.strip(F.regexp_replace(F.regexp_extract("text", r"^([^\n]*)", 1), "^[# ]+", ""))).otherwise("")
    if about is None:
        fields = [F.col("paper").alias("arxiv_id"), heading.alias("title"), F.array().cast("array<string>").alias("categories")]
    else:
        named = about.select(F.col("arxiv_id").alias("__paper"), F.col("title").alias("__title"), F.col("categories").alias("__categories"))
        rows = rows.join(named, F.col("paper") == F.col("__paper"), "left")
        fields = [F.col("paper").alias("arxiv_id"), F.coalesce("__title", heading).alias("title"), F.coalesce("__categories", F.array().cast("array<string>")).alias("categories")]
    return rows.select(F.concat(F.lit("arxiv_"), "paper").alias("id"), "text", F.lit(source).alias("source"), F.to_json(F.struct(*fields)).alias("metadata"))


@register_source("huggingface", priority=100, params={"path": str, "dataset": str, "subset": str, "split": str, "text_field": str, "limit": int})
def huggingface(spark: SparkSession, path: str, dataset: str = "", subset: str | None = None, split: str = "train", text_field: str = "text", limit: int | None = None) -> DataFrame:
    """Rows of a dataset copied to a folder or file, named hf_{n} by their place; other columns of plain types become metadata."""
    df = numbered(read_any(spark, path), "__n")
    if limit is not None:
        df = df.filter(F.col("__n") < limit)
    df = df.filter(T.text_of(text_field) != "")
    plain = [f.name for f in df.schema.fields if f.name not in ("text", "id", "url", "__n", text_field) and f.dataType.simpleString() in ("string", "bigint", "int", "double", "float", "boolean")]
    named = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ("id", "url") if c in df.columns]
    own = F.concat(F.lit("hf_"), F.col("__n").cast("string"))
    about = F.struct(F.lit(dataset or path).alias("dataset"), F.lit(subset).alias("subset"), F.lit(split).alias("split"), F.coalesce(*named, own).alias("original_id"), *plain)
    return df.select(own.alias("id"), F.col(text_field).alias("text"), F.lit(dataset or path).alias("source"), F.to_json(about).alias("metadata"))


def _month_files(spark: SparkSession, path: str, pattern: str, ids: list[str] | None) -> list[str]:
    """Files of a folder named by month, of which those that no wanted id is of are left out: whole files aren't read."""
    import re

    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath() for s in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)]
    found = [(m[1], p.toString()) for p in names if (m := re.search(pattern, p.getName()))]
    if ids is None:
        return [p for _, p in found]
    months = {m[1] for i in ids if (m := re.match(r"(\d{4})\.", i) or re.search(r"/(\d{4})\d{3}$", i))}
    return [p for month, p in found if month in months]


@register_source("arxiv_hf_bulk", domain="papers", priority=300, params={"path": str, "ids": list})
def arxiv_hf_bulk(spark: SparkSession, path: str, ids: list[str]) -> DataFrame:
    """Papers of a folder of {yymm}.jsonl.gz files of (id, text), by ids; ids are those of papers whatever stands before them."""
    files = _month_files(spark, path, r"^(\d{4})\.jsonl(?:\.gz)?$", ids)
    if not files:
        return spark.createDataFrame([], "id string, text string, source string, metadata string")
    rows = spark.read.schema("id string, text string").json(files)
    paper = F.coalesce(F.nullif(F.regexp_extract("id", r"(\d{4}\.\d{4,5})", 1), F.lit("")), arxiv_id(F.col("id")), F.col("id"))
    return _papers(rows.select(paper.alias("paper"), "text"), "ar5iv", ids)


@register_source("arxiv_s3_bulk", domain="papers", priority=200, params={"path": str, "full_archive": bool, "ids": list, "months": list})
def arxiv_s3_bulk(spark: SparkSession, path: str, full_archive: bool = False, ids: list[str] | None = None, months: list[str] | None = None) -> DataFrame:
    """Papers of monthly archives arXiv_src_{yymm}_{nnn}.tar: all of them, else those of the ids, else those of the months. Figures come along as (name, size, bytes)."""
    if not (full_archive or ids or months):
        raise ValueError("one of full_archive, ids and months is needed")
    pattern = r"_(\d{4})_\d+\.tar$"
    wanted = None if full_archive or not ids else ids
    files = _month_files(spark, path, pattern, wanted)
    if not full_archive and not ids:
        files = [f for m in months for f in _month_files(spark, path, rf"_({m})_\d+\.tar$", None)]
    if not files:
        return spark.createDataFrame([], "id string, text string, source string, metadata string, figures array<struct<name:string,size:bigint,bytes:binary>>")
    from ..operators.extract import source_figures, source_text

    rows = tar_members(spark, files).withColumn("paper", arxiv_id(F.col("member"))).filter("paper is not null")
    if wanted is not None:
        rows = rows.join(spark.createDataFrame([(i,) for i in wanted], "paper string").distinct(), "paper", "left_semi")
    rows = rows.select("paper", source_text(F.col("body")).alias("text"), source_figures(F.col("body")).alias("figures"))
    rows = rows.filter(F.length("text") >= LEAST_PAPER)
    about = F.to_json(F.struct(F.col("paper").alias("arxiv_id"), F.lit("latex").alias("format")))
    return rows.select(F.concat(F.lit("arxiv_"), "paper").alias("id"), "text", F.lit("arxiv_s3_bulk").alias("source"), about.alias("metadata"), "figures")


def _saved_pages(spark: SparkSession, path: str) -> DataFrame:
    """(paper, text) of pages saved as files named by their paper, / written as _."""
    rows = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.(?:html?|tex|txt))?$", 1).alias("paper"), F.col("value").alias("text"))
    return rows.withColumn("paper", F.regexp_replace("paper", "^([a-z-]+)_(\\d{7})$", "$1/$2"))


@register_source("arxiv_ar5iv", domain="papers", priority=100, params={"path": str, "ids": list, "about": str})
def arxiv_ar5iv(spark: SparkSession, path: str, ids: list[str] | None = None, about: str | None = None) -> DataFrame:
    """Pages of papers saved to a folder, by ids where given; about: Parquet of (arxiv_id, title, categories)."""
    return _papers(_saved_pages(spark, path), "ar5iv", ids, spark.read.parquet(about) if about else None)


@register_source("arxiv_latexml", domain="papers", priority=150, params={"path": str, "ids": list, "about": str})
def arxiv_latexml(spark: SparkSession, path: str, ids: list[str] | None = None, about: str | None = None) -> DataFrame:
    """TeX sources of papers saved to a folder, by ids where given; about: Parquet of (arxiv_id, title, categories)."""
    return _papers(_saved_pages(spark, path), "arxiv_latexml", ids, spark.read.parquet(about) if about else None)
