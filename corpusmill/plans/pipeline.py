"""Pipelines from YAML: filters, dedup, contamination, packaging, with stages that can be resumed."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contamination, dedup, extract, report, rules
from ..sources import readers, writers


@dataclass
class FilterConfig:
    name: str
    enabled: bool = True
    params: dict = field(default_factory=dict)


@dataclass
class DedupConfig:
    exact: bool = True
    minhash: bool = False
    version_key: str | None = None
    num_perm: int = 112
    bands: int = 14
    rows: int = 8
    ngram_size: int = 5


@dataclass
class PipelineConfig:
    """The YAML's ``pipeline`` part; ``extra`` holds the other top-level parts."""

    text_field: str = "text"
    filters: list[FilterConfig] = field(default_factory=list)
    dedup: DedupConfig = field(default_factory=DedupConfig)
    extra: dict = field(default_factory=dict)

    @classmethod
    def from_dict(cls, raw: dict) -> PipelineConfig:
        p = raw.get("pipeline", raw) or {}
        filters = []
        for f in p.get("filters", []):
            f = dict(f)
            name, enabled, params = f.pop("name"), f.pop("enabled", True), dict(f.pop("params", None) or {})  # other keys are options too
            filters.append(FilterConfig(name, enabled, params | f))
        d = p.get("dedup") or {}
        phase = raw.get("phase3") or {}
        of = lambda name: v if isinstance(v := d.get(name), dict) else {} if v is None else {"enabled": bool(v)}
        h = of("minhash")
        found = DedupConfig(bool(of("exact").get("enabled", True)), bool(h.get("enabled", False)), d.get("version_key") or ("arxiv_id" if phase.get("version_dedup") else None), *(h.get(k, v) for k, v in (("num_perm", 112), ("bands", 14), ("rows", 8), ("ngram_size", 5))))
        return cls(p.get("text_field", "text"), filters, found, {k: v for k, v in raw.items() if k != "pipeline"})

    @classmethod
    def default(cls, kind: str = "pretrain") -> PipelineConfig:
        """The usual filters for texts, or the rules for instruction data."""
        names = ("sft_rules",) if kind == "sft" else ("gopher_quality", "gopher_repetition", "c4", "fineweb", "pii")
        return cls(filters=[FilterConfig(n, params={"mode": "redact"} if n == "pii" else {}) for n in names])

    @classmethod
    def from_yaml(cls, path: str) -> PipelineConfig:
        with open(path, encoding="utf-8") as f:
            return cls.from_dict(yaml.safe_load(f) or {})

    def key(self) -> str:
        return hashlib.sha256(json.dumps(self, default=lambda o: o.__dict__, sort_keys=True).encode()).hexdigest()[:12]

    def chain(self) -> list[rules.Filter]:
        return [rules.make_filter(f.name, text_field=self.text_field, **f.params) for f in self.filters if f.enabled]


class Pipeline:
    """``run``: rows that pass all filters, texts rewritten; ``dry_run``: only how many each filter drops."""

    def __init__(self, config: PipelineConfig):
        self.config, self.filters = config, config.chain()

    def judged(self, docs: DataFrame, mutate: bool = True) -> DataFrame:
        return rules.verdicts(docs, self.filters, mutate)

    def run(self, docs: DataFrame) -> DataFrame:
        return rules.kept(self.judged(docs))

    def dry_run(self, docs: DataFrame) -> DataFrame:
        return report.funnel(rules.verdicts(docs, self.filters, mutate=True, first_only=True), self.filters)


STAGES = ("ingest", "extract", "curate", "package")
#: The column that numbers ingested rows; packages leave it out.
POSITION = "_position"


class Engine:
    """Stages over folders of Parquet files. A stage whose folder was finished with this configuration is left out when run again.

    Spark's commit writes _SUCCESS once a folder is whole; the folder's name holds the configuration's key, so a changed one begins anew.
    """

    def __init__(self, spark: SparkSession, config: PipelineConfig, output: str, order: str = "id", judge: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None):
        """judge: from documents to those that stay and those that go, as ``judge.split`` and ``models.split`` make them; it comes last, being dear."""
        self.spark, self.config, self.output, self.order, self.judge = spark, config, output.rstrip("/"), order, judge
        self.seconds: dict[str, float] = {}

    def folder(self, stage: str, kind: str = "kept") -> str:
        return f"{self.output}/{stage}-{self.config.key()}/{kind}"

    def _exists(self, path: str) -> bool:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)

    def done(self, stage: str) -> bool:
        return self._exists(f"{self.folder(stage)}/_SUCCESS")

    def rows(self, stage: str, kind: str = "kept") -> DataFrame:
        return self.spark.read.parquet(self.folder(stage, kind))

    def _put(self, df: DataFrame, stage: str, kind: str) -> None:
        df.write.mode("overwrite").parquet(self.folder(stage, kind))

    def ingest(self, path: str, limit: int | None = None) -> None:
        """Reads a file, or a folder of shards, and numbers the rows by file and place as ``POSITION``, so that copies and rows without ids are told apart.

        Rows without an id are named by their number. A limit takes the first rows by number.
        """
        df = readers.read_any(self.spark, path)
        df = readers.numbered(df, POSITION)
        if limit is not None:
            df = df.filter(F.col(POSITION) < limit)
        if self.order not in df.columns:
            df = df.withColumn(self.order, F.concat(F.lit("doc_"), F.lpad(F.col(POSITION).cast("string"), 12, "0")))
        self._put(df, "ingest", "kept")

    def extract(self) -> None:
        out = extract.extracted(self.rows("ingest"), self.config.text_field)
        self._put(out.filter("reject is not null"), "extract", "rejected")
        self._put(out.filter("reject is null").drop("reject", "error"), "extract", "kept")

    def curate(self, benchmarks: DataFrame | None = None) -> None:
        text, d = self.config.text_field, self.config.dedup
        judged = rules.verdicts(self.rows("extract"), self.config.chain())
        self._put(judged, "curate", "judged")
        judged = self.rows("curate", "judged")
        self._put(rules.rejected(judged), "curate", "rejected")
        kept = rules.kept(judged)
        if d.version_key:
            version = F.col("version") if "version" in kept.columns else F.lit(None).cast("string")
            marked = dedup.latest_version(kept, F.coalesce(F.col(d.version_key).cast("string"), F.col(self.order).cast("string")), version, POSITION)
            self._put(marked.filter("not is_latest").drop("is_latest"), "curate", "older")
            kept = marked.filter("is_latest").drop("is_latest")
        if d.exact:
            kept = dedup.first_rows(kept, POSITION, text)
        if d.minhash:
            kept = dedup.minhash(kept, POSITION, text, d.num_perm, d.bands, d.rows, d.ngram_size).filter("not is_duplicate").drop("is_duplicate")
        if benchmarks is not None:
            options = self.config.extra.get("phase4", {}).get("contamination", {}) if isinstance(self.config.extra.get("phase4"), dict) else {}
            options = {k: options[o] for k, o in (("n", "ngram_size"), ("threshold", "threshold")) if o in options}
            kept, bad = contamination.split(kept, benchmarks, key=POSITION, text_field=text, **options)
            self._put(bad, "curate", "contaminated")
        if self.judge is not None:
            kept, bad = self.judge(kept)
            self._put(bad, "curate", "low_quality")
        self._put(kept, "curate", "kept")

    def package(self, target: int = writers.SHARD_BYTES, version: str | None = None) -> dict:
        """Shards or sample archives of what curation kept, as the configuration's ``packaging`` says, by its ``phase5.sort_by``."""
        options, extra = self.config.extra.get("packaging") or {}, self.config.extra
        rows = self.rows("curate").drop(POSITION)
        by = (extra.get("phase5") or {}).get("sort_by", self.order)
        version = version or str(extra.get("version", "1.0"))
        if options.get("format", "jsonl_zst") == "webdataset":
            found = writers.write_webdataset(rows, self.folder("package"), int(options.get("samples_per_shard", 1000)), by if by in rows.columns else self.order, self.config.text_field)
            out = {"format": "webdataset", "num_shards": found.count(), "total_documents": found.agg(F.coalesce(F.sum("num_documents"), F.lit(0))).first()[0]}
        else:
            out = writers.manifest(writers.write_shards(rows, self.folder("package"), by, target, version=version), version)
        with_success = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder('package')}/_SUCCESS")
        with_success.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(with_success, True).close()
        return out

    def overview(self) -> DataFrame:
        """(phase, input_count, output_count, seconds, rejected_count, keep_rate) of the finished stages; seconds are null for stages of an earlier run."""
        rows, before = [], None
        for stage in ("ingest", "extract", "curate"):
            if self.done(stage):
                n = self.rows(stage).count()
                rows.append((stage, before if before is not None else n, n, self.seconds.get(stage)))
                before = n
        return report.phase_stats(self.spark.createDataFrame(rows, "phase string, input_count long, output_count long, seconds double"))

    def rejections(self) -> DataFrame:
        """What curation rejected rows by, filters by their rules and the later steps by theirs."""
        out = report.rejections(self.rows("curate", "rejected")).withColumn("step", F.lit("filters"))
        for kind in ("contaminated", "low_quality"):
            if self._exists(f"{self.folder('curate', kind)}/_SUCCESS"):
                rows = self.rows("curate", kind).groupBy("rule").agg(F.count(F.lit(1)).alias("rejected"))
                out = out.unionByName(rows.select(F.lit(kind).alias("filter"), "rule", "rejected", F.lit(kind).alias("step")))
        return out

    def run_all(self, path: str, limit: int | None = None, benchmarks: DataFrame | None = None, only: str | None = None) -> DataFrame:
        """All stages that aren't done, or ``only`` one, and the overview."""
        for stage, step in (("ingest", lambda: self.ingest(path, limit)), ("extract", self.extract), ("curate", lambda: self.curate(benchmarks)), ("package", self.package)):
            if only in (None, stage) and not self.done(stage):
                began = time.monotonic()
                step()
                self.seconds[stage] = time.monotonic() - began
        return self.overview()


def benchmark(datasets: dict[str, DataFrame], config: PipelineConfig, near_duplicates: bool = False) -> dict[str, DataFrame]:
    """Rule and filter pass rates, statistics and discrimination of named datasets under one chain; all rules are asked of every row.

    ``judged`` are the rows themselves, with their dataset and failures. With ``near_duplicates``, the share of near-duplicates is counted over
    all datasets together.
    """
    every = None
    for name, df in datasets.items():
        df = df.withColumn("dataset", F.lit(name))
        every = df if every is None else every.unionByName(df, allowMissingColumns=True)
    chain = config.chain()
    judged = dedup.saved(rules.verdicts(every, chain), "judged")
    rates, text = report.filter_rates(judged, chain), config.text_field if config.text_field in judged.columns else None
    out = {"judged": judged, "rules": report.rule_rates(judged, chain), "filters": rates, "discrimination": report.discrimination(rates), "samples": report.samples(judged, order="dataset")}
    if text:
        out |= {"datasets": report.dataset_stats(judged, text_field=text), "duplicates": dedup.exact_stats(judged, text)}
        if near_duplicates:
            d = config.dedup
            marked = dedup.minhash(readers.numbered_rows(judged), "__n", text, d.num_perm, d.bands, d.rows, d.ngram_size)
            out["near_duplicates"] = marked.agg(F.count(F.lit(1)).alias("total_docs"), F.count_if("is_duplicate").alias("duplicate_docs"))
    return out
