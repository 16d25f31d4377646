"""Command line: ``python -m corpusmill.cli bench|run|ingest|serve``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import server
from .operators import contamination, dedup, report, rules
from .plans import pipeline
from .sources import readers, writers


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="corpusmill")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="all stages of a pipeline, or one")
    run.add_argument("input")
    run.add_argument("-o", "--output", required=True)
    run.add_argument("-c", "--config", required=True)
    run.add_argument("-n", "--limit", type=int)
    run.add_argument("--stage", choices=pipeline.STAGES, help="this stage alone, from what those before it have left")
    run.add_argument("--dry-run", action="store_true", help="only how many documents each filter drops")
    bench = sub.add_parser("bench", help="pass rates of datasets")
    bench.add_argument("input", nargs="+")
    bench.add_argument("-c", "--config")
    bench.add_argument("-n", "--samples", type=int, help="documents of each dataset, drawn by the seed (all)")
    bench.add_argument("--seed", type=int, default=42)
    bench.add_argument("--data-type", choices=("auto", "sft", "pretrain"), default="auto", help="what the datasets are, for the rules where no configuration is given")
    bench.add_argument("--text-field", default=None)
    bench.add_argument("--dedup", action="store_true", help="near-duplicates are counted too")
    bench.add_argument("--save-rejected", metavar="PATH", help="rejected documents with their failures")
    bench.add_argument("-o", "--output")
    ingest = sub.add_parser("ingest", help="documents of a registered source")
    ingest.add_argument("source")
    ingest.add_argument("-o", "--output", required=True)
    ingest.add_argument("-p", "--param", action="append", default=[], metavar="NAME=VALUE", help="lists are separated by commas")
    serve = sub.add_parser("serve", help="the HTTP service over an output folder")
    serve.add_argument("-o", "--output", required=True)
    serve.add_argument("-c", "--config", required=True)
    serve.add_argument("--host", default="127.0.0.1")
    serve.add_argument("--port", type=int, default=8000)
    for p in (run, bench):
        p.add_argument("--check-contamination", metavar="NAMES", help="benchmarks by name or file, separated by commas, or all known ones")
        p.add_argument("--mirror", help="folder with copies of the known benchmarks' datasets")
    return parser


def _benchmarks(spark: SparkSession, names: str | None, mirror: str | None) -> DataFrame | None:
    if not names:
        return None
    return readers.named_benchmarks(spark, sorted(readers.BENCHMARKS) if names == "all" else [n.strip() for n in names.split(",") if n.strip()], mirror)


def _datasets(spark: SparkSession, paths: list[str], samples: int | None, seed: int) -> dict[str, DataFrame]:
    out = {}
    for path in paths:
        df = readers.read_any(spark, path)
        if samples:
            df = dedup.sampled(readers.numbered(df, "__n"), samples, "__n", seed).drop("__n")
        out[path.rstrip("/").rsplit("/", 1)[-1]] = df
    return out


def _bench(spark: SparkSession, a: argparse.Namespace) -> str:
    datasets = _datasets(spark, a.input, a.samples, a.seed)
    kind = a.data_type if a.data_type != "auto" else readers.data_type(next(iter(datasets.values())))
    config = pipeline.PipelineConfig.from_yaml(a.config) if a.config else pipeline.PipelineConfig.default(kind)
    config.text_field = a.text_field or config.text_field
    tables = pipeline.benchmark(datasets, config, near_duplicates=a.dedup)
    if a.save_rejected:
        writers.write_docs(rules.rejected(tables.pop("judged")).withColumn("failures", F.to_json("failures")), a.save_rejected)
    tables.pop("judged", None)
    text = report.to_json(**tables) if (a.output or "").endswith(".json") else report.to_markdown(f"Benchmark ({kind})", **tables)
    benchmarks = _benchmarks(spark, a.check_contamination, a.mirror)
    if benchmarks is not None:
        scans = [contamination.scan_report(readers.numbered_rows(df), benchmarks, name, key="__n", text_field=config.text_field) for name, df in datasets.items()]
        text = json.dumps({**json.loads(text), "contamination": scans}, indent=2, default=str) if (a.output or "").endswith(".json") else "\n".join([text, *map(contamination.report_markdown, scans)])
    return text


def main(args: list[str] | None = None) -> int:
    a = _parser().parse_args(args)
    spark = SparkSession.builder.appName("corpusmill").getOrCreate()
    if a.command == "ingest":
        source = readers.get_source(a.source)
        given = dict(p.split("=", 1) for p in a.param)
        writers.write_docs(source(spark, **{k: v.split(",") if source.params.get(k) is list else v for k, v in given.items()}), a.output)
        return 0
    if a.command == "serve":
        server.served(server.Service(spark, a.output, a.config), a.host, a.port).serve_forever()
    if a.command == "run":
        config = pipeline.PipelineConfig.from_yaml(a.config)
        if a.dry_run:
            pipeline.Pipeline(config).dry_run(readers.read_any(spark, a.input)).show(truncate=False)
            return 0
        engine, benchmarks = pipeline.Engine(spark, config, a.output), _benchmarks(spark, a.check_contamination, a.mirror)
        engine.run_all(a.input, a.limit, benchmarks, a.stage).show(truncate=False)
        return 0
    text = _bench(spark, a)
    if a.output:
        with open(a.output, "w", encoding="utf-8") as f:
            f.write(text)
    else:
        print(text)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
