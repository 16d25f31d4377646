"""Statistics of filtering runs as small aggregates, and their renderings."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import signals
from ..functions import text as T
from .rules import Filter


def rule_hits(judged: DataFrame, by: list[str] | None = None, failures: str = "failures") -> DataFrame:
    """(by, filter, rule, failed): rows that each rule fails."""
    keys = by or []
    # explode_outer: a filter on the array would be pushed below it and work out all rules a second time.
    return judged.select(*keys, F.explode_outer(failures).alias("f")).filter("f is not null").groupBy(*keys, F.col("f.filter").alias("filter"), F.col("f.rule").alias("rule")).agg(F.count(F.lit(1)).alias("failed"))


def rule_rates(judged: DataFrame, filters: list[Filter], dataset: str = "dataset", failures: str = "failures") -> DataFrame:
    """(dataset, filter, rule, total, passed, failed, pass_rate) for every rule, failed or not. The rules are few, their number is fixed by the filters."""
    spark = judged.sparkSession
    rules = spark.createDataFrame([(f.name, r.rule) for f in filters for r in f.rules()], "filter string, rule string")
    totals = judged.groupBy(dataset).agg(F.count(F.lit(1)).alias("total"))
    every = totals.join(F.broadcast(rules))
    out = every.join(rule_hits(judged, [dataset], failures), [dataset, "filter", "rule"], "left")
    failed = F.coalesce("failed", F.lit(0))
    return out.select(dataset, "filter", "rule", "total", (F.col("total") - failed).alias("passed"), failed.alias("failed"), T.ratio(F.col("total") - failed, F.col("total")).alias("pass_rate"))


def filter_rates(judged: DataFrame, filters: list[Filter], dataset: str = "dataset", failures: str = "failures") -> DataFrame:
    """(dataset, filter, passed, total, pass_rate), and a row named overall."""
    named = F.transform(failures, lambda f: f["filter"])
    flags = F.array(*(F.struct(F.lit(f.name).alias("filter"), (~F.array_contains(named, f.name)).alias("ok")) for f in filters), F.struct(F.lit("overall").alias("filter"), (F.size(failures) == 0).alias("ok")))
    rows = judged.select(dataset, F.explode(flags).alias("x"))
    return rows.groupBy(dataset, F.col("x.filter").alias("filter")).agg(F.sum(F.col("x.ok").cast("long")).alias("passed"), F.count(F.lit(1)).alias("total"), F.avg(F.col("x.ok").cast("double")).alias("pass_rate"))


def funnel(judged: DataFrame, filters: list[Filter], failures: str = "failures") -> DataFrame:
    """(step, filter, docs_in, docs_out, dropped, drop_rate) of a chain in which the first failing filter drops a row."""
    names = [f.name for f in filters]
    first = F.coalesce(F.array_position(F.array(*map(F.lit, names)), F.get(failures, F.lit(0))["filter"]), F.lit(len(names) + 1))
    n = judged.groupBy(F.when(first > 0, first).otherwise(F.lit(len(names) + 1)).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    steps = judged.sparkSession.createDataFrame([(i, name) for i, name in enumerate(names, 1)], "step int, filter string")
    pairs = F.broadcast(steps).join(n, F.col("at") >= F.col("step"))  # a row for each step and each place where rows end
    docs_in, dropped = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("at") == F.col("step"), F.col("n"))), F.lit(0))
    out = pairs.groupBy("step", "filter").agg(docs_in.alias("docs_in"), dropped.alias("dropped"))
    return out.select("step", "filter", "docs_in", (F.col("docs_in") - F.col("dropped")).alias("docs_out"), "dropped", T.ratio(F.col("dropped"), F.col("docs_in")).alias("drop_rate"))


def samples(judged: DataFrame, order: str = "doc_id", k: int = 5, failures: str = "failures") -> DataFrame:
    """The first k rows that each filter drops first. row_number with a limit below it keeps k rows of a filter in each task before the shuffle."""
    first = F.get(failures, F.lit(0))
    rows = judged.filter(F.size(failures) > 0).select(first["filter"].alias("filter"), first["reason"].alias("reason"), order)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("filter").orderBy(order))).filter(F.col("rank") <= k)


def rule_samples(judged: DataFrame, order: str = "doc_id", k: int = 5, failures: str = "failures") -> DataFrame:
    """(filter, rule, order, rank, value, threshold): the first k rows that each rule fails, whatever else fails them."""
    rows = judged.select(order, F.explode_outer(failures).alias("f")).filter("f is not null").select("f.filter", "f.rule", order, "f.value", "f.threshold")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("filter", "rule").orderBy(order))).filter(F.col("rank") <= k)


def by_failures(hits: DataFrame) -> DataFrame:
    """``rule_hits`` from the rule that fails most rows on; equals by name. Rules are few."""
    return hits.orderBy(F.desc("failed"), "filter", "rule")


def page(df: DataFrame, order: str, offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` by order: what a reader of results looks at, not a way to work through them."""
    return df.orderBy(order).offset(offset).limit(limit)


def dataset_stats(docs: DataFrame, dataset: str = "dataset", text_field: str = "text") -> DataFrame:
    """(dataset, num_docs, avg_word_count, min_word_count, max_word_count, avg_text_length)."""
    t = T.text_of(text_field)
    rows = docs.select(dataset, signals.real_words(t).alias("w"), F.length(t).alias("n"))
    return rows.groupBy(dataset).agg(F.count(F.lit(1)).alias("num_docs"), F.avg("w").alias("avg_word_count"), F.min("w").alias("min_word_count"), F.max("w").alias("max_word_count"), F.avg("n").alias("avg_text_length"))


def verdict(difference: Column) -> Column:
    return F.when(difference >= 0.05, "strong").when(difference >= 0.02, "moderate").otherwise("weak")


def discrimination(rates: DataFrame, dataset: str = "dataset") -> DataFrame:
    """(filter, difference, verdict): greatest less smallest pass rate over datasets; nothing for fewer than two datasets."""
    out = rates.filter("filter <> 'overall'").groupBy("filter").agg((F.max("pass_rate") - F.min("pass_rate")).alias("difference"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return out.select("filter", "difference", verdict(F.col("difference")).alias("verdict"))


def rejections(judged: DataFrame, failures: str = "failures") -> DataFrame:
    """(filter, rule, rejected): by what rejected rows failed first."""
    first = F.get(failures, F.lit(0))
    return judged.filter(F.size(failures) > 0).groupBy(first["filter"].alias("filter"), first["rule"].alias("rule")).agg(F.count(F.lit(1)).alias("rejected"))


def phase_stats(counts: DataFrame) -> DataFrame:
    """counts of (phase, input_count, output_count, ...) with rejected_count and keep_rate."""
    rest = [c for c in counts.columns if c not in ("phase", "input_count", "output_count")]
    return counts.select("phase", "input_count", "output_count", *rest, (F.col("input_count") - F.col("output_count")).alias("rejected_count"), T.ratio(F.col("output_count"), F.col("input_count")).alias("keep_rate"))


def histogram(values: DataFrame, column: str, low: float, high: float, bins: int = 20) -> DataFrame:
    """(bin, n) of a column between two bounds; what lies outside is in bins 0 and bins + 1."""
    return values.select(F.width_bucket(F.col(column).cast("double"), F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def to_json(**tables: DataFrame) -> str:
    """Small tables as one JSON object of row lists."""
    return json.dumps({k: [r.asDict(recursive=True) for r in df.collect()] for k, df in tables.items()}, indent=2, default=str)


def to_markdown(title: str, **tables: DataFrame) -> str:
    out = [f"# {title}"]
    for name, df in tables.items():
        show = lambda v: f"{v:.4f}" if isinstance(v, float) else "" if v is None else str(v).replace("|", "\\|")
        out += ["", f"## {name.replace('_', ' ')}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
        out += ["| " + " | ".join(map(show, r)) + " |" for r in df.collect()]
    return "\n".join(out) + "\n"
