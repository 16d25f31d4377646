"""Overlap of documents with benchmarks by word n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: n-grams of benchmarks up to which they are sent to every executor; more are shuffled.
BROADCAST_GRAMS = 2_000_000


def grams(df: DataFrame, keys: list[str], text: Column, n: int) -> DataFrame:
    """(keys, gram): hashes of the distinct n-grams of each row, of the hashes of their words; each word is hashed once. A row without an n-gram has one null."""
    words = F.transform(T.plain_words(T.benchmark_normal(text)), lambda w: F.xxhash64(w))
    rows = df.select(*keys, words.alias("w"))
    per = F.when(F.size("w") >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.xxhash64(F.slice("w", i, F.lit(n))))))
    # explode_outer: no filter on the array is inferred that would make it anew for every gram.
    return rows.select(*keys, per.alias("g")).select(*keys, F.explode_outer("g").alias("gram"))


def _matched(docs: DataFrame, benchmarks: DataFrame, n: int, key: str, text_field: str, name: str) -> DataFrame:
    """(key, benchmark, grams, hits, k): for each document a row per benchmark that it shares n-grams with, k of them, and one of null for the rest.

    The documents' n-grams are made and joined once. An n-gram that several benchmarks have counts once in grams and hits, with the first.
    """
    index = grams(benchmarks, [name], T.text_of("text"), n).filter("gram is not null").groupBy("gram").agg(F.sort_array(F.collect_set(name)).alias("names"))
    few = index.limit(BROADCAST_GRAMS + 1).count() <= BROADCAST_GRAMS
    own = grams(docs, [key], T.text_of(text_field), n)
    rows = own.join(F.broadcast(index) if few else index, "gram", "left").select(key, "gram", F.posexplode_outer("names").alias("place", "benchmark"))
    once = F.col("gram").isNotNull() & (F.coalesce("place", F.lit(0)) == 0)
    return rows.groupBy(key, "benchmark").agg(F.count_if(once).alias("grams"), F.count_if(once & F.col("benchmark").isNotNull()).alias("hits"), F.count("benchmark").alias("k"))


def overlaps(docs: DataFrame, benchmarks: DataFrame, n: int = 13, key: str = "doc_id", text_field: str = "text", name: str = "benchmark") -> DataFrame:
    """(key, benchmark, hits, total, overlap) for every document and benchmark that share an n-gram. benchmarks: (name, text)."""
    per = _matched(docs, benchmarks, n, key, text_field, name)
    lists = F.collect_list(F.when(F.col("benchmark").isNotNull(), F.struct("benchmark", "k")))  # as many as there are benchmarks
    rows = per.groupBy(key).agg(F.sum("grams").alias("total"), lists.alias("found")).select(key, "total", F.explode("found").alias("f"))
    return rows.select(key, F.col("f.benchmark").alias(name), F.col("f.k").alias("hits"), "total", (F.col("f.k") / F.col("total")).alias("overlap"))


def checked(docs: DataFrame, benchmarks: DataFrame, n: int = 13, threshold: float = 0.8, key: str = "doc_id", text_field: str = "text", name: str = "benchmark") -> DataFrame:
    """(key, overlap, benchmark, contaminated) of every document: its distinct n-grams found in any benchmark, and the benchmark that has most.

    Of benchmarks that have as many, the first counts: by ``ord`` where benchmarks have such a column, as the order of their registration is, else by name.
    """
    per = _matched(docs, benchmarks, n, key, text_field, name)
    ranked = "ord" in benchmarks.columns
    if ranked:
        order = benchmarks.groupBy(F.col(name).alias("benchmark")).agg(F.min("ord").alias("ord"))
        per = per.join(order, "benchmark", "left")
    first = F.struct((-F.col("k")).alias("k"), *([F.col("ord")] if ranked else []), F.col("benchmark"))
    out = per.groupBy(key).agg(F.sum("grams").alias("total"), F.sum("hits").alias("hits"), F.min(F.when(F.col("benchmark").isNotNull(), first)).alias("best"))
    overlap = T.ratio(F.col("hits"), F.col("total"))
    return out.select(key, overlap.alias("overlap"), F.coalesce("best.benchmark", F.lit("")).alias("benchmark"), ((F.col("total") > 0) & (overlap >= threshold)).alias("contaminated"))


def scanned(docs: DataFrame, benchmarks: DataFrame, n: int = 13, threshold: float = 0.8, key: str = "doc_id", text_field: str = "text", name: str = "benchmark") -> DataFrame:
    """One row for each benchmark: documents with text, contaminated ones, their rate and the mean overlap."""
    full = docs.filter(T.strip(T.text_of(text_field)) != "")
    pairs = overlaps(full, benchmarks, n, key, text_field, name)
    total = full.agg(F.count(F.lit(1)).alias("total_docs"))
    names = benchmarks.select(name).distinct()
    per = pairs.groupBy(name).agg(F.sum((F.col("overlap") >= threshold).cast("long")).alias("c"), F.sum("overlap").alias("s"))
    out = names.join(per, name, "left").join(F.broadcast(total))  # the total is one row
    c = F.coalesce("c", F.lit(0))
    return out.select(name, "total_docs", c.alias("contaminated_docs"), T.ratio(c, F.col("total_docs")).alias("contamination_rate"), T.ratio(F.coalesce("s", F.lit(0.0)), F.col("total_docs")).alias("avg_overlap"))


def split(docs: DataFrame, benchmarks: DataFrame, key: str = "doc_id", **options) -> tuple[DataFrame, DataFrame]:
    """(clean, contaminated) documents; the latter with a rule named after the benchmark."""
    bad = checked(docs, benchmarks, key=key, **options).filter("contaminated").select(key, F.concat(F.lit("contaminated_"), "benchmark").alias("rule"))
    return docs.join(bad, key, "left_anti"), docs.join(bad, key)


def scan_report(docs: DataFrame, benchmarks: DataFrame, dataset: str = "", n: int = 13, threshold: float = 0.8, key: str = "doc_id", text_field: str = "text", name: str = "benchmark", k: int = 10) -> dict:
    """The whole scan: documents with text, those contaminated by any benchmark, statistics of each benchmark, and the first k contaminated documents by key."""
    full = docs.filter(T.strip(T.text_of(text_field)) != "")
    verdict = checked(full, benchmarks, n, threshold, key, text_field, name)
    total, bad = verdict.agg(F.count(F.lit(1)), F.count_if("contaminated")).first()
    some = verdict.filter("contaminated").orderBy(key).limit(k)  # a report of the first k, by definition
    texts = full.select(key, F.substring(text_field, 1, 200).alias("text"))
    samples = [{"text": r["text"], "overlap_ratio": r["overlap"], "matched_benchmark": r["benchmark"]} for r in some.join(texts, key).orderBy(key).collect()]
    per = {r[name]: {"benchmark_name": r[name], **{c: r[c] for c in ("total_docs", "contaminated_docs", "contamination_rate", "avg_overlap")}} for r in scanned(docs, benchmarks, n, threshold, key, text_field, name).orderBy(name).collect()}
    return {"dataset_name": dataset, "method": "ngram", "total_docs": total, "contaminated_docs": bad, "contamination_rate": bad / total if total else 0.0, "per_benchmark": per, "sample_contaminated": samples}


def report_markdown(scan: dict) -> str:
    rows = [f"| {b['benchmark_name']} | {b['total_docs']} | {b['contaminated_docs']} | {b['contamination_rate']:.2%} | {b['avg_overlap']:.4f} |" for b in scan["per_benchmark"].values()]
    head = [f"# Contamination Report: {scan['dataset_name']}", "", f"**Method**: {scan['method']}", f"**Total documents**: {scan['total_docs']}", f"**Contaminated documents**: {scan['contaminated_docs']}", f"**Contamination rate**: {scan['contamination_rate']:.2%}", ""]
    table = ["## Per-Benchmark Results", "", "| Benchmark | Docs Checked | Contaminated | Rate | Avg Overlap |", "|-----------|-------------|--------------|------|-------------|", *rows, ""] if rows else []
    said = [f"{i}. **{s['matched_benchmark'] or 'unknown'}** (overlap={s['overlap_ratio']:.2%})\n   > {' '.join((s['text'] or '')[:150].splitlines())}...\n" for i, s in enumerate(scan["sample_contaminated"], 1)]
    return "\n".join([*head, *table, *(["## Sample Contaminated Documents", "", *said] if said else [])])
