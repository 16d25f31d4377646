"""URL filters: rules for hosts and paths, and gradient-boosted trees on lexical features for what no rule decides.

Everything is a DataFrame expression. The trees are grown level by level from histograms: one aggregation gives, for each open node,
feature and bin, the sums of gradients and curvatures over the sample, and only these sums reach the driver. A finished model is a sum
of conditional expressions over the features, so that scoring is a projection.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import scratch, staged

#: Rules up to which they become one conditional expression; more are joined by the suffixes of hosts.
INLINE_RULES = 256
#: Rows that the trees are fitted on, at most: those of smallest digest, copies of a URL having their own.
SAMPLE_ROWS = 20_000
#: Copies of a URL that are numbered at a time.
COPIES = 1000
#: Values of the leading part of a digest.
DIGESTS = 1 << 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host/path`` with what becomes of URLs that it fits."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased. Path: from there up to ?, # or the end. Without ://, both empty."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _matched_inline(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    host, path = F.col("host"), F.col("path")
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found, verdict = F.when(fits, F.lit(r.text)).otherwise(found), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return urls.withColumns({"rule": found, "rule_verdict": verdict})


def _matched_joined(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """One equi-join on the suffixes of distinct hosts; the longest rule comes from an aggregate per host and path."""
    table = urls.sparkSession.createDataFrame([(r.host, r.path, r.text, r.verdict) for r in rules], "suffix string, rule_path string, rule string, rule_verdict string")
    labels = F.split("host", r"\.")
    places = F.sequence(F.lit(1), F.size(labels))
    pairs = urls.select("host", "path").distinct().withColumn("suffix", F.explode(F.transform(places, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))))
    fits = pairs.join(table, "suffix").filter(F.col("path").startswith(F.col("rule_path")))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "rule_verdict")).alias("best"))
    return urls.join(best, ["host", "path"], "left").select(*urls.columns, F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("rule_verdict"))


def matched(urls: DataFrame, rules: list[Rule], inline: int = INLINE_RULES) -> DataFrame:
    """urls of (host, path, ...) with ``rule`` and ``rule_verdict``: of the rules that fit, the longest."""
    return _matched_inline(urls, rules) if len(rules) <= inline else _matched_joined(urls, rules)


def _entropy(text: Column) -> Column:
    """Bits a character, from the counts of the characters."""
    n = F.length(text).cast("double")
    kinds = F.array_distinct(F.split(text, ""))
    # log2(n) - sum(c log2 c) / n
    total = F.aggregate(
        F.filter(kinds, lambda c: c != ""), F.lit(0.0),
        lambda acc, c: acc + F.when(n > 0, (n - F.length(F.replace(text, c, F.lit("")))) * F.log2(n - F.length(F.replace(text, c, F.lit(""))))).otherwise(0.0),
    )
    return F.when(n > 0, F.log2(n) - total / n).otherwise(F.lit(0.0))


#: Names of the lexical features, in order; the last two come from all labelled URLs of a host's last label.
FEATURES = ("length", "host_length", "depth", "digit_ratio", "entropy", "parameters", "host_labels", "host_hyphens", "suffix_rate", "suffix_share")


def _lexical(rows: DataFrame) -> DataFrame:
    """rows of (url, host, path, ...) with the features that need only the URL, and the suffix."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    n = F.length(url).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return rows.withColumns({
        "length": n, "host_length": F.length(host).cast("double"), "depth": F.regexp_count(path, F.lit("/[^/]")).cast("double"),
        "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(n, F.lit(1.0)), "entropy": _entropy(url),
        "parameters": F.when(query == "", 0.0).otherwise(F.regexp_count(query, F.lit("&")) + 1.0),
        "host_labels": F.regexp_count(host, F.lit(r"[^.]+")).cast("double"), "host_hyphens": F.regexp_count(host, F.lit("-")).cast("double"),
        "suffix": F.regexp_extract(host, r"[^.]*$", 0),
    })


@dataclass(frozen=True)
class Suffixes:
    """Statistics of the last labels of hosts over all labelled URLs; ``mean`` is the share of URLs to block, which unseen labels get."""

    table: DataFrame
    rows: int
    mean: float

    def joined(self, df: DataFrame) -> DataFrame:
        rate, share = F.coalesce("suffix_rate", F.lit(self.mean)), F.coalesce("suffix_share", F.lit(0.0))
        return df.join(self.table, "suffix", "left").withColumns({"suffix_rate": rate, "suffix_share": share})


def suffix_statistics(labelled: DataFrame, prior: float = 20.0) -> Suffixes:
    """(suffix, suffix_rate, suffix_share): how often URLs of a last host label are blocked, drawn to the mean of all, and how common they are; over all rows."""
    per = staged(labelled.groupBy("suffix").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("blocked")), "suffixes")
    n, blocked = per.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0.0))).first()
    mean = blocked / n if n else 0.5
    table = per.select("suffix", ((F.col("blocked") + prior * mean) / (F.col("n") + prior)).alias("suffix_rate"), (F.col("n") / F.lit(float(max(n, 1)))).alias("suffix_share"))
    return Suffixes(table, n, mean)


def sampled(known: DataFrame, rows: int, n: int) -> DataFrame:
    """Of the n rows of known (url, host, path, y) those of smallest digest of the URL and the number of the copy, so that each row has the same chance.

    A bound on the digest, which follows from n, leaves little more than the sample before it is sorted.
    """
    per = known.groupBy("url", "host", "path", "y").agg(F.count(F.lit(1)).alias("n"))
    runs = per.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))))
    first = F.col("run") * COPIES
    each = runs.withColumn("copy", F.explode(F.sequence(first, F.least(first + COPIES, "n") - 1)))
    bound = DIGESTS * (rows + 6 * math.sqrt(rows) + 10) / max(n, 1)
    each = each.withColumn("digest", F.md5(F.concat_ws(":", "copy", "y", F.coalesce("url", F.lit("")))))
    each = each.filter(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") < F.lit(int(min(bound, DIGESTS))))
    return each.orderBy("digest", "url", "y", "copy").limit(rows).select("url", "host", "path", "y")


@dataclass(frozen=True)
class Split:
    feature: int
    threshold: float
    low: "Split | float"
    high: "Split | float"


@dataclass(frozen=True)
class Trees:
    """Boosted trees: the score is ``start`` plus each tree's leaf, in log odds of being blocked."""

    start: float
    trees: tuple["Split | float", ...]

    def column(self) -> Column:
        def walk(node: Split | float) -> Column:
            if isinstance(node, Split):
                return F.when(F.col(FEATURES[node.feature]) <= node.threshold, walk(node.low)).otherwise(walk(node.high))
            return F.lit(float(node))

        out = F.lit(self.start)
        for t in self.trees:
            out = out + walk(t)
        return out


def fit(sample: DataFrame, n_trees: int = 8, depth: int = 3, rate: float = 0.4, bins: int = 16, smooth: float = 1.0) -> Trees:
    """Boosted trees for y (0 or 1) from the ``FEATURES`` of a bounded sample, by logistic loss with second-order leaves."""
    cuts_at = [k / bins for k in range(1, bins)]
    first = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"), *(F.percentile_approx(f, cuts_at, 10_000).alias(f) for f in FEATURES)).first()
    n, y = first["n"], first["y"] or 0.0
    if not n or y in (0, n):
        return Trees(-30.0 if not y else 30.0, ())
    cuts = [sorted(set(first[f])) for f in FEATURES]
    start = math.log(y / (n - y))

    def bin_of(k: int) -> Column:
        out = F.lit(0)
        for c in cuts[k]:
            out = out + F.when(F.col(FEATURES[k]) > c, 1).otherwise(0)
        return out

    binned = staged(sample.select("y", F.array(*map(bin_of, range(len(FEATURES)))).alias("bins")), "url-sample").coalesce(4)

    def value(node: Split | float, leaf) -> Column:
        if isinstance(node, Split):
            k = cuts[node.feature].index(node.threshold)
            return F.when(F.get("bins", F.lit(node.feature)) <= k, value(node.low, leaf)).otherwise(value(node.high, leaf))
        return leaf(node)

    trees: list[Split | float] = []
    for _ in range(n_trees):
        margin = F.lit(start)
        for t in trees:
            margin = margin + value(t, lambda v: F.lit(float(v)))
        p = 1 / (1 + F.exp(-margin))
        base = binned.withColumns({"g": F.col("y") - p, "h": p * (1 - p)})
        splits: dict[int, tuple[int, int]] = {}  # node (1 is the root, 2i and 2i + 1 are below i): feature and bin
        leaves: dict[int, float] = {}

        def node_of(i: int, splits: dict = splits) -> Column:
            if i not in splits:
                return F.lit(i)
            return F.when(F.get("bins", F.lit(splits[i][0])) <= splits[i][1], node_of(2 * i)).otherwise(node_of(2 * i + 1))

        for level in range(depth):
            rows = base.withColumn("node", node_of(1)).filter(F.col("node") >= 1 << level)
            hist: dict[int, dict[int, dict[int, tuple[float, float]]]] = {}
            found = rows.select("node", "g", "h", F.posexplode("bins").alias("f", "b")).groupBy("node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            for r in found.collect():
                hist.setdefault(r["node"], {}).setdefault(r["f"], {})[r["b"]] = (r["g"], r["h"])
            for node, by in sorted(hist.items()):
                g, h = (sum(x[k] for x in by[0].values()) for k in (0, 1))
                leaves[node] = rate * g / (h + smooth)
                best = (1e-6, None)
                for f, table in sorted(by.items()):
                    gl = hl = 0.0
                    for b in sorted(table)[:-1]:
                        gl, hl = gl + table[b][0], hl + table[b][1]
                        gain = gl**2 / (hl + smooth) + (g - gl) ** 2 / (h - hl + smooth) - g**2 / (h + smooth)
                        if b < len(cuts[f]) and gain > best[0] + 1e-9:
                            best = (gain, (f, b))
                            sides = (rate * gl / (hl + smooth), rate * (g - gl) / (h - hl + smooth))
                if best[1]:
                    splits[node] = best[1]
                    leaves[2 * node], leaves[2 * node + 1] = sides
            if not any(i >= 1 << level for i in splits):
                break

        def built(i: int, splits: dict = splits, leaves: dict = leaves) -> Split | float:
            if i not in splits:
                return leaves.get(i, 0.0)
            f, b = splits[i]
            return Split(f, cuts[f][b], built(2 * i), built(2 * i + 1))

        tree = built(1)
        if not isinstance(tree, Split):
            break
        trees.append(tree)
    return Trees(start, tuple(trees))


def _parsed(df: DataFrame, *more: Column) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    return df.select("url", host.alias("host"), path.alias("path"), *more)


def learned(known: DataFrame, sample_rows: int = SAMPLE_ROWS, **options) -> tuple[Suffixes, Trees]:
    """Suffix statistics of all rows of known (url, host, path, y), and trees fitted on at most ``sample_rows`` of them. Without rows: a score of one half."""
    stats = suffix_statistics(known.withColumn("suffix", F.regexp_extract("host", r"[^.]*$", 0)))
    if not stats.rows:
        return stats, Trees(0.0, ())
    with scratch():
        return stats, fit(stats.joined(_lexical(sampled(known, sample_rows, stats.rows))), **options)


def _scored(rows: DataFrame, model: tuple[Suffixes, Trees]) -> DataFrame:
    return model[0].joined(_lexical(rows)).withColumn("score", 1 / (1 + F.exp(-model[1].column())))


def _decided(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None, id_col: str, url_col: str) -> tuple[DataFrame, DataFrame]:
    """(pages with rules, labelled URLs): without labels, the URLs that a rule decides, 1 where it blocks; what no rule decides has no label."""
    rows = matched(_parsed(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")), F.col("id")), rules)
    if labelled is None:
        return rows, rows.filter("rule_verdict is not null").select("url", "host", "path", (F.col("rule_verdict") == "block").cast("double").alias("y"))
    return rows, _parsed(labelled.select("url", F.col("y").cast("double").alias("y")), F.col("y")).filter("y is not null")


def judged(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", sample_rows: int = SAMPLE_ROWS, threshold: float = 0.5, **options) -> DataFrame:
    """One row per row of pages: id, host, path, rule, verdict, and score, the chance of being blocked that the trees give it.

    verdict is that of the longest rule that fits, else block where the score is over ``threshold``. labelled: (url, y) with y 1 for URLs to
    block and 0 for others, which the trees learn from; without it, they learn from the pages that a rule decides, and from them alone.
    Suffix statistics are of all of labelled, the trees of at most ``sample_rows`` of its rows; a suffix that labelled doesn't have gets the mean rate.
    Without labelled rows all scores are one half, which allows. A null URL, or one without ://, has an empty host and path, fits no rule
    and is scored by its features. Repeated rows are judged alike, null ids stay; an empty table gives an empty result; other columns are
    ignored.
    """
    rows, known = _decided(pages, rules, labelled, id_col, url_col)
    out = _scored(rows, learned(known, sample_rows, **options))
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") > threshold, "block").otherwise("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")


def held_out(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", sample_rows: int = SAMPLE_ROWS, threshold: float = 0.5, **options) -> DataFrame:
    """One row: rows, right, accuracy and base_rate (of the commoner verdict) on a fifth of the labelled URLs, by digest of the host, after learning from the others.

    Hosts of one part aren't in the other, so that hosts learned by heart don't count.
    """
    _, known = _decided(pages, rules, labelled, id_col, url_col)
    fifth = F.pmod(F.xxhash64("host"), F.lit(5)) == 0
    test = _scored(known.filter(fifth), learned(known.filter(~fifth), sample_rows, **options))
    n, right, y = F.count(F.lit(1)), F.sum(((F.col("score") > threshold) == (F.col("y") > 0.5)).cast("long")), F.sum("y")
    return test.agg(n.alias("rows"), right.alias("right"), (right / n).alias("accuracy"), (F.greatest(y, n - y) / n).alias("base_rate"))
