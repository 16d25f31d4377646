"""Registered queries of the engine, each over whole tables, with an SQL formulation where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grams, repetition, signals
from ..functions import text as T
from ..operators import contamination, dedup, report, rules
from ..sources import readers

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def lined() -> Column:
    """The documents have no paragraphs and few lines: one line for each sentence, and a paragraph before "The"."""
    return F.replace(F.replace("text", F.lit(". "), F.lit(".\n")), F.lit("\nThe "), F.lit("\n\nThe "))


def noisy() -> Column:
    """And nothing that C4's rules look for: some words become such phrases."""
    return F.replace(F.replace(F.replace(lined(), F.lit(" have "), F.lit(" JavaScript ")), F.lit(" with "), F.lit(" privacy policy ")), F.lit(" anea"), F.lit(" lorem ipsum {"))


SQL_LINED = r"replace(replace(text, '. ', '.' || chr(10)), chr(10) || 'The ', chr(10) || chr(10) || 'The ')"
SQL_NOISY = f"replace(replace(replace({SQL_LINED}, ' have ', ' JavaScript '), ' with ', ' privacy policy '), ' anea', ' lorem ipsum {{')"

# Symbols as DuckDB's classes have them.
_W = r"list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')"
_GOPHER = rf"""
WITH w AS (SELECT doc_id, source, text, {_W} AS w, list_filter(list_transform(string_split(text, chr(10)), lambda x: x), lambda x: true) AS ls FROM documents),
l AS (SELECT *, CASE WHEN text = '' THEN [] WHEN text LIKE '%' || chr(10) THEN ls[:-2] ELSE ls END AS lines,
             list_filter(w, lambda x: regexp_matches(x, '[^\pP\pS\p{{Cc}}]')) AS real FROM w),
s AS (SELECT doc_id, source, len(real) AS word_count, CASE WHEN len(real) > 0 THEN list_sum(list_transform(real, lambda x: length(x)))::DOUBLE / len(real) ELSE 0.0 END AS avg_word_length,
  CASE WHEN len(w) > 0 THEN len(regexp_extract_all(text, '#'))::DOUBLE / len(w) ELSE 0.0 END AS hash_ratio,
  CASE WHEN len(w) > 0 THEN len(regexp_extract_all(text, '\.\.\.|…'))::DOUBLE / len(w) ELSE 0.0 END AS ellipsis_ratio,
  CASE WHEN len(lines) > 0 THEN len(list_filter(lines, lambda x: regexp_matches(x, '^\s*[•-]')))::DOUBLE / len(lines) ELSE 0.0 END AS bullet_lines_ratio,
  CASE WHEN len(lines) > 0 THEN len(list_filter(lines, lambda x: regexp_matches(x, '(?:\.\.\.|…)\s*$')))::DOUBLE / len(lines) ELSE 0.0 END AS ellipsis_lines_ratio,
  CASE WHEN len(w) > 0 THEN len(list_filter(w, lambda x: regexp_matches(x, '\pL')))::DOUBLE / len(w) ELSE 0.0 END AS alpha_ratio,
  len(list_intersect(w, ['the','be','to','of','and','that','have','with'])) AS stopwords FROM l)
"""
_GOPHER_FAILS = (
    "list_filter(["
    "CASE WHEN word_count < 50 THEN 'min_words' END, CASE WHEN word_count > 100000 THEN 'max_words' END, CASE WHEN avg_word_length < 3 THEN 'min_avg_word_len' END, "
    "CASE WHEN avg_word_length > 10 THEN 'max_avg_word_len' END, CASE WHEN hash_ratio > 0.1 THEN 'hash_ratio' END, CASE WHEN ellipsis_ratio > 0.1 THEN 'ellipsis_ratio' END, "
    "CASE WHEN bullet_lines_ratio > 0.9 THEN 'bullet_lines_ratio' END, CASE WHEN ellipsis_lines_ratio > 0.3 THEN 'ellipsis_lines_ratio' END, "
    "CASE WHEN alpha_ratio < 0.8 THEN 'alpha_ratio' END, CASE WHEN stopwords < 2 THEN 'stopwords' END], lambda x: x IS NOT NULL)"
)


@query(_GOPHER + "SELECT doc_id, word_count, avg_word_length, hash_ratio, ellipsis_ratio, bullet_lines_ratio, ellipsis_lines_ratio, alpha_ratio, stopwords FROM s")
def gopher_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, said = F.col("g"), F.col("text").isNotNull()
    rows = documents(spark, sf_dir).select("doc_id", "text", signals.gopher(F.col("text")).alias("g"))
    return rows.select(
        "doc_id", F.when(said, g["n_real"]).alias("word_count"), T.ratio(g["real_chars"], g["n_real"]).alias("avg_word_length"), T.ratio(g["n_hashes"], g["n_words"]).alias("hash_ratio"),
        T.ratio(g["n_ellipses"], g["n_words"]).alias("ellipsis_ratio"), g["bullets_ratio"].alias("bullet_lines_ratio"), g["ends_ratio"].alias("ellipsis_lines_ratio"),
        T.ratio(g["n_alpha"], g["n_words"]).alias("alpha_ratio"), F.when(said, g["n_stops"]).alias("stopwords"),
    )


def _gopher(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.with_failures(documents(spark, sf_dir).withColumn("dataset", F.col("source")), rules.make_filter("gopher_quality"))


@query(_GOPHER + f"SELECT doc_id, array_to_string({_GOPHER_FAILS}, ',') AS rules, len({_GOPHER_FAILS}) = 0 AS keep FROM s")
def gopher_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gopher(spark, sf_dir).select("doc_id", F.array_join(F.transform("failures", lambda f: f["rule"]), ",").alias("rules"), (F.size("failures") == 0).alias("keep"))


@query(_GOPHER + f"SELECT 'gopher_quality' AS filter, rule, count(*) AS failed FROM (SELECT unnest({_GOPHER_FAILS}) AS rule FROM s) GROUP BY rule")
def rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.rule_hits(_gopher(spark, sf_dir))


@query(_GOPHER + rf"""
SELECT source AS dataset, 'gopher_quality' AS filter, r.rule, count(*) AS total, count(*) FILTER (NOT list_contains({_GOPHER_FAILS}, r.rule)) AS passed,
       count(*) FILTER (list_contains({_GOPHER_FAILS}, r.rule)) AS failed, count(*) FILTER (NOT list_contains({_GOPHER_FAILS}, r.rule))::DOUBLE / count(*) AS pass_rate
FROM s, (SELECT unnest(['min_words','max_words','min_avg_word_len','max_avg_word_len','hash_ratio','ellipsis_ratio','bullet_lines_ratio','ellipsis_lines_ratio','alpha_ratio','stopwords']) AS rule) r
GROUP BY source, r.rule""")  # fmt: skip
def rule_pass_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.rule_rates(_gopher(spark, sf_dir), [rules.make_filter("gopher_quality")])


_RATES = _GOPHER + f", r AS (SELECT source, avg((len({_GOPHER_FAILS}) = 0)::INT::DOUBLE) AS p FROM s GROUP BY source) "


@query(_RATES + "SELECT 'gopher_quality' AS filter, round(max(p) - min(p), 9) AS difference, CASE WHEN max(p) - min(p) >= 0.05 THEN 'strong' WHEN max(p) - min(p) >= 0.02 THEN 'moderate' ELSE 'weak' END AS verdict FROM r HAVING count(*) > 1")
def discrimination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = report.filter_rates(_gopher(spark, sf_dir), [rules.make_filter("gopher_quality")])
    return report.discrimination(rates).withColumn("difference", F.round("difference", 9))


@query(_GOPHER + f"""
, j AS (SELECT s.doc_id, len({_GOPHER_FAILS}) > 0 AS a, fw.b FROM s JOIN (SELECT doc_id, len(string_split(text, chr(10))) AS n,
   list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS f, text FROM documents) d USING (doc_id), LATERAL (SELECT
   len(f) = 0 OR len(list_filter(f, lambda x: regexp_matches(x, '[.!?"''”。！？]$')))::DOUBLE / greatest(len(f), 1) < 0.12
   OR len(list_filter(f, lambda x: length(x) <= 30))::DOUBLE / greatest(len(f), 1) > 0.67
   OR (list_sum(list_transform(f, lambda x: length(x))) - list_sum(list_transform(list_distinct(f), lambda x: length(x))))::DOUBLE / greatest(length(replace(text, chr(10), '')), 1) > 0.01
   OR (n - 1)::DOUBLE / greatest(len({_W}), 1) > 0.3 AS b) fw)
SELECT 1 AS step, 'gopher_quality' AS filter, count(*) AS docs_in, count(*) FILTER (NOT a) AS docs_out, count(*) FILTER (a) AS dropped, count(*) FILTER (a)::DOUBLE / count(*) AS drop_rate FROM j
UNION ALL SELECT 2, 'fineweb', count(*) FILTER (NOT a), count(*) FILTER (NOT a AND NOT b), count(*) FILTER (NOT a AND b), count(*) FILTER (NOT a AND b)::DOUBLE / count(*) FILTER (NOT a) FROM j
""")  # fmt: skip
def funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = [rules.make_filter("gopher_quality"), rules.make_filter("fineweb")]
    return report.funnel(rules.verdicts(documents(spark, sf_dir), chain, first_only=True), chain)


@query(_GOPHER + f"""
SELECT 'gopher_quality' AS filter, doc_id, row_number() OVER (ORDER BY doc_id) AS rank,
  CASE {_GOPHER_FAILS}[1] WHEN 'min_words' THEN 'too_few_words' WHEN 'max_words' THEN 'too_many_words' WHEN 'min_avg_word_len' THEN 'avg_word_len_too_short' WHEN 'max_avg_word_len' THEN 'avg_word_len_too_long'
  WHEN 'hash_ratio' THEN 'high_hash_ratio' WHEN 'ellipsis_ratio' THEN 'high_ellipsis_ratio' WHEN 'bullet_lines_ratio' THEN 'too_many_bullets' WHEN 'ellipsis_lines_ratio' THEN 'too_many_end_ellipsis'
  WHEN 'alpha_ratio' THEN 'low_alpha_ratio' ELSE 'too_few_stopwords' END AS reason FROM s WHERE len({_GOPHER_FAILS}) > 0 QUALIFY rank <= 5""")  # fmt: skip
def dropped_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.samples(_gopher(spark, sf_dir)).withColumn("rank", F.col("rank").cast("long"))


@query(_GOPHER + f"""SELECT rule, doc_id, rank FROM (SELECT rule, doc_id, row_number() OVER (PARTITION BY rule ORDER BY doc_id) AS rank FROM (SELECT doc_id, unnest({_GOPHER_FAILS}) AS rule FROM s)) WHERE rank <= 3""")
def rule_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.rule_samples(_gopher(spark, sf_dir), k=3).select("rule", "doc_id", F.col("rank").cast("long").alias("rank"))


@query(_GOPHER + f"SELECT {_GOPHER_FAILS}[1] AS rule, count(*) AS rejected FROM s WHERE len({_GOPHER_FAILS}) > 0 GROUP BY 1")
def rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.rejections(_gopher(spark, sf_dir)).select("rule", "rejected")


@query("SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 20 OFFSET 40")
def document_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.page(documents(spark, sf_dir).select("doc_id", "source"), "doc_id", 40, 20)


@query(_GOPHER + "SELECT source AS dataset, count(*) AS num_docs, avg(word_count) AS avg_word_count, min(word_count) AS min_word_count, max(word_count) AS max_word_count, (SELECT avg(length(d.text)) FROM documents d WHERE d.source = s.source) AS avg_text_length FROM s GROUP BY source")
def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = report.dataset_stats(documents(spark, sf_dir).withColumn("dataset", F.col("source")))
    return out.withColumns({c: F.col(c).cast("long") for c in ("min_word_count", "max_word_count")})


@query("SELECT CASE WHEN n_chars < 0 THEN 0 WHEN n_chars >= 20000 THEN 21 ELSE 1 + (n_chars // 1000) END AS bin, count(*) AS n FROM documents GROUP BY 1")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.histogram(documents(spark, sf_dir), "n_chars", 0, 20000, 20)


@query(rf"""
WITH t AS (SELECT doc_id, {SQL_LINED} AS t FROM documents),
p AS (SELECT doc_id, t, list_filter(string_split_regex(t, '\n+'), lambda x: x <> '') AS l, list_filter(string_split_regex(trim(t, ' ' || chr(10)), '\n{{2,}}'), lambda x: x <> '') AS p FROM t)
SELECT doc_id, CASE WHEN len(p) > 0 THEN (len(p) - len(list_distinct(p)))::DOUBLE / len(p) ELSE 0.0 END AS dup_para_ratio,
  CASE WHEN len(p) > 0 THEN (list_sum(list_transform(p, lambda x: length(x))) - list_sum(list_transform(list_distinct(p), lambda x: length(x))))::DOUBLE / length(t) ELSE 0.0 END AS dup_para_char_frac,
  CASE WHEN len(l) > 0 THEN (len(l) - len(list_distinct(l)))::DOUBLE / len(l) ELSE 0.0 END AS dup_line_ratio,
  CASE WHEN len(l) > 0 THEN (list_sum(list_transform(l, lambda x: length(x))) - list_sum(list_transform(list_distinct(l), lambda x: length(x))))::DOUBLE / length(t) ELSE 0.0 END AS dup_line_char_frac
FROM p""")
def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", lined().alias("t"))
    rows = rows.withColumns({"p": T.dup_paragraphs(F.col("t")), "l": T.dup_lines(F.col("t"))})
    t = F.col("t")
    return rows.select("doc_id", T.dup_ratio(F.col("p")).alias("dup_para_ratio"), T.dup_char_frac(F.col("p"), t).alias("dup_para_char_frac"), T.dup_ratio(F.col("l")).alias("dup_line_ratio"), T.dup_char_frac(F.col("l"), t).alias("dup_line_char_frac"))


_TOP = " UNION ALL ".join(
    f"SELECT doc_id, {n} AS n, array_to_string(w[i:i + {n - 1}], ' ') AS g, i FROM w, LATERAL (SELECT unnest(range(1, len(w) - {n} + 2)) AS i)" for n in (2, 3, 4)
)


@query(rf"""
WITH w AS (SELECT doc_id, {_W} AS w FROM documents), g AS ({_TOP}),
c AS (SELECT doc_id, n, g, count(*) AS k, min(i) AS first FROM g GROUP BY ALL),
b AS (SELECT doc_id, n, length(g) * k AS chars FROM c QUALIFY row_number() OVER (PARTITION BY doc_id, n ORDER BY k DESC, first) = 1)
SELECT d.doc_id, coalesce(max(b.chars) FILTER (n = 2), 0)::DOUBLE / greatest(length(any_value(d.text)), 1) AS top_2, coalesce(max(b.chars) FILTER (n = 3), 0)::DOUBLE / greatest(length(any_value(d.text)), 1) AS top_3,
       coalesce(max(b.chars) FILTER (n = 4), 0)::DOUBLE / greatest(length(any_value(d.text)), 1) AS top_4
FROM documents d LEFT JOIN b USING (doc_id) GROUP BY d.doc_id""")
def top_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", repetition.ngram_fractions(T.text_of("text"), dup=()).alias("g")).select("doc_id", *(F.col(f"g.top_{n}") for n in repetition.TOP))


@query()
def gopher_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.with_failures(documents(spark, sf_dir).withColumn("text", lined()), rules.make_filter("gopher_repetition"))
    return out.select("doc_id", F.array_join(F.transform("failures", lambda f: f["rule"]), ",").alias("rules"))


_FW = rf"""
WITH d AS (SELECT doc_id, {SQL_LINED} AS text FROM documents),
f AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\S')) AS f, {_W} AS w FROM d),
v AS (SELECT doc_id, len(f) AS n, len(list_filter(f, lambda x: regexp_matches(x, '[.!?"''”。！？]$')))::DOUBLE / greatest(len(f), 1) AS ended, len(list_filter(f, lambda x: length(x) <= 30))::DOUBLE / greatest(len(f), 1) AS short,
  coalesce(list_sum(list_transform(f, lambda x: length(x))) - list_sum(list_transform(list_distinct(f), lambda x: length(x))), 0)::DOUBLE / greatest(length(replace(text, chr(10), '')), 1) AS dup,
  (length(text) - length(replace(text, chr(10), '')))::DOUBLE / greatest(len(w), 1) AS list FROM f)
"""


@query(_FW + """SELECT doc_id, array_to_string(list_filter([CASE WHEN n = 0 THEN 'empty_doc' END, CASE WHEN n > 0 AND ended < 0.12 THEN 'line_punct_ratio' END, CASE WHEN n > 0 AND short > 0.67 THEN 'short_line_ratio' END,
  CASE WHEN n > 0 AND dup > 0.01 THEN 'char_dup_ratio' END, CASE WHEN n > 0 AND list > 0.3 THEN 'list_ratio' END], lambda x: x IS NOT NULL), ',') AS rules FROM v""")  # fmt: skip
def fineweb(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.with_failures(documents(spark, sf_dir).withColumn("text", lined()), rules.make_filter("fineweb"))
    return out.select("doc_id", F.array_join(F.transform("failures", lambda f: f["rule"]), ",").alias("rules"))


_C4 = rf"""
WITH d AS (SELECT doc_id, {SQL_NOISY} AS text FROM documents),
l AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: trim(x)) AS l FROM d),
f AS (SELECT doc_id, list_transform(l, lambda x: CASE WHEN x <> '' AND (x LIKE '%...' OR NOT regexp_matches(x, '[.?!"'']$')) THEN 'p' WHEN contains(lower(x), 'lorem ipsum') THEN 'lorem_ipsum'
   WHEN contains(lower(x), 'javascript') THEN 'j' WHEN contains(lower(x), 'privacy policy') THEN 'o' ELSE 'k' END) AS f, l FROM l),
k AS (SELECT doc_id, list_contains(f, 'lorem_ipsum') AS bad, CASE WHEN list_contains(f, 'lorem_ipsum') THEN [] ELSE list_filter(l, lambda x, i: f[i] = 'k') END AS kept FROM f),
s AS (SELECT doc_id, bad, trim(array_to_string(kept, chr(10)), ' ' || chr(10)) AS t, coalesce(list_sum(list_transform(kept, lambda x: greatest(len(regexp_extract_all(x, '[^.!?。！？]*[.!?。！？]')), (x <> '')::INT))), 0) AS n FROM k)
"""


@query(_C4 + """SELECT doc_id, md5(t) AS kept_md5, n::BIGINT AS sentences, array_to_string(list_filter([CASE WHEN bad THEN 'lorem_ipsum' END, CASE WHEN t = '' THEN 'empty_after_line_filter' END,
  CASE WHEN t <> '' AND n < 5 THEN 'min_sentences' END], lambda x: x IS NOT NULL), ',') AS rules FROM s""")  # fmt: skip
def c4(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = rules.make_filter("c4")
    out = f.signals(documents(spark, sf_dir).select("doc_id", noisy().alias("text"))).withColumn("failures", rules.failures(f))
    return out.select("doc_id", F.md5("__text").alias("kept_md5"), F.col("__sentences").cast("long").alias("sentences"), F.array_join(F.transform("failures", lambda x: x["rule"]), ",").alias("rules"))


@query(r"""
SELECT doc_id, len(regexp_extract_all(text, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b')) AS email,
  len(list_filter(regexp_extract_all(text, '\b(?:25[0-5]|2[0-4]\d|1\d{2}|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d{2}|[1-9]?\d)){3}\b'), lambda x: NOT regexp_matches(x, '^(10\.|127\.|172\.(1[6-9]|2\d|3[01])\.|192\.168\.)'))) AS ip,
  len(list_filter(regexp_extract_all(text, '\d+'), lambda x: regexp_matches(x, '^1[3-9]\d{9}$'))) AS cn_phone,
  len(list_filter(regexp_extract_all(text, '\d+[Xx]?'), lambda x: regexp_matches(x, '^[1-9]\d{5}(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\d{3}[\dXx]$'))) AS cn_id,
  len(list_filter(regexp_extract_all(text, '\d+'), lambda x: length(x) BETWEEN 16 AND 19)) AS bank_card FROM documents""")
def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import filters

    return documents(spark, sf_dir).select("doc_id", *(v.cast("long").alias(k) for k, v in filters.pii_counts(T.text_of("text")).items()))


@query(r"""
WITH e AS (SELECT doc_id, regexp_replace(text, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b', 'email@example.com', 'g') AS t FROM documents)
SELECT doc_id, len(regexp_extract_all(t, 'email@example\.com')) AS emails, contains(t, '@mail') AS leak FROM e""")
def pii_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = rules.make_filter("pii").rewrite(documents(spark, sf_dir))
    return documents(spark, sf_dir).select("doc_id", t.alias("t")).select("doc_id", T.count(F.col("t"), r"email@example\.com").cast("long").alias("emails"), F.col("t").contains("@mail").alias("leak"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a conversation: its first user turn as instruction, its first assistant turn as output."""
    turns = table(spark, sf_dir, "conversations")
    said = lambda role, out: F.min_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col("turn"))).alias(out)
    return turns.groupBy("conv_id").agg(said("user", "instruction"), said("assistant", "output"))


_CLOSED = r"(?i)\b(classif[y|ication]|categoriz|label|output\s+[01]|output\s+(true|false|yes|no)|answer\s+(yes|no|true|false)|(is|are|was|were)\s+.{1,40}\?$|name\s+the|list\s+the|identify\s+the|extract\s+the|what\s+is\s+the\s+(name|number|date|year|country|city|capital)|who\s+(is|was|are|were)\b|how\s+many\b|choose\s+(one|the|from|between)|select\s+(one|the|from)|pick\s+(one|the)|which\s+(one|of)\b|translate\s+.{1,20}\s+to\b|convert\s+.{1,30}\s+to\b|spell|abbreviat|acronym|true\s+or\s+false|yes\s+or\s+no|in\s+one\s+word|in\s+a\s+word|one-word\s+answer)"
_SFT = rf"""
WITH c AS (SELECT conv_id, coalesce(arg_min(text, turn) FILTER (role = 'user'), '') AS i, coalesce(arg_min(text, turn) FILTER (role = 'assistant'), '') AS o FROM conversations GROUP BY conv_id),
g AS (SELECT *, trim(lower(i)) AS li, trim(lower(o)) AS lo, len(list_filter(string_split_regex(i, '\s+'), lambda x: regexp_matches(x, '[^\pP\pS\p{{Cc}}]'))) AS iw, len(list_filter(string_split_regex(o, '\s+'), lambda x: regexp_matches(x, '[^\pP\pS\p{{Cc}}]'))) AS ow FROM c),
t AS (SELECT *, list_distinct(list_transform(range(1, length(li) - 1), lambda k: substr(li, k, 3))) AS a, list_distinct(list_transform(range(1, length(lo) - 1), lambda k: substr(lo, k, 3))) AS b FROM g),
s AS (SELECT *, CASE WHEN li = '' OR lo = '' THEN 0.0 WHEN len(a) = 0 OR len(b) = 0 THEN (li = lo)::INT::DOUBLE ELSE len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))) END AS sim,
  CASE WHEN regexp_matches(i, '{_CLOSED}') THEN 1 ELSE 5 END AS least, regexp_matches(lo, '^(i cannot|i''m sorry, but i cannot|i''m sorry, but i can''t|i apologize, but i cannot|i apologize, but i can''t|i''m not able to|i am not able to|i''m unable to|i am unable to)') AS hard,
  regexp_matches(lo, '^(as an ai language model|as an ai assistant|as an ai,|i''m sorry, but i|i apologize)') AS soft FROM t)
SELECT conv_id, array_to_string(list_filter([CASE WHEN i = '' AND o = '' THEN 'missing_sft_fields' END, CASE WHEN (i <> '' OR o <> '') AND lo = '' THEN 'empty_output' END, CASE WHEN iw >= 20 AND ow < least THEN 'output_too_short' END,
  CASE WHEN lo <> '' AND sim > 0.8 THEN 'instruction_copy' END, CASE WHEN lo <> '' AND (hard OR (soft AND ow < 50)) THEN 'ai_refusal' END], lambda x: x IS NOT NULL), ',') AS rules FROM s"""  # fmt: skip


@query(_SFT)
def sft_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.with_failures(conversations(spark, sf_dir), rules.make_filter("sft_rules"))
    return out.select("conv_id", F.array_join(F.transform("failures", lambda f: f["rule"]), ",").alias("rules"))


#: Words of a list that the caller gives; these are words of the test documents.
WORDS = {"en": ["idiot", "moron", "clown"], "de": ["und"], "fr": ["une"]}


@query(r"""SELECT doc_id, CASE lang WHEN 'en' THEN regexp_matches(lower(text), '(?:[^\pL\pN_]|^)(idiot|moron|clown)(?:[^\pL\pN_]|$)') WHEN 'de' THEN regexp_matches(lower(text), '(?:[^\pL\pN_]|^)(und)(?:[^\pL\pN_]|$)')
  WHEN 'fr' THEN regexp_matches(lower(text), '(?:[^\pL\pN_]|^)(une)(?:[^\pL\pN_]|$)') ELSE false END AS bad FROM documents""")  # fmt: skip
def badwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = rules.make_filter("badwords", word_lists=WORDS, language_field="lang")
    return rules.with_failures(documents(spark, sf_dir), f).select("doc_id", (F.size("failures") > 0).alias("bad"))


@query("SELECT doc_id, lang NOT IN ('en', 'de') OR n_chars <= 650 AS dropped FROM documents")
def language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("lang_scores", F.create_map("lang", F.least(F.col("n_chars") / 1000.0, F.lit(1.0))))
    return rules.with_failures(docs, rules.make_filter("language", languages=["en", "de"])).select("doc_id", (F.size("failures") > 0).alias("dropped"))


@query("SELECT doc_id, coalesce(quality < 0.5, false) AS low_quality, n_chars < 400 AS low, n_chars > 4000 AS high FROM documents LEFT JOIN labels USING (doc_id)")
def score_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumns({"quality_score": F.col("quality").cast("double"), "perplexity": F.col("n_chars").cast("double")})
    out = rules.verdicts(docs, [rules.make_filter("fasttext_quality"), rules.make_filter("perplexity", min_ppl=400, max_ppl=4000)])
    named = F.transform("failures", lambda f: f["rule"])
    return out.select("doc_id", F.array_contains(named, "low_quality").alias("low_quality"), F.array_contains(named, "perplexity_too_low").alias("low"), F.array_contains(named, "perplexity_too_high").alias("high"))


_NORMAL = r"regexp_replace(trim(lower(text), ' ' || chr(10)), '\s+', ' ', 'g')"


@query(f"SELECT doc_id, sha256({_NORMAL}) AS hash, min(doc_id) OVER (PARTITION BY {_NORMAL}) AS first, doc_id <> min(doc_id) OVER (PARTITION BY {_NORMAL}) AS is_duplicate FROM documents")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact(documents(spark, sf_dir)).select("doc_id", "hash", "first", "is_duplicate")


@query(f"SELECT count(*) AS total_docs, count(DISTINCT {_NORMAL}) AS unique_docs, count(*) - count(DISTINCT {_NORMAL}) AS duplicate_docs, round((count(*) - count(DISTINCT {_NORMAL}))::DOUBLE / count(*), 4) AS dedup_rate FROM documents")
def exact_dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_stats(documents(spark, sf_dir))


@query("SELECT doc_id, row_number() OVER (PARTITION BY n_chars ORDER BY 'v' || lang DESC, doc_id DESC) = 1 AS is_latest FROM documents")
def version_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.latest_version(documents(spark, sf_dir), F.col("n_chars"), F.concat(F.lit("v"), "lang"), "doc_id").select("doc_id", "is_latest")


@query()
def minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.minhash(documents(spark, sf_dir)).select("doc_id", "is_duplicate")


_BM = r"regexp_replace(regexp_replace(lower(text), '[!-/:-@\[-`{-~]', '', 'g'), '\s+', ' ', 'g')"


def _sql_grams(key: str, rows: str) -> str:
    return f"SELECT DISTINCT {key}, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT {key}, list_filter(string_split({_BM}, ' '), lambda x: x <> '') AS w FROM {rows}), LATERAL (SELECT unnest(range(1, len(w) - 11)) AS i)"


def benchmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark table as named benchmarks of ten items each."""
    return table(spark, sf_dir, "benchmark").select(F.concat(F.lit("bm_"), F.floor(F.col("item_id") / 10).cast("string")).alias("benchmark"), "text")


_CONTAM = f"""WITH dg AS ({_sql_grams('doc_id', 'documents')}), bg AS ({_sql_grams('benchmark', "(SELECT 'bm_' || (item_id // 10)::VARCHAR AS benchmark, text FROM benchmark)")}),
tot AS (SELECT doc_id, count(*) AS total FROM dg GROUP BY doc_id), hit AS (SELECT doc_id, benchmark, count(*) AS hits FROM dg JOIN bg USING (g) GROUP BY ALL) """


@query(_CONTAM + "SELECT doc_id, benchmark, hits, total, hits::DOUBLE / total AS overlap FROM hit JOIN tot USING (doc_id)")
def contamination_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.overlaps(documents(spark, sf_dir), benchmarks(spark, sf_dir))


@query(_CONTAM + ", u AS (SELECT doc_id, count(DISTINCT g) AS hits FROM dg JOIN bg USING (g) GROUP BY doc_id), b AS (SELECT doc_id, benchmark FROM hit QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, benchmark) = 1) "
       "SELECT d.doc_id, coalesce(hits, 0)::DOUBLE / coalesce(total, 1) AS overlap, coalesce(benchmark, '') AS benchmark, coalesce(hits::DOUBLE / total >= 0.1, false) AS contaminated FROM documents d LEFT JOIN tot USING (doc_id) LEFT JOIN u USING (doc_id) LEFT JOIN b USING (doc_id)")  # fmt: skip
def contamination_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.checked(documents(spark, sf_dir), benchmarks(spark, sf_dir), threshold=0.1)


@query(_CONTAM + """, n AS (SELECT count(*) AS n FROM documents WHERE trim(text) <> '')
SELECT b.benchmark, n.n AS total_docs, count(*) FILTER (h.hits::DOUBLE / t.total >= 0.1) AS contaminated_docs, count(*) FILTER (h.hits::DOUBLE / t.total >= 0.1)::DOUBLE / n.n AS contamination_rate, round(coalesce(sum(h.hits::DOUBLE / t.total), 0) / n.n, 9) AS avg_overlap
FROM (SELECT DISTINCT 'bm_' || (item_id // 10)::VARCHAR AS benchmark FROM benchmark) b CROSS JOIN n LEFT JOIN hit h ON h.benchmark = b.benchmark LEFT JOIN tot t ON t.doc_id = h.doc_id GROUP BY b.benchmark, n.n""")  # fmt: skip
def contamination_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.scanned(documents(spark, sf_dir), benchmarks(spark, sf_dir), threshold=0.1).withColumn("avg_overlap", F.round("avg_overlap", 9))


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id::VARCHAR), doc_id) AS place FROM documents QUALIFY place <= 100")
def reservoir_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    out = dedup.sampled(documents(spark, sf_dir), 100)
    return out.select("doc_id", F.row_number().over(Window.orderBy(*dedup.seeded_order("doc_id"))).cast("long").alias("place"))


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id::VARCHAR), doc_id) <= 3")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.stratified(documents(spark, sf_dir), "source", 3).select("doc_id", "source")


@query(rf"""SELECT doc_id, greatest(len(regexp_extract_all(text, '[^.!?。！？]*[.!?。！？]')), (trim(text, ' ' || chr(10)) <> '')::INT)::BIGINT AS sentences, len(regexp_extract_all(lower(text), '[\pL\pN_\pM]+')) AS tokens,
  length(text) - length(replace(text, '#', '')) AS hashes FROM documents""")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = T.text_of("text")
    return documents(spark, sf_dir).select("doc_id", T.sentences(t).cast("long").alias("sentences"), F.size(T.simple_tokens(t)).cast("long").alias("tokens"), T.count(t, "#").cast("long").alias("hashes"))


@query(rf"""
WITH t AS (SELECT doc_id, {SQL_LINED} AS text FROM documents), s AS (SELECT doc_id, text, trim(lower(text), ' ' || chr(10)) AS low, {_W} AS w, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS f FROM t)
SELECT doc_id, CASE WHEN len(f) > 0 THEN len(list_filter(f, lambda x: regexp_matches(x, '[.!?;。！？；]$')))::DOUBLE / len(f) ELSE 0.0 END AS punct_lines,
  CASE WHEN length(text) < 10 THEN 0.0 ELSE least(1.0, (length(text) - 9 - len(list_distinct(list_transform(range(1, length(text) - 8), lambda i: substr(text, i, 10))))) * 10.0 / length(text)) END AS char_repetition,
  greatest(length(low) - 4, 1) AS char_grams, len(list_distinct(CASE WHEN length(low) < 5 THEN [low] ELSE list_transform(range(1, length(low) - 3), lambda i: substr(low, i, 5)) END)) AS distinct_char_grams, greatest(len(w) - 2, 0) AS word_grams FROM s""")  # fmt: skip
def ngram_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.col("t").isNotNull()
    rows = documents(spark, sf_dir).select("doc_id", lined().alias("t")).select("doc_id", "t", grams.ngram_counts(F.col("t")).alias("g"))
    return rows.select(
        "doc_id", "g.punct_lines", F.when(said, F.col("g.char_repetition")).otherwise(1.0).alias("char_repetition"), "g.char_grams",
        F.when(said, F.col("g.distinct_char_grams")).alias("distinct_char_grams"), "g.word_grams",
    )


@query(r"SELECT page_id, CASE WHEN contains(lower(html[:500]), '<html') OR contains(lower(html[:500]), '<!doctype') THEN 'html' WHEN contains(html, '\begin{document}') OR contains(html[:500], '\documentclass') THEN 'latex' ELSE 'text' END AS format FROM pages")
def detected_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.detected_format(T.text_of("html")).alias("format"))


def queries() -> dict[str, Query]:
    from . import more_queries  # noqa: F401  registers the rest

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules per source with their pass rates."""
    return rule_pass_rates(spark, sf_dir)
