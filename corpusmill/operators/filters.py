"""Built-in filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import repetition
from ..functions import signals as counting
from ..functions import text as T
from .rules import Filter, Rule, register_filter


def _under(rule: str, value: Column, least: float, reason: str | None = None) -> Rule:
    return Rule(rule, value < least, value, least, reason)


def _over(rule: str, value: Column, most: float, reason: str | None = None) -> Rule:
    return Rule(rule, value > most, value, most, reason)


@register_filter("gopher_quality")
def gopher_quality(
    text_field: str = "text", min_words: int = 50, max_words: int = 100_000, min_avg_word_len: float = 3.0, max_avg_word_len: float = 10.0,
    max_symbol_ratio: float = 0.1, max_bullet_lines_ratio: float = 0.9, max_ellipsis_lines_ratio: float = 0.3, min_stopwords: int = 2, min_alpha_ratio: float = 0.8,
) -> Filter:
    def signals(df: DataFrame) -> DataFrame:
        names = {"__wc": "n_real", "__chars": "real_chars", "__n": "n_words", "__hash": "n_hashes", "__dots": "n_ellipses", "__bullets": "bullets_ratio", "__ends": "ends_ratio", "__alpha": "n_alpha", "__stops": "n_stops"}
        return df.withColumn("__gopher", counting.gopher(F.col(text_field))).withColumns({k: F.col(f"__gopher.{v}") for k, v in names.items()})

    def rules() -> list[Rule]:
        wc, n = F.col("__wc"), F.col("__n")
        length = T.ratio(F.col("__chars"), wc)
        return [
            _under("min_words", wc, min_words, "too_few_words"), _over("max_words", wc, max_words, "too_many_words"),
            _under("min_avg_word_len", length, min_avg_word_len, "avg_word_len_too_short"), _over("max_avg_word_len", length, max_avg_word_len, "avg_word_len_too_long"),
            _over("hash_ratio", T.ratio(F.col("__hash"), n), max_symbol_ratio, "high_hash_ratio"), _over("ellipsis_ratio", T.ratio(F.col("__dots"), n), max_symbol_ratio, "high_ellipsis_ratio"),
            _over("bullet_lines_ratio", F.col("__bullets"), max_bullet_lines_ratio, "too_many_bullets"), _over("ellipsis_lines_ratio", F.col("__ends"), max_ellipsis_lines_ratio, "too_many_end_ellipsis"),
            _under("alpha_ratio", T.ratio(F.col("__alpha"), n), min_alpha_ratio, "low_alpha_ratio"), _under("stopwords", F.col("__stops"), min_stopwords, "too_few_stopwords"),
        ]

    return Filter("gopher_quality", rules, signals, text_field=text_field)


# Thresholds of repeated word n-grams by n.
DUP_NGRAMS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
TOP_NGRAMS = {2: 0.20, 3: 0.18, 4: 0.16}


@register_filter("gopher_repetition")
def gopher_repetition(
    text_field: str = "text", max_dup_para_ratio: float = 0.30, max_dup_para_char_frac: float = 0.20, max_dup_line_ratio: float = 0.30,
    max_dup_line_char_frac: float = 0.20, max_char_repetition: float | None = None, **grams: float,
) -> Filter:
    """max_top_{n}gram and max_dup_{n}gram_frac are further options; max_char_repetition has no effect."""
    top = {n: grams.pop(f"max_top_{n}gram", v) for n, v in TOP_NGRAMS.items()}
    dup = {n: grams.pop(f"max_dup_{n}gram_frac", v) for n, v in DUP_NGRAMS.items()}
    if grams:
        raise ValueError(f"unknown options: {', '.join(grams)}")

    def signals(df: DataFrame) -> DataFrame:
        t = T.text_of(text_field)
        df = df.withColumns({"__paras": T.dup_paragraphs(t), "__lines": T.dup_lines(t), "__grams": repetition.ngram_fractions(t)})
        return df.withColumns({
            "__dpr": T.dup_ratio(F.col("__paras")), "__dpc": T.dup_char_frac(F.col("__paras"), t), "__dlr": T.dup_ratio(F.col("__lines")), "__dlc": T.dup_char_frac(F.col("__lines"), t),
        })

    def rules() -> list[Rule]:
        out = [
            _over("dup_para_ratio", F.col("__dpr"), max_dup_para_ratio, "high_dup_para_ratio"), _over("dup_para_char_frac", F.col("__dpc"), max_dup_para_char_frac, "high_dup_para_char_frac"),
            _over("dup_line_ratio", F.col("__dlr"), max_dup_line_ratio, "high_dup_line_ratio"), _over("dup_line_char_frac", F.col("__dlc"), max_dup_line_char_frac, "high_dup_line_char_frac"),
        ]
        out += [_over(f"top_{n}gram", F.col(f"__grams.top_{n}"), v, f"high_top_{n}gram") for n, v in top.items()]
        return out + [_over(f"dup_{n}gram_frac", F.col(f"__grams.dup_{n}"), v) for n, v in dup.items()]

    return Filter("gopher_repetition", rules, signals, text_field=text_field)


@register_filter("fineweb")
def fineweb(
    text_field: str = "text", line_punct_thr: float = 0.12, line_punct_exclude_zero: bool = False, short_line_thr: float = 0.67, short_line_length: int = 30,
    char_duplicates_ratio: float = 0.01, new_line_ratio: float = 0.3, stop_chars: str = ".!?\"'”。！？",
) -> Filter:
    """stop_chars end a line well; lines are taken as they are, not stripped."""
    def signals(df: DataFrame) -> DataFrame:
        t = T.text_of(text_field)
        df = df.withColumns({"__gopher": counting.gopher(F.col(text_field)), "__flat": F.length(F.replace(t, F.lit("\n"), F.lit("")))})
        df = df.withColumn("__full", F.filter(F.split(t, "\n"), lambda x: F.regexp_like(x, F.lit(rf"[^{T.SPACE}]"))))
        stops = "[" + "".join("\\" + c if c in r"]\^-[&" else c for c in stop_chars) + "]$"
        return df.withColumns({
            "__ended": T.share(F.col("__full"), lambda x: F.regexp_like(x, F.lit(stops))), "__short": T.share(F.col("__full"), lambda x: F.length(x) <= short_line_length),
            "__dup": T.ratio(T._chars(F.col("__full")) - T._chars(F.array_distinct("__full")), F.col("__flat")), "__list": T.ratio(F.length(t) - F.col("__flat"), F.col("__gopher.n_words")),
        })

    def rules() -> list[Rule]:
        some = F.size("__full") > 0
        ended = F.col("__ended")
        exempt = (ended == 0) if line_punct_exclude_zero else F.lit(False)
        return [
            Rule("empty_doc", ~some, F.size("__full"), 1), Rule("line_punct_ratio", some & (ended < line_punct_thr) & ~exempt, ended, line_punct_thr),
            Rule("short_line_ratio", some & (F.col("__short") > short_line_thr), F.col("__short"), short_line_thr),
            Rule("char_dup_ratio", some & (F.col("__dup") > char_duplicates_ratio), F.col("__dup"), char_duplicates_ratio), Rule("list_ratio", some & (F.col("__list") > new_line_ratio), F.col("__list"), new_line_ratio),
        ]

    return Filter("fineweb", rules, signals, text_field=text_field)


# Phrases of lines on policies.
POLICY = ("terms of use", "privacy policy", "cookie policy", "uses cookies", "use of cookies", "use cookies")


@register_filter("c4")
def c4(
    text_field: str = "text", remove_no_terminal_punct: bool = True, remove_javascript_lines: bool = True, remove_policy_lines: bool = True,
    remove_lorem_ipsum: bool = True, remove_curly_brace: bool = False, min_sentences: int = 5,
) -> Filter:
    """Lines are stripped and sorted out one by one; the first line that rejects its document does so only if it isn't dropped before."""
    never = F.lit(False)

    def on(flag: bool, test):
        return test if flag else lambda x: never

    unended = on(remove_no_terminal_punct, lambda x: (x != "") & ~F.regexp_like(x, F.lit(r"(?<!\.\.)[.]$|[?!\"']$")))
    lorem = on(remove_lorem_ipsum, lambda x: F.lower(x).contains("lorem ipsum"))
    script = on(remove_javascript_lines, lambda x: F.lower(x).contains("javascript"))
    curly = on(remove_curly_brace, lambda x: x.contains("{"))
    policy = on(remove_policy_lines, lambda x: F.regexp_like(F.lower(x), F.lit("|".join(POLICY))))

    def signals(df: DataFrame) -> DataFrame:
        def fate(x: Column) -> Column:
            return F.when(unended(x), "no_terminal_punct").when(lorem(x), "lorem_ipsum").when(script(x), "javascript").when(curly(x), "curly_brace").when(policy(x), "policy").otherwise("kept")

        df = df.withColumn("__fates", F.transform(F.transform(T.lines(T.text_of(text_field)), T.strip), lambda x: F.struct(x.alias("line"), fate(x).alias("fate"))))
        df = df.withColumn("__reject", F.get(F.filter(F.transform("__fates", lambda x: x["fate"]), lambda x: x.isin("lorem_ipsum", "curly_brace")), F.lit(0)))
        kept = F.transform(F.filter("__fates", lambda x: x["fate"] == "kept"), lambda x: x["line"])
        df = df.withColumn("__kept", F.when(F.col("__reject").isNull(), kept).otherwise(F.array().cast("array<string>")))
        return df.withColumn("__text", T.strip(F.array_join("__kept", "\n"))).withColumn("__sentences", F.aggregate("__kept", F.lit(0), lambda n, x: n + T.sentences(x)))

    def rules() -> list[Rule]:
        empty = F.col("__text") == ""
        return [
            Rule("lorem_ipsum", F.coalesce(F.col("__reject") == "lorem_ipsum", never), F.lit(1), 0), Rule("curly_brace", F.coalesce(F.col("__reject") == "curly_brace", never), F.lit(1), 0),
            Rule("empty_after_line_filter", empty, F.size("__kept"), 1), Rule("min_sentences", ~empty & (F.col("__sentences") < min_sentences), F.col("__sentences"), min_sentences, "too_few_sentences"),
        ]

    return Filter("c4", rules, signals, lambda df: F.col("__text"), text_field)


# Patterns of personal data in the order of their replacement, and what replaces them.
PII = (
    ("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "email@example.com"),
    (
        "ip",
        r"\b(?!10\.)(?!127\.)(?!172\.(?:1[6-9]|2\d|3[01])\.)(?!192\.168\.)(?:25[0-5]|2[0-4]\d|1\d{2}|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d{2}|[1-9]?\d)){3}\b",
        "0.0.0.0",
    ),
    ("cn_phone", r"(?<!\d)1[3-9]\d{9}(?!\d)", "1XXXXXXXXXX"),
    ("cn_id", r"(?<!\d)[1-9]\d{5}(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\d{3}[\dXx](?!\d)", "XXXXXXXXXXXXXXXXXX"),
    ("bank_card", r"(?<!\d)\d{16,19}(?!\d)", "XXXXXXXXXXXXXXXX"),
)


def redacted(text: Column) -> Column:
    for _, pattern, put in PII:
        text = F.regexp_replace(text, pattern, put)
    return text


def pii_counts(text: Column, redact: bool = False) -> dict[str, Column]:
    """Matches of each pattern in the text; with ``redact``, in what the patterns before it leave."""
    out = {}
    for name, pattern, put in PII:
        out[name] = T.count(text, pattern)
        if redact:
            text = F.regexp_replace(text, pattern, put)
    return out


@register_filter("pii")
def pii(text_field: str = "text", mode: str = "redact") -> Filter:
    """Never rejects; in mode redact it rewrites. ``pii_counts`` gives what it finds."""
    if mode not in ("detect", "redact"):
        raise ValueError(f"the mode is detect or redact, not {mode!r}")
    return Filter("pii", list, rewrite=(lambda df: redacted(T.text_of(text_field))) if mode == "redact" else None, text_field=text_field)


# Fields of instruction data, refusals, closed-form tasks and CJK ranges of its rules.
INSTRUCTION_FIELDS = ("prompt", "input", "question", "query", "human")
OUTPUT_FIELDS = ("response", "answer", "reply", "assistant", "completion")
REFUSALS = (
    "i cannot", "i'm sorry, but i cannot", "i'm sorry, but i can't", "i apologize, but i cannot", "i apologize, but i can't", "i'm not able to", "i am not able to", "i'm unable to",
    "i am unable to",
)
SOFT_REFUSALS = ("as an ai language model", "as an ai assistant", "as an ai,", "i'm sorry, but i", "i apologize")
CLOSED_FORM = (
    r"(?i)\b(classif[y|ication]|categoriz|label|output\s+[01]|output\s+(true|false|yes|no)|answer\s+(yes|no|true|false)|(is|are|was|were)\s+.{1,40}\?$|"
    r"name\s+the|list\s+the|identify\s+the|extract\s+the|what\s+is\s+the\s+(name|number|date|year|country|city|capital)|who\s+(is|was|are|were)\b|how\s+many\b|"
    r"choose\s+(one|the|from|between)|select\s+(one|the|from)|pick\s+(one|the)|which\s+(one|of)\b|translate\s+.{1,20}\s+to\b|convert\s+.{1,30}\s+to\b|"
    r"spell|abbreviat|acronym|true\s+or\s+false|yes\s+or\s+no|in\s+one\s+word|in\s+a\s+word|one-word\s+answer)"
)
SFT_CJK = r"\u4E00-\u9FFF\u3400-\u4DBF\u2E80-\u2EFF\uF900-\uFAFF\x{20000}-\x{2A6DF}"


def sft_fields(df: DataFrame, instruction_field: str = "instruction", output_field: str = "output") -> tuple[Column, Column, Column]:
    """(instruction, output, whether there are such fields) by the fields that df has: the named ones, conversations, then other names."""
    def first(names: tuple[str, ...]) -> Column:
        there = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in names if c in df.columns]
        return F.coalesce(*there, F.lit("")) if there else F.lit("")

    own_i, own_o = first((instruction_field,)), first((output_field,))
    any_i, any_o = first((instruction_field, *INSTRUCTION_FIELDS)), first((output_field, *OUTPUT_FIELDS))
    some = (any_i != "") | (any_o != "")
    if "conversations" not in df.columns:
        return any_i, any_o, some
    fields = {f.name for f in df.schema["conversations"].dataType.elementType.fields}

    def said(i: int) -> Column:
        turn = F.get("conversations", F.lit(i))
        return F.coalesce(*(F.nullif(turn[c], F.lit("")) for c in ("value", "content", "text") if c in fields), F.lit(""))

    talk = (own_i == "") & (own_o == "") & (F.coalesce(F.size("conversations"), F.lit(0)) > 0)
    return F.when(talk, said(0)).otherwise(any_i), F.when(talk, said(1)).otherwise(any_o), talk | some


@register_filter("sft_rules")
def sft_rules(
    text_field: str = "text", instruction_field: str = "instruction", output_field: str = "output", min_output_words: int = 5, min_output_words_closed_form: int = 1,
    min_instruction_words_for_short_check: int = 20, max_copy_similarity: float = 0.80, refusal_patterns: tuple[str, ...] = REFUSALS,
    soft_refusal_patterns: tuple[str, ...] = SOFT_REFUSALS, min_words_after_refusal: int = 50, lang_mismatch_threshold: float = 0.3,
) -> Filter:
    def signals(df: DataFrame) -> DataFrame:
        i, o, some = sft_fields(df, instruction_field, output_field)
        df = df.withColumns({"__i": i, "__o": o, "__some": some})
        i, o = F.col("__i"), F.col("__o")
        head = F.lower(T.strip(o))

        def prefix(patterns: tuple[str, ...]) -> Column:
            out = F.lit(None).cast("string")
            for p in reversed(patterns):
                out = F.when(head.startswith(p.lower()), F.lit(p.lower())).otherwise(out)
            return out

        df = df.withColumns({"__blank": T.strip(o) == "", "__iw": T.word_count(i), "__ow": T.word_count(o), "__hard": prefix(refusal_patterns), "__soft": prefix(soft_refusal_patterns)})
        asked = F.when(F.regexp_like(i, F.lit(CLOSED_FORM)), min_output_words_closed_form).otherwise(min_output_words)
        return df.withColumns({
            "__least": asked, "__copy": F.when(F.col("__blank"), 0.0).otherwise(T.trigram_similarity(i, o)),
            "__refusal": F.coalesce("__hard", F.when(F.col("__ow") < min_words_after_refusal, F.col("__soft"))), "__cjk": F.abs(T.cjk_ratio(i, SFT_CJK) - T.cjk_ratio(o, SFT_CJK)),
        })

    def rules() -> list[Rule]:
        some, blank = F.col("__some"), F.col("__blank")
        return [
            Rule("missing_sft_fields", ~some, F.lit("instruction/output required"), is_text=True), Rule("empty_output", some & blank, F.lit(0), 1),
            Rule("output_too_short", some & (F.col("__iw") >= min_instruction_words_for_short_check) & (F.col("__ow") < F.col("__least")), F.col("__ow"), min_output_words),
            Rule("instruction_copy", some & ~blank & (F.col("__copy") > max_copy_similarity), F.round("__copy", 3), max_copy_similarity),
            Rule("ai_refusal", some & ~blank & F.col("__refusal").isNotNull(), F.col("__refusal"), is_text=True),
            Rule("language_mismatch", some & ~blank & (F.col("__i") != "") & (F.col("__cjk") > lang_mismatch_threshold), F.round("__cjk", 2), lang_mismatch_threshold),
        ]

    return Filter("sft_rules", rules, signals, text_field=text_field)


@register_filter("arxiv")
def arxiv(text_field: str = "text", max_latex_residual: float = 0.05, require_abstract: bool = False, min_sections: int = 2) -> Filter:
    from ..functions import latex

    def signals(df: DataFrame) -> DataFrame:
        df = df.withColumn("__clean", latex.cleaned(T.text_of(text_field)))
        clean = F.col("__clean")
        return df.withColumns({"__residual": latex.residual(clean), "__abstract": F.regexp_like(clean, F.lit(r"(?i)(?:^|\n)#{1,4}\s*abstract")), "__sections": T.count(clean, r"(?m)^#{1,4}\s+")})

    def rules() -> list[Rule]:
        missing = ~F.col("__abstract") if require_abstract else F.lit(False)
        return [
            Rule("latex_residual", F.col("__residual") > max_latex_residual, F.round("__residual", 4), max_latex_residual), Rule("missing_abstract", missing, F.lit(0), 1),
            Rule("too_few_sections", F.col("__sections") < min_sections, F.col("__sections"), min_sections),
        ]

    return Filter("arxiv", rules, signals, lambda df: F.col("__clean"), text_field)


# Languages with word lists, those matched without word borders, and exceptions.
BADWORD_LANGS = (
    "ar", "cs", "da", "de", "en", "eo", "es", "fa", "fi", "fil", "fr", "fr-CA-u-sd-caqc", "hi", "hu", "it", "ja", "kab", "ko", "nl", "no", "pl", "pt", "ru", "sv", "th", "tlh", "tr", "zh",
)
UNBROKEN_LANGS = ("ja", "th", "zh")
ALLOWED = {"ja": ("sm", "グロ", "女の子"), "zh": ("性",)}


@register_filter("badwords")
def badwords(word_lists: dict[str, list[str]] | None = None, text_field: str = "text", default_language: str = "en", language_field: str = "language") -> Filter:
    """word_lists: words by language, given by the caller. Languages without a list pass; an unknown language counts as the default one."""
    import re

    lists = {k: [w for w in v if w and w not in ALLOWED.get(k, ())] for k, v in (word_lists or {}).items()}

    def signals(df: DataFrame) -> DataFrame:
        nested = "metadata" in df.columns and language_field in getattr(df.schema["metadata"].dataType, "names", ())
        own = F.col(f"metadata.{language_field}") if nested else F.col(language_field) if language_field in df.columns else F.lit(None).cast("string")
        lang = F.when(own.isin(*BADWORD_LANGS), own).otherwise(F.lit(default_language))
        low, hit = F.lower(T.text_of(text_field)), F.lit(False)
        for k, ws in sorted(lists.items()):
            if ws and k in BADWORD_LANGS:
                any_of = "|".join(re.escape(w).replace(r"\ ", " ") for w in ws)
                pattern = any_of if k in UNBROKEN_LANGS else rf"(?U)(?:\W|^)({any_of})(?:\W|$)"
                hit = F.when(lang == k, F.regexp_like(low, F.lit(pattern))).otherwise(hit)
        return df.withColumns({"__lang": lang, "__bad": (T.strip(low) != "") & hit})

    return Filter("badwords", lambda: [Rule("badwords", F.col("__bad"), F.col("__lang"), is_text=True)], signals, text_field=text_field)


@register_filter("language")
def language(text_field: str = "text", languages: list[str] | None = None, language_threshold: float = 0.65, label_only: bool = False, scores: str = "lang_scores") -> Filter:
    """Decides by a map column of scores by language, which any model may fill; see ``with_language_scores``. Scores must be above the threshold."""
    def signals(df: DataFrame) -> DataFrame:
        m = F.coalesce(F.col(scores), F.create_map().cast("map<string,double>"))
        asked = F.map_filter(m, lambda k, v: k.isin(*languages)) if languages else m
        return df.withColumns({"__best": F.coalesce(F.array_max(F.map_values(asked)), F.lit(0.0)), "__empty": T.strip(T.text_of(text_field)) == ""})

    def rules() -> list[Rule]:
        low = F.lit(False) if label_only else ~F.col("__empty") & (F.col("__best") <= language_threshold)
        return [Rule("empty_text", F.col("__empty"), F.lit(0), 1), Rule("language", low, F.col("__best"), language_threshold)]

    return Filter("language", rules, signals, text_field=text_field)


@register_filter("fasttext_quality")
def fasttext_quality(text_field: str = "text", score: str = "quality_score", threshold: float = 0.5) -> Filter:
    """Keeps what a quality model scores at the threshold or above; without a score a row passes."""
    return Filter("fasttext_quality", lambda: [Rule("low_quality", F.coalesce(F.col(score) < threshold, F.lit(False)), F.col(score), threshold)], text_field=text_field)


@register_filter("perplexity")
def perplexity(text_field: str = "text", score: str = "perplexity", min_ppl: float = 5.0, max_ppl: float = 1000.0) -> Filter:
    def rules() -> list[Rule]:
        p, no = F.col(score), F.lit(False)
        return [Rule("perplexity_too_low", F.coalesce(p < min_ppl, no), p, min_ppl), Rule("perplexity_too_high", F.coalesce(p > max_ppl, no), p, max_ppl)]

    return Filter("perplexity", rules, text_field=text_field)
