"""Text expressions: counts and ratios over words, lines and characters, as Columns.

Words are runs of characters other than white space. Counting is done by regular expressions over the text, which stays in generated
code; arrays of words are made only where a definition needs the words themselves. Java's classes are ASCII by default, so white
space and letters are spelt out to mean the same code points for all texts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space, CJK ranges, ends of sentences, stop words.
SPACE = r"\s\x0B\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
CJK = r"\u4E00-\u9FFF\u3400-\u4DBF\u2E80-\u2EFF\u3000-\u303F\uF900-\uFAFF\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
CJK_WORD = r"[\u4E00-\u9FFF\u3400-\u4DBF\uF900-\uFAFF]|[a-zA-Z]+"
SENTENCE_END = ".!?。！？"
STOP_WORDS = ("the", "be", "to", "of", "and", "that", "have", "with")
LINE_BREAK = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85\u2028\u2029]"

#: Characters of words that are nothing but symbols: punctuation, symbols and control characters.
SYMBOL = r"\p{P}\p{S}\p{Cntrl}"


def let(value: Column, body) -> Column:
    """body of a value that is worked out once: what a lambda refers to outside itself is worked out again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(empty))


def strip(text: Column) -> Column:
    """Without white space at both ends. The first and the last character tell whether there is any."""
    ends = F.concat(F.substring(text, 1, 1), F.substring(text, -1, 1))
    cut = F.regexp_replace(F.regexp_replace(text, rf"^[{SPACE}]+", ""), rf"(?<![{SPACE}])[{SPACE}]+$", "")
    return F.when(F.regexp_like(ends, F.lit(f"[{SPACE}]")), cut).otherwise(text)


def letters(text: Column) -> Column:
    return count(text, r"\p{L}")


def cjk_ratio(text: Column, ranges: str = CJK) -> Column:
    return ratio(count(text, f"[{ranges}]"), letters(text))


def is_cjk(text: Column, threshold: float = 0.3) -> Column:
    # A cheap look first: most texts have no such character.
    return F.when(F.regexp_like(text, F.lit(f"[{CJK}]")), cjk_ratio(text) > threshold).otherwise(False)


def plain_words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def cjk_words(text: Column) -> Column:
    """Of segments between white space, those with CJK characters give each such character and each run of a-z, others stay whole."""
    return F.flatten(F.transform(plain_words(text), lambda s: F.when(F.regexp_like(s, F.lit(f"[{CJK}]")), F.regexp_extract_all(s, F.lit(CJK_WORD), F.lit(0))).otherwise(F.array(s))))


def words(text: Column) -> Column:
    return F.when(is_cjk(text), cjk_words(text)).otherwise(plain_words(text))


def _per_words(text: Column, plain: Column, of_array) -> Column:
    """plain for most texts, of_array(words) for texts of CJK."""
    return F.when(is_cjk(text), of_array(cjk_words(text))).otherwise(plain)


# White space and symbols below U+0250, as plain ranges, which are quicker to match than classes by property.
LATIN_SPACE = r"\x09-\x0D\x1C-\x20\x85\xA0"
LATIN_SYMBOL = r"\x00-\x08\x0E-\x1B!-/:-@\[-`{-\x7F\xA1-\xA9\xAB\xAC\xAE-\xB1\xB4\xB6-\xB8\xBB\xBF\xD7\xF7"


def _by_script(text: Column, pattern: str, symbol: str, body) -> Column:
    """body of the pattern with its {s} and {p}, white space and symbols, put in: by plain ranges for texts of Latin letters, else by all of Unicode."""
    put = lambda space, marks: pattern.replace("{s}", space).replace("{p}", marks)
    latin = (F.length(text) == F.octet_length(text)) | ~F.regexp_like(text, F.lit(r"[^\x00-\u024F]"))
    return F.when(latin, body(put(LATIN_SPACE, LATIN_SYMBOL))).otherwise(body(put(SPACE, symbol)))


def n_words(text: Column) -> Column:
    return _per_words(text, _by_script(text, "[^{s}]+", "", lambda p: count(text, p)), F.size)


def _real(w: Column) -> Column:
    return F.regexp_like(w, F.lit(rf"[^{SYMBOL}{SPACE}]"))


def word_count(text: Column) -> Column:
    """Words that are more than symbols."""
    plain = _by_script(text, "(?<![^{s}])[{p}]*+[^{s}]+", rf"{SYMBOL}&&[^{SPACE}]", lambda p: count(text, p))
    return _per_words(text, plain, lambda a: F.size(F.filter(a, _real)))


def word_chars(text: Column) -> Column:
    """Characters of those words."""
    plain = _by_script(text, "(?<![^{s}])[{p}]++(?![^{s}])|[{s}]+", rf"{SYMBOL}&&[^{SPACE}]", lambda p: F.length(F.regexp_replace(text, p, "")))
    return _per_words(text, plain, lambda a: F.aggregate(F.filter(a, _real), F.lit(0), lambda n, w: n + F.length(w)))


def avg_word_length(text: Column) -> Column:
    return ratio(word_chars(text), word_count(text))


def alpha_words(text: Column) -> Column:
    """Words with a letter."""
    return _per_words(text, count(text, rf"[^{SPACE}\p{{L}}]*+\p{{L}}[^{SPACE}]*+"), lambda a: F.size(F.filter(a, lambda w: F.regexp_like(w, F.lit(r"\p{L}")))))


def alpha_ratio(text: Column) -> Column:
    return ratio(alpha_words(text), n_words(text))


def hash_ratio(text: Column) -> Column:
    return ratio(count(text, "#"), n_words(text))


def ellipsis_ratio(text: Column) -> Column:
    return ratio(count(text, r"\.\.\.|…"), n_words(text))


def stop_words(text: Column, stops: tuple[str, ...] = STOP_WORDS) -> Column:
    """How many of the stop words occur, whatever their number: searched between blanks in the text with all white space made blanks."""
    def found(t: Column) -> Column:
        out = F.lit(0)
        for w in stops:
            out = out + t.contains(f" {w} ").cast("int")
        return out

    blanks = F.concat(F.lit(" "), F.regexp_replace(text, _blank_class(), " "), F.lit(" "))
    return _per_words(text, let(blanks, found), lambda a: F.size(F.array_intersect(a, F.array(*map(F.lit, stops)))))


def _blank_class() -> str:
    """White space other than the blank itself."""
    return r"[\x09-\x0D\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def lines(text: Column) -> Column:
    """Lines at any line break; a break at the end begins no line."""
    def of(parts: Column) -> Column:
        whole = F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
        return F.when((F.size(parts) == 1) & (F.element_at(parts, 1) == ""), F.array().cast("array<string>")).otherwise(whole)

    return let(F.split(text, LINE_BREAK), of)


def share(items: Column, holds) -> Column:
    return ratio(F.size(F.filter(items, holds)), F.size(items))


def bullet_lines_ratio(text: Column) -> Column:
    return let(lines(text), lambda a: share(a, lambda x: F.regexp_like(x, F.lit(rf"^[{SPACE}]*[•-]"))))


def ellipsis_lines_ratio(text: Column) -> Column:
    return let(lines(text), lambda a: share(a, lambda x: F.regexp_like(x, F.lit(rf"(?:\.\.\.|…)[{SPACE}]*$"))))


def punct_lines_ratio(text: Column) -> Column:
    full = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")
    return share(full, lambda x: F.regexp_like(x, F.lit(r"[.!?;。！？；]$")))


def sentences(text: Column) -> Column:
    """Stretches that end with an end of sentence; without one, a text that isn't blank is one."""
    # Every end closes one stretch, so the ends are counted; matching the stretches would take time with the square of a text without any.
    found = count(text, f"[{SENTENCE_END}]")
    return F.when(found > 0, found).otherwise((strip(text) != "").cast("int"))


def _parts(text: Column, pattern: str) -> Column:
    return F.filter(F.split(text, pattern), lambda x: x != "")


def dup_lines(text: Column) -> Column:
    return _parts(text, "\n+")


def dup_paragraphs(text: Column) -> Column:
    return _parts(strip(text), "\n{2,}")


def _chars(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda n, x: n + F.length(x))


def dup_ratio(items: Column) -> Column:
    """Share of items that equal an earlier one."""
    return ratio(F.size(items) - F.size(F.array_distinct(items)), F.size(items))


def dup_char_frac(items: Column, text: Column) -> Column:
    return ratio(_chars(items) - _chars(F.array_distinct(items)), F.length(text))


def _slices(t: Column, n: int) -> Column:
    """All strings of n characters of a text that has as many. Cut from an array of characters: a place in a text is found by walking to it."""
    def of(chars: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(chars) - n + 1), lambda i: F.array_join(F.slice(chars, i, F.lit(n)), ""))

    return let(F.split(t, ""), of)


def char_repetition(text: Column, n: int = 10) -> Column:
    """Share of characters in repeated strings of n characters, at most 1."""
    def of(t: Column) -> Column:
        return F.when(F.length(t) < n, 0.0).otherwise(let(_slices(t, n), lambda g: F.least(F.lit(1.0), (F.size(g) - F.size(F.array_distinct(g))) * n / F.length(t))))

    return let(text, of)


def char_ngrams(text: Column, n: int) -> Column:
    return let(strip(F.lower(text)), lambda t: F.when(F.length(t) < n, F.array(t)).otherwise(_slices(t, n)))


def simple_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w+"), F.lit(0))


def word_ngrams(items: Column, n: int) -> Column:
    def of(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.slice(w, i, F.lit(n)))
        return F.when(F.size(w) < n, F.array().cast("array<array<string>>")).otherwise(grams)

    return let(items, of)


#: White space of Latin texts other than the blank, and white space that only other texts have.
_LATIN_BLANKS = ("\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0")
_OTHER_SPACE = r"[\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def squeezed(text: Column) -> Column:
    """White space made single blanks, none at the ends. Plain replacements where a text has no white space but that of Latin texts, as nearly all have."""
    plain = text
    for c in _LATIN_BLANKS:
        plain = F.replace(plain, F.lit(c), F.lit(" "))
    plain = let(plain, lambda t: F.when(t.contains("  "), F.regexp_replace(t, " {2,}", " ")).otherwise(t))
    ascii_only = F.length(text) == F.octet_length(text)
    whole = F.regexp_replace(text, f"{_blank_class()}[{SPACE}]*+| [{SPACE}]++", " ")
    return F.trim(F.when(ascii_only | ~F.regexp_like(text, F.lit(_OTHER_SPACE)), plain).otherwise(whole))


def dedup_normal(text: Column) -> Column:
    return let(F.lower(text), squeezed)


def sha256(text: Column) -> Column:
    return F.sha2(dedup_normal(text), 256)


def benchmark_normal(text: Column) -> Column:
    """Lower case, ASCII punctuation deleted, white space made single blanks."""
    return let(F.regexp_replace(F.lower(text), r"[!-/:-@\[-`{-~]++", ""), squeezed)


def trigram_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of the sets of three characters of lower-cased, stripped texts; where one has none, whether they are equal."""
    def grams(t: Column) -> Column:
        return F.when(F.length(t) < 3, F.array().cast("array<string>")).otherwise(F.array_distinct(_slices(t, 3)))

    def of(v: Column) -> Column:
        p, q = F.size(v["p"]), F.size(v["q"])
        common = F.size(F.array_intersect(v["p"], v["q"]))
        return F.when((v["x"] == "") | (v["y"] == ""), 0.0).when((p == 0) | (q == 0), (v["x"] == v["y"]).cast("double")).otherwise(common / (p + q - common))

    texts = F.struct(strip(F.lower(a)).alias("x"), strip(F.lower(b)).alias("y"))
    return let(let(texts, lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"), grams(v["x"]).alias("p"), grams(v["y"]).alias("q"))), of)


def latex_residual(text: Column) -> Column:
    """Share of characters outside formulas that belong to LaTeX commands."""
    plain = F.regexp_replace(F.regexp_replace(text, r"(?s)\$\$.*?\$\$", ""), r"(?<!\$)\$(?!\$)(?!\s)[^$]+?\$(?!\$)", "")
    return ratio(F.length(plain) - F.length(F.regexp_replace(plain, r"\\[a-zA-Z]+(?:\{[^}]*\})*", "")), F.length(plain))


def structure(text: Column) -> Column:
    """What a paper in Markdown has: title, abstract, sections, formulas, code blocks."""
    heads = count(text, r"(?m)^#+\s+")
    return F.struct(
        F.regexp_like(text, F.lit(rf"^[{SPACE}]*#")).alias("has_title"), F.regexp_like(text, F.lit(r"(?i)(?:^|\n)#+\s*abstract")).alias("has_abstract"),
        (heads > 0).alias("has_sections"), heads.alias("num_sections"), F.floor(count(text, r"\$\$") / 2).cast("int").alias("num_equations_display"),
        count(text, r"(?<!\$)\$(?!\$)(?!\s)[^$]+?\$(?!\$)").alias("num_equations_inline"), F.floor(count(text, "```") / 2).cast("int").alias("num_code_blocks"),
    )


def detected_format(text: Column) -> Column:
    """html, latex or text, by what a text begins with and holds."""
    head = F.lower(F.substring(text, 1, 500))
    html = head.contains("<html") | head.contains("<!doctype")
    return F.when(html, "html").when(text.contains(r"\begin{document}") | F.substring(text, 1, 500).contains(r"\documentclass"), "latex").otherwise("text")


def camel_twice(text: Column) -> Column:
    """A capitalised word that is followed by itself in lower case becomes one: Mainmain is Main."""
    return F.regexp_replace(text, r"\b([A-Z][a-z]+)(?i:\1)\b", "$1")
