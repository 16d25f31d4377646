import re

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import repetition
from corpusmill.functions import text as T
from corpusmill.operators import filters, rules

GOOD = " ".join(["The quick brown fox jumps over the lazy dog and runs to the hills with great joy."] * 1 + [f"Sentence number {w} tells of the town and that people have been kind to travellers." for w in "one two three four five six seven".split()])


def failed(spark, name, texts, mode="rule", **params):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    out = rules.with_failures(df, rules.make_filter(name, **params)).orderBy("id").collect()
    return [[f[mode] for f in r.failures] for r in out]


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "text string").select(column(F.col("text"))).first()[0]


def test_gopher_quality_rules(spark):
    got = failed(spark, "gopher_quality", [GOOD, "too short", None, "1 2 3 " * 40, "word " * 60, "# " + GOOD.replace(" ", " # "), "- a b c\n- d e f\n" * 20])
    assert got[0] == []
    assert {"min_words", "stopwords"} <= set(got[1]) and "min_words" in got[2]
    assert "alpha_ratio" in got[3] and got[4] == ["stopwords"] and "hash_ratio" in got[5] and "bullet_lines_ratio" in got[6]
    assert failed(spark, "gopher_quality", ["too short"], "reason")[0][0] == "too_few_words"


def test_thresholds_are_strict(spark):
    assert "min_words" not in failed(spark, "gopher_quality", ["the of " * 25])[0]
    assert "min_words" in failed(spark, "gopher_quality", ["the of " * 24 + "the"])[0]


@pytest.mark.parametrize("text", ["", "a b", "x ... # — hi!", "中文字符测试 hello 世界", "é b\x1cc d", "--- *** a.b", "\n- x\n• y\n"])
def test_counts_agree_with_plain_python(spark, text):
    def words(t):
        cjk = len(re.findall(r"[一-鿿㐀-䶿⺀-⻿　-〿豈-﫿]", t))
        alpha = sum(c.isalpha() for c in t)
        if alpha and cjk / alpha > 0.3:
            out = []
            for s in t.split():
                out += re.findall(r"[一-鿿㐀-䶿豈-﫿]|[a-zA-Z]+", s) if re.search("[一-鿿]", s) else [s]
            return out
        return t.split()

    w = words(text)
    assert one(spark, T.n_words, text) == len(w)
    assert one(spark, T.words, text) == w
    assert one(spark, T.alpha_words, text) == sum(any(c.isalpha() for c in x) for x in w)
    real = [x for x in w if re.search(r"[^\W_]", x)]
    assert one(spark, T.word_count, text) == len(real)
    assert one(spark, T.word_chars, text) == sum(map(len, real))
    assert one(spark, T.lines, text) == text.splitlines()


def test_repetition(spark):
    line = "This line is said again and again.\n"
    got = failed(spark, "gopher_repetition", [" ".join(f"word{i}" for i in range(80)), line * 10, "a b " * 50, "Para one.\n\n" * 5])
    assert got[0] == [] and {"dup_line_ratio", "dup_line_char_frac"} <= set(got[1])
    assert {"top_2gram", "dup_5gram_frac"} <= set(got[2]) and "dup_para_ratio" in got[3]
    assert repetition.top_share(["a", "b", "a", "b"], 2, 7) == 6 / 7 and repetition.dup_share(["a", "b"] * 5, 5, 19) == 5 / 19
    assert repetition.dup_share(list("abcde") * 2, 5, 19) == 5 / 19


def test_c4_lines(spark):
    text = 'One is here. Two too.\nno end\nThree is "here"\nUse JavaScript now.\nRead our privacy policy.\nFour...\nFive! Six? Seven.'
    f = rules.make_filter("c4")
    df = spark.createDataFrame([(text,), ("Bad lorem ipsum.",), ("lorem ipsum\nGood. One. Two. Three. Four.",), ("",), ("a { b.",)], "text string")
    out = f.signals(df).withColumn("failures", rules.failures(f)).collect()
    assert out[0]["__text"] == 'One is here. Two too.\nThree is "here"\nFive! Six? Seven.'
    assert [x.rule for x in out[0].failures] == []
    assert [x.rule for x in out[1].failures] == ["lorem_ipsum", "empty_after_line_filter"]
    assert [x.rule for x in out[2].failures] == [] and [x.rule for x in out[3].failures] == ["empty_after_line_filter"]
    assert failed(spark, "c4", ["a { b."], remove_curly_brace=True)[0][0] == "curly_brace"


def test_fineweb(spark):
    got = failed(spark, "fineweb", ["", "Long enough line that ends well with a full stop.\n" + "Another line of this text that also ends well.", "short\n" * 9, "Same line that is rather long and ends well.\n" * 3])
    assert got[0] == ["empty_doc"] and got[1] == [] and {"line_punct_ratio", "short_line_ratio", "char_dup_ratio", "list_ratio"} == set(got[2]) and "char_dup_ratio" in got[3]
    assert "line_punct_ratio" not in failed(spark, "fineweb", ["no end"], line_punct_exclude_zero=True)[0]


def test_pii_counts_and_redaction(spark):
    text = "Mail a.b@c.org from 8.8.8.8 not 10.0.0.1, call 13912345678, id 11010519491231002X, card 6222021234567890."
    df = spark.createDataFrame([(text,)], "text string")
    got = df.select(*(v.alias(k) for k, v in filters.pii_counts(F.col("text")).items())).first()
    assert got.asDict() == {"email": 1, "ip": 1, "cn_phone": 1, "cn_id": 1, "bank_card": 2}
    clean = df.select(filters.redacted(F.col("text"))).first()[0]
    assert clean == "Mail email@example.com from 0.0.0.0 not 10.0.0.1, call 1XXXXXXXXXX, id XXXXXXXXXXXXXXXXXX, card XXXXXXXXXXXXXXXX."
    with pytest.raises(ValueError):
        rules.make_filter("pii", mode="x")


def test_sft_rules(spark):
    long = "Please explain in detail " + "why the sky looks blue to people who stand on the ground and look up at it during the day"
    rows = [
        ("Explain this", "A proper answer of some words.", None), (long, "Because.", None), ("Same text for both sides here", "Same text for both sides here", None), ("Hi", "I cannot do that for you.", None),
        ("Hi", "As an AI, " + "word " * 60, None), ("Hi", "As an AI, no.", None), ("Hi there", " ", None), (None, None, [("a question for you", None), ("an answer to it", None)]), (None, None, None), ("Translate", "这是中文的回答内容", None),
        ("Classify " + long, "Yes", None),
    ]
    df = spark.createDataFrame(rows, "instruction string, output string, conversations array<struct<value:string,content:string>>")
    got = [[f.rule for f in r.failures] for r in rules.with_failures(df, rules.make_filter("sft_rules")).collect()]
    assert got == [[], ["output_too_short"], ["instruction_copy"], ["ai_refusal"], [], ["ai_refusal"], ["empty_output"], [], ["missing_sft_fields"], ["language_mismatch"], []]


def test_badwords_language_and_scores(spark):
    df = spark.createDataFrame([("A darn thing", "en"), ("darnation", "en"), ("DARN!", "xx"), ("坏词在内", "zh"), ("darn", "de"), ("", "en")], "text string, language string")
    f = rules.make_filter("badwords", word_lists={"en": ["darn"], "zh": ["坏词", "性"]})
    assert [len(r.failures) for r in rules.with_failures(df, f).collect()] == [1, 0, 1, 1, 0, 0]
    df = spark.createDataFrame([("a", {"en": 0.9}), ("a", {"en": 0.65}), ("a", {"fr": 0.9}), (" ", {"en": 1.0}), ("a", None)], "text string, lang_scores map<string,double>")
    got = [[f.rule for f in r.failures] for r in rules.with_failures(df, rules.make_filter("language", languages=["en"])).collect()]
    assert got == [[], ["language"], ["language"], ["empty_text"], ["language"]]


def test_arxiv_cleaning(spark):
    md = "# 1 Title\n\n## 2.1 Part\nAs shown by smith2020deep , it is $a_1 \\alpha$ .\n\n```\ncode  smith2020deep\n```\n\\foo{x} end\n\n$$a % note\n + $b$$$\n| a |\n\n| b |"
    f = rules.make_filter("arxiv")
    out = f.signals(spark.createDataFrame([(md,), ("plain",)], "text string")).withColumn("failures", rules.failures(f)).collect()
    clean = out[0]["__clean"]
    assert "## Part" in clean and "smith2020deep ," not in clean and "$a_1 \\alpha$" in clean and "code  smith2020deep" in clean and "| a |\n| b |" in clean
    assert out[0].failures == [] and [x.rule for x in out[1].failures] == ["too_few_sections"]


def test_chain_rewrites_only_when_asked(spark):
    chain = [rules.make_filter("pii"), rules.make_filter("badwords", word_lists={"en": ["example"]})]
    df = spark.createDataFrame([("write to a@b.com",)], "text string")
    assert rules.verdicts(df, chain).first().failures == [] and rules.verdicts(df, chain).first().text == "write to a@b.com"
    changed = rules.verdicts(df, chain, mutate=True).first()
    assert changed.text == "write to email@example.com" and [f.rule for f in changed.failures] == ["badwords"]


def test_unknown_filter():
    with pytest.raises(ValueError):
        rules.make_filter("nothing")
