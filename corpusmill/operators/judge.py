"""Judging by a language model: rules, prompts and the reading of answers as expressions; the model is a function that the caller gives."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@dataclass(frozen=True)
class JudgeRule:
    """mode binary: passes or fails; mode score: 1 to max_score, passes from threshold on. scope: universal, sft or pretrain."""

    name: str
    description: str
    scope: str = "universal"
    mode: str = "binary"
    threshold: float = 1.0
    max_score: int = 1


# The built-in rules and the words of the prompt.
RULES = (
    JudgeRule("factuality", "Are there any obvious factual errors? PASS if no errors, FAIL if contains fabricated facts or wrong information."),
    JudgeRule("coherence", "Is the text well-structured and logically organized? PASS if coherent, FAIL if fragmented, contradictory, or garbled."),
    JudgeRule("harmlessness", "Is the content safe and appropriate? PASS if safe, FAIL if contains dangerous instructions, discrimination, or harmful content."),
    JudgeRule("instruction_following", "Does the response directly address what the instruction asks for? PASS if yes, FAIL if off-topic or ignores key requirements.", "sft"),
    JudgeRule("completeness", "Does the response cover what the instruction asks for? PASS if complete, FAIL if missing critical steps or incomplete answer.", "sft"),
    JudgeRule("format_compliance", "If the instruction specifies a format, does the response follow it? PASS if correct or no format specified, FAIL if wrong format.", "sft"),
    JudgeRule("information_density", "Does the text contain substantive, informative content? PASS if yes, FAIL if ads, navigation menus, cookie notices, or boilerplate.", "pretrain"),
    JudgeRule("originality", "Does the text appear to be original content? PASS if original, FAIL if SEO spam, template-generated, or machine-generated filler.", "pretrain"),
)
TEMPLATE = {
    "system": "You are a quality judge. Evaluate the content against these rules and return structured JSON.",
    "rules_header": "Rules:", "input_header_text": "Text:", "input_header_sft_instruction": "Instruction:", "input_header_sft_response": "Response:",
    "trailer": "Respond with ONLY valid JSON in this exact format:",
}
MAX_CHARS = 4000


def rules_for(scope: str, overrides: dict[str, dict] | None = None) -> list[JudgeRule]:
    """The rules of a scope and the universal ones; overrides change fields by rule name, None drops a rule, unknown names are new rules."""
    out = {r.name: r for r in RULES}
    for name, fields in (overrides or {}).items():
        if fields is None:
            out.pop(name, None)
        else:
            out[name] = replace(out[name], **fields) if name in out else JudgeRule(name, **fields)
    return [r for r in out.values() if r.scope in ("universal", scope)]


def prompt(rules: list[JudgeRule], text: Column | None = None, instruction: Column | None = None, output: Column | None = None, template: dict | None = None) -> Column:
    """The prompt as an expression: everything but the content is one literal."""
    t = TEMPLATE | {k: v for k, v in (template or {}).items() if k in TEMPLATE and v}
    said, shape = [], []
    for i, r in enumerate(rules, 1):
        if r.mode == "score":
            said.append(f"{i}. {r.name} [score 1..{int(r.max_score)}, pass ≥ {r.threshold}]: {r.description}")
            shape.append(f'  "{r.name}": {{"score": <integer 1..{int(r.max_score)}>, "reason": "brief justification"}}')
        else:
            said.append(f"{i}. {r.name} [PASS/FAIL]: {r.description}")
            shape.append(f'  "{r.name}": {{"pass": true/false, "reason": "brief explanation if failed"}}')
    head = f"{t['system']}\n\n{t['rules_header']}\n" + "\n".join(said) + "\n\n"
    tail = f"\n\n{t['trailer']}\n{{\n" + ",\n".join(shape) + "\n}"
    cut = lambda c: F.substring(F.coalesce(c, F.lit("")), 1, MAX_CHARS)
    if instruction is not None and output is not None:
        content = F.concat(F.lit(f"{t['input_header_sft_instruction']} "), cut(instruction), F.lit(f"\n\n{t['input_header_sft_response']} "), cut(output))
    else:
        content = F.concat(F.lit(f"{t['input_header_text']} "), cut(text))
    return F.concat(F.lit(head), content, F.lit(tail))


def parsed(answer: Column, rules: list[JudgeRule]) -> Column:
    """array<struct<rule, pass, score, reason>>: from JSON that has all rules, else by patterns, else failed."""
    entry = "struct<pass:boolean,score:double,reason:string>"
    read = F.from_json(F.trim(answer), "struct<" + ",".join(f"`{r.name}`:{entry}" for r in rules) + ">")
    whole = F.coalesce(F.lit(True), F.lit(True))
    for r in rules:
        whole = whole & read[r.name].isNotNull()
    out = []
    for r in rules:
        flag = F.lower(F.regexp_extract(answer, rf'(?is)"{r.name}":\s*\{{[^}}]*"pass":\s*(true|false)', 1))
        mark = F.regexp_extract(answer, rf'(?is)"{r.name}":\s*\{{[^}}]*"score":\s*(\d+(?:\.\d+)?)', 1)
        ok = F.when(whole, F.coalesce(read[r.name]["pass"], F.lit(False))).otherwise(flag == "true")
        score = F.when(whole, F.coalesce(read[r.name]["score"], F.lit(0.0))).otherwise(F.coalesce(F.nullif(mark, F.lit("")).cast("double"), F.lit(0.0)))
        reason = F.when(whole, F.coalesce(read[r.name]["reason"], F.lit(""))).when((flag == "") & (mark == ""), "Parse error — defaulted to fail").otherwise("")
        passes = score >= r.threshold if r.mode == "score" else ok
        out.append(F.struct(F.lit(r.name).alias("rule"), F.coalesce(passes, F.lit(False)).alias("pass"), F.coalesce(score if r.mode == "score" else ok.cast("double"), F.lit(0.0)).alias("score"), reason.alias("reason")))
    return F.array(*out)


def judged(df: DataFrame, rules: list[JudgeRule], answer: Column) -> DataFrame:
    """df with ``verdicts``, ``failed_rules`` and ``quality``: high if none fails."""
    df = df.withColumn("verdicts", parsed(answer, rules))
    df = df.withColumn("failed_rules", F.transform(F.filter("verdicts", lambda v: ~v["pass"]), lambda v: v["rule"]))
    return df.withColumn("quality", F.when(F.size("failed_rules") == 0, "high").otherwise("low"))


def asked(ask: Callable[[str], str], retries: int = 3, delay: float = 1.0):
    """An Arrow UDF that asks the model for each prompt, again after longer and longer pauses; what fails to the end answers with nothing."""
    @F.pandas_udf(StringType())
    def answers(prompts: pd.Series) -> pd.Series:
        import time

        def one(p: str) -> str:
            for k in range(retries):
                try:
                    return ask(p)
                except Exception:
                    if k + 1 < retries:
                        time.sleep(delay * (k + 1))
            return ""

        return prompts.map(one)

    return answers


def score_summary(df: DataFrame) -> DataFrame:
    """(rule, scored, failed, mean_score) over judged rows, and a row named quality with the high ones as its mean."""
    each = df.select(F.explode("verdicts").alias("v")).groupBy(F.col("v.rule").alias("rule")).agg(F.count(F.lit(1)).alias("scored"), F.sum((~F.col("v.pass")).cast("long")).alias("failed"), F.avg("v.score").alias("mean_score"))
    high = (F.col("quality") == "high").cast("long")
    return each.union(df.agg(F.count(F.lit(1)).alias("scored"), F.coalesce(F.sum(1 - high), F.lit(0)).alias("failed"), F.avg(high).alias("mean_score")).select(F.lit("quality").alias("rule"), "scored", "failed", "mean_score"))


def prompted(df: DataFrame, rules: list[JudgeRule], text_field: str = "text", template: dict | None = None) -> Column:
    """The prompt of a row: of its instruction and output where it has such columns, else of its text."""
    if "instruction" in df.columns and "output" in df.columns:
        return prompt(rules, instruction=F.col("instruction"), output=F.col("output"), template=template)
    return prompt(rules, text=F.col(text_field), template=template)


def split(df: DataFrame, ask: Callable[[str], str], scope: str = "pretrain", overrides: dict[str, dict] | None = None, text_field: str = "text", retries: int = 3, delay: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(documents of high quality, the others with the rule that they failed first) by the model's answers, each document asked about once.

    Answers are written to the shared folder before rows are split by them, so that no document is asked about twice.
    """
    from .dedup import saved

    rules = rules_for(scope, overrides)
    done = saved(judged(df, rules, asked(ask, retries, delay)(prompted(df, rules, text_field))), "judged")
    rule = F.concat(F.lit("llm_"), F.coalesce(F.get("failed_rules", F.lit(0)), F.lit("unknown")))
    return done.filter("quality = 'high'").select(*df.columns), done.filter("quality <> 'high'").withColumn("rule", rule)


def scored_sample(df: DataFrame, ask: Callable[[str], str], n: int = 50, key: str = "doc_id", scope: str = "pretrain", overrides: dict[str, dict] | None = None, text_field: str = "text", seed: int = 42, retries: int = 3, delay: float = 1.0) -> DataFrame:
    """``score_summary`` of n documents drawn by a seed: what a report says of a dataset, the sample being its definition."""
    from .dedup import sampled, saved

    rules, some = rules_for(scope, overrides), saved(sampled(df, n, key, seed), "asked-about")
    return score_summary(saved(judged(some, rules, asked(ask, retries, delay)(prompted(some, rules, text_field))), "judged"))


def client_settings(config: dict | None = None, env: dict[str, str] | None = None, defaults: dict | None = None) -> dict:
    """Where and what to ask: the configuration's ``llm`` part comes first, then the environment, then defaults; empty values count as absent."""
    import os

    env = os.environ if env is None else env
    out = {}
    for name, variable in (("api_url", "LLM_API_URL"), ("api_key", "LLM_API_KEY"), ("model", "LLM_MODEL"), ("samples", "LLM_SAMPLES")):
        out[name] = (config or {}).get(name) or env.get(variable) or (defaults or {}).get(name)
    return out
