"""Filters as lists of rules: each rule is a value, a threshold and a condition, and all rules of a filter are one projection.

``verdicts`` adds the failures of a row as an array; ``kept`` and ``rejected`` split by it. Filters that rewrite texts do so only where
asked (``mutate``), as a step of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILURE = "struct<filter:string,rule:string,reason:string,value:double,value_text:string,threshold:double>"


@dataclass(frozen=True)
class Rule:
    """rule is the name among all failures, reason the name as first failure."""

    rule: str
    fails: Column
    value: Column
    threshold: float | None = None
    reason: str | None = None
    is_text: bool = False


@dataclass(frozen=True)
class Filter:
    """A filter of documents. signals: adds the columns that rules read, named with a leading ``__``; rewrite: the text that it leaves."""

    name: str
    rules: Callable[[], list[Rule]]
    signals: Callable[[DataFrame], DataFrame] = lambda df: df
    rewrite: Callable[[DataFrame], Column] | None = None
    text_field: str = "text"
    params: dict = field(default_factory=dict)


_REGISTRY: dict[str, Callable[..., Filter]] = {}


def register_filter(name: str):
    def add(make: Callable[..., Filter]) -> Callable[..., Filter]:
        _REGISTRY[name] = make
        return make

    return add


def make_filter(name: str, **params) -> Filter:
    from . import filters  # noqa: F401  registers the built-in ones

    if name not in _REGISTRY:
        raise ValueError(f"unknown filter {name!r}; known: {', '.join(sorted(_REGISTRY))}")
    return _REGISTRY[name](**params)


def known_filters() -> list[str]:
    from . import filters  # noqa: F401

    return sorted(_REGISTRY)


def failures(f: Filter) -> Column:
    """The failing rules of a filter, in their order."""
    empty = F.lit(None).cast(FAILURE)
    found = [
        F.when(
            r.fails,
            F.struct(
                F.lit(f.name).alias("filter"), F.lit(r.rule).alias("rule"), F.lit(r.reason or r.rule).alias("reason"),
                (F.lit(None) if r.is_text else r.value).cast("double").alias("value"), (r.value if r.is_text else F.lit(None)).cast("string").alias("value_text"),
                F.lit(r.threshold).cast("double").alias("threshold"),
            ),
        ).otherwise(empty)
        for r in f.rules()
    ]
    return F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast(f"array<{FAILURE}>")


def with_failures(df: DataFrame, f: Filter, out: str = "failures") -> DataFrame:
    """df with the failures of one filter."""
    own = df.columns
    return f.signals(df).withColumn(out, failures(f)).select(*[c for c in own if c != out], out)


def verdicts(df: DataFrame, filters: list[Filter], mutate: bool = False, out: str = "failures", first_only: bool = False) -> DataFrame:
    """df with the failures of all filters, in order. With ``mutate``, filters that rewrite texts do so for those after them.

    With ``first_only``, a row that a filter drops isn't judged by those after it: they see null in place of its text, and what they say of it
    doesn't count.
    """
    rest = [c for c in df.columns if c != out]
    none = F.array().cast(f"array<{FAILURE}>")
    df = df.select(*rest, none.alias(out))
    for k, f in enumerate(filters):
        open_, whole = F.size("__before") == 0, f.text_field
        df = df.withColumnRenamed(out, "__before")
        if first_only and k:
            df = df.withColumns({"__whole": F.col(f.text_field), f.text_field: F.when(open_, F.col(f.text_field))})
            whole = "__whole"
        df = f.signals(df).withColumn("__own", F.when(open_, failures(f)).otherwise(none) if first_only and k else failures(f))
        text = F.when(open_ & (F.size("__own") == 0), f.rewrite(df)).otherwise(F.col(whole)) if mutate and f.rewrite else F.col(whole)
        df = df.select(*[text.alias(c) if c == f.text_field else c for c in rest], F.concat("__before", "__own").alias(out))
    return df


def kept(df: DataFrame, out: str = "failures") -> DataFrame:
    return df.filter(F.size(out) == 0).drop(out)


def rejected(df: DataFrame, out: str = "failures") -> DataFrame:
    return df.filter(F.size(out) > 0)


def first_failure(out: str = "failures") -> Column:
    """The first failing rule's filter and reason; null where none fails."""
    return F.get(out, F.lit(0))
