"""Models of a text's words that are trained here: classifiers (language, quality, worth as teaching) and a language model for perplexity.

Both are tables over a vocabulary of bounded size, the most frequent words of all training texts. Training is a few aggregations over all of
them. Scoring looks each word of a text up in the table, which every executor has, so that no text is shuffled: an Arrow UDF.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..functions import text as T
from ..workers import give_back, importable

#: Words of a vocabulary, and classes of a classifier, at most.
VOCABULARY, CLASSES = 5000, 200


def _words(df: DataFrame, keys: list[Column], text_field: str) -> DataFrame:
    """(keys, word) of every word of every text, in lower case."""
    return df.select(*keys, F.explode_outer(T.plain_words(F.lower(T.text_of(text_field)))).alias("word")).filter("word is not null")


def _counter(text: str | None) -> Counter:
    return Counter((text or "").lower().split())


@dataclass(frozen=True)
class Classifier:
    """Naive Bayes over word counts. logs: for each class and word the logarithm of its smoothed share; words outside the vocabulary say nothing."""

    classes: tuple[str, ...]
    priors: tuple[float, ...]
    words: tuple[str, ...]
    logs: tuple[tuple[float, ...], ...]

    def chances(self, text: Column) -> Column:
        """array<double>: the chance of each class, in the order of ``classes``."""
        importable()
        place, table, prior = {w: i for i, w in enumerate(self.words)}, np.array(self.logs, dtype=float).reshape(len(self.classes), -1), np.array(self.priors)

        def one(text: str | None) -> list[float]:
            found = [(place[w], n) for w, n in _counter(text).items() if w in place]
            score = prior + (table[:, [i for i, _ in found]] @ np.array([n for _, n in found], dtype=float) if found else 0.0)
            chance = np.exp(score - score.max())
            return (chance / chance.sum()).tolist()

        @F.pandas_udf(ArrayType(DoubleType()))
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            try:
                for texts in batches:
                    yield texts.map(one)
            finally:
                give_back()

        return run(text)

    def scores(self, text: Column) -> Column:
        """map<string,double> from class to chance, as the language filter reads it."""
        return F.map_from_arrays(F.array(*map(F.lit, self.classes)), self.chances(text))

    def chance_of(self, name: str, text: Column) -> Column:
        return F.get(self.chances(text), F.lit(self.classes.index(name)))

    def best(self, text: Column) -> Column:
        """The likeliest class, the first of equals."""
        chances = self.chances(text)
        return T.let(chances, lambda c: F.get(F.array(*map(F.lit, self.classes)), (F.array_position(c, F.array_max(c)) - 1).cast("int")))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_classifier(spark: SparkSession, path: str) -> Classifier:
    raw = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return Classifier(tuple(raw["classes"]), tuple(raw["priors"]), tuple(raw["words"]), tuple(map(tuple, raw["logs"])))


def train_classifier(docs: DataFrame, label: str, text_field: str = "text", vocabulary: int = VOCABULARY) -> Classifier:
    """From all rows of docs with a label. Classes are few; more than ``CLASSES`` raise."""
    rows = docs.filter(F.col(label).isNotNull()).withColumn("__label", F.col(label).cast("string"))
    sizes = sorted((r["__label"], r["n"]) for r in rows.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).limit(CLASSES + 1).collect())
    if not sizes or len(sizes) > CLASSES:
        raise ValueError(f"training needs between one and {CLASSES} classes")
    counts = _words(rows, [F.col("__label")], text_field).groupBy("__label", "word").agg(F.count(F.lit(1)).alias("n"))
    known = counts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(vocabulary)
    per = counts.join(F.broadcast(known.select("word")), "word").collect()  # classes times vocabulary rows at most
    words = sorted({r["word"] for r in per})
    place, names = {w: i for i, w in enumerate(words)}, [name for name, _ in sizes]
    table = np.zeros((len(names), len(words)))
    for r in per:
        table[names.index(r["__label"]), place[r["word"]]] = r["n"]
    logs = np.log((table + 1) / (table.sum(axis=1, keepdims=True) + max(1, len(words))))
    total = sum(n for _, n in sizes)
    return Classifier(tuple(names), tuple(math.log(n / total) for _, n in sizes), tuple(words), tuple(map(tuple, logs.tolist())))


@dataclass(frozen=True)
class LanguageModel:
    """Shares of words, smoothed; words outside the vocabulary have equal parts of theirs."""

    words: tuple[str, ...]
    logs: tuple[float, ...]
    unknown: float

    def perplexity(self, text: Column) -> Column:
        """e to the mean surprise of a text's words; 0 for a text without words."""
        importable()
        table, unknown = dict(zip(self.words, self.logs, strict=True)), self.unknown

        def one(text: str | None) -> float:
            counts = _counter(text)
            n = sum(counts.values())
            return math.exp(-math.fsum(k * table.get(w, unknown) for w, k in counts.items()) / n) if n else 0.0

        @F.pandas_udf(DoubleType())
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            try:
                for texts in batches:
                    yield texts.map(one)
            finally:
                give_back()

        return run(text)


def train_language_model(docs: DataFrame, text_field: str = "text", vocabulary: int = VOCABULARY) -> LanguageModel:
    counts = _words(docs, [], text_field).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    known = counts.orderBy(F.desc("n"), "word").limit(vocabulary).collect()
    room = total + len(known) + 1
    return LanguageModel(tuple(r["word"] for r in known), tuple(math.log((r["n"] + 1) / room) for r in known), math.log((total - sum(r["n"] for r in known) + 1) / room / max(1, distinct - len(known))))


#: What a document needs to stay where a classifier of its worth decides.
LEAST_SCORE = 3.0


def split(docs: DataFrame, score: Column, least: float = LEAST_SCORE) -> tuple[DataFrame, DataFrame]:
    """(documents that stay, those that go) by a score, which becomes ``classifier_score``; a null score goes."""
    scored = docs.withColumn("classifier_score", score)
    stays = F.coalesce(F.col("classifier_score") >= least, F.lit(False))
    return scored.filter(stays), scored.filter(~stays).withColumn("rule", F.lit("low_classifier_score"))
