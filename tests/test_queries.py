"""Registered queries against their SQL on tables of odd rows."""

import random
from collections import Counter

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from corpusmill import workers
from corpusmill.functions import grams, repetition

ODD = [
    ("The house of the man.\nIt stands. " * 8, "en"), ("123 456 !? 789", "en"), ("", "de"), (None, "fr"), (" \n ", "en"), ("Größe und Maß der Häuser … und so weiter ... # #", "de"), ("no language", None),
    ("- one\n- two ...\n• three…\n\nThe end.\n\nThe end.", "en"), ("a b " * 60, "en"), ("中文文本。没有空格", "zh"),
]


@pytest.fixture
def same_as_sql(spark, tmp_path):
    def check(name, texts, key="doc_id"):
        rows = [{"doc_id": i, "text": t, "lang": lang, "source": f"s{i % 2}", "n_chars": len(t or "")} for i, (t, lang) in enumerate(texts)]
        pq.write_table(pa.Table.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])), tmp_path / "documents.parquet")
        with duckdb.connect() as db:
            db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
            found = db.execute(entry.oracle_sql()[name])
            names, want = [c[0] for c in found.description], found.fetchall()
        got = [tuple(r) for r in entry.queries()[name](spark, str(tmp_path)).select(*names).collect()]
        at = names.index(key)
        for a, b in zip(sorted(got, key=lambda r: r[at]), sorted(want, key=lambda r: r[at]), strict=True):
            assert a == tuple(pytest.approx(x, rel=1e-12) if isinstance(x, float) else x for x in b), name

    return check


@pytest.mark.parametrize("name", ["latex_markdown", "html_markdown"])
def test_papers_of_texts_without_letters_and_of_none(same_as_sql, name):
    same_as_sql(name, ODD)


WORDS_APART = [("a bc d e f g ab c d e f g", "en"), ("x y z " * 3, "en"), ("ab " * 3 + "cd " * 3 + "é" * 9 + " é" * 40, "de"), ("😀a" * 30 + ". 😀", "en"), ("w" * 400, "en")]


@pytest.mark.parametrize("name", ["gopher_signals", "ngram_functions", "top_ngrams", "dataset_stats", "language_model"])
def test_counts_on_odd_texts(same_as_sql, name):
    """But texts of CJK, which the SQL doesn't cut into words; the statistics count null as empty."""
    texts = [(t, lang) for t, lang in ODD + WORDS_APART if lang != "zh" and (t is not None or name != "dataset_stats")]
    same_as_sql(name, texts, key="dataset" if name == "dataset_stats" else "doc_id")


def test_ngram_shares_against_brute_force():
    """Words are put together without gaps for n-grams seen before, so that different words may give equal n-grams."""
    rng = random.Random(5)
    for _ in range(400):
        words = rng.choices(rng.choice([["a", "b"], ["a", "aa", "b"], ["ab", "c", "abc", "é"], [str(i) for i in range(40)]]), k=rng.randrange(60))
        size = len(" ".join(words))
        tops, dups = [], []
        for n in repetition.TOP:
            many = Counter(" ".join(words[i : i + n]) for i in range(len(words) - n + 1)).most_common(1)
            tops.append(len(many[0][0]) * many[0][1] / size if many else 0.0)
        for n in repetition.DUP:
            seen, covered, i = set(), 0, 0
            while i <= len(words) - n:
                gram = "".join(words[i : i + n])
                covered += len(gram) * (gram in seen)
                i += n if gram in seen else 1
                seen.add(gram)
            dups.append(covered / size if size else 0.0)
        assert repetition.fractions(" ".join(words)) == tops + dups


def test_distinct_slices_of_small_and_large_alphabets():
    rng = random.Random(3)
    for letters in ("ab", "abcd \n.", "😀xy", "".join(map(chr, range(32, 900)))):
        text = "".join(rng.choices(letters, k=700))
        for n in (3, 5, 10):
            assert grams.distinct_slices(text, n) == len({text[i : i + n] for i in range(len(text) - n + 1)})
    assert grams.distinct_slices("ab", 3) == 0


@pytest.mark.parametrize("name", ["gopher_signals", "ngram_functions", "dataset_stats"])
def test_counts_of_a_text_take_one_pass(spark, tmp_path, name):
    """No expression that looks at a text once for each count: on 0.1 GB they took many times as long as one pass."""
    pq.write_table(pa.table({"doc_id": [1], "text": ["The house."], "source": ["s"]}), tmp_path / "documents.parquet")
    plan = entry.queries()[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan.lower() and "split(" not in plan and plan.count("run(") >= 1


def test_batches_of_long_texts_are_bounded(spark):
    """However many rows a task has, its worker holds a few megabytes of them at once."""
    from collections.abc import Iterator

    import pandas as pd
    from pyspark.sql import functions as F

    workers.importable()

    @F.pandas_udf("long")
    def held(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([int(texts.str.len().sum())] * len(texts))

    rows = spark.range(0, 300, numPartitions=1).select(F.repeat(F.lit("words "), 20_000).alias("t"))
    assert rows.select(F.max(held("t"))).first()[0] <= 2 * workers.BATCH_BYTES
