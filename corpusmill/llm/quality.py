"""Quality rules learned as a decision list by sequential covering.

Statistics of labelled documents grow one rule after another: a conjunction of thresholds, each the one of greatest information gain
for the bad class, pruned on rows it wasn't grown on. The rows that a rule covers leave, and the next is grown on what is left, until
none is precise enough. The list is compiled to one ordered conditional expression of Spark.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import bytes_np as B
from .shared import importable, trimmed, unused

#: Labelled rows that the list is fitted on, at most: those of smallest digest of their id.
LABELLED_ROWS = 10_000
#: Counts of a text, in this order; see ``stats_of``.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits")

_SYMBOL, _MARK = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK[list(b"!?")] = True


def stats_of(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ``COUNTS`` of each row of a chunk, a column for each.

    word_chars: code points in words; n_symbols: characters of #*$%&|<>; n_dup_lines: lines with a word that equal an earlier line of
    the text; n_repeat_words: words in windows of three words found twice or more in the text; n_lines: lines with a word; n_upper: A-Z;
    n_marks: ! and ?. Lines, words and windows are compared exactly.
    """
    n = len(at) - 1
    start, end, first = B.words(data, at)
    row = B.per_row(first)
    out = np.zeros((len(COUNTS), n), dtype=np.int64)

    def count(flags: np.ndarray) -> np.ndarray:
        return np.bincount(np.searchsorted(at, np.flatnonzero(flags), "right") - 1, minlength=n)

    out[0] = np.diff(first)
    inside = ~B.SPACE[data]
    letters = np.r_[0, np.cumsum(inside & ((data & 0xC0) != 0x80))]
    out[1] = letters[at[1:]] - letters[at[:-1]]
    out[2], out[6], out[7] = count(_SYMBOL[data]), count((data >= 65) & (data <= 90)), count(_MARK[data])
    out[8] = count((data >= 48) & (data <= 57))
    # Lines: from a row's start or after a line feed to the next one or the row's end.
    feeds = np.flatnonzero(data == 10)
    of_feed = np.searchsorted(at, feeds, "right") - 1
    begin, begin_row = _by_row(np.r_[at[:-1], feeds + 1], np.r_[np.arange(n), of_feed])
    close, _ = _by_row(np.r_[feeds, at[1:]], np.r_[of_feed, np.arange(n)])
    full = np.searchsorted(start, close) > np.searchsorted(start, begin)
    begin, close, begin_row = begin[full], close[full], begin_row[full]
    blob, last, seen = data.tobytes(), -1, set()
    for r, i, j in zip(begin_row.tolist(), begin.tolist(), close.tolist(), strict=True):
        if r != last:
            last, seen = r, set()
        line = blob[i:j]
        if line in seen:
            out[3, r] += 1
        else:
            seen.add(line)
    out[5] = np.bincount(begin_row, minlength=n)
    if len(start) >= 3:
        hit = np.zeros(len(start) + 3, dtype=bool)
        twice = _repeated_windows(B.word_ids(data, start, end), row)
        for k in range(3):
            hit[twice + k] = True
        out[4] = np.bincount(row[hit[: len(start)]], minlength=n)
    return out


def _repeated_windows(word: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Starts of the windows of three words that are found twice or more in their row."""
    ok = np.flatnonzero(row[:-2] == row[2:])
    key = B.mix(word[:-2] * np.uint64(3) + B.mix(word[1:-1] * np.uint64(5) + B.mix(word[2:])))[ok] ^ B.mix(row[ok].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    a, b = ok[order[:-1]], ok[order[1:]]
    same = key[order[:-1]] == key[order[1:]]
    a, b = a[same], b[same]
    if (row[a] != row[b]).any() or any((word[a + k] != word[b + k]).any() for k in range(3)):  # a hash that two windows share
        windows: dict[tuple, list[int]] = {}
        for i in ok.tolist():
            windows.setdefault((row[i], *word[i : i + 3].tolist()), []).append(i)
        return np.array([i for found in windows.values() if len(found) > 1 for i in found], dtype=np.int64)
    return np.unique(np.r_[a, b])


def _by_row(places: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(row, kind="stable")
    return places[order], row[order]


def with_stats(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """docs with the ``COUNTS`` of their texts as long columns after their own; null counts as empty."""
    importable(docs.sparkSession)
    place = docs.columns.index(text_col)
    names = [*docs.columns, *(prefix + c for c in COUNTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [stats_of(data, at) for _, _, data, at in B.chunks(batch.column(place))]
            table = np.concatenate(found, axis=1) if found else np.zeros((len(COUNTS), 0), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, table)], names)

    schema = StructType([*docs.schema.fields, *(StructField(prefix + c, LongType()) for c in COUNTS)])
    return docs.mapInArrow(trimmed(run), schema)


#: What rules test: name and how it comes from counts, as numerator and denominator (None: the count itself).
FEATURES = (
    ("symbols_per_word", "n_symbols", "n_words"),
    ("chars_per_word", "word_chars", "n_words"),
    ("repeat_share", "n_repeat_words", "n_words"),
    ("dup_line_share", "n_dup_lines", "n_lines"),
    ("upper_share", "n_upper", "word_chars"),
    ("marks_per_word", "n_marks", "n_words"),
    ("digit_share", "n_digits", "word_chars"),
    ("n_words", "n_words", None),
)


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """A column for each of ``FEATURES``; over nothing: 0."""
    cols = [counts[a].astype(float) if b is None else counts[a] / np.maximum(counts[b], 1) for _, a, b in FEATURES]
    return np.stack(cols, axis=1) if len(cols[0]) else np.zeros((0, len(FEATURES)))


@dataclass(frozen=True)
class Test:
    feature: int
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{FEATURES[self.feature][0]} {'>' if self.above else '<='} {self.threshold:.6g}"

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x[:, self.feature] > self.threshold if self.above else x[:, self.feature] <= self.threshold

    def column(self, prefix: str) -> Column:
        _, a, b = FEATURES[self.feature]
        value = F.col(prefix + a).cast("double") if b is None else F.col(prefix + a) / F.greatest(F.col(prefix + b), F.lit(1))
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


Rule = tuple[Test, ...]


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for test in rule:
        out &= test.holds(x)
    return out


def _best_test(x: np.ndarray, bad: np.ndarray) -> tuple[float, Test] | None:
    """The test of greatest FOIL gain; its threshold lies halfway between two values."""
    p0, n0 = bad.sum(), (~bad).sum()
    base, best = math.log2(p0 / (p0 + n0)), None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, b = x[order, f], np.cumsum(bad[order])
        cut = np.flatnonzero(np.diff(v) > 0)
        if not len(cut):
            continue
        p, total = b[cut], cut + 1
        for above, pos, every in ((False, p, total), (True, p0 - p, len(v) - total)):
            gain = np.where(pos > 0, pos * (np.log2(np.maximum(pos, 1) / every) - base), -np.inf)
            i = int(np.argmax(gain))
            if best is None or gain[i] > best[0]:
                best = (float(gain[i]), Test(f, above, float((v[cut[i]] + v[cut[i] + 1]) / 2)))
    return best


def simplified(rule: Rule) -> Rule:
    """The rule with one test for each side of a feature, the narrowest."""
    kept: dict[tuple[int, bool], Test] = {}
    for t in rule:
        other = kept.get((t.feature, t.above))
        if other is None or (t.threshold > other.threshold) == t.above:
            kept[t.feature, t.above] = t
    return tuple(kept.values())


def learn(x: np.ndarray, bad: np.ndarray, max_rules: int = 12, max_tests: int = 4, precision: float = 0.95, least: int = 3, tries: int = 10, seed: int = 0) -> list[Rule]:
    """An ordered list of rules for the bad class. ``precision`` is what a rule needs on rows it wasn't grown on, ``least`` how many it must cover.

    Each rule is grown on two thirds of the rows, drawn anew, and pruned on the rest; after ``tries`` draws without a good rule the list ends.
    """
    rules: list[Rule] = []
    rng = np.random.default_rng(seed)
    failed = 0
    while len(rules) < max_rules and failed < tries and bad.sum() >= least:
        fold = rng.random(len(x)) < 1 / 3
        failed += 1
        if bad[~fold].sum() < least:
            continue
        gx, gb, px, pb = x[~fold], bad[~fold], x[fold], bad[fold]
        rule: Rule = ()
        live = np.ones(len(gx), dtype=bool)
        while len(rule) < max_tests and (~gb[live]).any() and gb[live].any():
            found = _best_test(gx[live], gb[live])
            if found is None or found[0] <= 1e-9:
                break
            rule = (*rule, found[1])
            live &= found[1].holds(gx)

        def worth(r: Rule, px: np.ndarray = px, pb: np.ndarray = pb) -> float:
            hit = _covers(r, px)
            p, n = (hit & pb).sum(), (hit & ~pb).sum()
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = _covers(rule, px) if rule else np.zeros(len(px), dtype=bool)
        hits = _covers(rule, x) if rule else np.zeros(len(x), dtype=bool)
        if not rule or hits.sum() < least or (bad & hits).sum() < precision * hits.sum() or (hit.any() and (pb & hit).sum() < precision * hit.sum()):
            continue
        rules.append(simplified(rule))
        failed = 0
        x, bad = x[~hits], bad[~hits]
    return rules


def compiled(rules: list[Rule], prefix: str = "") -> Column:
    """The number of the first rule that holds, from 1 on, or 0: one ordered conditional expression."""
    out = None
    for i, rule in enumerate(rules, 1):
        holds = rule[0].column(prefix)
        for test in rule[1:]:
            holds = holds & test.column(prefix)
        out = F.when(holds, F.lit(i)) if out is None else out.when(holds, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


#: Digests are cut to this many values.
DIGESTS = 1 << 32


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled_rows: int = LABELLED_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bad, digest) of at most ``labelled_rows`` labelled ids, those of smallest digest.

    A bound on the digest, which follows from the number of labels, leaves little more than the sample before it is sorted. Rows without
    an id or a label don't count; labels that say the same of an id count once, and of documents that share an id the one of least counts.
    The sample's ids go to every executor: it is bounded.
    """
    named = labels.filter(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).select(F.col(id_col).cast("long").alias("label_id"), (F.col("quality") == 0).alias("bad")).distinct()
    n = named.count()
    digest = F.conv(F.substring(F.md5(F.col("label_id").cast("string")), 1, 8), 16, 10).cast("long")
    bound = DIGESTS * (labelled_rows + 6 * math.sqrt(labelled_rows) + 10) / max(n, 1)
    some = named.withColumn("digest", digest).filter(F.col("digest") < F.lit(int(min(bound, DIGESTS)))).orderBy("digest", "label_id", "bad").limit(labelled_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(some), F.col("id") == F.col("label_id"))
    counted = with_stats(rows.select("id", "bad", "digest", "text"))
    found = counted.groupBy("digest", "id", "bad").agg(F.min(F.struct(*COUNTS)).alias("x")).orderBy("digest", "id", "bad").collect()
    table = {c: np.array([r["x"][c] for r in found], dtype=np.int64) for c in COUNTS}
    return features(table), np.array([r["bad"] for r in found], dtype=bool), np.array([r["digest"] for r in found], dtype=np.int64)


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled_rows: int = LABELLED_ROWS, **options) -> list[Rule]:
    """Rules learned from labels (id, quality 0 or 1) of a bounded sample of labelled documents; without labels, none."""
    x, bad, _ = labelled_sample(docs, labels, id_col, text_col, labelled_rows)
    return learn(x, bad, **options) if len(x) else []


def held_out(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled_rows: int = LABELLED_ROWS, fifth: int = 0, **options) -> dict[str, float]:
    """How a list learned from four fifths of the labelled sample does on the fifth: rows, share of bad ones, precision and recall for them."""
    x, bad, digest = labelled_sample(docs, labels, id_col, text_col, labelled_rows)
    test = digest % 5 == fifth
    rules = learn(x[~test], bad[~test], **options)
    hit = np.zeros(int(test.sum()), dtype=bool)
    for rule in rules:
        hit |= _covers(rule, x[test])
    right = int((hit & bad[test]).sum())
    return {"rows": len(hit), "bad": float(bad[test].mean()) if len(hit) else 0.0, "precision": right / max(1, int(hit.sum())), "recall": right / max(1, int(bad[test].sum()))}


def base_failed(prefix: str = "") -> Column:
    n = F.col(prefix + "n_words")
    return (n < 50) | (100 * F.col(prefix + "n_repeat_words") > 50 * n)


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of docs: id, counts, base_failed, kept, and rule, the number of the learned rule that rejects it (0: none).

    base_failed: under 50 words, or over half of them in repeated windows. kept: neither that nor a learned rule holds. A null text
    counts as empty, and so fails. Repeated rows are judged alike, null ids too; an empty table gives an empty result; other columns
    are ignored. Nothing is shuffled but the labelled sample.
    """
    rules = fitted(docs, labels, id_col, text_col, **options)
    out = with_stats(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).withColumn("rule", compiled(rules))
    return out.select(F.col("id").alias(id_col), *COUNTS[:5], base_failed().alias("base_failed"), (~base_failed() & (F.col("rule") == 0)).alias("kept"), "rule")


def kept_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that ``judged`` keeps, with all their columns.

    Null, empty and blank texts have no words and go; rows without an id are judged by their text like others. Rows that share an id, and
    repeated rows, are judged each by itself and stay together. An empty table gives an empty result. Columns of docs may have any name.
    """
    rules = fitted(docs, labels, id_col, text_col, **options)
    prefix = unused(docs.columns, "count_")
    out = with_stats(docs, text_col, prefix)
    return out.filter(~base_failed(prefix) & (compiled(rules, prefix) == 0)).select(*docs.columns)
