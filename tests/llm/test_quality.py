import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import bytes_np as B
from corpusmill.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), len(lines),
        len(re.findall("[A-Z]", text)), len(re.findall("[!?]", text)), len(re.findall("[0-9]", text)),
    )


def thue_morse(n, pair="ab"):
    """Strings for which polynomial hashes modulo 2 ** 64 collide with those of their complements from 1,024 items on."""
    return "".join(pair[bin(i).count("1") % 2] for i in range(n))


def texts():
    rng = random.Random(5)
    out = [None, "", "\n\n", " \n a\n a\na\na", "a b c a b c", "é# 中|\x0b$ 😀!?9"]
    for n in (1024, 4096):
        one, other = thue_morse(n), thue_morse(n, "ba")
        out += [f"{one}\n{other}", f"{one}\n{other}\n{one}", f"{one} x y {other} x y", f"{one} x y z {one} x y", " ".join(one), " ".join(one + other)]
    out.append("long " + "w" * 300_000 + " " + "w" * 300_000 + " long\n" + "v" * 17 + " " + "v" * 17 + " " + "v" * 16)
    for _ in range(150):
        out.append("".join(rng.choice(["a", "b", "C", " ", "\n", "\t", "é", "#", "中", "!", "7", "ab "]) for _ in range(rng.randint(0, 200))))
    return out


@pytest.mark.parametrize("limit", [1, 500, 1 << 22])
def test_counts_against_brute_force(limit):
    found = np.concatenate([quality.stats_of(d, a) for _, _, d, a in B.chunks(pa.array(texts()), limit)], axis=1)
    assert [tuple(x) for x in found.T.tolist()] == [brute(t) for t in texts()]


def test_words_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(B, "word_hashes", lambda data, start, end: (end - start).astype(np.uint64))
    test_counts_against_brute_force(500)


def test_columns_of_any_name_and_sample_bound(spark):
    docs = spark.createDataFrame([(i, "a b c d e " * 20 if i % 2 else " ".join(f"w{i}x{k}" for k in range(60)), i, 1) for i in range(40)], "doc_id long, text string, count_n_words long, rule int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    left = quality.kept_rows(docs, labels)
    assert left.columns == docs.columns and left.count() in range(0, 21)
    x, bad, digest = quality.labelled_sample(docs.union(docs), labels.union(labels), labelled_rows=10)
    assert len(x) == len(bad) == 10 and (np.diff(digest) > 0).all()
    assert quality.held_out(docs, labels)["rows"] in range(1, 40)


def test_judged_rows(spark):
    rng = random.Random(1)
    good = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(80))
    noisy = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) + "***" for _ in range(80))
    rows = [(i, good() if i % 3 else noisy(), "x") for i in range(300)]
    rows += [(300, None, None), (301, "", "y"), (None, good(), "z"), (302, "a b c " * 40, "w"), (302, "a b c " * 40, "w"), (303, noisy(), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rule string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 300, 2)] + [(None, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.judged(docs, labels).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert all(by[i].kept == bool(i % 3) for i in range(300))
    assert by[None].kept and not by[303].kept and by[303].rule > 0
    assert not by[300].kept and by[300].base_failed and by[302].base_failed and by[301].n_words == 0
    left = quality.kept_rows(docs, labels)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in out)
    none = quality.judged(docs, labels.limit(0)).collect()
    assert {r.rule for r in none} == {0} and all(r.kept != r.base_failed for r in none)
    assert quality.judged(docs.limit(0), labels).collect() == []


def test_held_out_accuracy_and_pruning():
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(quality.FEATURES)))
    bad = (x[:, 0] > 0.7) | ((x[:, 1] < 0.2) & (x[:, 2] > 0.6))
    rules = quality.learn(x[:1000], bad[:1000])
    hit = np.zeros(1000, dtype=bool)
    for r in rules:
        hit |= quality._covers(r, x[1000:])
    assert (hit == bad[1000:]).mean() > 0.97
    assert quality.learn(x[:100], np.zeros(100, dtype=bool)) == []
