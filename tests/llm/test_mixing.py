import random
import re

import pytest

from corpusmill.llm import mixing


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets(sizes, weights=(3, 1, 2), total=1.5, epochs=2):
    """Resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, out, rest = set(), {}, total * sum(sizes.values())
    while True:
        left = rest - sum(epochs * sizes[s] for s in full)
        share = sum(w[s] for s in names if s not in full)
        out = {s: epochs * sizes[s] if s in full else left * w[s] / share for s in names}
        over = {s for s in names if s not in full and out[s] > epochs * sizes[s]}
        if not over:
            return out
        full |= over


def corpus(n, seed):
    rng = random.Random(seed)
    names = ["a", "b", "é", "\U0001f600", None, "hot", "hot", "hot", "tiny"]
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 60))), rng.choice(names[:-1])) for i in range(n)]
    return [*rows, (n, "one two", "tiny"), (n + 1, None, "a"), (n + 2, "", None), (None, "x y z", "b"), (3, rows[3][1], rows[3][2])]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, len(t or ""), 1) for i, t, s in rows], "doc_id long, text string, source string, n_chars long, target int")


@pytest.mark.parametrize("bucket", [7, 20_000])
def test_mix(spark, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(mixing, "CHUNK_SLOTS", bucket)
    rows = corpus(600, 1)
    out = mixing.mixed(docs_of(spark, rows), block_words=8).collect()
    assert len(out) == len(rows)
    by_source = {}
    for _, t, s in rows:
        by_source[s] = by_source.get(s, 0) + size(t)
    want = targets(by_source)
    source_of = {i: s for i, _, s in rows}
    taken = {}
    for r in out:
        s = source_of[r.doc_id]
        assert r.source_size == by_source[s] and r.target == pytest.approx(want[s]) and r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(40, 0.02 * t)
    again = mixing.mixed(docs_of(spark, rows).repartition(3), block_words=8).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_rows_of_the_mix(spark):
    rows = [r for r in corpus(200, 2) if r[0] is not None][:-1]
    docs = docs_of(spark, rows)
    per = {r.doc_id: r.taken for r in mixing.mixed(docs, block_words=8).collect()}
    out = mixing.taken_rows(docs, block_words=8)
    assert out.columns == docs.columns
    got, text_of = {}, {i: t for i, t, _ in rows}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + size(r.text)
        assert r.n_chars == len(r.text) and (r.text == text_of[r.doc_id] or " ".join(r.text.split()) in " ".join(text_of[r.doc_id].split()))
    assert got == {i: n for i, n in per.items() if n}


def test_equal_rows_rows_without_ids_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 3)
    rows = [(None, "a b c", None, 5, 1)] * 40 + [(None, f"x{i} y z", "s", 5, 1) for i in range(40)] + [(7, "q r", "s", i, 1) for i in range(2)]
    rows += [(8, None, "s", 0, 0), (9, " ", None, 0, 0), (10, "w " * 5000, "s", 3, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_size int, row_dg int")
    per = mixing.mixed(docs, block_words=4).collect()
    assert len(per) == len(rows) and sum(r.size for r in per) == sum(size(t) for _, t, *_ in rows)
    out = mixing.taken_rows(docs, block_words=4)
    assert out.columns == docs.columns
    got = out.collect()
    taken = {}
    for r in got:
        key = (r.doc_id, r.source)
        taken[key] = taken.get(key, 0) + size(r.text)
    want = {}
    source = {7: "s", 8: "s", 9: None, 10: "s"}
    for r in per:
        key = (r.doc_id, source[r.doc_id] if r.doc_id else (None if r.source_size == 120 else "s"))
        want[key] = want.get(key, 0) + r.taken
    assert {k[1]: sum(v for j, v in taken.items() if j[1] == k[1]) for k in taken} == {k[1]: sum(v for j, v in want.items() if j[1] == k[1]) for k in want}
    whole = [r for r in got if r.source == "s" and r.doc_id is None]
    assert all(sum(x.text == r.text for x in whole) <= 2 for r in whole)
    assert mixing.taken_rows(docs.limit(0)).collect() == []


def test_source_of_under_one_block(spark):
    rows = [(i, "w " * 1000, "ab"[i % 2]) for i in range(520)] + [(600 + i, "x y", "small") for i in range(4)]
    docs = docs_of(spark, rows)
    out = [r for r in mixing.mixed(docs).collect() if r.doc_id >= 600]
    assert [(r.size, r.target, r.taken) for r in out] == [(2, 16.0, 4)] * 4
    assert sum(r.source == "small" for r in mixing.taken_rows(docs).collect()) == 8


@pytest.mark.parametrize("block", [1, 8, 50, 300])
def test_small_targets_are_taken_to_the_word(spark, block):
    rows = [(i, "w " * (i % 50 + 1), "ab"[i % 2]) for i in range(400)]
    weights, source_of = (200, 1), {i: s for i, _, s in rows}
    want = targets({s: sum(size(t) for _, t, x in rows if x == s) for s in "ab"}, weights, total=0.6)
    taken = {"a": 0, "b": 0}
    for r in mixing.mixed(docs_of(spark, rows), weights=weights, total=0.6, block_words=block).collect():
        taken[source_of[r.doc_id]] += r.taken
    assert abs(taken["b"] - want["b"]) <= (0.5 if want["b"] < 64 * block else 3 * block) and abs(taken["a"] - want["a"]) <= 3 * block


def test_nothing_to_mix(spark):
    assert mixing.mixed(docs_of(spark, [])).collect() == []
    assert [(r.size, r.target, r.taken) for r in mixing.mixed(docs_of(spark, [(1, None, "a"), (2, " ", None)])).collect()] == [(0, 0.0, 0)] * 2
    with pytest.raises(ValueError):
        mixing.mixed(docs_of(spark, []), total=3.0)
