import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from corpusmill.llm import substring_dedup, suffix_dedup


def brute_words(rows, length):
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    key = [1 << 70 if i is None else i for i, _ in rows]
    for k, w in zip(key, words, strict=True):
        for j in range(len(w) - length + 1):
            g = tuple(w[j : j + length])
            first[g] = min(first.get(g, 1 << 71), k)
    out = []
    for k, w in zip(key, words, strict=True):
        gone = {j + x for j in range(len(w) - length + 1) if first[tuple(w[j : j + length])] < k for x in range(length)}
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()))
    return out


def brute_bytes(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[j : j + length] for t in texts for j in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = {j + x for j in range(len(t) - length + 1) if seen[t[j : j + length]] > 1 for x in range(length)}
        spans = sum(j - 1 not in gone for j in gone)
        out.append((len(t), len(gone), spans, hashlib.sha256(bytes(b for j, b in enumerate(t) if j not in gone)).hexdigest()))
    return out


def corpus(seed, words):
    rng = random.Random(seed)
    vocab = ["a", "b", "cé", "d\x00", "中", "é"] + [f"w{i}" for i in range(words)]
    some = lambda n: [rng.choice(vocab) for _ in range(n)]
    passages = [some(rng.randint(8, 60)) for _ in range(12)]
    rows = [(0, None), (1, ""), (2, "a"), (3, "x " * 100), (4, "ab" * 90), (5, "x x " * 50)]
    for i in range(6, 120):
        text = some(rng.randint(0, 30))
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p)))) if rng.random() < 0.5 else (0, len(p))
            p = list(p[a:b])
            if p and rng.random() < 0.3:
                p[rng.randrange(len(p))] = "changed"
            text += p + some(rng.randint(0, 6))
        rows.append((i * 7 % 120 + 6, rng.choice([" ", "\n", "  \t"]).join(text)))
    rows += [rows[20], rows[30], (None, rows[40][1]), (rows[50][0], rows[51][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("together", [2, 50_000])
@pytest.mark.parametrize("words", [3, 400])
def test_word_repeats_against_brute_force(spark, words, together):
    rows = corpus(words, words)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, spans string, n_words int")
    out = substring_dedup.without_repeats(docs, length=12, seed=4, with_text=True, together=together).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in out) == sorted((i is None, i or 0, *b) for (i, _), b in zip(rows, brute_words(rows, 12), strict=True))
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in out)


@pytest.mark.parametrize("together", [2, 50_000])
@pytest.mark.parametrize("words", [3, 400])
def test_byte_repeats_against_brute_force(spark, words, together):
    rows = corpus(words + 1, words)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, spans string, id int")
    out = suffix_dedup.without_repeats(docs, length=40, seed=8, together=together).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == sorted((i is None, i or 0, *b) for (i, _), b in zip(rows, brute_bytes(rows, 40), strict=True))


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    import pyarrow as pa

    rng = random.Random(3)
    text = "".join(rng.choice("ab") for _ in range(2000))
    found = []
    for row, base, roll, at in suffix_dedup._pieces(40)(pa.array([text, text[500:900], ""])):
        from corpusmill.llm import repeats

        h, c, r, lo, reach, n = repeats.described(roll, at, 40, 8)
        found += [(int(row[x]), int(l + base[x]) + k) for x, l, m in zip(r, lo, n, strict=True) for k in range(m + 1)]
    assert sorted(found) == [(0, s) for s in range(1961)] + [(1, s) for s in range(361)]


def test_multikey_sort():
    rng = np.random.default_rng(0)
    for n, width in ((1, 5), (300, 3), (500, 41)):
        rows = rng.integers(0, 2, (n, width)).astype(np.uint8) * 255
        rows[n // 2 :] = rows[: n - n // 2]
        order, common = suffix_dedup.multikey_sort(rows)
        want = sorted(rows[i].tobytes() for i in range(n))
        assert [rows[i].tobytes() for i in order] == want
        lcp = [next((k for k in range(width) if a[k] != b[k]), width) for a, b in zip(want, want[1:], strict=False)]
        assert common[1:].tolist() == lcp


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.without_repeats(docs).collect() == []
    assert suffix_dedup.without_repeats(docs).collect() == []


def thue_morse(n, pair="ab"):
    return "".join(pair[bin(i).count("1") % 2] for i in range(n))


def test_words_and_bytes_that_polynomial_hashes_confuse(spark):
    rows = []
    for k, n in enumerate((1024, 4096)):
        base = [f"x{k}w{i}" for i in range(50)]
        rows += [(10 * k, " ".join(base[:49] + [thue_morse(n)])), (10 * k + 1, " ".join(base[:49] + [thue_morse(n, "ba")])), (10 * k + 2, " ".join(base[:49] + [thue_morse(n, "ba")]))]
        rows += [(10 * k + 3, thue_morse(n, "cd")), (10 * k + 4, thue_morse(n, "dc"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = substring_dedup.without_repeats(docs).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in out) == sorted((i, *b) for (i, _), b in zip(rows, brute_words(rows, 50), strict=True))
    out = suffix_dedup.without_repeats(docs).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == sorted((i, *b) for (i, _), b in zip(rows, brute_bytes(rows, 200), strict=True))


def test_windows_of_one_hash_are_told_apart(spark, monkeypatch):
    from corpusmill.llm import bytes_np as B

    rows = [(r, t) for r, t in corpus(5, 400)][:40]
    kind, table = substring_dedup.kind_of(12, 4), {}
    words = [np.array([hash(w) % (1 << 62) for w in (t or "").split()[:15]], dtype=np.uint64) for _, t in rows]
    words = [w for w in words if len(w) == 15] * 2
    table = {"h": np.zeros(len(words), dtype=np.int64), "c": np.arange(len(words)), "mid": np.arange(len(words)), "reach": np.full(len(words), 3), "n": np.full(len(words), 3), "data": np.concatenate(words).view(np.uint8), "at": np.arange(len(words) + 1) * 120}
    want = substring_dedup._compare(kind, table)
    monkeypatch.setattr(B.Roller, "of", lambda self, a, b: np.zeros(len(a), dtype=np.uint64))
    got = substring_dedup._compare(kind, table)
    assert all((a == b).all() for a, b in zip(want, got, strict=True)) and want[2].sum() == len(words) // 2


def test_hot_anchors_and_long_texts(spark):
    """A third of all runs have one anchor and one class; a text of 300,000 words repeats a passage of others."""
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(80))
    rows = [(i, f"{passage} tail{i}") for i in range(60)] + [(100 + i, " ".join(f"n{i}x{k}" for k in range(90))) for i in range(20)]
    rows.append((200, " ".join(f"l{rng.randrange(10**9)}" for _ in range(300_000)) + " " + passage))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.n_removed for r in substring_dedup.without_repeats(docs).collect()}
    assert out == {i: 80 * (0 < i < 60 or i == 200) for i, _ in rows}
    size = len(passage) + 1
    out = {r.doc_id: r.n_removed for r in suffix_dedup.without_repeats(docs).collect()}
    # The blank before the last one's passage is no start of a shared string, the tail's first letters are.
    assert all((n >= size - 1) == (i < 60 or i == 200) for i, n in out.items())
