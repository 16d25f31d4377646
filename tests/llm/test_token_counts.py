import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusmill.llm import token_counts as C

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def texts():
    rng = random.Random(6)
    out = [None, "", "\n", "\n\n\n", "a\n\n b", "one line", "é中😀\nzwölf  \n\n\n  x", "word " * 3000, "🙂" * 50 + "\n" + "🏳️‍🌈" * 9]
    for _ in range(200):
        out.append("".join(rng.choice(["a", " ", "\n", "the ", "\n\n", "é", "中文", "😀", ".", "123", "ing"]) for _ in range(rng.randint(0, 60))))
    return out


def brute(text):
    """Spans from another library, and every token against every line."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    lines, at = [], 0
    for x in text.split("\n"):
        lines.append((at, at + len(x)))
        at += len(x) + 1
    n, across = [0] * (len(lines) + 1), [0] * (len(lines) + 1)
    for a, b in t.encode(text, add_special_tokens=False).offsets:
        held = [min(b, h) - max(a, l) for l, h in lines]
        k = held.index(max(held)) if max(held) > 0 else -1
        n[k + 1] += 1
        across[k + 1] += k >= 0 and (a < lines[k][0] or b > lines[k][1])
    return [(k, *((0, 0) if k < 0 else lines[k]), n[k + 1], across[k + 1]) for k in range(-1, len(lines)) if k >= 0 or n[0]]


def test_lines_against_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "a\nb", None), (0, None, None)]
    out = C.by_lines(spark.createDataFrame(rows, "doc_id long, text string, section string"), PATH, PATTERN).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.section, r.start, r.end, r.n_tokens, r.n_crossing) for r in out)
    assert got == sorted((i is None, i or 0, *x) for i, t, _ in rows for x in brute(t or ""))


def test_fields_and_empty_table(spark):
    df = spark.createDataFrame([(1, "Title", None, "Body of text"), (2, None, None, None)], "doc_id long, a string, b string, c string")
    out = {(r.doc_id, r.section): r.n_tokens for r in C.by_fields(df, ["a", "b", "c"], PATH, PATTERN).collect()}
    assert out[1, 0] == 1 and out[1, 1] == 0 and out[1, 2] == 3 and out[2, 0] == out[2, 1] == out[2, 2] == 0
    assert C.by_lines(spark.createDataFrame([], "doc_id long, text string"), PATH, PATTERN).collect() == []


@pytest.mark.parametrize("low, high, want", [([0, 5], [5, 9], [0, 0, 1]), ([0, 3], [2, 9], [0, 1, 1]), ([], [], [-1, -1, -1])])
def test_rule(low, high, want):
    import numpy as np

    a = np.array
    assert C.attributed(a([0, 2, 6]), a([2, 6, 8]), a(low, dtype=int), a(high, dtype=int)).tolist() == want
