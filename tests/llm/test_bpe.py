import hashlib
import os
import random
import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusmill.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(1)
    alphabet = "abcdefghijklmnopqrstuvwxyz'  \n\tABC123.,!?$ßéñÇİΣσςÅéﬁ½²中文字😀\x00\x1c\x85 \xad <|>ŉǅ"
    out = ["", "don't we're THEY'LL 12345 <|endoftext|> x<|startoftext|>", "<|endoftext|", "a" * 5000, "$" * 3000 + "é" * 3000, "ΑΣ ΟΔΟΣ.", "aaaa bbbb"]
    return out + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(1500)]


def test_against_the_library(library):
    for text, (ids, decoded) in zip(texts(), bpe.encoder(PATH).encode_batch(texts()), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == want, text
        assert decoded == library.decode(want, skip_special_tokens=False) == bpe.decode_ids(want, PATH)


def test_words_made_of_two_tokens(library):
    rng = random.Random(2)
    words = [w.replace("</w>", "") for w in bpe.encoder(PATH).vocab]
    pairs = [" ".join(rng.choice(words) + rng.choice(words) for _ in range(20)) for _ in range(300)]
    for text, (ids, _) in zip(pairs, bpe.encoder(PATH).encode_batch(pairs), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_merging_of_many_words_is_that_of_one():
    merges = bpe.encoder(PATH).merges
    rng = random.Random(3)
    base = [int(x) for x in bpe.encoder(PATH).inner[97:123]]
    words = [[rng.choice(base[:6]) for _ in range(rng.randint(1, 40))] for _ in range(300)]
    symbols, word = merges.merge_all(np.concatenate(words), np.repeat(np.arange(300), list(map(len, words))))
    assert [symbols[word == i].tolist() for i in range(300)] == [merges.merge(w) for w in words]


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    b = bpe.WordBpe(PATH)
    for _ in range(3):
        list(b.encode_batch(["some new words here"]))
        list(b.encode_batch([" ".join(f"w{i}x" for i in range(30))]))
    assert len(b.ids) < 100


def test_rows(spark, library):
    rows = [(1, None, "x"), (2, "", "y"), (None, "Hello world", "z"), (2, "Hello world", None)]
    out = bpe.encoded(spark.createDataFrame(rows, "doc_id long, text string, ids string"), PATH, with_ids=True).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    for r, (i, t, _) in zip(out, rows, strict=True):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert (r.doc_id, r.n_tokens, list(r.ids)) == (i, len(want), want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest() and r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
        assert t or r.ids_sha256 == r.decoded_sha256 == nothing
    assert bpe.encoded(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_workers_give_back_what_they_freed():
    """After a task a worker holds little more than before it, though a block that lies above the freed ones stays."""
    script = """
import re
from corpusmill.llm import shared
held = lambda: sum(map(int, re.findall(r"\\nPss_Anon: +([0-9]+)", open("/proc/self/smaps_rollup").read()))) >> 10
kept = []
def run(batches):
    blocks = [bytearray(60_000) for _ in range(3000)]
    kept.append(bytearray(60_000))
    yield len(blocks)
before = held()
assert list(shared.trimmed(run)([])) == [3000]
assert held() - before < 40, held() - before
"""
    subprocess.run([sys.executable, "-c", script], check=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
