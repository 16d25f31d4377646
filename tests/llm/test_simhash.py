import random
import re
import time

import pytest
import xxhash

from corpusmill.llm import simhash


def brute_print(text, n=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=2):
    ids = [i for i, _ in prints if i is not None]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    items = [(i, f) for i, f in prints if i is not None]
    for k, (i, f) in enumerate(items):
        for j, g in items[k + 1 :]:
            if (f ^ g).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in ids}


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, fp long, rep long")


def test_fingerprints_and_components_against_brute_force(spark):
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdeé中") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts = [None, "", " \t", "A", "a b", "ONE  two\x0bTHREE", "x" * 400 + " y " + "é" * 40]
    for _ in range(40):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(vocab)
            texts.append(" ".join(near).upper() if rng.random() < 0.3 else "\n".join(near))
    rows = [(i * 3, t, "x", 1, 2) for i, t in enumerate(texts)] + [(None, "a b", None, None, None), (0, None, None, None, None)]
    out = simhash.near_duplicates(docs_of(spark, rows), shingle=3, similarity=None).collect()
    assert len(out) == len(rows)
    want = {i: brute_print(t) for i, t, *_ in rows if i is not None}
    comps = brute_components(list(want.items()))
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert r.fingerprint == f"{want[r.doc_id]:016x}"
            assert r.component_id == comps[r.doc_id]


@pytest.mark.parametrize("run", [2, 128])
@pytest.mark.parametrize("distance", [1, 2])
def test_links_connect_what_brute_force_connects(spark, run, distance):
    rng = random.Random(run * 10 + distance)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            prints.add(x)
            x ^= 1 << rng.randrange(64)
            if rng.random() < 0.4:
                x ^= 1 << rng.randrange(64)
    hub = rng.getrandbits(64)
    prints |= {hub ^ 1 << b for b in range(40)}
    rows = [(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(sorted(prints))]
    fps = spark.createDataFrame(rows, "fp long, rep long")
    found = [(r.u, r.v) for r in simhash.links(fps, distance, run).collect()]
    by = dict(enumerate(sorted(prints)))
    assert all((by[u] ^ by[v]).bit_count() <= distance for u, v in found)
    from corpusmill.llm.components import components

    got = {r.node: r.component for r in components(simhash.links(fps, distance, run)).collect()}
    want = brute_components(list(by.items()), distance)
    assert {i: got.get(i, i) for i in by} == want


def test_thresholds_obey_the_pigeonhole_sum():
    import numpy as np

    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (500, 64))
    bits[:, 1] = bits[:, 0]
    for distance in (1, 2):
        chosen = simhash.plan(500, (bits.T @ bits).astype(float), distance)
        assert sum(t + 1 for t in chosen.thresholds) == distance + 1
        assert len({b for p in chosen.parts for b in p}) == sum(map(len, chosen.parts))


def test_similar_texts_against_brute_force(spark):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(500)]
    texts = [None, "", "a b", "A  b"]
    for _ in range(30):
        base = [rng.choice(vocab) for _ in range(rng.randint(20, 200))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            near = list(base)
            for _ in range(rng.randint(1, 6)):
                near[rng.randrange(len(near))] = rng.choice(vocab)
            texts.append(" ".join(near))

    def grams(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets = [grams(t) for t in texts]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    from corpusmill.llm import similar
    from corpusmill.llm.components import components

    got = {(r.u, r.v) for r in similar.links(docs).collect()}
    assert got <= want and len(got) >= 0.9 * len(want) > 10
    linked = lambda pairs: {r.node: r.component for r in components(spark.createDataFrame(sorted(pairs), "u long, v long")).collect()}
    assert linked(got) == linked(want)
    named = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, fingerprint string, fp long, rep long")
    comps = {r.doc_id: r.component_id for r in simhash.near_duplicates(named).collect()}
    assert all(comps[i] == comps[j] for i, j in want)
    left = simhash.representatives(named)
    assert left.columns == named.columns and {r.doc_id for r in left.collect()} == {i for i, c in comps.items() if i == c}


def grams_of(t, n=5):
    w = t.lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def edited(rng, words, edits):
    out = list(words)
    for k in rng.sample(range(len(out) // 10), edits):
        out[10 * k + rng.randrange(5)] = f"e{rng.getrandbits(40)}"
    return out


def test_original_of_middle_id_and_its_copies(spark):
    from corpusmill.llm import similar
    from corpusmill.llm.components import components

    rng = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(edited(rng, base, 8)) for _ in range(300)]
    texts.insert(150, " ".join(base))
    texts.append(texts[7].upper())
    sets = [grams_of(t) for t in texts]
    near = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    assert all(near(sets[150], s) for s in sets) and sum(near(a, b) for a in sets[:20] for b in sets[20:40]) < 40
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = components(similar.links(docs)).collect()
    assert {r.node for r in got} == set(range(1, len(texts))) and {r.component for r in got} == {0}


def test_crowded_shingles_against_brute_force(spark, monkeypatch):
    from corpusmill.llm import similar
    from corpusmill.llm.components import components

    # Every shared shingle is crowded, and the first comparison finds nothing, so that all is left to the blocks.
    monkeypatch.setattr(similar, "RUN", 1)
    monkeypatch.setattr(similar, "_verified", lambda joined, t: joined.select("u", "v").limit(0))
    monkeypatch.setattr(similar, "BLOCK_ROWS", 8)
    monkeypatch.setattr(similar, "COLUMNS", 64)
    rng = random.Random(6)
    texts = []
    for g in range(2):
        base = [f"g{g}w{i}" for i in range(300)]
        layers = [[base]]
        for _ in range(4):
            layers.append([edited(rng, rng.choice(layers[-1]), rng.randint(3, 7)) for _ in range(15)])
        texts += [" ".join(w) for layer in layers for w in layer]
    rng.shuffle(texts)
    sets = [grams_of(t) for t in texts]
    want = [(i, j) for j in range(len(texts)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    across = []
    whole = similar._across
    monkeypatch.setattr(similar, "_across", lambda cells, t: across.append(whole(cells, t)) or across[-1])
    got = {(r.u, r.v) for r in similar.links(docs).collect()}
    assert {tuple(sorted(x)) for x in got} <= set(want) and across[0].count() > 0
    linked = lambda pairs: {r.node: r.component for r in components(spark.createDataFrame(sorted(pairs), "u long, v long")).collect()}
    assert linked(got) == linked(want)


def test_empty_table(spark):
    assert simhash.near_duplicates(docs_of(spark, [])).collect() == []


def test_chain_and_star_components(spark):
    from corpusmill.llm.components import components

    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (101, 100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}}


def test_pairs_that_share_four_fifths_of_their_words(spark):
    """Texts of one boilerplate and a part of their own, in pairs that are similar and pairs that just aren't; sizes differ too."""
    from corpusmill.llm import similar
    from corpusmill.llm.components import components

    rng = random.Random(12)
    boiler = [f"b{i}" for i in range(160)]
    texts = []
    for g in range(300):
        own = [f"o{g}x{i}" for i in range(40)]
        first = boiler + own
        second = list(first)
        for k in rng.sample(range(len(first) - 5), rng.randint(0, 7)):
            second[k] = f"e{rng.getrandbits(40)}"
        texts += [" ".join(first), " ".join(second[: len(second) - rng.randint(0, 30)])]
    sets = [grams_of(t) for t in texts]
    near = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    want = [(i, j) for j in range(len(texts)) for i in range(j) if near(sets[i], sets[j])]
    assert 100 < sum(j == i + 1 and i % 2 == 0 for i, j in want) < 300
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {(r.u, r.v) for r in similar.links(docs).collect()}
    assert {tuple(sorted(x)) for x in got} <= set(want)
    linked = lambda pairs: {r.node: r.component for r in components(spark.createDataFrame(sorted(pairs), "u long, v long")).collect()}
    assert linked(got) == linked(want)


def test_stage_with_odd_rows(spark):
    import os

    from corpusmill.llm.shared import shared_dir

    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(5, None, 1), (4, " ", 2), (None, long, 3), (8, long, 4), (7, long + " end", 5), (7, "apart from all that", 6), (7, "apart from all that", 6), (None, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone_id int")
    before = set(os.listdir(shared_dir(spark)))
    left = simhash.representatives(docs)
    assert {f.split("-")[0] for f in set(os.listdir(shared_dir(spark))) - before} == {"near"}
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.gone_id) for r in left.collect()) == [(0, 3), (0, 7), (4, 2), (7, 5), (7, 6), (7, 6)]
    assert simhash.representatives(docs.limit(0)).collect() == []


def test_sets_are_compared_in_parts(spark, monkeypatch):
    from corpusmill.llm import similar
    from corpusmill.llm.components import components

    monkeypatch.setattr(similar, "RUN", 2)
    monkeypatch.setattr(similar, "BLOCK_ROWS", 8)
    monkeypatch.setattr(similar, "PART_SHARE", 1 << 30)
    monkeypatch.setattr(similar, "PART_GRAMS", 5000)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(edited(rng, edited(rng, base, 4), rng.randint(2, 7))) for _ in range(24)]
    for g in range(6):
        other = [f"g{g}w{i}" for i in range(200)]
        texts += [" ".join(other), " ".join(edited(rng, other, 2))]
    sets = [grams_of(t) for t in texts]
    want = [(i, j) for j in range(len(texts)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    parts, one = [], similar._sets
    monkeypatch.setattr(similar, "_sets", lambda texts, n: parts.append(texts.count()) or one(texts, n))
    got = {(r.u, r.v) for r in similar.links(spark.createDataFrame(list(enumerate(texts)), "id long, text string")).collect()}
    assert len(parts) > 2 and {tuple(sorted(x)) for x in got} <= set(want)
    linked = lambda pairs: {r.node: r.component for r in components(spark.createDataFrame(sorted(pairs), "u long, v long")).collect()}
    assert linked(got) == linked(want)


def test_staged_tables_leave_no_shuffle_files(spark):
    from corpusmill.llm.shared import dropped, staged

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    spark._jvm.System.gc()
    before = {b.name() for b in (lambda all_: [all_.apply(i) for i in range(all_.size())])(disk.getAllBlocks())}
    table = staged(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count(), "counted")
    deadline = time.time() + 20
    while new := {b.name() for b in (lambda all_: [all_.apply(i) for i in range(all_.size())])(disk.getAllBlocks())} - before:
        assert time.time() < deadline, new
        time.sleep(0.2)
    assert table.count() == 7
    dropped(table)
