"""The pipeline's stages against brute force, each on its own input, and tables with odd rows."""

import hashlib
import os
import re
from collections import Counter

import pytest

p = pytest.importorskip("corpus_pipeline")

from test_mixing import size, targets  # noqa: E402
from test_quality import brute as counts_of  # noqa: E402
from test_simhash import brute_components, brute_print  # noqa: E402

from corpusmill.llm import bytes_np, quality  # noqa: E402, F401
from corpusmill.llm.shared import shared_dir  # noqa: E402

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_groups(rows):
    """The smallest id of each row's group: fingerprints within two bits, or similar sets."""
    links = brute_components([(i, brute_print(t, 5)) for i, t in rows], 2)
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    pairs = [(i, j) for k, i in enumerate(ids) for j in ids[k + 1 :] if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(links[i], links[j])
            if links[i] != links[j]:
                old = max(links[i], links[j])
                links = {k: low if v == old else v for k, v in links.items()}
                changed = True
    return links


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(p.STAGES)
    kept = spark.createDataFrame(stages["quality_rules"](spark, docs, SF).collect(), docs.schema)
    learned = quality.fitted(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = []
    for r in docs.collect():
        c = dict(zip(quality.COUNTS, counts_of(r.text), strict=True))
        value = lambda f, c=c: c[f[1]] / max(c[f[2]], 1) if f[2] else c[f[1]]
        bad = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        for rule in learned:
            bad |= all((value(quality.FEATURES[t.feature]) > t.threshold) == t.above for t in rule)
        want += [] if bad else [r.doc_id]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want) and 50 < len(want) < 200

    single = spark.createDataFrame(stages["exact_dedup"](spark, kept, SF).collect(), docs.schema)
    best = {}
    for r in kept.collect():
        key = "".join(re.findall(r"[^\x20\x09-\x0D]", r.text))
        best[key] = min(best.get(key, (1, 0)), (-len(r.text), r.doc_id))
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for _, i in best.values())

    apart = spark.createDataFrame(stages["simhash_dedup"](spark, single, SF).collect(), docs.schema)
    groups = near_groups([(r.doc_id, r.text) for r in single.collect()])
    assert sorted(r.doc_id for r in apart.collect()) == sorted(set(groups.values())) and len(set(groups.values())) < len(groups)

    mixed = spark.createDataFrame(stages["source_mix"](spark, apart, SF).collect(), docs.schema)
    before = {r.doc_id: r for r in apart.collect()}
    sizes, taken, per = Counter(), Counter(), Counter()
    for r in before.values():
        sizes[r.source] += size(r.text)
    for r in mixed.collect():
        taken[r.source] += size(r.text)
        per[r.doc_id] += size(r.text)
        assert " ".join(r.text.split()) in " ".join(before[r.doc_id].text.split()) and r.source == before[r.doc_id].source
    for s, t in targets(sizes).items():
        assert abs(taken[s] - t) <= 200
    assert all(n <= 2 * size(before[i].text) for i, n in per.items())

    import tokenizers

    own = tokenizers.Tokenizer.from_file(p.vocabulary())
    out = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in stages["bpe"](spark, mixed, SF).collect())
    want = Counter()
    for r in mixed.collect():
        ids = own.encode(r.text, add_special_tokens=False).ids
        digest = hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        want[r.doc_id, len(ids), digest, hashlib.sha256(own.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert out == want


def odd_tables(spark, tmp_path, empty):
    text = " ".join(f"w{i} x" for i in range(60))
    rows = [(1, text, "en", "a", 9, True, "k"), (1, text, "en", "a", 9, True, "k"), (None, text + " more words", "en", None, 9, None, None), (2, None, None, None, None, None, None)]
    rows += [(3, "", "en", "a", 0, False, ""), (4, " ".join(f"long{i}" for i in range(50_000)), "en", "b", 1, True, "k"), (None, " ".join(f"z{i}" for i in range(70)), None, None, None, None, None), (5, text + " it", "en", "b", 3, None, "k")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, gone_id string"
    spark.createDataFrame([] if empty else rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([] if empty else [(1, 1, 0), (None, 0, 0), (3, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_odd_rows_and_what_is_left_in_the_shared_folder(spark, tmp_path):
    folder = odd_tables(spark, tmp_path, empty=False)
    before = set(os.listdir(shared_dir(spark)))
    out = p.run(spark, folder)
    assert {x.split("-")[0] for x in set(os.listdir(shared_dir(spark))) - before} == {"source_mix"}
    # 1 stands for its copy and for 5, whose text is similar; the rows without an id stay; 2 and 3 have no words.
    assert {r.doc_id for r in out.collect()} == {1, None, 4}
    assert all(r.n_tokens > 0 for r in out.collect())


def test_empty_tables(spark, tmp_path):
    assert p.run(spark, odd_tables(spark, tmp_path, empty=True)).collect() == []
