import hashlib
import re

from pyspark.sql import functions as F

from corpusmill.llm import exact_dedup

ROWS = [(4, "a b"), (2, "ab"), (9, " a\tb "), (1, None), (3, ""), (5, " \n"), (6, "é 中"), (7, "é 中"), (8, "x" * 50_000), (8, "x" * 50_000), (None, "ab"), (None, "lone")]


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    out = []
    for (i, _), n in zip(rows, norm, strict=True):
        group = [(-len(t or ""), j is None, j or 0, j) for (j, t), m in zip(rows, norm, strict=True) if m == n]
        keep = min(group)[3]
        out.append((str(i), str(keep), len(group), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, digest string, keep_id int")


def test_groups_against_brute_force(spark):
    for limit in (0, 1000):  # hits shuffled, and sent to every executor
        out = exact_dedup.exact_groups(docs_of(spark, ROWS), broadcast_rows=limit).collect()
        assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in out) == brute(ROWS)


def test_texts_of_one_digest_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.lpad(F.hex(F.pmod(F.xxhash64(c), F.lit(2))), 64, "0"))
    out = exact_dedup.exact_groups(docs_of(spark, ROWS)).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in out) == [x[:4] for x in brute(ROWS)]


def test_stage_keeps_one_row_of_each_group(spark):
    docs = docs_of(spark, ROWS)
    left = exact_dedup.first_copies(docs)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["5", "6", "7", "8", "9", "None"]
    # Columns by the names that the operator itself uses.
    docs = spark.createDataFrame([(i, t, True, k, "a", "b") for k, (i, t) in enumerate(ROWS)], "doc_id long, text string, kept boolean, copy_id long, keep_id string, __digest string")
    left = exact_dedup.first_copies(docs)
    assert left.columns == docs.columns and sorted(str(r.doc_id) for r in left.collect()) == ["5", "6", "7", "8", "9", "None"]
    assert exact_dedup.first_copies(docs.limit(0)).collect() == []


def test_stage_where_digests_clash(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.lpad(F.hex(F.pmod(F.xxhash64(c), F.lit(2))), 64, "0"))
    assert sorted(str(r.doc_id) for r in exact_dedup.first_copies(docs_of(spark, ROWS)).collect()) == ["5", "6", "7", "8", "9", "None"]


def digests(spark, pairs):
    df = spark.createDataFrame(pairs, "id long, t string")
    return df.select(F.unhex(F.sha2("t", 256)).alias("digest"), "id", F.length("t").cast("long").alias("n_chars"))


def test_index_over_several_runs_and_empty_table(spark):
    index = exact_dedup.DigestIndex(spark, fanout=2)
    assert index.append(digests(spark, [(5, "a"), (6, "b"), (4, "b")])).count() == 1
    assert index.append(digests(spark, [(3, "a"), (7, "c")])).count() == 1
    assert [(r.level, r.digests) for r in index.runs] == [(1, 3)]
    asked = digests(spark, [(0, t) for t in "abcz"]).select("digest")
    assert sorted((r.keep_id, r.group_size) for r in index.lookup(asked).collect()) == [(3, 2), (4, 2), (7, 1)]
    assert exact_dedup.exact_groups(docs_of(spark, [])).collect() == []


def test_filters_keep_runs_shut(spark):
    index = exact_dedup.DigestIndex(spark, fanout=9)
    for k in range(3):
        index.append(digests(spark, [(i, f"run {k} text {i}") for i in range(500)]))
    asked = digests(spark, [(0, "run 1 text 7"), (0, "run 1 text 499")]).select("digest")
    index.opened = index.skipped = 0
    assert index.lookup(asked).count() == 2 and (index.opened, index.skipped) == (1, 2)
    strange = digests(spark, [(i, f"strange {i}") for i in range(2000)]).select("digest")
    assert sum(index.candidates(strange, r).count() for r in index.runs) < 60  # of 6000
    assert all(index.candidates(spark.read.parquet(r.path + "/data").select("digest"), r).count() == r.digests for r in index.runs)


def test_index_opens_again_after_a_crash(spark, monkeypatch):
    index = exact_dedup.DigestIndex(spark, fanout=2)
    index.append(digests(spark, [(5, "a"), (6, "b")]))

    def lost(self, runs):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(exact_dedup.DigestIndex, "_commit", lost)
        try:
            index.append(digests(spark, [(1, "b")]))
        except OSError:
            pass
    again = exact_dedup.DigestIndex(spark, index.path, fanout=2)
    assert [(r.level, r.digests) for r in again.runs] == [(0, 2)]
    assert again.append(digests(spark, [(1, "b")])).count() == 1
    found = exact_dedup.DigestIndex(spark, index.path).lookup(digests(spark, [(0, "b")]).select("digest")).first()
    assert (found.keep_id, found.group_size) == (1, 2)
    again.close()
    assert exact_dedup.DigestIndex(spark, index.path).runs == []


def test_many_memtables(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_MEMTABLES", 6)
    rows = [(i, f"t {i % 7}") for i in range(60)]
    docs = docs_of(spark, rows).repartition(8)
    out = exact_dedup.exact_groups(docs).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in out) == brute(rows)


def test_no_python_workers_for_an_empty_index(spark):
    with exact_dedup.scratch():
        found = exact_dedup.DigestIndex(spark).lookup(spark.range(3).selectExpr("cast(cast(id as string) as binary) as digest"))
        assert "ExistingRDD" not in found._jdf.queryExecution().toString()
        assert found.dtypes == [("digest", "binary"), ("keep_id", "bigint"), ("n_chars", "bigint"), ("group_size", "bigint")] and not found.collect()
