import pytest

pytest.importorskip("corpus_pipeline")


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert set(entry.oracle_sql()) <= set(names)


def test_pipeline_stages(spark):
    """Each stage's rows are rows of the one before, and each stage's work is done on its input."""
    import corpus_pipeline as p

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows, columns = {r.doc_id: r.text for r in docs.collect()}, docs.columns
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns
        got = [(r.doc_id, r.text) for r in out.collect()]
        assert got and {i for i, _ in got} <= set(rows)
        if name == "exact_dedup":
            assert len({"".join(t.split()) for _, t in got}) == len(got) == len({"".join(t.split()) for t in rows.values()})
        if name != "source_mix":
            assert all(rows[i] == t for i, t in got) and len(got) == len({i for i, _ in got})
        docs, rows = spark.createDataFrame(out.collect(), out.schema), dict(got)
    final = p.STAGES[-1][1](spark, docs, sf_dir)
    assert final.count() == docs.count() and final.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_rest_of_the_library_does_not_import_llm():
    import pathlib
    import re

    root = pathlib.Path(__file__).parents[2] / "corpusmill"
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert not re.search(r"import llm|\.llm", f.read_text()), f
