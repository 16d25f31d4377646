import json

from corpusmill import cli


def docs(spark, tmp_path, name="in.jsonl"):
    long = " ".join(["This text has words enough and that is what the rules of quality ask of it."] * 6)
    path = str(tmp_path / name)
    spark.createDataFrame([(1, long), (2, "short"), (3, long + " More."), (4, long + " More.")], "id long, text string").coalesce(1).write.json(path)
    return path


def test_bench(spark, tmp_path, capsys):
    one, two = docs(spark, tmp_path), docs(spark, tmp_path, "two.jsonl")
    out, bad, gram = str(tmp_path / "r.json"), str(tmp_path / "bad.jsonl"), tmp_path / "bm.txt"
    gram.write_text("This text has words enough and that is what the rules of quality ask\n")
    assert cli.main(["bench", one, two, "-o", out, "--dedup", "--save-rejected", bad, "--check-contamination", str(gram)]) == 0
    got = json.load(open(out))
    assert {r["dataset"] for r in got["datasets"]} == {"in.jsonl", "two.jsonl"} and got["near_duplicates"][0]["total_docs"] == 8
    assert {r["text"] for r in spark.read.json(bad).collect()} >= {"short"} and got["contamination"][0]["total_docs"] == 4
    assert cli.main(["bench", one, "-n", "2", "--data-type", "sft"]) == 0
    said = capsys.readouterr().out
    assert "# Benchmark (sft)" in said and "sft_rules" in said


def test_run_by_stages(spark, tmp_path, capsys):
    path, config, out = docs(spark, tmp_path), tmp_path / "c.yaml", str(tmp_path / "out")
    config.write_text("pipeline:\n  filters:\n    - name: gopher_quality\n")
    assert cli.main(["run", path, "-o", out, "-c", str(config), "--dry-run"]) == 0
    for stage in ("ingest", "extract", "curate", "package"):
        assert cli.main(["run", path, "-o", out, "-c", str(config), "--stage", stage]) == 0
    assert "curate" in capsys.readouterr().out


def test_ingest(spark, tmp_path):
    path, out = docs(spark, tmp_path), str(tmp_path / "o.parquet")
    assert cli.main(["ingest", "local_file", "-o", out, "-p", f"path={path}", "-p", "source=s"]) == 0
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "2", "3", "4"]
