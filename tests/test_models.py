import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import judge, models
from corpusmill.plans import pipeline
from corpusmill.sources import readers


def corpus(spark, n=120):
    rng = random.Random(1)
    words = {"en": ["the", "and", "of", "house"], "de": ["der", "und", "von", "Haus"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(30)), lang if i % 10 else None) for i, lang in ((i, "en" if i % 3 else "de") for i in range(n))]
    return spark.createDataFrame([*rows, (n, "", "en"), (n + 1, None, "de")], "doc_id long, text string, lang string")


def test_classifier_trains_saves_and_feeds_the_language_filter(spark, tmp_path):
    docs = corpus(spark)
    model = models.train_classifier(docs, "lang", vocabulary=6)
    assert model.classes == ("de", "en") and len(model.words) == 6
    model.save(spark, str(tmp_path / "m"))
    assert models.load_classifier(spark, str(tmp_path / "m")) == model
    got = docs.select("doc_id", model.best(F.col("text")).alias("best"), model.chance_of("en", F.col("text")).alias("p")).collect()
    assert all((r.best == "en") == bool(r.doc_id % 3) and (r.p > 0.5) == (r.best == "en") for r in got if r.doc_id < 120)
    assert {r.best for r in got if r.doc_id >= 120} == {"en"}  # nothing but the prior
    from corpusmill.operators import rules

    judged = rules.with_failures(docs.withColumn("lang_scores", model.scores(F.col("text"))), rules.make_filter("language", languages=["en"]))
    assert all((len(r.failures) == 0) == bool(r.doc_id % 3) for r in judged.collect() if r.doc_id < 120)
    with pytest.raises(ValueError):
        models.train_classifier(docs.limit(0), "lang")


def test_perplexity(spark):
    docs = spark.createDataFrame([(1, "a a a a b b"), (2, "c d e f g h"), (3, ""), (4, None)], "doc_id long, text string")
    model = models.train_language_model(docs, vocabulary=2)
    got = {r.doc_id: r.p for r in docs.select("doc_id", model.perplexity(F.col("text")).alias("p")).collect()}
    assert model.words == ("a", "b") and got[3] == got[4] == 0.0 and got[1] < got[2]
    assert got[2] == pytest.approx((12 + 2 + 1) / (6 + 1) * 6)


def test_split_by_score(spark):
    docs = spark.createDataFrame([(1, 3.0), (2, 2.9), (3, None)], "doc_id long, s double")
    stay, go = models.split(docs, F.col("s"))
    assert [r.doc_id for r in stay.collect()] == [1] and sorted((r.doc_id, r.rule) for r in go.collect()) == [(2, "low_classifier_score"), (3, "low_classifier_score")]


def model_of_the_caller():
    good, bad = ("{" + ", ".join(f'"{r.name}": {{"pass": {flag}, "reason": ""}}' for r in judge.rules_for("pretrain")) + "}" for flag in ("true", "false"))

    def answer(prompt):
        if "broken" in prompt:
            raise RuntimeError("no model")
        return good if "good text" in prompt else bad

    return answer


def test_judge_in_an_engine_and_over_a_sample(spark, tmp_path):
    answer = model_of_the_caller()
    docs = spark.createDataFrame([(i, f"{kind} text {i}") for i, kind in enumerate(["good", "bad", "broken", "good"])], "doc_id long, text string")
    stay, go = judge.split(docs, answer, delay=0.0)
    assert sorted(r.doc_id for r in stay.collect()) == [0, 3] and sorted((r.doc_id, r.rule) for r in go.collect()) == [(1, "llm_factuality"), (2, "llm_factuality")]
    summary = {r.rule: (r.scored, r.failed) for r in judge.scored_sample(docs, answer, n=3, delay=0.0).collect()}
    assert summary["quality"][0] == 3 and judge.client_settings({"model": "m"}, {"LLM_MODEL": "x", "LLM_API_URL": "u"}, {"samples": 5}) == {"api_url": "u", "api_key": None, "model": "m", "samples": 5}
    docs.select("text").write.json(str(tmp_path / "in.jsonl"))
    engine = pipeline.Engine(spark, pipeline.PipelineConfig.from_dict({"pipeline": {"filters": []}}), str(tmp_path / "out"), judge=lambda df: judge.split(df, answer, delay=0.0))
    engine.run_all(str(tmp_path / "in.jsonl"))
    assert sorted(r.text for r in engine.rows("curate").collect()) == ["good text 0", "good text 3"] and engine.rows("curate", "low_quality").count() == 2


def test_engine_keeps_one_of_each_copy_whatever_the_ids(spark, tmp_path):
    rows = [(1, "same text"), (1, "Same  TEXT"), (2, "other"), (2, "third"), (3, "other")]
    for k, (with_id, options) in enumerate(((True, {}), (False, {}), (False, {"dedup": {"exact": True}}), (True, {"dedup": {"exact": {"enabled": True}, "minhash": {"enabled": True}}}))):
        df = spark.createDataFrame(rows, "id long, text string").coalesce(1)
        (df if with_id else df.select("text")).write.json(str(tmp_path / f"in{k}.jsonl"))
        engine = pipeline.Engine(spark, pipeline.PipelineConfig.from_dict({"pipeline": {"filters": [], **options}}), str(tmp_path / f"out{k}"))
        engine.run_all(str(tmp_path / f"in{k}.jsonl"))
        assert sorted(r.text for r in engine.rows("curate").collect()) == ["other", "same text", "third"]
        assert engine.package()["total_documents"] == 3
        assert "_position" not in readers.read_shards(spark, engine.folder("package")).columns
    off = pipeline.PipelineConfig.from_dict({"pipeline": {"filters": [], "dedup": {"exact": False}}})
    assert not off.dedup.exact and pipeline.PipelineConfig.from_dict({"filters": [{"name": "pii", "mode": "redact"}]}).filters[0].params == {"mode": "redact"}


def test_webdataset_packaging_versions_and_shard_folders(spark, tmp_path):
    from corpusmill.sources import writers

    df = spark.createDataFrame([("a", "one", "p", "v1"), ("b", "two", "p", "v2"), ("c", "three", "q", None)], "id string, text string, arxiv_id string, version string")
    writers.write_shards(df, str(tmp_path / "shards"), target=60)
    config = pipeline.PipelineConfig.from_dict({"pipeline": {"filters": []}, "phase3": {"version_dedup": True}, "packaging": {"format": "webdataset", "samples_per_shard": 1}, "version": "2.0"})
    engine = pipeline.Engine(spark, config, str(tmp_path / "out"))
    engine.run_all(str(tmp_path / "shards"))
    assert sorted(r.id for r in engine.rows("curate").collect()) == ["b", "c"] and [r.id for r in engine.rows("curate", "older").collect()] == ["a"]
    assert engine.package() == {"format": "webdataset", "num_shards": 2, "total_documents": 2}
    limited = pipeline.Engine(spark, config, str(tmp_path / "out2"))
    limited.ingest(str(tmp_path / "shards"), limit=2)
    assert [r.id for r in limited.rows("ingest").orderBy("id").collect()] == ["a", "b"]


def test_named_benchmarks_and_reports(spark, tmp_path):
    from corpusmill.operators import contamination

    text = " ".join(f"w{i}" for i in range(14))
    spark.createDataFrame([(text,), ("",)], "question string").write.parquet(str(tmp_path / "openai/gsm8k/main/test.parquet"))
    (tmp_path / "own.txt").write_text(text + "\nanother line\n")
    bms = readers.named_benchmarks(spark, ["gsm8k", str(tmp_path / "own.txt")], str(tmp_path))
    assert sorted((r.benchmark, r.ord) for r in bms.collect()) == [("gsm8k", 0), ("own", 1), ("own", 1)]
    for bad in ("gsm8k", "nothing"):
        with pytest.raises(ValueError):
            readers.named_benchmarks(spark, [bad])
    docs = spark.createDataFrame([(1, text), (2, "clean text"), (3, " ")], "doc_id long, text string")
    flipped = bms.withColumn("benchmark", F.when(F.col("benchmark") == "gsm8k", "z").otherwise("a"))
    assert {r.doc_id: r.benchmark for r in contamination.checked(docs, flipped).collect()} == {1: "z", 2: "", 3: ""}  # the first registered, not the first by name
    scan = contamination.scan_report(docs, bms, "d")
    assert (scan["total_docs"], scan["contaminated_docs"], scan["contamination_rate"]) == (2, 1, 0.5) and scan["per_benchmark"]["own"]["contaminated_docs"] == 1
    said = contamination.report_markdown(scan)
    assert "| gsm8k | 2 | 1 | 50.00% |" in said and "1. **gsm8k** (overlap=100.00%)" in said


def test_sources_of_folders(spark, tmp_path):
    import gzip
    import io
    import json
    import tarfile

    long = "# A Title\n" + "text " * 60
    (tmp_path / "hf").mkdir()
    for month, ids in (("2401", ["2401.00001", "2401.00002"]), ("2402", ["2402.00003"])):
        with gzip.open(tmp_path / "hf" / f"{month}.jsonl.gz", "wt") as f:
            f.writelines(json.dumps({"id": f"arXiv:{i}", "text": long if i != "2401.00002" else "short"}) + "\n" for i in ids)
    got = readers.get_source("arxiv_hf_bulk")(spark, path=str(tmp_path / "hf"), ids=["2401.00001", "2401.00002", "2403.00009"]).collect()
    assert [(r.id, r.source, json.loads(r.metadata)["title"]) for r in got] == [("arxiv_2401.00001", "ar5iv", "A Title")]
    assert readers.get_source("arxiv_hf_bulk")(spark, path=str(tmp_path / "hf"), ids=["2505.00009"]).collect() == []

    def packed(files):
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w:gz") as tar:
            for name, body in files.items():
                info = tarfile.TarInfo(name)
                info.size = len(body)
                tar.addfile(info, io.BytesIO(body))
        return out.getvalue()

    (tmp_path / "s3").mkdir()
    for month in ("2401", "2402"):
        with tarfile.open(tmp_path / "s3" / f"arXiv_src_{month}_001.tar", "w") as tar:
            body = packed({"main.tex": rb"\begin{document}" + b"x " * 150, "figs/a.png": b"png"})
            info = tarfile.TarInfo(f"{month}/{month}.00001.gz")
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
    read = readers.get_source("arxiv_s3_bulk")
    assert sorted(r.id for r in read(spark, path=str(tmp_path / "s3"), full_archive=True, ids=["2402.00001"]).collect()) == ["arxiv_2401.00001", "arxiv_2402.00001"]
    one = read(spark, path=str(tmp_path / "s3"), ids=["2402.00001"], months=["2401"]).collect()
    assert [r.id for r in one] == ["arxiv_2402.00001"] and [(f["name"], f["size"], bytes(f["bytes"])) for f in one[0].figures] == [("figs/a.png", 3, b"png")]
    assert [r.id for r in read(spark, path=str(tmp_path / "s3"), months=["2401"]).collect()] == ["arxiv_2401.00001"]
    with pytest.raises(ValueError):
        read(spark, path=str(tmp_path / "s3"))

    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "hep-th_9901001.html").write_text("<html>" + "page " * 60)
    spark.createDataFrame([("hep-th/9901001", "Known", ["hep-th"])], "arxiv_id string, title string, categories array<string>").write.parquet(str(tmp_path / "about"))
    page = readers.get_source("arxiv_ar5iv")(spark, path=str(tmp_path / "pages"), ids=["hep-th/9901001"], about=str(tmp_path / "about")).first()
    assert page.id == "arxiv_hep-th/9901001" and json.loads(page.metadata) == {"arxiv_id": "hep-th/9901001", "title": "Known", "categories": ["hep-th"]}
    (tmp_path / "d.jsonl").write_text('{"text": "a", "url": "u", "k": 1}\n{"text": ""}\n{"text": "b"}\n')
    rows = readers.get_source("huggingface")(spark, path=str(tmp_path / "d.jsonl"), dataset="x/y").collect()
    assert [(r.id, json.loads(r.metadata)["original_id"]) for r in rows] == [("hf_0", "u"), ("hf_2", "hf_2")]
