import json
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import contamination, dedup, extract, judge, report, rules
from corpusmill.plans import pipeline
from corpusmill.sources import readers, writers


def test_exact_and_version_dedup(spark):
    df = spark.createDataFrame([(3, "A  b"), (1, "a b "), (2, "c"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.is_duplicate for r in dedup.exact(df).collect()}
    assert got == {1: False, 2: False, 3: True, 4: False}
    assert dedup.exact_stats(df).first().asDict() == {"total_docs": 4, "unique_docs": 3, "duplicate_docs": 1, "dedup_rate": 0.25}
    rows = spark.createDataFrame([(1, "p", "v1"), (2, "p", "v2"), (3, "p", "v2"), (4, "q", None), (5, None, "v1")], "doc_id long, paper string, version string")
    assert {r.doc_id: r.is_latest for r in dedup.latest_version(rows, F.col("paper"), F.col("version"), "doc_id").collect()} == {1: False, 2: False, 3: True, 4: True, 5: True}


def test_minhash_keeps_first_by_greedy_order(spark):
    rng = random.Random(0)
    base = "".join(rng.choice("abcdefghij ") for _ in range(400))
    texts = [base, base, base[:-3] + "xyz", "".join(rng.choice("klmnop ") for _ in range(300)), "", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.is_duplicate for r in dedup.minhash(df).collect()}
    assert got == {0: False, 1: True, 2: True, 3: False, 4: False, 5: True}
    sig = {r.doc_id: r.s for r in df.select("doc_id", dedup.signature(F.col("text")).alias("s")).collect()}
    kept = []
    for i in range(len(texts)):
        if not any(sig[i][b : b + 8] == sig[j][b : b + 8] for j in kept for b in range(0, 112, 8)):
            kept.append(i)
    assert kept == [i for i in got if not got[i]]


def test_contamination(spark):
    gram = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, gram.upper() + "!"), (2, gram + " fourteen fifteen"), (3, "short"), (4, None)], "doc_id long, text string")
    bms = spark.createDataFrame([("b", gram), ("a", gram), ("c", "short")], "benchmark string, text string")
    got = {r.doc_id: r for r in contamination.checked(docs, bms).collect()}
    assert got[1].contaminated and got[1].overlap == 1.0 and got[1].benchmark == "a"
    assert not got[2].contaminated and got[2].overlap == pytest.approx(1 / 3) and got[3].overlap == 0 and got[4].benchmark == ""
    scan = {r.benchmark: r for r in contamination.scanned(docs, bms).collect()}
    assert scan["a"].total_docs == 3 and scan["a"].contaminated_docs == 1 and scan["c"].contaminated_docs == 0
    clean, bad = contamination.split(docs, bms)
    assert clean.count() == 3 and bad.first().rule == "contaminated_a"


def test_reports_and_config(spark, tmp_path):
    config = pipeline.PipelineConfig.from_dict({"pipeline": {"filters": [{"name": "gopher_quality", "params": {"min_words": 3}}, {"name": "pii", "mode": "redact"}, {"name": "c4", "enabled": False}], "dedup": {"exact": {"enabled": True}}}, "x": 1})
    assert [f.name for f in config.chain()] == ["gopher_quality", "pii"] and config.dedup.exact and config.extra == {"x": 1}
    good = "the cat and the dog went to that house with joy"
    docs = spark.createDataFrame([("1", good), ("2", good), ("3", "no")], "id string, text string")
    funnel = pipeline.Pipeline(config).dry_run(docs).orderBy("step").collect()
    assert [(r.docs_in, r.dropped) for r in funnel] == [(3, 1), (2, 0)]
    tables = pipeline.benchmark({"a": docs, "b": docs.filter("id = '3'")}, config)
    assert {r.filter: r.difference for r in tables["discrimination"].collect()}["gopher_quality"] == pytest.approx(2 / 3)
    assert json.loads(report.to_json(d=tables["datasets"]))["d"] and "| dataset |" in report.to_markdown("T", datasets=tables["datasets"])


def test_engine_resumes(spark, tmp_path):
    source = tmp_path / "in.jsonl"
    good = "the cat and the dog went to that house with joy"
    source.write_text("".join(json.dumps({"id": str(i), "text": t}) + "\n" for i, t in enumerate([good, good, "no", good + " mail a@b.com"])))
    config = pipeline.PipelineConfig.from_dict({"pipeline": {"filters": [{"name": "gopher_quality", "params": {"min_words": 3}}], "dedup": {"exact": {"enabled": True}}}})
    engine = pipeline.Engine(spark, config, str(tmp_path / "out"))
    got = {r.phase: (r.input_count, r.output_count) for r in engine.run_all(str(source)).collect()}
    assert got == {"ingest": (4, 4), "extract": (4, 4), "curate": (4, 2)}
    stamp = (tmp_path / "out").stat().st_mtime
    engine.run_all(str(source))
    assert (tmp_path / "out").stat().st_mtime == stamp
    found = readers.read_shards(spark, engine.folder("package"))
    assert sorted(r.id for r in found.collect()) == ["0", "3"]
    manifest = json.loads((tmp_path / "out" / f"package-{config.key()}" / "kept" / "manifest.json").read_text())
    assert manifest["total_documents"] == 2 and len(manifest["shards"][0]["sha256"]) == 64


def test_shards_and_tars(spark, tmp_path):
    df = spark.createDataFrame([(f"k/{i:03d}", "x" * 50, [("f.png", bytearray(b"png"))]) for i in range(40)], "id string, text string, figures array<struct<name:string,bytes:binary>>")
    found = writers.write_shards(df.drop("figures"), str(tmp_path / "s"), target=1000).orderBy("path").collect()
    assert sum(r.num_documents for r in found) == 40 and len(found) > 2 and all(r.bytes >= 900 for r in found[:-1])
    back = [r.id for r in readers.read_shards(spark, str(tmp_path / "s")).orderBy("shard", "id").collect()]
    assert back == sorted(back) and len(back) == 40
    tars = writers.write_webdataset(df, str(tmp_path / "t"), per_tar=15).orderBy("path").collect()
    assert [r.num_documents for r in tars] == [15, 15, 10]
    members = {r.member for r in readers.tar_members(spark, str(tmp_path / "t" / "*.tar")).collect()}
    assert {"k_000.txt", "k_000.json", "k_000.fig_00.png"} <= members and len(members) == 120


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"x, ""y"""\n2,z\n')
    assert [r.text for r in readers.read_docs(spark, str(tmp_path / "a.csv")).collect()] == ['x, "y"', "z"]
    (tmp_path / "b.jsonl").write_text('{"content": "a"}\n{"content": ""}\n{"content": "b"}\n')
    out = readers.get_source("local_file")(spark, path=str(tmp_path / "b.jsonl"), text_field="content").collect()
    assert [(r.id, r.text) for r in out] == [("local_0", "a"), ("local_1", "b")]
    with pytest.raises(ValueError):
        readers.get_source("local_file")(spark, nothing=1)
    (tmp_path / "c.jsonl").write_text('{"question": "q", "text": ""}\n')
    assert readers.read_benchmark(spark, "b", str(tmp_path / "c.jsonl")).first().text == "q"
    assert readers.data_type(spark.createDataFrame([("a", "b")], "instruction string, output string")) == "sft"


def test_extraction():
    page = "<html><body><nav>menu</nav><h1>T</h1><p>A <math alttext='x\\bm{y}' display='inline'></math> b</p><ul><li>one</li><li>two</li></ul><table><tr><th>a</th><th rowspan=2>b</th></tr><tr><td>1</td></tr></table><p>" + "text " * 50 + "</p></body></html>"
    md = extract.html(page)
    assert "# T" in md and "$x\\boldsymbol{y}$" in md and "- one\n- two" in md and "menu" not in md and "| a | b |" in md
    assert extract.html("<p>short</p>") is None
    assert extract.katex(r"\hat\mathbf{x} \label{eq} \text{a_b} x_\text{i} \nonumber") .split() == [r"\hat{\mathbf{x}}", r"\text{a\_b}", r"x_{\text{i}}"]
    assert extract.merge_tex({"a.tex": r"x \input{b}", "m.tex": r"\begin{document}\input{a}\input{none}\end{document}", "b.tex": "B"}) == r"\begin{document}x B\end{document}"


def test_judge(spark):
    rs = [judge.JudgeRule("a", "A?"), judge.JudgeRule("b", "B?", mode="score", threshold=3, max_score=5)]
    answers = ['{"a": {"pass": true, "reason": ""}, "b": {"score": 4, "reason": ""}}', 'x {"a": {"pass": false}, "b": {"score": 3}', "none", '{"a": {"pass": true}}']
    df = judge.judged(spark.createDataFrame([(t,) for t in answers], "t string"), rs, F.col("t"))
    assert [(r.quality, r.failed_rules) for r in df.collect()] == [("high", []), ("low", ["a"]), ("low", ["a", "b"]), ("low", ["b"])]
    text = spark.range(1).select(judge.prompt(rs, F.lit("content"))).first()[0]
    assert "Text: content" in text and "1. a [PASS/FAIL]: A?" in text and "score 1..5" in text
    calls = judge.asked(lambda p: 1 / 0, retries=2, delay=0)
    assert spark.createDataFrame([("p",)], "p string").select(calls("p")).first()[0] == ""


def test_stream_filters(spark, tmp_path):
    from corpusmill.streaming import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"text": "no"}\n{"text": "no"}\n{"text": "yes the and to of that"}\n')
    stream = ingest.read_folder(spark, str(tmp_path / "in"), "text string")
    out = ingest.deduplicated(ingest.filtered(stream, [rules.make_filter("gopher_quality", min_words=3, min_avg_word_len=1)]))
    q = out.writeStream.format("memory").queryName("got").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    assert q.awaitTermination(60)
    assert sorted((r.text, len(r.failures) > 0) for r in spark.table("got").collect()) == [("no", True), ("yes the and to of that", False)]
