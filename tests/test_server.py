import json
import threading
import time
import urllib.error
import urllib.request

from corpusmill import server


def test_service_over_http(spark, tmp_path):
    rows = [(f"d{i}", "a text that stays" if i % 2 else "a copy", [{"name": "f.png", "bytes": b"png"}] if i == 1 else []) for i in range(4)]
    spark.createDataFrame(rows, "id string, text string, figures array<struct<name:string,bytes:binary>>").coalesce(1).write.parquet(str(tmp_path / "in.parquet"))
    config = tmp_path / "c.yaml"
    config.write_text("pipeline:\n  filters: []\n")
    http = server.served(server.Service(spark, str(tmp_path / "out"), str(config)))
    threading.Thread(target=http.serve_forever, daemon=True).start()

    def ask(method, path, **fields):
        request = urllib.request.Request(f"http://127.0.0.1:{http.server_address[1]}/api/{path}", method=method, data=json.dumps(fields).encode() if fields else None)
        try:
            with urllib.request.urlopen(request, timeout=120) as r:
                body = r.read()
                return json.loads(body) if r.headers["Content-Type"] == "application/json" else body
        except urllib.error.HTTPError as e:
            return e.code

    def wait(path):
        for _ in range(300):
            if (found := ask("GET", path))["status"] not in ("running", "cancelling"):
                return found
            time.sleep(0.2)

    assert ask("GET", "status") == {"status": "idle"} and ask("GET", "nothing") == 404 and ask("GET", "docs/ingest") == 404
    assert ask("POST", "run", input=str(tmp_path / "in.parquet")) == {"status": "started"}
    assert wait("status")["status"] == "done"
    assert [p["done"] for p in ask("GET", "phases")] == [True] * 4 and ask("GET", "events")[0]["status"] == "done"
    assert ask("GET", "phase-stats/curate")["output_count"] == 2 and len(ask("GET", "stages/all")["overview"]) == 3
    page = ask("GET", "docs/ingest?offset=1&limit=2")
    assert page["total"] == 4 and [d["id"] for d in page["documents"]] == ["d1", "d2"]
    assert ask("GET", "doc?id=d1")["text"] == "a text that stays" and ask("GET", "doc?id=x") == 404
    assert ask("GET", "image?id=d1&name=f.png") == b"png"
    assert ask("GET", f"raw-input/doc?path={tmp_path / 'in.parquet'}&place=3")["id"] == "d3"
    assert ask("POST", "run-phase", phase="nothing") == 400 and ask("PUT", "config/raw", raw="pipeline:\n  filters:\n    - name: nothing\n") == 400
    assert ask("PUT", "config", pipeline={"filters": [{"name": "gopher_quality"}]}) == {"status": "saved"} and "gopher_quality" in ask("GET", "config/raw")["raw"]
    assert ask("PUT", "llm-config", api_key="k", model="m") == ask("GET", "llm-config") and ask("GET", "llm-config")["api_key"] is True
    assert ask("GET", "configs/list") == ["c.yaml"] and "huggingface" in {x["name"] for x in ask("GET", "sources?domain=general")}
    assert ask("POST", "bench", inputs=[str(tmp_path / "in.parquet")])["status"] == "started"
    assert wait("bench/status")["result"]["filters"] and ask("POST", "bench/reset") == {"status": "idle"} and ask("POST", "cache/clear")
    assert ask("POST", "ingest", source="local_file", output=str(tmp_path / "o.parquet"), params={"path": str(tmp_path / "in.parquet")})["status"] == "started"
    assert wait("ingest/status")["status"] == "done" and spark.read.parquet(str(tmp_path / "o.parquet")).count() == 4 and ask("POST", "ingest/cancel")["status"] == "done"
    http.shutdown()
