"""An HTTP service over one output folder: starting stages, reports and looks at documents, as JSON. The standard library's server; one job at a time.

Routes are a table of method, path and function, so that a route is a function of an ``Service`` and the request's fields.
"""

from __future__ import annotations

import json
import os
import re
import threading
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qsl, urlparse

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import judge, report
from .plans import pipeline
from .sources import readers, writers


class Refused(Exception):
    """A request that can't be served: its status and why."""

    def __init__(self, status: int, why: str):
        super().__init__(why)
        self.status = status


class Service:
    """What the routes share: the session, the output folder, the configuration, and the state and events of the job that runs."""

    def __init__(self, spark: SparkSession, output: str, config_path: str):
        self.spark, self.output, self.config_path = spark, output, config_path
        self.jobs = {name: {"status": "idle"} for name in ("run", "bench", "ingest")}
        self.events: list[dict] = []
        self.lock, self.settings, self.tables = threading.Lock(), {}, {}

    def config(self) -> dict:
        with open(self.config_path, encoding="utf-8") as f:
            return yaml.safe_load(f) or {}

    def engine(self) -> pipeline.Engine:
        return pipeline.Engine(self.spark, pipeline.PipelineConfig.from_dict(self.config()), self.output)

    def start(self, job: str, work: Callable[[], object]) -> dict:
        """Runs work in the background unless that job runs already; its cancellation is Spark's, by job group."""
        with self.lock:
            if self.jobs[job]["status"] == "running":
                raise Refused(400, f"{job} is running")
            self.jobs[job] = {"status": "running"}

        def run() -> None:
            try:
                self.spark.sparkContext.setJobGroup(job, job, interruptOnCancel=True)
                done = {"status": "done", "result": work()}
            except Exception as e:
                done = {"status": "cancelled" if self.jobs[job]["status"] == "cancelling" else "failed", "error": f"{type(e).__name__}: {e}"[:500]}
            with self.lock:
                self.jobs[job] = done
                self.events.append({"job": job, **{k: v for k, v in done.items() if k != "result"}})

        threading.Thread(target=run, daemon=True).start()
        return {"status": "started"}

    def rows(self, stage: str, kind: str) -> DataFrame:
        engine = self.engine()
        if stage not in pipeline.STAGES[:-1] or not re.fullmatch(r"[a-z_]+", kind) or not engine._exists(f"{engine.folder(stage, kind)}/_SUCCESS"):
            raise Refused(404, f"nothing in {stage}/{kind}")
        return engine.rows(stage, kind)


ROUTES: list[tuple[str, re.Pattern, Callable]] = []


def route(method: str, path: str):
    pattern = re.compile("/api/" + re.sub(r"\{(\w+)\}", r"(?P<\1>[^/]+)", path))

    def add(f: Callable) -> Callable:
        ROUTES.append((method, pattern, f))
        return f

    return add


def _records(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def _page(df: DataFrame, order: str, offset, limit) -> dict:
    return {"total": df.count(), "documents": _records(report.page(df, order, int(offset), min(200, int(limit))))}


@route("GET", "status")
def status(s: Service) -> dict:
    return s.jobs["run"]


@route("POST", "run")
def run(s: Service, input: str, limit: int | None = None) -> dict:
    return s.start("run", lambda: _records(s.engine().run_all(input, limit)))


@route("POST", "run-phase")
def run_phase(s: Service, phase: str, input: str = "", limit: int | None = None) -> dict:
    if phase not in pipeline.STAGES:
        raise Refused(400, f"stages are {', '.join(pipeline.STAGES)}")
    return s.start("run", lambda: _records(s.engine().run_all(input, limit, only=phase)))


@route("GET", "events")
def events(s: Service, since: int = 0) -> list[dict]:
    return s.events[int(since) :]


@route("GET", "config")
def get_config(s: Service) -> dict:
    return s.config()


@route("PUT", "config")
def put_config(s: Service, **config) -> dict:
    return put_raw(s, yaml.safe_dump(config, sort_keys=False, allow_unicode=True))


@route("GET", "config/raw")
def get_raw(s: Service) -> dict:
    with open(s.config_path, encoding="utf-8") as f:
        return {"raw": f.read()}


@route("PUT", "config/raw")
def put_raw(s: Service, raw: str) -> dict:
    try:
        pipeline.PipelineConfig.from_dict(yaml.safe_load(raw) or {}).chain()
    except Exception as e:
        raise Refused(400, f"not a configuration: {e}") from e
    part = f"{s.config_path}.part"
    with open(part, "w", encoding="utf-8") as f:
        f.write(raw)
    os.replace(part, s.config_path)
    return {"status": "saved"}


@route("GET", "llm-config")
def get_llm(s: Service) -> dict:
    found = judge.client_settings({**(s.config().get("llm") or {}), **s.settings})
    return {**found, "api_key": bool(found["api_key"])}  # whether there is one, not which


@route("PUT", "llm-config")
def put_llm(s: Service, **fields) -> dict:
    s.settings.update({k: v for k, v in fields.items() if k in ("api_url", "api_key", "model", "samples") and v})
    return get_llm(s)


@route("GET", "configs/list")
def list_configs(s: Service) -> list[str]:
    folder = os.path.dirname(os.path.abspath(s.config_path))
    return sorted(f for f in os.listdir(folder) if f.endswith((".yaml", ".yml")))


@route("GET", "phases")
def phases(s: Service) -> list[dict]:
    engine = s.engine()
    return [{"phase": p, "done": engine.done(p)} for p in pipeline.STAGES]


@route("GET", "stages/all")
def all_stages(s: Service) -> dict:
    return {"phases": phases(s), "overview": overview(s)}


@route("GET", "phase-stats/{phase}")
def phase_stats(s: Service, phase: str) -> dict:
    found = [r for r in overview(s) if r["phase"] == phase]
    if not found:
        raise Refused(404, f"{phase} isn't done")
    return found[0] | ({"rejections": _records(s.engine().rejections())} if phase == "curate" else {})


@route("GET", "overview")
def overview(s: Service) -> list[dict]:
    return _records(s.engine().overview())


@route("GET", "docs/{stage}")
@route("GET", "docs/{stage}/{sub}")
def docs(s: Service, stage: str, sub: str = "kept", offset: int = 0, limit: int = 20) -> dict:
    return _page(s.rows(stage, sub), pipeline.POSITION, offset, limit)


@route("GET", "doc")
def doc(s: Service, id: str, stage: str = "curate", sub: str = "kept") -> dict:
    found = _records(s.rows(stage, sub).filter(F.col("id").cast("string") == id).limit(1))
    if not found:
        raise Refused(404, f"no document {id}")
    return found[0]


@route("GET", "raw-input")
def raw_input(s: Service, path: str, offset: int = 0, limit: int = 20) -> dict:
    return _page(readers.numbered(readers.read_any(s.spark, path), "place"), "place", offset, limit)


@route("GET", "raw-input/doc")
def raw_doc(s: Service, path: str, place: int) -> dict:
    found = raw_input(s, path, int(place), 1)["documents"]
    if not found:
        raise Refused(404, f"no row {place}")
    return found[0]


@route("POST", "cache/clear")
def clear_cache(s: Service) -> dict:
    s.spark.catalog.clearCache()
    s.tables.clear()
    return {"status": "cleared"}


@route("GET", "image")
def image(s: Service, id: str, name: str, stage: str = "ingest") -> bytes:
    figures = s.rows(stage, "kept").filter(F.col("id").cast("string") == id).select(F.explode("figures").alias("f")).filter(F.col("f.name") == name).select("f.bytes").first()
    if figures is None:
        raise Refused(404, f"no figure {name}")
    return bytes(figures[0])


@route("POST", "bench")
def bench(s: Service, inputs: list[str], samples: int | None = None) -> dict:
    def work() -> dict:
        found = pipeline.benchmark({p.rstrip("/").rsplit("/", 1)[-1]: readers.read_docs(s.spark, p, limit=samples) for p in inputs}, pipeline.PipelineConfig.from_dict(s.config()))
        found.pop("judged")
        return json.loads(report.to_json(**found))

    return s.start("bench", work)


@route("GET", "bench/status")
def bench_status(s: Service) -> dict:
    return s.jobs["bench"]


@route("POST", "bench/reset")
def bench_reset(s: Service) -> dict:
    if s.jobs["bench"]["status"] == "running":
        raise Refused(400, "bench is running")
    s.jobs["bench"] = {"status": "idle"}
    return s.jobs["bench"]


@route("GET", "sources")
def sources(s: Service, domain: str | None = None) -> list[dict]:
    return [{"name": x.name, "domain": x.domain, "priority": x.priority, "params": {k: t.__name__ for k, t in x.params.items()}} for x in readers.sources(domain)]


@route("POST", "ingest")
def ingest(s: Service, source: str, output: str, params: dict | None = None) -> dict:
    found = readers.get_source(source)
    return s.start("ingest", lambda: writers.write_docs(found(s.spark, **(params or {})), output))


@route("POST", "ingest/cancel")
def cancel(s: Service) -> dict:
    if s.jobs["ingest"]["status"] == "running":
        s.jobs["ingest"] = {"status": "cancelling"}
        s.spark.sparkContext.cancelJobGroup("ingest")
    return s.jobs["ingest"]


@route("GET", "ingest/status")
def ingest_status(s: Service) -> dict:
    return s.jobs["ingest"]


def handled(s: Service, method: str, path: str, fields: dict) -> tuple[int, object]:
    """(status, answer) of a request."""
    for known, pattern, f in ROUTES:
        if known == method and (m := pattern.fullmatch(path)):
            try:
                return 200, f(s, **fields, **m.groupdict())
            except Refused as e:
                return e.status, {"error": str(e)}
            except (TypeError, ValueError) as e:  # fields that the route hasn't, or that don't fit
                return 400, {"error": str(e)}
    return 404, {"error": f"no {method} {path}"}


def served(service: Service, host: str = "127.0.0.1", port: int = 0) -> ThreadingHTTPServer:
    """A server that is ready to ``serve_forever``; its address is ``server_address``."""

    class Handler(BaseHTTPRequestHandler):
        def answer(self) -> None:
            url, size = urlparse(self.path), int(self.headers.get("Content-Length") or 0)
            try:
                fields = dict(parse_qsl(url.query)) | (json.loads(self.rfile.read(size)) if size else {})
                status, found = handled(service, self.command, url.path.rstrip("/"), fields)
            except json.JSONDecodeError as e:
                status, found = 400, {"error": str(e)}
            body = found if isinstance(found, bytes) else json.dumps(found, default=str).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/octet-stream" if isinstance(found, bytes) else "application/json")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        do_GET = do_POST = do_PUT = answer

        def log_message(self, *_) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
