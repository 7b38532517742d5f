"""Search as a service: backends that answer one request, and a small HTTP server over them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions import text as T
from lodestar.operators import checks as C
from lodestar.operators import contracts, hybrid
from lodestar.operators import search as S
from lodestar.sources.shared import scratch


class SearchBackend(Protocol):
    def search(self, query: str, location_codes: Sequence[str] = (), duty_codes: Sequence[str] = (), limit: int = 50) -> list[str]:
        """Ids of jobs, the best first."""


class Empty:
    def search(self, query, location_codes=(), duty_codes=(), limit=50):
        return []


class Lexical:
    """An index made by stages.index_jobs."""

    def __init__(self, spark: SparkSession, held: S.Index):
        self.spark, self.held = spark, held

    def _asked(self, query: str, location_codes: Sequence[str], duty_codes: Sequence[str]) -> DataFrame:
        row = [(0, query, "|".join(location_codes), "|".join(duty_codes))]
        schema = "query_id long, query string, location_code string, occupation_code string"
        return self.spark.createDataFrame(row, schema).withColumns({"terms": T.query_terms(F.col("query")), "query_time": F.current_timestamp()})

    def search(self, query, location_codes=(), duty_codes=(), limit=50):
        asked = self._asked(query, location_codes, duty_codes)
        codes = asked.select("query_id", "terms", hybrid._codes("location_code").alias("location"), hybrid._codes("occupation_code").alias("duty"))
        return [r.job_id for r in S.search(codes, self.held, limit).orderBy("rank").select("job_id").collect()]  # at most `limit`


class Hybrid(Lexical):
    """The index and a graph, reranked by a model or the baseline; jobs are as fresh as the request's time says."""

    def __init__(self, spark: SparkSession, held: S.Index, g: C.Graph, model=None, pool: int = 200):
        super().__init__(spark, held)
        self.g, self.model, self.pool = g, model, pool

    def search(self, query, location_codes=(), duty_codes=(), limit=50):
        with scratch(self.spark):
            asked = self._asked(query, location_codes, duty_codes)
            found = hybrid.hybrid_search(asked, self.held, self.held.docs, self.g.nodes, self.g.edges, limit, self.pool, model=self.model)
            return [r.job_id for r in found.orderBy("rank").select("job_id").collect()]  # at most `limit`


def respond(backend: SearchBackend, body: dict, limit: int = 50) -> dict:
    """The answer to a request {query, location_code, duty_code}; other fields and values outside the contract are errors."""
    if not isinstance(body, dict) or set(body) - {"query", "location_code", "duty_code"} or not isinstance(body.get("query"), str):
        raise ValueError("a request has a query and may have location_code and duty_code")
    asked = contracts.request(body["query"], body.get("location_code"), body.get("duty_code"))
    ids = backend.search(asked["query"], asked["locations"] or (), asked["duties"] or (), limit)
    ranked = list(enumerate(ids, 1))
    contracts.check_ranked(ranked)
    return {"request_id": f"req_{uuid.uuid4().hex[:16]}", "result": [{"job_id": i, "rank": r} for r, i in ranked]}


def server(backend: SearchBackend, host: str = "127.0.0.1", port: int = 8000, limit: int = 50) -> ThreadingHTTPServer:
    """GET /health and POST /api/v1/jobs/search; call serve_forever() on it."""

    class Handler(BaseHTTPRequestHandler):
        def _send(self, status: int, value: dict) -> None:
            data = json.dumps(value).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_GET(self):
            known = self.path == "/health"
            self._send(200 if known else 404, {"status": "ok", "backend": type(backend).__name__, "result_limit": limit} if known else {"error": "not found"})

        def do_POST(self):
            if self.path != "/api/v1/jobs/search":
                return self._send(404, {"error": "not found"})
            try:
                body = json.loads(self.rfile.read(min(1 << 20, int(self.headers.get("Content-Length") or 0))))
                self._send(200, respond(backend, body, limit))
            except (ValueError, AttributeError, TypeError) as e:
                self._send(422, {"error": str(e)})

        def log_message(self, *args):
            pass

    return ThreadingHTTPServer((host, port), Handler)
