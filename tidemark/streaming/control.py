"""The engine's control plane over HTTP: JSON answers, counters as text."""

from __future__ import annotations

import json
import threading
from dataclasses import asdict
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

from tidemark.streaming.sinks import Engine


def answer(engine: Engine, method: str, target: str, body: str = "") -> tuple[int, object]:
    """(status, JSON value, or text for counters) of a request; unknown paths are 404, requests that can't be met 400."""
    url = urlsplit(target)
    parts = [p for p in url.path.split("/") if p]
    try:
        if method == "GET":
            if parts == ["status"]:
                return 200, {**engine.status(), "synced": engine.synced(), "sinks": engine.progress}
            if parts == ["metrics"]:
                return 200, "".join(f"tidemark_{k} {v}\n" for k, v in sorted(engine.metrics().items()))
            if parts == ["schema"]:
                return 200, engine.databases()
            if parts[:1] == ["schema"] and len(parts) == 2:
                return 200, engine.tables(parts[1])
            if parts[:1] == ["schema"] and len(parts) == 3:
                return 200, asdict(engine.table_def(*parts[1:]))
            if parts == ["ddl", "failed"]:
                return 200, engine.failed_ddl()
        elif method == "POST":
            if parts == ["ddl", "retry"]:
                engine.retry_ddl()
                return 200, {"ok": True}
            if parts == ["ddl", "exec"]:
                engine.exec_ddl(parse_qs(url.query).get("sql", [body])[0])
                return 200, {"ok": True}
    except Exception as e:
        return 400, {"error": f"{type(e).__name__}: {e}"}
    return 404, {"error": f"no {method} {url.path}"}


def serve(engine: Engine, host: str = "127.0.0.1", port: int = 0) -> ThreadingHTTPServer:
    """A running server; its port is ``server_address[1]``, ``shutdown()`` ends it."""

    class Requests(BaseHTTPRequestHandler):
        def _do(self) -> None:
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0)).decode()
            status, value = answer(engine, self.command, self.path, body)
            text = value if isinstance(value, str) else json.dumps(value, default=str)
            raw = text.encode()
            self.send_response(status)
            self.send_header("Content-Type", "text/plain" if isinstance(value, str) else "application/json")
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        do_GET = do_POST = _do  # noqa: N815

        def log_message(self, *args) -> None:
            pass

    server = ThreadingHTTPServer((host, port), Requests)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
