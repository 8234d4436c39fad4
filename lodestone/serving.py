"""The request side without a model: which requests are valid, and a server that answers with the stub."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Mapping
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ranges of a request's fields: name, least, most, whether the least itself is allowed (fixed values).
PROMPT_CHARS, CONTEXT_CHARS = (1, 8000), 16000
RANGES = (("max_new_tokens", 1, 1024, True), ("temperature", 0.0, 2.0, True), ("top_p", 0.0, 1.0, False))
DEFAULTS = {"max_new_tokens": 256, "temperature": 0.0, "top_p": 0.9}
STUB = "[stub] No model is loaded, so this is a placeholder response. The prompt received was: "


def invalid_field(prompt: Column, context: Column, **numbers: Column) -> Column:
    """The first field of a request that is out of range, or null; numbers that are null take their defaults."""
    checks = [("prompt", prompt.isNull() | ~F.length(prompt).between(*PROMPT_CHARS)), ("context", F.coalesce(F.length(context), F.lit(0)) > CONTEXT_CHARS)]
    for name, least, most, closed in RANGES:
        if name in numbers:
            v = F.coalesce(numbers[name], F.lit(DEFAULTS[name]))
            low = v < least if closed else v <= least
            checks.append((name, low | (v > most) | F.isnan(v.cast("double"))))
    return F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in checks])


def checked(request: dict) -> str | None:
    """The same for one request as a mapping."""
    prompt, context = request.get("prompt"), request.get("context")
    if not isinstance(prompt, str) or not PROMPT_CHARS[0] <= len(prompt) <= PROMPT_CHARS[1]:
        return "prompt"
    if context is not None and (not isinstance(context, str) or len(context) > CONTEXT_CHARS):
        return "context"
    for name, least, most, closed in RANGES:
        v = request.get(name, DEFAULTS[name])
        if isinstance(v, bool) or not isinstance(v, int | float) or not (least <= v if closed else least < v) or not v <= most:
            return name
    return None


def model_to_serve(given: str | None = None, env: Mapping[str, str] | None = None) -> str | None:
    """Which model answers: none (the stub) if the environment asks for the stub, else the one given, else the environment's."""
    env = os.environ if env is None else env
    if env.get("LODESTONE_STUB", "").lower() in ("1", "true", "yes"):
        return None
    return given or env.get("LODESTONE_MODEL_URI") or None


class Handler(BaseHTTPRequestHandler):
    def _send(self, status: int, body: dict) -> None:
        raw = json.dumps(body).encode()
        self.send_response(status)
        self.send_header("Content-Type", "application/json")
        self.send_header("Content-Length", str(len(raw)))
        self.end_headers()
        self.wfile.write(raw)

    def do_GET(self) -> None:
        self._send(200, {"status": "ok", "model": "stub"}) if self.path == "/health" else self._send(404, {})

    def do_POST(self) -> None:
        started = time.perf_counter()
        if self.path != "/predict":
            return self._send(404, {})
        try:
            request = json.loads(self.rfile.read(int(self.headers.get("Content-Length") or 0)))
            wrong = checked(request) if isinstance(request, dict) else "body"
        except ValueError:
            wrong = "body"
        if wrong:
            return self._send(422, {"detail": wrong})
        text = STUB + request["prompt"][:200]
        self._send(200, {"model": "stub", "prediction": text, "finish_reason": "stub", "latency_ms": round((time.perf_counter() - started) * 1000, 3), "prompt_tokens": len(request["prompt"].split()), "completion_tokens": len(text.split())})

    def log_message(self, *_) -> None:
        pass


def server(port: int) -> ThreadingHTTPServer:
    return ThreadingHTTPServer(("127.0.0.1", port), Handler)


def run(port: int) -> None:
    with server(port) as s:
        s.serve_forever()
