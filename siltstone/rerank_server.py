"""A reranking service: POST /rerank {query, texts, top_k?} answers {results: [{index, score}]}, GET /health answers {status}."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

PairScorer = Callable[[str, list[str]], list[float]]
#: Texts that a scorer gets at once.
BATCH = 32


def term_overlap(query: str, texts: list[str]) -> list[float]:
    """Jaccard similarity of the terms, as the engine's own offline scorer has it."""
    terms = lambda s: {t for t in re.findall("[a-z0-9]+", s.lower()) if len(t) >= 2}
    asked = terms(query)
    return [len(asked & t) / len(asked | t) if asked | t else 0.0 for t in map(terms, texts)]


def rank(query: str, texts: list[str], scorer: PairScorer = term_overlap, top_k: int | None = None) -> list[dict]:
    """Indices and scores, best first, ties in the given order."""
    scores = [s for at in range(0, len(texts), BATCH) for s in scorer(query, texts[at : at + BATCH])]
    order = sorted(range(len(texts)), key=lambda i: -scores[i])
    return [{"index": i, "score": float(scores[i])} for i in order[:top_k]]


def server(port: int = 0, scorer: PairScorer = term_overlap, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """A server that is bound and not started; port 0 takes a free one."""

    class Handler(BaseHTTPRequestHandler):
        def _answer(self, code: int, body: dict) -> None:
            data = json.dumps(body).encode()
            self.send_response(code)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_GET(self) -> None:
            self._answer(200, {"status": "ok"}) if self.path == "/health" else self._answer(404, {"error": "not found"})

        def do_POST(self) -> None:
            try:
                asked = json.loads(self.rfile.read(int(self.headers.get("Content-Length", 0))))
                found = rank(asked["query"], asked["texts"], scorer, asked.get("top_k"))
            except (KeyError, TypeError, ValueError) as e:
                return self._answer(400, {"error": str(e)})
            return self._answer(200, {"results": found}) if self.path == "/rerank" else self._answer(404, {"error": "not found"})

        def log_message(self, *_) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
