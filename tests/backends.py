"""A stand-in for an OCR service."""

from __future__ import annotations

import base64
import json

from pageloom.operators.ocr import Backend, BackendFactory


def echo_backend(model_errors: dict[str, str] | None = None) -> BackendFactory:
    """A deterministic backend for tests and dry runs.

    Answers with the text of the bytes it was sent, one page per form feed.
    ``model_errors`` maps a text the payload starts with to an error.
    """
    failures = dict(model_errors or {})

    def make() -> Backend:
        def call(request: str) -> str:
            document = json.loads(request)["document"]
            uri = document.get("documentUrl") or document.get("imageUrl")
            payload = base64.b64decode(uri.split(";base64,", 1)[1])
            text = payload.decode("utf-8")
            for start, message in failures.items():
                if text.startswith(start):
                    raise RuntimeError(message)
            pages = [{"markdown": page} for page in text.split("\f")]
            return json.dumps({"pages": pages}, ensure_ascii=False)

        return call

    return make
