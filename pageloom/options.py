"""Caller options. Plain values, never columns."""

from __future__ import annotations

from dataclasses import dataclass

# Extensions admitted when the caller names none.
DEFAULT_SUPPORTED_TYPES = (
    ".jpg",
    ".jpeg",
    ".png",
    ".webp",
    ".tiff",
    ".bmp",
    ".gif",
    ".pdf",
)

# The id is the service's own; pass ``model_name`` for the service in use.
DEFAULT_MODEL = "ocr-latest"


@dataclass(frozen=True)
class LoadOptions:
    """How files become documents.

    ``model_name`` falls back to the default when empty, ``split_pages`` and
    ``supported_types`` only when ``None``.
    """

    model_name: str | None = None
    split_pages: bool | None = None
    supported_types: tuple[str, ...] | None = None

    @property
    def model(self) -> str:
        return self.model_name or DEFAULT_MODEL

    @property
    def split(self) -> bool:
        return True if self.split_pages is None else self.split_pages

    @property
    def types(self) -> tuple[str, ...]:
        if self.supported_types is None:
            return DEFAULT_SUPPORTED_TYPES
        return tuple(self.supported_types)
