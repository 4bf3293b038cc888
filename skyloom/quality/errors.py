"""Errors a strict quality gate raises on the driver."""

from __future__ import annotations


class QualityError(Exception):
    """Data failed its checks; ``results`` holds the summary row as a dict."""

    def __init__(self, message: str, results: dict | None = None) -> None:
        super().__init__(message)
        self.results = results or {}

    def __str__(self) -> str:
        failed = self.results.get("failed_expectations")
        text = super().__str__()
        return text if failed is None else f"{text} ({failed} failed)"
