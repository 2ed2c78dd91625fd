"""Column functions (JVM-side expressions only)."""

from . import html, scoring, text, urls

__all__ = ["html", "scoring", "text", "urls"]
