"""Secrets out of text: literal values first, the longest before its parts, then known shapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REDACTED = "[REDACTED]"
#: The shapes that are redacted, in this order.
SHAPES = (
    (r"(?U)\b[\w.+-]+@[\w-]+\.[\w.-]+\b", REDACTED),
    (r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", REDACTED),
    (r"\bsb_(?:secret|publishable)_[A-Za-z0-9_-]+", REDACTED),
    (r"\bsk-[A-Za-z0-9_-]{16,}", REDACTED),
    (r"\bre_[A-Za-z0-9_-]{16,}", REDACTED),
    (r"\bgh[pousr]_[A-Za-z0-9]{16,}", REDACTED),
    (r"\bgithub_pat_[A-Za-z0-9_]{20,}", REDACTED),
    (r"(?i)\b(authorization|apikey|api[-_]?key)\s*[:=]\s*\S[^,;}\]\"'\n]*", "$1: " + REDACTED),
)
#: Shorter values would match ordinary text.
SHORTEST = 8


def secret_values(values: list[str]) -> list[str]:
    """The distinct values worth looking for, longest first."""
    return sorted({v.strip() for v in values if v and len(v.strip()) >= SHORTEST}, key=lambda v: (-len(v), v))


def scrub(text: Column, secrets: list[str] = ()) -> Column:
    """text with secrets and secret shapes redacted. Null stays null."""
    for value in secret_values(list(secrets)):
        text = F.replace(text, F.lit(value), F.lit(REDACTED))
    for shape, by in SHAPES:
        text = F.regexp_replace(text, shape, by)
    return text
