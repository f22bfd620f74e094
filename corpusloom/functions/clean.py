"""Boilerplate cleaning as Column expressions.

All steps are native regex expressions (one projection, no UDF), so a
cleaning pass is a map-only stage inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These patterns must equal the reference's for equal results.
# (?s) = dot matches newline, as the reference compiles them with DOTALL.
# ---------------------------------------------------------------------------
START_MARKER = r"\*\*\* START OF TH[EI]S? PROJECT GUTENBERG EBOOK.*?\*\*\*"
END_MARKER = r"\*\*\* END OF TH[EI]S? PROJECT GUTENBERG EBOOK"
CREDIT = r"Produced by .*?(pgdp\.net[^\n]*(\s*\(This file.*?\))?|\n)"
NOTE = r"\[\s*(Illustration|Transcriber's Note).*?\]"
# ---------------------------------------------------------------------------

# Python's str.isspace set = Java's Unicode \s plus the four separators
# U+001C..U+001F.  Java needs (?U) for \s to be Unicode-aware.
_WS = r"[\s\x{1c}-\x{1f}]"


def _java(pattern: str) -> str:
    """Make the reference's ``\\s`` behave as in Python (Unicode + U+001C-1F)."""
    return "(?sU)" + pattern.replace(r"\s", _WS)


def normalize_newlines(c: Column) -> Column:
    """A2: text-mode reading turns ``\\r\\n`` and lone ``\\r`` into ``\\n``."""
    return F.regexp_replace(c, "\r\n?", "\n")


def after_start(c: Column) -> Column:
    """B1: text after the first START marker; the whole text if there is none."""
    return F.element_at(F.split(c, _java(START_MARKER), 2), -1)


def before_end(c: Column) -> Column:
    """B2: text before the first END marker."""
    return F.element_at(F.split(c, _java(END_MARKER), 2), 1)


def drop_credits(c: Column) -> Column:
    """Delete every "Produced by ..." credit (lazy; see the pattern)."""
    return F.regexp_replace(c, _java(CREDIT), "")


def drop_notes(c: Column) -> Column:
    """Delete ``[Illustration...]`` / ``[Transcriber's Note...]`` up to the first ``]``."""
    return F.regexp_replace(c, _java(NOTE), "")


def strip_ws(c: Column) -> Column:
    """Strip leading/trailing whitespace with Python's Unicode set
    (``trim`` would strip only U+0020)."""
    return F.regexp_replace(c, r"(?U)\A" + _WS + r"+|" + _WS + r"+\z", "")


def strip_boilerplate(c: Column) -> Column:
    """B1-B5 in exactly that order, one expression."""
    return strip_ws(drop_notes(drop_credits(before_end(after_start(c)))))
