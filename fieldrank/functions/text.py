"""Tokenisers (string -> array<string>) matching the reference's splitting rules.

* url:     split on every non-word character, drop empties, case kept
* lower:   ``lower().strip().split()`` (title, headers, anchors, queries)
* raw:     ``strip().split()`` with case kept (BM25F fields, corpus documents)

``\\s`` and ``\\W`` are ASCII classes in Java regex, as in the reference's byte strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "nonempty", "tok_url", "tok_lower", "tok_raw", "tok_headers_lower", "tok_headers_raw",
    "tok_query", "tok_corpus_distinct", "regex_tokens", "body_length_clamp",
]

WS = r"\s+"


def nonempty(arr: Column) -> Column:
    return F.array_remove(arr, "")


def tok_url(url: Column) -> Column:
    """``filter(len > 0, re.split('\\W', url))`` — not lowercased, ``_`` is a word char."""
    return nonempty(F.split(F.coalesce(url, F.lit("")), r"\W", -1))


def tok_lower(s: Column) -> Column:
    """Lowercase whitespace tokens."""
    return nonempty(F.split(F.lower(F.coalesce(s, F.lit(""))), WS, -1))


def tok_raw(s: Column) -> Column:
    """Whitespace tokens, case kept."""
    return nonempty(F.split(F.coalesce(s, F.lit("")), WS, -1))


def tok_headers_lower(headers: Column) -> Column:
    """T4: tokens of all header strings concatenated in order, lowercased."""
    return F.flatten(F.transform(F.coalesce(headers, F.array().cast("array<string>")), tok_lower))


def tok_headers_raw(headers: Column) -> Column:
    """T5: as T4 with case kept (BM25F)."""
    return F.flatten(F.transform(F.coalesce(headers, F.array().cast("array<string>")), tok_raw))


def tok_query(query: Column) -> Column:
    """``query.lower().strip().split()``; duplicates kept."""
    return tok_lower(query)


def tok_corpus_distinct(text: Column) -> Column:
    """Distinct whitespace tokens of a corpus document (case kept)."""
    return F.array_distinct(tok_raw(text))


def regex_tokens(s: Column, pattern: str = "[a-z0-9_]+") -> Column:
    """All matches of ``pattern`` in ``lower(s)`` (normaliser for raw text and HTML)."""
    return F.regexp_extract_all(F.lower(F.coalesce(s, F.lit(""))), F.lit(pattern), 0)


def body_length_clamp(body_length: Column) -> Column:
    """``max(1000.0, body_length)``, missing body_length = 1.0."""
    return F.greatest(F.lit(1000.0), F.coalesce(body_length.cast("double"), F.lit(1.0)))
