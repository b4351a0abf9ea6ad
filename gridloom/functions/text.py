"""Text rules as column expressions."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

SAFE_NAME = r"^[a-z][a-z0-9]*(?:_[a-z0-9]+)+$"
OPAQUE = r"^[A-Za-z0-9][A-Za-z0-9_.:/-]{0,127}$"


def stripped(text: Column) -> Column:
    """Without white space at the edges, Unicode's included (``trim`` takes spaces only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def present(text: Column) -> Column:
    """Stripped text, null where blank."""
    return F.nullif(stripped(text), F.lit(""))


def cell_text(text: Column) -> Column:
    """The strict extractor's white-space rules on any string column."""
    text = F.regexp_replace(text, r"\r\n?", "\n")
    text = F.regexp_replace(text, r"[\t\f\x0B ]+", " ")
    text = F.regexp_replace(text, r" *\n *", "\n")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return F.regexp_replace(text, r"^[ \n]+|[ \n]+$", "")


def fingerprint(content: Column) -> Column:
    return F.sha2(content, 256)


def artifact_reference(sha: Column) -> Column:
    return F.when(sha.rlike("^[0-9a-fA-F]{64}$"), F.concat(F.lit("artifact:"), F.substring(F.lower(sha), 1, 16)))


def content_id(value: Column) -> Column:
    inner = F.regexp_replace(F.regexp_replace(F.trim(value), "^<", ""), ">$", "")
    return F.nullif(F.trim(inner), F.lit(""))


def snake(header: Column, suffix: str = "_field") -> Column:
    """``naming.snake_name`` for names that need no cutting."""
    words = F.regexp_replace(F.trim(header), "([a-z0-9])([A-Z])", "$1_$2")
    words = F.lower(F.regexp_replace(F.regexp_replace(words, "[^0-9a-zA-Z]+|_+", "_"), "_+", "_"))
    words = F.regexp_replace(words, "^_+|_+$", "")
    numbered = F.when(words.rlike("^[0-9]"), F.concat(F.lit("col_"), words)).otherwise(words)
    return F.when(F.instr(words, "_") == 0, F.concat(F.substring(numbered, 1, 63 - len(suffix)), F.lit(suffix))).otherwise(numbered)


def is_safe_name(name: Column) -> Column:
    return name.rlike(SAFE_NAME) & (F.octet_length(name) <= 63)


def is_opaque(reference: Column) -> Column:
    return reference.rlike(OPAQUE)


def mapping_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^0-9a-z]+", "_")


def mapping_source(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(name), r"\s*\.\s*", "."), r"\s+", " ")


def canonical_json(value) -> str:
    """Sorted keys, no spaces, non-ASCII kept."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def digest(value) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()
