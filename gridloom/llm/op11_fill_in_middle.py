"""Fill-in-the-middle: documents cut at token offsets and rearranged for infilling.

A ``Split`` pre-tokenizer of the ``tokenizers`` library, with isolated matches of a pattern, gives the code-point
offsets of a text's tokens; nothing is trained. The length of the offset array is the number of tokens n; the
offsets at two ranks drawn from a hash of the document's id are where prefix and middle end. Texts are handed to
the library in parts of about ``PART_CHARS`` code points, cut where no token can span: short parts are
split faster, and offsets of long texts do not all exist as objects at once; what is kept is one array of integers.

Each document is worked out by itself, in the task that reads it: no shuffle, and a lost task is run again.

Defined cases: a null text counts as empty, and empty texts stay plain (n = 0); a null doc_id is drawn as the empty
string and stays null; texts that hold a marker stay plain, so that every other output can be rebuilt; equal
doc_ids draw alike, repeated rows give a row each; empty parts are kept (an empty middle among them); very long
texts are taken whole; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import common

#: Tokens: runs of ASCII letters, and any other code point by itself.
PATTERN = "[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of 100 documents, so many are rearranged; of 100 of these, so many begin with the suffix.
REARRANGED, SUFFIX_FIRST = 90, 20
#: Code points given to the pre-tokenizer at a time, about.
PART_CHARS = 1 << 10

SCHEMA = "doc_id long, n long, form string, prefix string, middle string, suffix string, output string"


def splitter(pattern: str = PATTERN) -> Callable[[str], list]:
    """Text to ``[(token, (start, end)), ...]``."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(pattern), "isolated").pre_tokenize_str


def _letter(c: str) -> bool:
    return c.isascii() and c.isalpha()


def parts(text: str, size: int = PART_CHARS) -> list[tuple[int, int]]:
    """Bounds of parts that no token spans: a part ends beside a code point that is no ASCII letter."""
    bounds, start = [], 0
    while len(text) - start > size:
        end = start + size
        while end < len(text) and _letter(text[end - 1]) and _letter(text[end]):
            end += 1
        bounds.append((start, end))
        start = end
    return [*bounds, (start, len(text))] if start < len(text) else bounds


def token_starts(text: str, split: Callable[[str], list], size: int = PART_CHARS) -> np.ndarray:
    """Where each token of ``PATTERN`` starts, in code points."""
    found = [np.fromiter(map(itemgetter(0), map(itemgetter(1), split(text[a:b]))), np.int64) + a for a, b in parts(text, size)]
    return np.concatenate(found) if found else np.empty(0, np.int64)


def draws(doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits from the hash of the document's id."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def form_of(text: str, h3: int, h4: int) -> str:
    if not text or any(m in text for m in MARKERS) or h3 % 100 >= REARRANGED:
        return PLAIN
    return SPM if h4 % 100 < SUFFIX_FIRST else PSM


def transformed(doc_id: int | None, text: str, split: Callable[[str], list], size: int = PART_CHARS) -> tuple:
    """n, form, prefix, middle, suffix (null if plain) and the output of one document."""
    h1, h2, h3, h4 = draws(doc_id)
    starts = token_starts(text, split, size)
    n, form = len(starts), form_of(text, h3, h4)
    if form == PLAIN:
        return n, form, None, None, None, text
    first, last = (int(starts[rank]) if rank < n else len(text) for rank in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    output = PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle if form == PSM else SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, form, prefix, middle, suffix, output


def fill_in_middle(docs: DataFrame, pattern: str = PATTERN) -> DataFrame:
    """One row a document: n, form, the three parts (null if plain) and the output.

    Tokens of another pattern may span any place, so texts are then split whole.
    """
    held: list = []
    size = PART_CHARS if pattern == PATTERN else sys.maxsize

    def work(part: pa.RecordBatch) -> dict:
        if not held:
            held.append(splitter(pattern))
        ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
        rows = [transformed(i, t or "", held[0], size) for i, t in zip(ids, texts, strict=True)]
        names = ("n", "form", "prefix", "middle", "suffix", "output")
        return {"doc_id": part.column(0), **dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))}

    return common.map_slices(common.texts_of(docs), work, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text of an output. No marker overlaps itself or another, so the first occurrence is the one that was put in."""
    outer, inner = (F.when(form == PSM, a).otherwise(b) for a, b in ((PREFIX, SUFFIX), (SUFFIX, PREFIX)))
    body = F.substr(output, F.length(outer) + 1)
    cut, end = F.position(inner, body), F.position(F.lit(MIDDLE), body)
    left, right = F.substr(body, F.lit(1), cut - 1), F.substr(body, cut + F.length(inner), end - cut - F.length(inner))
    middle = F.substr(body, end + len(MIDDLE))
    return F.when(form == PLAIN, output).when(form == PSM, F.concat(left, middle, right)).otherwise(F.concat(right, middle, left))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(common.documents(spark, sf_dir))
    chars = lambda c: F.length(c).cast("long").alias(f"{c}_chars")
    digest = lambda c, name: F.sha2(c, 256).alias(name)
    return made.select("doc_id", "n", "form", chars("prefix"), chars("middle"), digest(F.col("output"), "output_sha256"), digest(restored(F.col("output"), F.col("form")), "restored_sha256"))


ORACLE_SQL = r"""
WITH drawn AS (SELECT doc_id, coalesce(text, '') t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) h, length(regexp_replace(coalesce(text, ''), '[A-Za-z]+', 'a', 'g')) n FROM documents),
ranked AS (SELECT doc_id, t, n, ('0x' || h[1:8])::BIGINT % (n + 1) a, ('0x' || h[9:16])::BIGINT % (n + 1) b, ('0x' || h[17:24])::BIGINT % 100 c, ('0x' || h[25:32])::BIGINT % 100 d FROM drawn),
formed AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain' WHEN d < 20 THEN 'spm' ELSE 'psm' END form, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') k FROM ranked),
cut AS (SELECT *, array_to_string(k[1:least(a, b)], '') p, array_to_string(k[least(a, b) + 1:greatest(a, b)], '') m, array_to_string(k[greatest(a, b) + 1:], '') s FROM formed)
SELECT doc_id, n::BIGINT n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) output_sha256, sha256(t) restored_sha256
FROM cut
"""
