"""Benchmark decontamination by size-partitioned MinHash containment search.

Short test items hide in long documents, and the shingles of an item may lie far apart there.

1. Items are dealt into parts by their number of distinct shingles (up to 1, 2, 4, 8, ...). All items of
   a part are sketched alike: an item's MinHash sketch is its shingles of the least permuted hashes, as
   many as the part needs. Of n shingles at most ``n - need`` may be missing in a document that contains
   the item (``need``: the threshold's share, rounded up), and of any k of them so at least
   ``k - (n - need)`` are there. Sketches hold ``WIDER`` times the most that may be missing in the part,
   and one more: a document is a candidate for an item exactly when it has so many of its sketch.
   Unlike banded MinHash this misses no contained item, however short or scattered it is.
2. Every shingle of a document is tested against a bitmap of all sketches (of fixed size), and what
   passes is joined with the sketches and counted by text and item.
3. Candidates are confirmed by the exact containment of the item's shingles in the whole text.

The documents are read once for the sketches and once more where they are candidates, whatever the
size of the benchmark; neither benchmark nor documents pass through the driver or are broadcast.
Equal texts are searched once.

Defined cases: null, empty or blank texts hold nothing and are found nowhere; with fewer words than
the shingle the whole sequence is one shingle, so an item of under ``width`` words is found only in a
document of exactly the same words, never inside a longer one (as in the SQL below); repeated
documents and items each give their own rows; ties in a sketch cannot occur, as shingles are distinct;
null ids are kept; very long texts are hashed whole, one text at a time; empty tables give no rows;
other columns, whatever their names, are neither read nor changed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import common
from gridloom.llm.op4_near_dedup import set_key
from gridloom.llm.shingles import MIX, mixed, row_sets
from gridloom.session import Run

#: How many times the most shingles that may be missing a sketch holds.
WIDER = 2


def missing(n: int, threshold: int) -> int:
    """How many of n distinct shingles a document may lack that still contains the item."""
    return n - max(1, -(-threshold * n // 100))


def sketch(found: np.ndarray, threshold: int) -> tuple[np.ndarray, int]:
    """The MinHash sketch of a shingle set, and how many of it a containing document has at least."""
    part = 1 << (len(found) - 1).bit_length()
    size = min(len(found), WIDER * missing(part, threshold) + 1)
    least = np.argsort(mixed(found ^ MIX), kind="stable")[:size]
    return found[least], size - missing(len(found), threshold)


def items_of(benchmark: DataFrame, width: int, threshold: int) -> DataFrame:
    """item_id, cls (key of the set), n, hits (of the sketch, needed), sketch and shingles of every item with a word."""

    def work(part: pa.RecordBatch) -> dict | None:
        rows = []
        for item_id, found in zip(part.column(0).to_pylist(), row_sets(part.column(1), width), strict=True):
            if len(found):
                least, hits = sketch(found, threshold)
                rows.append((item_id, set_key(found), len(found), hits, least.view(np.int64), found.view(np.int64)))
        return dict(zip(("item_id", "cls", "n", "hits", "sketch", "shingles"), zip(*rows, strict=True), strict=True)) if rows else None

    texts = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text"))
    return common.map_slices(texts, work, "item_id long, cls long, n long, hits long, sketch array<long>, shingles array<long>")


def sketch_hits(texts: DataFrame, keys: DataFrame, width: int, shared: common.Shared) -> DataFrame:
    """row and hash: the shingles of each text that may be in a sketch."""
    held = shared(common.bitmap(keys, "hash", hashed=True))

    def work(part: pa.RecordBatch) -> dict | None:
        owners, hashes = [], []
        for row, found in zip(part.column(0).to_pylist(), row_sets(part.column(1), width), strict=True):
            kept = found[common.in_bitmap(held.value, (found & np.uint64(common.FILTER_BITS - 1)).astype(np.int64))]
            if len(kept):
                owners.append(np.full(len(kept), row, np.int64))
                hashes.append(kept.view(np.int64))
        return {"row": np.concatenate(owners), "hash": np.concatenate(hashes)} if owners else None

    return common.map_slices(texts.select("row", "text"), work, "row long, hash long")


def sets_of(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """row and shingles of the texts whose key is in ``wanted``, and of a few more."""

    def work(part: pa.RecordBatch) -> dict:
        return {"row": part.column(0), "shingles": [found.view(np.int64) for found in row_sets(part.column(1), width)]}

    chosen = common.flagged(texts.select("row", "text"), F.col("row"), common.bitmap_words(wanted, "row"), "chosen").where("chosen")
    return common.map_slices(chosen.select("row", "text"), work, "row long, shingles array<long>")


def found_in(texts: DataFrame, benchmark: DataFrame, width: int, threshold: int, run: Run) -> tuple[DataFrame, DataFrame]:
    """The items (item_id, cls), and row, cls, n_item and n_shared of every text (by key) and item set it contains."""
    shared = common.Shared(texts.sparkSession)
    items = run.table(items_of(benchmark, width, threshold), "items")
    sets = run.table(items.drop("item_id").dropDuplicates(["cls"]), "item-sets")
    keys = run.table(sets.select("cls", "hits", F.explode("sketch").alias("hash")), "sketches")
    hits = run.table(sketch_hits(texts, keys, width, shared).distinct(), "hits")
    shared.release()
    counted = hits.join(keys, "hash").groupBy("row", "cls").agg(F.count("*").alias("met"), F.first("hits").alias("hits"))
    candidates = run.table(counted.where("met >= hits").select("row", "cls"), "candidates")
    rows = run.table(candidates.select("row").distinct(), "rows")
    whole = run.table(sets_of(texts, rows, width).join(rows, "row", "left_semi").dropDuplicates(["row"]), "texts")
    both = F.size(F.array_intersect("shingles", "wanted")).cast("long")
    checked = candidates.join(whole, "row").join(sets.select("cls", F.col("n").alias("n_item"), F.col("shingles").alias("wanted")), "cls")
    found = run.table(checked.withColumn("n_shared", both).where(100 * F.col("n_shared") >= threshold * F.col("n_item")).select("row", "cls", "n_item", "n_shared"), "found")
    run.drop(sets, keys, hits, candidates, rows, whole)
    return items.select("item_id", "cls"), found


def contained(docs: DataFrame, benchmark: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """doc_id, item_id, n_item (the item's distinct shingles) and n_shared: one row an item found in a document."""
    run, texts = Run(docs.sparkSession, "contained"), common.texts_of(docs, "row")
    items, found = found_in(texts, benchmark, width, threshold, run)
    holders = common.flagged(texts.drop("text"), F.col("row"), run.table(common.bitmap_words(found, "row"), "bitmap"), "holds").where("holds").drop("holds")
    return holders.join(found, "row").join(items, "cls").select("doc_id", "item_id", "n_item", "n_shared")


def decontaminated(docs: DataFrame, benchmark: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """``docs`` without the rows in whose texts an item is contained. Only rows in the bitmap of such texts are shuffled."""
    run = Run(docs.sparkSession, "decontaminated")
    _, found = found_in(common.texts_of(docs, "row"), benchmark, width, threshold, run)
    texts = run.table(found.select("row").distinct(), "texts")
    run.drop(found)
    maybe, key, row = common.fresh_names(docs, "maybe", "text_key", "found_row")
    placed = common.flagged(docs.withColumn(key, common.row_key(docs["text"])), F.col(key), run.table(common.bitmap_words(texts, "row"), "bitmap"), maybe)
    columns = [f"`{c}`" for c in docs.columns]
    gone = texts.select(F.col("row").alias(row))
    kept = placed.where(F.col(maybe)).join(gone, F.col(key) == F.col(row), "left_anti")
    return placed.where(~F.col(maybe)).select(columns).unionByName(kept.select(columns))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(common.documents(spark, sf_dir), common.documents(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH texts AS (
  SELECT 0 kind, row_number() OVER () k, doc_id id, text FROM documents UNION ALL SELECT 1, row_number() OVER (), item_id, text FROM benchmark),
words AS (
  SELECT kind, k, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w FROM texts),
shingles AS (
  SELECT DISTINCT kind, k, id, array_to_string(w[i:least(i + 4, len(w))], ' ') s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) i FROM words WHERE len(w) > 0)),
items AS (SELECT k, id, s, count(*) OVER (PARTITION BY k) n FROM shingles WHERE kind = 1)
SELECT d.id doc_id, i.id item_id, any_value(i.n)::BIGINT n_item, count(*)::BIGINT n_shared
FROM shingles d JOIN items i ON d.s = i.s WHERE d.kind = 0 GROUP BY d.k, i.k, d.id, i.id HAVING 100 * count(*) >= 80 * any_value(i.n)
"""
