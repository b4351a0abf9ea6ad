"""Quality selection by importance resampling over hashed n-grams.

Words (ASCII lower-cased) and word pairs of a text are hashed into ``buckets``. Two bag models are
counted: the raw one over every row, the target one over rows labelled as good (a bounded sample of
at most ``target_rows`` labels, the least by a hash of the id). A row's importance is the log-ratio of
the models over its n-grams: the ratio of the two models' probabilities of the whole text. With ``effective`` it
is scaled to a text of so many n-grams, which gives the noise more weight among long texts. Rows are resampled without replacement by Gumbel top-k: the k
greatest of importance plus Gumbel noise (a hash of id, text and a seed). k is ``fraction`` of the rows that have an n-gram, by default
the share of good rows among the labelled. The k-th greatest key is found by repeated histograms,
so no task sorts or gathers all rows.

Defined cases: null or blank text: no n-gram, null log_weight, never selected; no label: the
target equals the raw model; rows that tie at the k-th key are all selected; repeated rows each get
a row and the same verdict; null ids are kept, and told apart by their texts; an empty table gives no
rows; very long texts are counted whole, one text at a time; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import common
from gridloom.llm.shingles import MIX, mixed, row_words
from gridloom.session import Run

BUCKETS, BINS = 10_000, 4096
#: Integer key units of one nat.
UNIT = 1_000_000_000

def features(words: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of each word and of each pair of neighbouring words, from word hashes."""
    pairs = mixed(words[:-1] * MIX + words[1:])
    return (np.concatenate([words, pairs]) % np.uint64(buckets)).astype(np.int64)


def row_features(column: pa.Array, buckets: int) -> Iterator[np.ndarray]:
    words, bounds = row_words(column)
    for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield features(words[start:stop], buckets)


def counts(docs: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """bucket, raw, target: n-gram counts over all rows, and over rows of ``target`` (ids; bounded)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for part in common.slices(batches):
            for found, wanted in zip(row_features(part.column(1), buckets), part.column(2).to_pylist(), strict=True):
                found = np.bincount(found, minlength=buckets)
                raw += found
                if wanted:
                    good += found
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(good[seen])], names=["bucket", "raw", "target"])
        common.release()

    common.ship(docs.sparkSession)
    marked = docs.join(F.broadcast(target.withColumn("wanted", F.lit(True))), "doc_id", "left")
    parts = marked.select("doc_id", "text", F.coalesce("wanted", F.lit(False))).mapInArrow(run, "bucket long, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(table: DataFrame, buckets: int) -> np.ndarray:
    """ln p_target - ln p_raw by bucket, one added to each count; the table has at most ``buckets`` rows."""
    raw, good = np.ones(buckets), np.ones(buckets)
    for bucket, n, m in table.collect():
        raw[bucket] += n
        good[bucket] += m
    if good.sum() == buckets:
        return np.zeros(buckets)
    return np.log(good / good.sum()) - np.log(raw / raw.sum())


def importance(texts: DataFrame, ratios: np.ndarray, effective: float | None) -> DataFrame:
    """doc_id, row, n_ngrams, log_weight."""

    def work(part: pa.RecordBatch) -> dict:
        sizes, weights = [], []
        for found in row_features(part.column(2), len(ratios)):
            sizes.append(len(found))
            weights.append(float(ratios[found].sum()) * (effective / len(found) if effective else 1.0) if len(found) else None)
        return {"doc_id": part.column(0), "row": part.column(1), "n_ngrams": sizes, "log_weight": weights}

    return common.map_slices(texts, work, "doc_id long, row long, n_ngrams long, log_weight double")


def kth_greatest(rows: DataFrame, key: str, k: int) -> int | None:
    """The k-th greatest value of a long column, by histograms of ever narrower ranges."""
    low, high, n = rows.agg(F.min(key), F.max(key), F.count(key)).first()
    if not n or k <= 0:
        return None
    k = min(k, n)
    while low < high:
        width = (high - low) // BINS + 1
        inside = rows.where(F.col(key).between(low, high)).select(F.expr(f"({key} - {low}L) div {width}L").alias("bin"))
        above = 0
        for bin_, n in sorted(inside.groupBy("bin").agg(F.count("*")).collect(), reverse=True):
            if above + n >= k:
                low, high, k = low + bin_ * width, min(high, low + (bin_ + 1) * width - 1), k - above
                break
            above += n
    return low


def resample(docs: DataFrame, labels: DataFrame, fraction: float | None = None, buckets: int = BUCKETS, target_rows: int = 20_000, effective: float | None = None, seed: int = 11) -> DataFrame:
    """doc_id, n_ngrams, log_weight, gumbel_key and selected of every row; without ``effective`` the key is the plain importance weight."""
    texts = common.texts_of(docs)
    marks = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("quality")).where("doc_id is not null and quality is not null")
    good = marks.where("quality = 1").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(target_rows)
    ratios = log_ratios(counts(texts, good, buckets), buckets)
    uniform = (F.pmod(F.xxhash64("doc_id", "row", F.lit(seed)), F.lit(1 << 52)) + 0.5) / (1 << 52)
    key = ((F.col("log_weight") - F.log(-F.log(uniform))) * UNIT).cast("long")
    rows = Run(docs.sparkSession, "resample").table(importance(common.texts_of(docs, "row"), ratios, effective).withColumn("key", key).drop("row"), "keys")
    if fraction is None:
        all_marks, good_marks = marks.agg(F.count("*"), F.sum(F.when(F.col("quality") == 1, 1).otherwise(0))).first()
        fraction = good_marks / all_marks if all_marks else 1.0
    least = kth_greatest(rows, "key", round(fraction * rows.where("key is not null").count()))
    chosen = F.coalesce(F.col("key") >= least, F.lit(False)) if least is not None else F.lit(False)
    return rows.select("doc_id", "n_ngrams", "log_weight", (F.col("key") / UNIT).alias("gumbel_key"), chosen.alias("selected"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(common.documents(spark, sf_dir), common.documents(spark, sf_dir, "labels"))
