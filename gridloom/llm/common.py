"""What the operators share: Arrow batches in slices, bounded worker memory, bitmaps, keys of texts."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import Run, shipped

#: Word separators of the corpus contracts: space and the ASCII controls TAB to CR.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: White space to ``str.split()`` that the contracts count as part of a word.
OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Bytes of text that a worker holds in derived form at a time (one text at least).
SLICE_CHARS = 600_000
#: Bytes of one Arrow batch on its way to a worker; held in the JVM and in the worker at once.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.execution.arrow.maxRecordsPerBatch": "4096"}


def ship(spark: SparkSession) -> SparkSession:
    """Ship the package, and keep Arrow batches small."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return shipped(spark)


def release() -> None:
    """Give a worker's freed memory back to the system: workers live on after their task."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc := ctypes.CDLL(None), "malloc_trim"):
        _libc.malloc_trim(0)


class Shared:
    """Values broadcast for one step, removed from the executors when it is over."""

    def __init__(self, spark: SparkSession):
        self._context, self._held = spark.sparkContext, []

    def __call__(self, value) -> Broadcast:
        self._held.append(self._context.broadcast(value))
        return self._held[-1]

    def release(self) -> None:
        while self._held:
            self._held.pop().unpersist()


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds about ``limit`` bytes of text, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(size)
        yield batch.slice(start)


#: Bits of the filters that pick rows to read again; beyond their capacity they only filter less.
FILTER_BITS = 1 << 25


def slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))


def bitmap_words(keys: DataFrame, key: str, hashed: bool = False) -> DataFrame:
    """word and bits: a bitmap of the slots of a column's values, ``FILTER_BITS / 64`` rows at most.

    Values that are hashes already (``hashed``) are their own slots, modulo the size.
    """
    place = F.pmod(keys[key].cast("long"), F.lit(FILTER_BITS)) if hashed else slot(keys[key])
    grouped = keys.select(place.alias("slot")).groupBy(F.expr("slot div 64").alias("word"))
    return grouped.agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits"))


def bitmap(keys: DataFrame, key: str, hashed: bool = False) -> np.ndarray:
    """The same bitmap as an array for workers; the driver gets its words."""
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for batch in bitmap_words(keys, key, hashed).toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return table


def in_bitmap(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return ((table[slots >> 6] >> (slots & 63)) & 1).astype(bool)


def flagged(df: DataFrame, key: Column, words: DataFrame, flag: str) -> DataFrame:
    """``df`` with ``flag``: whether the bitmap holds the slot of the key. Only the bitmap is broadcast, whose size is fixed."""
    word, bits, place = fresh_names(df, "bitmap_word", "bitmap_bits", "bitmap_slot")
    table = F.broadcast(words.select(F.col("word").alias(word), F.col("bits").alias(bits)))
    placed = df.withColumn(place, slot(key))
    joined = placed.join(table, F.expr(f"`{place}` div 64") == table[word], "left")
    held = F.expr(f"(shiftright(`{bits}`, cast(`{place}` % 64 as int)) & 1L) = 1L")
    return joined.withColumn(flag, F.coalesce(held, F.lit(False))).drop(word, bits, place)


def words(text: str) -> list[str]:
    """``WORD.findall``, by the faster ``split()`` where that is the same."""
    return WORD.findall(text) if OTHER_SPACE.search(text) else text.split()


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], dict | None], schema: str, text: str = "text") -> DataFrame:
    """``mapInArrow`` with ``work`` called once a slice; it returns columns by name, or None for no row."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for part in slices(batches, text):
                columns = work(part)
                if columns is not None:
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in arrow], schema=arrow)
        finally:
            release()

    return df.mapInArrow(run, schema)


def text_function(work: Callable[[pa.Array], pa.Array], kind: str):
    """A column function of one text column, worked out in slices."""

    @F.arrow_udf(kind)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for column in batches:
                batch = pa.RecordBatch.from_arrays([column], names=["text"])
                yield pa.concat_arrays([work(part.column(0)) for part in slices([batch])] or [work(column)])
        finally:
            release()

    return of


def row_key(text: Column) -> Column:
    """64-bit key of a whole text; a null text has one too."""
    return F.xxhash64(text.cast("string"))


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text of a table, whatever else it holds; ``row`` among ``more`` adds the key of the text."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), *[row_key(docs["text"]).alias(m) for m in more], docs["text"].cast("string").alias("text"))


def fresh_names(docs: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that the table does not have."""
    taken = {c.lower() for c in docs.columns}
    return [next(n for n in (w + "_" * k for k in range(len(taken) + 1)) if n.lower() not in taken) for w in wanted]
