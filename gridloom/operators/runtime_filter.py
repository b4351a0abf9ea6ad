"""A filter of fixed size for rows that must not be shuffled, such as artifacts with their contents.

The keys that are wanted set bits of a bitmap, which is built by an aggregate and broadcast; rows whose bit is
not set go before anything else is done with them. A row may pass by chance, never be missed, and no row moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a bitmap: 4 MB, sent as at most 524 288 rows. With more keys it only filters less.
BITS = 1 << 25


def slot(*keys: Column, bits: int = BITS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def bitmap(wanted: DataFrame, *keys: str, bits: int = BITS) -> DataFrame:
    """word and mask: the bits of the wanted keys, 64 to a row."""
    at = wanted.select(slot(*[wanted[k] for k in keys], bits=bits).alias("at"))
    return at.groupBy(F.expr("at div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("mask"))


def passing(rows: DataFrame, words: DataFrame, *keys: str, bits: int = BITS) -> DataFrame:
    """Rows whose keys may be wanted."""
    at, word, mask = "_filter_at", "_filter_word", "_filter_mask"
    table = F.broadcast(words.select(F.col("word").alias(word), F.col("mask").alias(mask)))
    joined = rows.withColumn(at, slot(*[rows[k] for k in keys], bits=bits)).join(table, F.expr(f"{at} div 64 = {word}"))
    return joined.where(F.expr(f"(shiftright({mask}, cast({at} % 64 as int)) & 1L) = 1L")).drop(at, word, mask)
