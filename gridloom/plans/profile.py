"""Column types of artifacts, and how they merge into a table's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions import types

SAMPLE_ROWS = 200


def column_types(cells: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """artifact_sha256, ordinal, header, kind (from the first rows) and misfit (over all rows).

    ``cells``: artifact_sha256, row_no, ordinal, header, value (stripped, null where blank).
    """
    # a bit for each type that a value conforms to: two aggregates say it of all types, for the first rows and for all
    conforming = sum((F.when(types.conforms(F.col("value"), t), 1 << i).otherwise(0) for i, t in enumerate(types.LOAD_TYPES)), F.lit(0))
    each = cells.select("artifact_sha256", "ordinal", "header", (F.col("row_no") <= sample).alias("sampled"), F.when(F.col("value").isNotNull(), conforming).alias("types"))
    first = F.when(F.col("sampled"), F.col("types"))
    found = each.groupBy("artifact_sha256", "ordinal", "header").agg(F.count(first).alias("seen"), F.bit_and(first).alias("sample_types"), F.bit_and("types").alias("all_types"))
    kind, fits = F.lit("TEXT"), F.lit(True)
    for i, t in reversed(list(enumerate(types.LOAD_TYPES))):
        kind = F.when(F.col("sample_types").bitwiseAND(1 << i) != 0, t).otherwise(kind)
        fits = F.when(F.col("kind") == t, F.col("all_types").bitwiseAND(1 << i) != 0).otherwise(fits)
    typed = found.withColumn("kind", F.when(F.col("seen") == 0, "TEXT").otherwise(kind))
    return typed.select("artifact_sha256", "ordinal", "header", "kind", (~F.coalesce(fits, F.lit(True))).alias("misfit"))


def merged_types(found: DataFrame) -> DataFrame:
    """header, ordinal (first seen), type (one throughout and no misfit, else TEXT), kinds met."""
    one = (F.count_distinct("kind") == 1) & ~F.bool_or("misfit")
    return found.groupBy("header").agg(F.min("ordinal").alias("ordinal"), F.when(one, F.min("kind")).otherwise("TEXT").alias("type"), F.collect_set("kind").alias("kinds"))


def promoted(live: str | None, incoming: str, misfit: bool) -> str:
    """Type of a live column after an artifact: any mismatch or misfit widens to TEXT, never back."""
    if live is None:
        return "TEXT" if misfit else incoming
    return live if live == "TEXT" or live == incoming and not misfit else "TEXT"
