"""Choosing tables and rows from the parse stage's output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.text import present


def texts(cells: Column) -> Column:
    return F.transform(cells, lambda c: c["text"])


def primary(rows: DataFrame) -> DataFrame:
    """Rows of each artifact's largest table (columns times data rows, the first of equals)."""
    return rows.where("is_primary")


def only_table(rows: DataFrame) -> DataFrame:
    """Rows of artifacts with exactly one table that has a header; blank rows before it stay."""
    return rows.where("error_code is null and table_count = 1 and headers is not null")


def data_rows(rows: DataFrame) -> DataFrame:
    """Rows without the header, numbered from 1 in each table, cells as texts."""
    return rows.where("not is_header_row").withColumn("cells", texts(F.col("cells")))


def as_maps(rows: DataFrame) -> DataFrame:
    """Header to cell; missing cells are blank, the last of equal headers wins."""
    width = F.size("headers")
    padded = F.transform(F.sequence(F.lit(1), width), lambda i: F.coalesce(F.try_element_at("cells", i), F.lit("")))
    return rows.withColumn("values", F.map_from_arrays("headers", padded))


def has_headers(headers: Column, required: list[str]) -> Column:
    """Exact names, case included."""
    return F.size(F.array_except(F.array(*[F.lit(r) for r in required]).cast("array<string>"), headers)) == 0


def long_cells(rows: DataFrame) -> DataFrame:
    """artifact_sha256, row_no, ordinal, header and the present value (null where blank or missing)."""
    cells = rows.select("artifact_sha256", "row_no", "cells", F.posexplode("headers").alias("ordinal", "header"))
    value = present(F.try_element_at("cells", F.col("ordinal") + 1))
    return cells.select("artifact_sha256", "row_no", "ordinal", "header", value.alias("value"))
