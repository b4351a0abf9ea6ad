"""Structural reports that hold no value of the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_FIELDS = ("row_count", "data_row_count", "column_count", "header_row_index", "header_source", "header_value_count", "diagnostics")


def _shape() -> dict[str, Column]:
    """Report fields of a table, from any of its strictly parsed rows."""
    named = F.when(F.col("headers").isNull(), 0).otherwise(F.size(F.filter("headers", lambda h: h != "")))
    own = {"header_row_index": F.col("header_index").cast("long"), "header_value_count": named.cast("long"), "diagnostics": F.col("notes")}
    return {f: own.get(f, F.col(f)) for f in REPORT_FIELDS}


def first_rows(rows: DataFrame) -> DataFrame:
    """One row a table, or an artifact that has none."""
    return rows.where("coalesce(row_index, 0) = 0")


def table_shapes(rows: DataFrame, *carried: str) -> DataFrame:
    """Dimensions of each strictly parsed table, with carried columns."""
    tables = first_rows(rows).where("table_ordinal is not null")
    return tables.select("artifact_sha256", *carried, "table_ordinal", *[c.alias(n) for n, c in _shape().items()])


def reports(rows: DataFrame, *carried: str) -> DataFrame:
    """One row an artifact: identity, size, location hash, diagnostics, table shapes, or an error code.

    ``rows`` are strictly parsed; what is grouped is a row a table.
    """
    shape = F.struct("table_ordinal", *[c.alias(n) for n, c in _shape().items()])
    of_artifact = {
        "source_size_bytes": F.col("source_bytes"), "root_content_location_hash_sha256": F.sha2("location", 256), "diagnostics": F.col("document_notes"), "error_code": F.col("error_code"),
        **{c: F.col(c) for c in carried},
    }
    listed = F.sort_array(F.collect_list(F.when(F.col("table_ordinal").isNotNull(), shape)))
    grouped = first_rows(rows).groupBy(F.col("artifact_sha256").alias("source_hash_sha256")).agg(listed.alias("tables"), *[F.first(v).alias(n) for n, v in of_artifact.items()])
    tables = F.transform("tables", lambda t: F.struct(*[t[f].alias(f) for f in REPORT_FIELDS]))
    return grouped.select("source_hash_sha256", "source_size_bytes", "root_content_location_hash_sha256", F.size("tables").alias("table_count"), "diagnostics", tables.alias("tables"), "error_code", *carried)


def report_json(found: DataFrame) -> DataFrame:
    """The report of each artifact as JSON with sorted keys; of a failed one, its error code alone."""
    names = ("source_hash_sha256", "source_size_bytes", "root_content_location_hash_sha256", "table_count", "diagnostics", "tables")
    whole = F.to_json(F.struct(*sorted(names)), {"ignoreNullFields": "false"})
    return found.select("source_hash_sha256", F.when(F.col("error_code").isNull(), whole).otherwise(F.to_json(F.struct("error_code"))).alias("report"))
