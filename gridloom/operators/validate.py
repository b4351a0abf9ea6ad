"""Checks of a table before it is loaded. Family rules are data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Family:
    """A kind of export: known by its table name, by one key header, or by several hint headers."""

    name_part: str
    keys: tuple[str, ...]
    hints: tuple[str, ...]
    least_hints: int = 2


# The export family that the reference results depend on.
DEFAULT_FAMILY = Family("zcrht811", ("MANDT", "GUID"), ("DOCNOSUB", "ACTHGUID", "VOCTP", "VOCCTS", "ERTCD", "ZGBISPJTNO"))


def _texts(values: tuple[str, ...] | list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def upper(headers: Column) -> Column:
    return F.transform(headers, lambda h: F.upper(F.trim(h)))


def in_family(headers: Column, table: Column, family: Family = DEFAULT_FAMILY) -> Column:
    up = upper(headers)
    named = F.coalesce(F.contains(F.lower(table), F.lit(family.name_part)), F.lit(False))
    return named | F.arrays_overlap(up, _texts(family.keys)) | (F.size(F.array_intersect(up, _texts(family.hints))) >= family.least_hints)


def required_headers(headers: Column, table: Column, explicit: list[str] | None = None, family: Family = DEFAULT_FAMILY) -> Column:
    """An explicit list wins, an empty one too; else the family's keys where it applies; else none."""
    if explicit is not None:
        return _texts(explicit)
    return F.when(in_family(headers, table, family), _texts(family.keys)).otherwise(_texts([]))


def missing_headers(headers: Column, required: Column) -> Column:
    return F.array_except(F.transform(required, lambda h: F.upper(h)), upper(headers))


def failure(explicit: list[str] | None = None, table: str | None = None, need_rows: bool = True) -> Column:
    """The first rule that a leniently parsed table fails, from any of its rows; null where it passes."""
    lacking = missing_headers(F.col("headers"), required_headers(F.col("headers"), F.lit(table).cast("string"), explicit))
    rule = F.when(F.size("headers") == 0, "no_headers").when(F.exists("headers", lambda h: F.trim(h) == ""), "blank_header").when(F.size(lacking) > 0, "missing_headers")
    rule = rule.when(F.col("ragged_row").isNotNull(), "ragged_row")
    return rule.when(F.col("data_row_count") == 0, "no_data_rows") if need_rows else rule


def verdicts(rows: DataFrame, *carried: str, **rules) -> DataFrame:
    """One row an artifact: its primary table's headers, counts, first ragged row and first failing rule.

    ``rows`` are leniently parsed; the rules (explicit, table, need_rows) are those of :func:`failure`.
    """
    heads = rows.where("is_primary and is_header_row")
    return heads.select("artifact_sha256", *carried, F.transform("headers", lambda h: F.trim(h)).alias("headers"), "column_count", "data_row_count", "ragged_row", failure(**rules).alias("failure"))
