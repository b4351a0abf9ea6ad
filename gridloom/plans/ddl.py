"""Table schemas with logical types, and their DDL texts."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql.types import BooleanType, DataType, DateType, DecimalType, LongType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from gridloom.errors import GridloomError
from gridloom.functions.naming import safe_identifier, sql_literal, unique_snake_names
from gridloom.functions.types import LOAD_TYPES, PRECISION, SCALE

DEFAULT_TABLE = "web_table_rows"
SUPPORTED = (*LOAD_TYPES, "TEXT")
# The lineage columns of every loaded table.
LINEAGE = (("source_artifact_path", "TEXT"), ("source_artifact_sha256", "TEXT"), ("source_row_number", "BIGINT"), ("loaded_at", "TIMESTAMP"))


@dataclass(frozen=True)
class Column:
    source_name: str
    name: str
    type: str
    comment: str | None = None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]

    def struct(self) -> StructType:
        fields = []
        for c in self.columns:
            metadata = {"source_name": c.source_name, "logical_type": c.type} | ({"comment": c.comment} if c.comment else {})
            fields.append(StructField(c.name, spark_type(c.type), True, metadata))
        lineage = {"TEXT": StringType(), "BIGINT": LongType(), "TIMESTAMP": TimestampType()}
        return StructType(fields + [StructField(n, lineage[t], False) for n, t in LINEAGE])

    def types(self) -> dict[str, str]:
        return {c.source_name: c.type for c in self.columns}

    def comments(self) -> dict[str, str]:
        return {c.name: c.comment for c in self.columns if c.comment is not None}

    def commented(self, comments: dict[str, str]) -> Table:
        return replace(self, columns=tuple(replace(c, comment=comments.get(c.name, c.comment)) for c in self.columns))


def spark_type(logical: str, stored: bool = False) -> DataType:
    """Type of a load type when read. Times are text, as parquet readers differ on TIME; numbers are stored as their digits."""
    if logical not in SUPPORTED:
        raise GridloomError("unsupported_type")
    if stored and logical == "NUMERIC":
        return StringType()
    return {"BOOLEAN": BooleanType(), "BIGINT": LongType(), "NUMERIC": DecimalType(PRECISION, SCALE), "TIMESTAMP": TimestampNTZType(), "DATE": DateType()}.get(logical, StringType())


def lineage_types() -> list[str]:
    return [n for n, _ in LINEAGE]


def table_of(name: str, headers: list[str], types: list[str]) -> Table:
    return Table(safe_identifier(name), tuple(Column(h, n, t) for h, n, t in zip(headers, unique_snake_names(headers), types, strict=True)))


def create_ddl(table: Table, lineage: bool = True) -> str:
    lines = []
    for c in table.columns:
        if c.type not in SUPPORTED:
            raise GridloomError("unsupported_type")
        lines.append(f"    {safe_identifier(c.name)} {c.type}")
    if lineage:
        lines += [f"    {n} {t} NOT NULL" + (" DEFAULT NOW()" if n == "loaded_at" else "") for n, t in LINEAGE]
    return f"CREATE TABLE IF NOT EXISTS {safe_identifier(table.name)} (\n" + ",\n".join(lines) + "\n);"


def comment_ddl(table: Table) -> list[str]:
    return [f"COMMENT ON COLUMN {safe_identifier(table.name)}.{safe_identifier(c.name)} IS {sql_literal(c.comment)};" for c in table.columns if c.comment is not None]


def ddl(table: Table, lineage: bool = True, comments: bool = True) -> str:
    return "\n\n".join([create_ddl(table, lineage), *(comment_ddl(table) if comments else [])])
