"""What a load needs of the place it loads into, and the ingest catalog."""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.errors import LoadFailed
from gridloom.functions.naming import legacy_names, legacy_table_name
from gridloom.plans.ddl import Column, Table

# Columns of the ingest catalog, its key, and what one of them was called before.
CATALOG = "source_artifact_sha256 string, table_name string, source_artifact_path string, source_artifact_size long, row_count long, load_status_code string, loaded_at timestamp"
KEY = ("source_artifact_sha256", "table_name")
STATUS, OLD_STATUS = "load_status_code", "status"


def _renamed(catalog: DataFrame, old: str, new: str) -> DataFrame:
    if {old, new} <= set(catalog.columns):
        raise LoadFailed("ambiguous_catalog")
    return catalog.withColumnRenamed(old, new)


def upgraded(catalog: DataFrame) -> DataFrame:
    """A catalog whose status column may still have its old name; with both names it is ambiguous and refused."""
    return _renamed(catalog, OLD_STATUS, STATUS)


def downgraded(catalog: DataFrame) -> DataFrame:
    """The catalog as older releases read it."""
    return _renamed(catalog, STATUS, OLD_STATUS)


class Sink(ABC):
    """A table that loads go into. Rows are staged by a distributed write, and count once they are committed."""

    name: str

    @abstractmethod
    def version(self) -> int:
        """What a commit is based on."""

    @abstractmethod
    def table(self) -> Table:
        """The columns so far."""

    @abstractmethod
    def catalog(self) -> DataFrame:
        """The newest entry of each artifact, with the columns of ``CATALOG`` at least."""

    @abstractmethod
    def tables(self) -> set[str]:
        """Names of all tables there."""

    @abstractmethod
    def write_rows(self, rows: DataFrame, types: dict[str, str]) -> str:
        """Stage the rows of a load, whose columns have the given types; the load's id."""

    @abstractmethod
    def commit(self, table: Table, load: str | None, types: dict[str, str], entries: DataFrame | None, base: int, replaces: bool = False, stamp: tuple[str, int] | None = None) -> None:
        """Publish columns, a staged load and its catalog entries together, or nothing at all.

        With ``replaces`` the entries' artifacts may have older rows, which go. A ``stamp`` is a stream and the number of
        its batch: it is published with the rest, so that a batch that runs again is recognised.
        """

    @abstractmethod
    def stamped(self, source: str) -> int | None:
        """The newest batch of a stream that is committed here."""

    @abstractmethod
    def rows(self) -> DataFrame:
        """The live rows."""

    def count(self) -> int:
        return self.rows().count()

    def sample(self, n: int = 5) -> DataFrame:
        return self.rows().orderBy("source_artifact_sha256", "source_row_number").limit(max(0, n))

    def loaded(self) -> DataFrame:
        """artifact_sha256 and loaded_rows of what is loaded."""
        return self.catalog().where(F.col(STATUS) == "loaded").select(F.col("source_artifact_sha256").alias("artifact_sha256"), F.col("row_count").alias("loaded_rows"))

    def refuse_split(self, arriving: list[Column]) -> None:
        """Stop where rows would go beside a table or column that is still named by the old one-word rules."""
        if not self.table().columns and legacy_table_name(self.name) in self.tables() - {self.name}:
            raise LoadFailed("legacy_table_requires_migration")
        live = {c.name for c in self.table().columns}
        old = legacy_names([c.source_name for c in arriving])
        if any(was != c.name and was in live for was, c in zip(old, arriving, strict=True)):
            raise LoadFailed("legacy_column_requires_migration")
