"""Tables of a database over JDBC as a sink.

One distributed write cannot be one transaction. So rows and catalog entries go to staging tables first,
by as many connections as there are tasks, and one connection of the driver then moves them in one
transaction: columns, old rows out, new rows and entries in. A crash before its commit leaves the
staging tables behind and nothing else changed.

Each commit also inserts its number, one more than the version it builds on, under a primary key: of two that build
on one version the database refuses the second, which fails with ``concurrent_commit``. Rows are read over as many
connections as there are ranges of the artifact hash, and catalogs likewise; the database's metadata is asked for
this schema and these tables only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.errors import LoadFailed
from gridloom.functions.naming import legacy_table_name, safe_identifier
from gridloom.plans.ddl import LINEAGE, Column, Table, spark_type
from gridloom.plans.sink import CATALOG, KEY, OLD_STATUS, STATUS, Sink

CATALOG_TABLE, COLUMN_TABLE, STAMP_TABLE, COMMIT_TABLE = "gridloom_ingest_artifact", "gridloom_table_column", "gridloom_stream_batch", "gridloom_commit"
#: Load types that are staged as texts.
TEXTS = ("TEXT", "KEY", "NUMERIC", "TIME")
#: Types of the two tables beside the loaded ones, in load types.
ENTRY_TYPES = {c.split()[0]: {"string": "KEY", "long": "BIGINT", "timestamp": "TIMESTAMP"}[c.split()[1]] for c in CATALOG.split(", ")}
STAMP_TYPES, COMMIT_TYPES = {"table_name": "KEY", "stream_name": "KEY", "batch_number": "BIGINT"}, {"table_name": "KEY", "commit_number": "BIGINT"}
COLUMN_TYPES = {"table_name": "KEY", "column_position": "BIGINT", "source_name": "TEXT", "column_name": "KEY", "column_type": "KEY", "comment_text": "TEXT"}


@dataclass(frozen=True)
class Dialect:
    """How a database names the load types (KEY: a short text), how Spark writes texts there, and how a column becomes text."""

    types: dict[str, str] = field(default_factory=dict)
    staged_text: str = "TEXT"
    widen: tuple[str, ...] = ("ALTER TABLE {table} ALTER COLUMN {column} TYPE {text} USING {column}::text",)
    rename: str = "ALTER TABLE {table} RENAME COLUMN {old} TO {new}"

    def type(self, kind: str) -> str:
        return self.types.get(kind, "TEXT" if kind == "KEY" else kind)


POSTGRES = Dialect()
#: The database in Spark's own distribution.
DERBY = Dialect(
    {"TEXT": "VARCHAR(32672)", "KEY": "VARCHAR(255)", "NUMERIC": "DECIMAL(31,18)"},
    "CLOB",
    ("ALTER TABLE {table} ADD COLUMN wide_{column} {text}", "UPDATE {table} SET wide_{column} = TRIM(CAST({column} AS CHAR(254)))", "ALTER TABLE {table} DROP COLUMN {column}", "RENAME COLUMN {table}.wide_{column} TO {column}"),
    "RENAME COLUMN {table}.{old} TO {new}",
)


class JdbcTable(Sink):
    """``options`` are those of Spark's JDBC source (user, password, driver)."""

    def __init__(self, spark: SparkSession, url: str, name: str, options: dict[str, str] | None = None, dialect: Dialect | None = None, ranges: int = 16):
        self._ranges = ranges
        self.spark, self.url, self.name, self._options = spark, url, safe_identifier(name), options or {}
        self._dialect = dialect or (DERBY if url.startswith("jdbc:derby:") else POSTGRES)

    # --- one connection of the driver

    def _connection(self):
        """A connection; a driver that came as a jar of the application is registered as Spark's own source does it."""
        properties = self.spark._jvm.java.util.Properties()
        for key, value in self._options.items():
            properties.setProperty(key, value)
        if "driver" in self._options:
            self.spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self._options["driver"])
        return self.spark._jvm.java.sql.DriverManager.getConnection(self.url, properties)

    def _run(self, statements: Sequence[str], refused: str = "database_failed") -> None:
        """Statements in one transaction. ``refused`` is the error where a key is there already."""
        try:
            connection = self._connection()
            try:
                connection.setAutoCommit(False)
                statement = connection.createStatement()
                for sql in statements:
                    statement.executeUpdate(sql)
                connection.commit()
            except Py4JJavaError:
                connection.rollback()
                raise
            finally:
                connection.close()
        except Py4JJavaError as error:
            state = getattr(error.java_exception, "getSQLState", lambda: None)()
            raise LoadFailed(refused if state and state.startswith("23") else "database_failed") from None

    def _read(self, source: str, split: str | None = None) -> DataFrame:
        """A table or subquery; with ``split``, a column of hexadecimal hashes, over one connection for each of ``ranges`` ranges of it."""
        if split is None or self._ranges < 2:
            frame = self.spark.read.jdbc(self.url, source, properties=self._options)
        else:
            frame = self.spark.read.jdbc(self.url, source, predicates=hash_ranges(split, self._ranges), properties=self._options)
        return frame.toDF(*[c.lower() for c in frame.columns])

    def _write(self, frame: DataFrame, table: str, types: dict[str, str]) -> None:
        """Stage a frame: texts, numbers and times as Spark writes texts."""
        kind = lambda t: self._dialect.staged_text if t in TEXTS else self._dialect.type(t)
        self._run([f"CREATE TABLE {table} ({', '.join(f'{c} {kind(t)}' for c, t in types.items())})"])
        frame.select(*types).write.jdbc(self.url, table, mode="append", properties=self._options)

    def columns_of(self, table: str) -> list[str]:
        """Columns that the database has; none where there is no such table."""
        return self._listed("getColumns", table, "COLUMN_NAME")

    def tables(self) -> set[str]:
        """Names in the connection's schema of the table, of those that older rules would give it, and of the engine's own."""
        return {t for name in {self.name, legacy_table_name(self.name), CATALOG_TABLE, COLUMN_TABLE, STAMP_TABLE, COMMIT_TABLE} for t in self._listed("getTables", name, "TABLE_NAME")}

    def _listed(self, what: str, table: str, wanted: str) -> list[str]:
        """What the metadata of the connection's own schema has for a table, in lower case, in order."""
        connection = self._connection()
        try:
            metadata, rows = connection.getMetaData(), []
            escape = metadata.getSearchStringEscape() or ""
            # names are stored in the database's own case
            stored = table.upper() if metadata.storesUpperCaseIdentifiers() else table
            pattern = stored.replace("_", f"{escape}_") if escape else stored
            found = getattr(metadata, what)(connection.getCatalog(), connection.getSchema(), pattern, None)
            while found.next():
                if found.getString("TABLE_NAME") == stored:
                    rows.append(found.getString(wanted).lower())
            return rows
        finally:
            connection.close()

    # --- the catalog

    def ensure_catalog(self) -> None:
        """Create what is missing beside the table; a catalog with its status under the old name is renamed, one with both refused."""
        have = self.tables()
        made = lambda table, types, key: f"CREATE TABLE {table} ({', '.join(f'{c} {self._dialect.type(t)}' + (' NOT NULL' if c in key else '') for c, t in types.items())}, PRIMARY KEY ({', '.join(key)}))"
        if CATALOG_TABLE not in have:
            self._run([made(CATALOG_TABLE, ENTRY_TYPES, KEY)])
        elif OLD_STATUS in (columns := self.columns_of(CATALOG_TABLE)):
            if STATUS in columns:
                raise LoadFailed("ambiguous_catalog")
            self._run([self._dialect.rename.format(table=CATALOG_TABLE, old=OLD_STATUS, new=STATUS)])
        for table, types, key in ((COLUMN_TABLE, COLUMN_TYPES, ("table_name", "column_name")), (STAMP_TABLE, STAMP_TYPES, ("table_name", "stream_name")), (COMMIT_TABLE, COMMIT_TYPES, tuple(COMMIT_TYPES))):
            if table not in have:
                self._run([made(table, types, key)])

    def downgrade_catalog(self) -> None:
        """Give the status column its old name back, for older releases."""
        columns = self.columns_of(CATALOG_TABLE)
        if {STATUS, OLD_STATUS} <= set(columns):
            raise LoadFailed("ambiguous_catalog")
        if STATUS in columns:
            self._run([self._dialect.rename.format(table=CATALOG_TABLE, old=STATUS, new=OLD_STATUS)])

    def _own(self, table: str) -> str:
        return f"(SELECT * FROM {table} WHERE table_name = '{self.name}') own"

    def version(self) -> int:
        """The number of the newest commit."""
        self.ensure_catalog()
        return self._read(f"(SELECT MAX(commit_number) AS n FROM {COMMIT_TABLE} WHERE table_name = '{self.name}') newest").first()[0] or 0

    def stamped(self, source: str) -> int | None:
        self.ensure_catalog()
        found = self._read(self._own(STAMP_TABLE)).where(F.col("stream_name") == source).first()
        return found["batch_number"] if found else None

    def catalog(self) -> DataFrame:
        self.ensure_catalog()
        return self._read(self._own(CATALOG_TABLE), "source_artifact_sha256").select(*ENTRY_TYPES)

    def table(self) -> Table:
        self.ensure_catalog()
        rows = self._read(self._own(COLUMN_TABLE)).orderBy("column_position").collect()  # as many as the table has columns
        return Table(self.name, tuple(Column(r["source_name"], r["column_name"], r["column_type"], r["comment_text"]) for r in rows))

    # --- loading

    def write_rows(self, rows: DataFrame, types: dict[str, str]) -> str:
        load = f"stage_{uuid.uuid4().hex[:20]}"
        self._write(rows, load, types | dict(LINEAGE))
        return load

    def commit(self, table: Table, load: str | None, types: dict[str, str], entries: DataFrame | None, base: int, replaces: bool = False, stamp: tuple[str, int] | None = None) -> None:
        listed, staged = f"{load or 'stage'}_column", f"{load}_entry"
        columns = [(self.name, i, c.source_name, c.name, c.type, c.comment) for i, c in enumerate(table.columns)]
        self._write(self.spark.createDataFrame(columns, "table_name string, column_position long, source_name string, column_name string, column_type string, comment_text string"), listed, COLUMN_TYPES)
        old, kind, change = {c.name: c for c in self.table().columns}, self._dialect.type, []
        # numbers go up by one, and each is there once: a commit that builds on an older version has none left
        change.append(f"INSERT INTO {COMMIT_TABLE} (table_name, commit_number) VALUES ('{self.name}', {int(base) + 1})")
        if stamp:
            change.append(f"DELETE FROM {STAMP_TABLE} WHERE table_name = '{self.name}' AND stream_name = {_quoted(stamp[0])}")
            change.append(f"INSERT INTO {STAMP_TABLE} (table_name, stream_name, batch_number) VALUES ('{self.name}', {_quoted(stamp[0])}, {int(stamp[1])})")
        if not old:
            lineage = [f"{n} {kind('KEY' if t == 'TEXT' else t)} NOT NULL" for n, t in LINEAGE]
            change.append(f"CREATE TABLE {self.name} ({', '.join([f'{safe_identifier(c.name)} {kind(c.type)}' for c in table.columns] + lineage)})")
        for c in table.columns if old else ():
            if c.name not in old:
                change.append(f"ALTER TABLE {self.name} ADD COLUMN {safe_identifier(c.name)} {kind(c.type)}")
            elif old[c.name].type != c.type:
                change += [s.format(table=self.name, column=safe_identifier(c.name), text=kind("TEXT")) for s in self._dialect.widen]
        if load is not None:
            self._write(entries, staged, ENTRY_TYPES)
            mine = f"source_artifact_sha256 IN (SELECT {self._cast('source_artifact_sha256', 'KEY')} FROM {staged})"
            if replaces:
                change.append(f"DELETE FROM {self.name} WHERE {mine}")
            change.append(self._moved(load, self.name, types | dict(LINEAGE)))
            change += [f"DELETE FROM {CATALOG_TABLE} WHERE table_name = '{self.name}' AND {mine}", self._moved(staged, CATALOG_TABLE, ENTRY_TYPES), f"DROP TABLE {staged}", f"DROP TABLE {load}"]
        change += [f"DELETE FROM {COLUMN_TABLE} WHERE table_name = '{self.name}'", self._moved(listed, COLUMN_TABLE, COLUMN_TYPES), f"DROP TABLE {listed}"]
        self._run(change, "concurrent_commit")

    def _cast(self, name: str, kind: str) -> str:
        """A staged column as its table has it; a text is read as a plain one first."""
        if kind not in TEXTS:
            return name
        plain = f"CAST({name} AS {self._dialect.type('TEXT')})"
        return plain if kind == "TEXT" else f"CAST({plain} AS {self._dialect.type(kind)})"

    def _moved(self, stage: str, table: str, types: dict[str, str]) -> str:
        return f"INSERT INTO {table} ({', '.join(types)}) SELECT {', '.join(self._cast(n, t) for n, t in types.items())} FROM {stage}"

    def rows(self) -> DataFrame:
        table = self.table()
        if not table.columns:
            return self.spark.createDataFrame([], table.struct())
        found = self._read(self.name, "source_artifact_sha256")
        return found.select(*[found[c.name].cast(spark_type(c.type)).alias(c.name) for c in table.columns], *[n for n, _ in LINEAGE])


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def hash_ranges(column: str, ranges: int) -> list[str]:
    """Predicates that split hexadecimal hashes, which are even by nature, into like ranges; every value and null is in exactly one.

    Comparisons are of the first digits as texts, whose order is that of the numbers in any collation of digits and letters.
    """
    ranges = min(max(ranges, 1), 16**3)
    bounds = [f"{16**3 * i // ranges:03x}" for i in range(1, ranges)]
    lower, upper = [None, *bounds], [*bounds, None]
    parts = [[f"{column} >= '{a}'"] * (a is not None) + [f"{column} < '{b}'"] * (b is not None) for a, b in zip(lower, upper, strict=True)]
    first = f"({' AND '.join(parts[0]) or '1 = 1'} OR {column} IS NULL)"
    return [first, *(" AND ".join(p) for p in parts[1:])]
