"""The one procedural stage: artifact bytes to table rows, errors as rows.

A failed artifact gives exactly one row with ``error_code``; a strictly read one without tables gives
one row with a null ``table_ordinal``, a table without rows one with a null ``row_index``. Whatever
depends on one artifact alone is worked out here while the artifact is in memory (which table is the
primary one, header texts, row numbers, shape, the first ragged row), so that later steps are
filters and projections and nothing is joined with itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from gridloom.errors import GridloomError, LenientError
from gridloom.limits import Budgets
from gridloom.session import prepared
from gridloom.sources import grid, mime

#: What is known of an artifact, of a table, and of a row.
SCHEMA = (
    "artifact_sha256 string, source_bytes long, location string, document_notes array<string>, table_count int, "
    "table_ordinal int, is_primary boolean, header_source string, headers array<string>, header_index int, row_count long, data_row_count long, column_count long, ragged_row long, notes array<string>, "
    "row_index int, is_header_row boolean, row_no long, cells array<struct<text: string, is_header: boolean>>, error_code string"
)
FRAME_ROWS = 10_000


def _rows(shape: tuple, header: int | None, rows: Iterable[list[dict]]) -> Iterator[tuple]:
    """The rows of one table; data rows are numbered from 1."""
    number = 0
    for index, cells in enumerate(rows):
        number += index != header
        yield (*shape, index, index == header, None if index == header else number, cells, None)


def _strict(content: bytes, budgets: Budgets) -> Iterator[tuple]:
    document = mime.strict_document(content, budgets)
    tables = grid.strict_tables(document.html, budgets)
    artifact = (len(content), document.location, list(document.notes), len(tables))
    if not tables:
        yield (*artifact, *[None] * 14, None)
    for ordinal, table in enumerate(tables):
        headers = [c.text for c in table.rows[table.header_row]] if table.header_row is not None else None
        shape = (*artifact, ordinal, None, table.header_source, headers, table.header_row, len(table.rows), len(table.rows) - (headers is not None), table.width, None, list(table.notes))
        if table.rows:
            yield from _rows(shape, table.header_row, ([{"text": c.text, "is_header": c.is_header} for c in row] for row in table.rows))
        else:
            yield (*shape, *[None] * 4, None)


def _lenient(content: bytes, _: Budgets) -> Iterator[tuple]:
    tables = grid.lenient_tables(mime.lenient_html(content))
    if not tables:
        raise LenientError("no_table")
    primary, artifact = grid.primary_table(tables), (len(content), None, [], len(tables))
    for ordinal, table in enumerate(tables):
        width = len(table.headers)
        ragged = next((i for i, row in enumerate(table.rows, 1) if len(row) != width), None)
        shape = (*artifact, ordinal, table is primary, "first_row", table.headers, 0, len(table.rows) + 1, len(table.rows), width, ragged, [])
        yield from _rows(shape, 0, ([{"text": c, "is_header": i == 0} for c in row] for i, row in enumerate([table.headers, *table.rows])))


READERS = {"strict": _strict, "lenient": _lenient}


def parse(artifacts: DataFrame, mode: str, budgets: Budgets = Budgets(), carry: Sequence[str] = ()) -> DataFrame:  # noqa: B008
    """Rows of all tables of ``artifacts`` (artifact_sha256, content), read strictly or leniently.

    Columns named in ``carry`` go along with every row of their artifact. The lenient reader has no
    size budget, as its callers choose by ``length`` what they read (``scan.within``).
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    read = READERS[mode]
    prepared(artifacts.sparkSession)
    source = artifacts.select("artifact_sha256", "content", *carry)
    carried = StructType([f for f in source.schema.fields if f.name in carry])
    schema = StructType(StructType.fromDDL(SCHEMA).fields + carried.fields)
    arrow, names, width = to_arrow_schema(schema), [f.name for f in carried.fields], len(StructType.fromDDL(SCHEMA).fields)

    def frame(rows: list[tuple], batch: pa.RecordBatch, owners: list[int]) -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(arrow)[:width], strict=True)]
        taken = pa.array(owners, pa.int64())
        columns += [batch.column(batch.schema.get_field_index(n)).take(taken).cast(arrow.field(n).type) for n in names]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            owners: list[int] = []
            for at in range(batch.num_rows):
                sha, content = batch.column(0)[at].as_py(), batch.column(1)[at].as_py() or b""
                try:
                    held = [(sha, *row) for row in read(content, budgets)]
                except GridloomError as error:
                    held = [(sha, len(content), *[None] * (width - 3), error.code)]
                rows += held
                owners += [at] * len(held)
                while len(rows) >= FRAME_ROWS:
                    yield frame(rows[:FRAME_ROWS], batch, owners[:FRAME_ROWS])
                    del rows[:FRAME_ROWS], owners[:FRAME_ROWS]
            if rows:
                yield frame(rows, batch, owners)

    return source.mapInArrow(run, schema)
