"""Loading artifacts into a sink: skip or replace, comments, lineage, outcomes as rows."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridloom.errors import LoadFailed
from gridloom.functions import types
from gridloom.functions.naming import unique_snake_names
from gridloom.functions.text import present
from gridloom.limits import Budgets
from gridloom.operators.mapping import Attached, attached
from gridloom.operators.runtime_filter import BITS, bitmap, passing
from gridloom.operators.tables import as_maps, data_rows, long_cells
from gridloom.operators.validate import failure
from gridloom.plans.ddl import DEFAULT_TABLE, Column, Table, ddl
from gridloom.plans.profile import column_types, merged_types, promoted
from gridloom.plans.sink import Sink
from gridloom.plans.snapshot import SnapshotTable
from gridloom.session import Run, prepared
from gridloom.sources.mapping import MappingDocument
from gridloom.sources.parse import parse
from gridloom.sources.scan import artifacts as scanned
from gridloom.sources.scan import identified

MODES = ("skip", "replace")
#: Bits of the filter before the parser; fewer only let more through that is left out later.
FILTER_BITS = BITS


@dataclass
class LoadResult:
    """Outcomes (one row an artifact), the table after the load, and what became of the mapping."""

    outcomes: DataFrame
    #: The outcomes with the header texts of the artifacts that were parsed.
    parsed: DataFrame
    sink: Sink
    table: Table
    ddl: str
    inserted: int
    loaded_at: datetime
    on_duplicate: str
    mapping: dict | None = None
    totals: dict = field(default_factory=dict)

    def summary(self) -> dict:
        """Batch totals; no header, value or path."""
        return self.totals

    def details(self, headers: list[str] | None = None, lineage_json: str | None = None) -> dict | None:
        """All about the load of a single artifact: headers, types, comments, mapping report, catalog entry, lineage.

        A skipped artifact was not parsed: its ``headers`` are what the caller knows of them.
        """
        one = self.parsed.first()
        if one is None:
            return None
        entry = self.sink.catalog().where(F.col("source_artifact_sha256") == one["sha256"]).drop("load_id").first()
        entry = entry.asDict() | {"loaded_at": entry["loaded_at"].isoformat()} if entry else None
        rows, lineage = self.sink.count(), lineage_record(one["sha256"], one["size"], None, one["rows"], self.table.name, self.loaded_at)
        return {
            "ok": one["ok"], "skipped": one["skipped"], "replaced": one["replaced"], "error": one["error"], "headers": list(one["headers"] or headers or []), "inserted_rows": one["inserted_rows"],
            "data_row_count": one["rows"], "table_name": self.table.name, "schema": self.table.types(), "column_comments": self.table.comments(), "column_mapping": self.mapping, "ddl": self.ddl,
            "catalog": entry, "source_sha256": one["sha256"], "on_duplicate": self.on_duplicate, "lineage": lineage | ({"skipped": True} if one["skipped"] else {}), "lineage_json": lineage_json,
            "queryable": {"table_name": self.table.name, "row_count": rows, "db_row_count": rows},
        }


def first_of_equals(found: DataFrame) -> DataFrame:
    """Artifacts (path, artifact_sha256, and what depends on these) with copies and repeat.

    Of artifacts with the same bytes the first by path loads, the others are skipped; rows that agree in
    path and bytes are one row, with their number as ``copies``.
    """
    others = [F.first(c).alias(c) for c in found.columns if c not in ("artifact_sha256", "path")]
    named = found.groupBy("artifact_sha256", "path").agg(*others, F.count("*").alias("copies"))
    first = found.groupBy("artifact_sha256").agg(F.min("path").alias("_first"))
    return named.join(first, "artifact_sha256").withColumn("repeat", F.col("path") != F.col("_first")).drop("_first")


def stored_value(text: SparkColumn, kind: str) -> SparkColumn:
    """A stripped text as its column stores it: numbers as their own digits (-0.00 too), times as text."""
    if kind in ("TEXT", "NUMERIC", "TIME"):
        return types.text_form(text, kind, signed=True)
    return types.READERS[kind](text)


def load(
    spark: SparkSession, sink: Sink, found: DataFrame, on_duplicate: str = "skip", required: list[str] | None = None, mapping: MappingDocument | None = None, comments: dict[str, str] | None = None,
    continue_on_error: bool = True, stamp: tuple[str, int] | None = None,
) -> LoadResult:
    """Load ``found`` (path, content) as one job. Failing artifacts are outcomes, not job failures.

    Contents are hashed first, so that what is loaded already is not parsed; a filter of fixed size then lets only new ones
    through to the parser, by path and hash, and no content is shuffled. What is new is parsed once, to a
    table of the run; everything after that reads it, and counts ride on what is written. Comments come by column name, or from a mapping
    that is resolved against the columns that arrive. Without ``continue_on_error`` the first failure in
    path order ends the load: what comes before it is loaded, nothing from it on, and LoadFailed is raised.
    A ``stamp`` (stream and number of its batch) is committed with the load, even where nothing is new.
    """
    if on_duplicate not in MODES:
        raise LoadFailed("invalid_on_duplicate")
    run, now, replaces = Run(prepared(spark), "load"), datetime.now(timezone.utc), on_duplicate == "replace"
    base, live = sink.version(), sink.table()
    hashed = identified(found.select(F.coalesce("path", F.lit("")).alias("path"), "content")).withColumn("size", F.octet_length("content").cast("long"))
    lost = F.col("artifact_sha256").isNull()
    identity, listed = run.observed(hashed.select("path", "artifact_sha256", "reference", "size"), "identity", unread=F.count_if(lost), stop=F.min(F.when(lost, F.col("path"))))
    is_fresh = ~F.col("repeat") & (F.col("loaded_rows").isNull() | F.lit(replaces))
    known, seen = run.observed(first_of_equals(identity).join(sink.loaded(), "artifact_sha256", "left"), "known", fresh=F.count_if(is_fresh))
    unread = identity.where("artifact_sha256 is null")
    fresh = known.where(is_fresh).select("path", "artifact_sha256")
    rows = parse(passing(hashed, bitmap(fresh, "artifact_sha256", "path", bits=FILTER_BITS), "artifact_sha256", "path", bits=FILTER_BITS), "lenient", carry=("path", "reference", "size"))
    judged = F.coalesce("error_code", failure(required, sink.name)).alias("failure")
    is_head = F.col("is_header_row") | F.col("error_code").isNotNull()
    counts = {"heads": F.count_if(is_head), "stop": F.min(F.when(is_head & F.col("failure").isNotNull(), F.col("path")))}
    parsed, met = run.observed(rows.where("is_primary or error_code is not null").select("*", judged), "parsed", **counts)
    if met["heads"] != seen["fresh"]:
        # artifacts that passed by chance, or rows that agree in path and bytes
        exact = parsed.join(fresh, ["artifact_sha256", "path"], "left_semi").dropDuplicates(["artifact_sha256", "row_index"])
        parsed, met = run.observed(exact.select(parsed.columns), "exact", **counts)
    heads = parsed.where(is_head).select("artifact_sha256", "path", "reference", "size", "failure", "headers", F.col("data_row_count").alias("arrived"))

    good, stop = F.col("failure").isNull(), None
    if not continue_on_error:
        stop = min((s for s in (met["stop"], listed["stop"]) if s is not None), default=None)
        good &= F.lit(True) if stop is None else F.col("path") < stop
    data = data_rows(parsed.where(good))
    profile = column_types(long_cells(data))
    columns = merged_types(profile).limit(Budgets().columns + 1).collect()
    if len(columns) > Budgets().columns:
        raise LoadFailed("too_many_columns")
    arriving = {r["header"]: (r["ordinal"], r["type"], set(r["kinds"])) for r in columns}

    table = merged_table(live, {h: (at, kind) for h, (at, kind, _) in arriving.items()}).commented(comments or {})
    report = None
    if mapping is not None and arriving:
        table, report = commented(spark, table, set(arriving), mapping)
    sink.refuse_split([c for c in table.columns if c.source_name in arriving])

    inserted = 0
    if arriving:
        types_of = {c.name: c.type for c in table.columns if c.source_name in arriving}
        value = lambda c: present(F.try_element_at("values", F.lit(c.source_name)))
        met = {c.source_name: arriving[c.source_name][2] for c in table.columns if c.source_name in arriving}
        mapped = as_maps(data)
        if any(len(met[c.source_name]) > 1 for c in table.columns if c.source_name in met and c.type == "TEXT"):
            kinds = profile.groupBy("artifact_sha256").agg(F.map_from_entries(F.collect_list(F.struct("header", "kind"))).alias("kinds"))
            mapped = mapped.join(kinds, "artifact_sha256")
        cells = [_stored(value(c), c, met[c.source_name]).alias(c.name) for c in table.columns if c.source_name in met]
        lineage = [F.col("reference").alias("source_artifact_path"), F.col("artifact_sha256").alias("source_artifact_sha256"), F.col("row_no").alias("source_row_number"), F.lit(now).alias("loaded_at")]
        written = Observation()
        load_id = sink.write_rows(mapped.select(*cells, *lineage).observe(written, F.count(F.lit(1)).alias("n")), types_of)
        inserted = written.get["n"]
        entries = heads.where(good).select(
            F.col("artifact_sha256").alias("source_artifact_sha256"), F.lit(sink.name).alias("table_name"), F.col("reference").alias("source_artifact_path"), F.col("size").alias("source_artifact_size"),
            F.col("arrived").alias("row_count"), F.lit("loaded").alias("load_status_code"), F.lit(now).alias("loaded_at"),
        )
        sink.commit(table, load_id, types_of, entries, base, replaces, stamp)
    elif table != live or stamp:
        sink.commit(table, None, {}, None, base, stamp=stamp)

    each = known.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    skipped = F.col("repeat") | (F.col("copy") > 1) | (F.col("loaded_rows").isNotNull() & F.lit(not replaces))
    outcomes = each.join(heads.select("artifact_sha256", "failure", "arrived", "headers"), "artifact_sha256", "left").select(
        "reference", F.col("artifact_sha256").alias("sha256"), "size", (skipped | F.col("failure").isNull()).alias("ok"), skipped.alias("skipped"),
        (F.col("loaded_rows").isNotNull() & ~skipped & F.col("failure").isNull()).alias("replaced"),
        F.when(skipped, F.coalesce("loaded_rows", "arrived", F.lit(0))).otherwise(F.when(F.col("failure").isNull(), F.col("arrived")).otherwise(0)).cast("long").alias("rows"),
        F.when(skipped | F.col("failure").isNotNull(), 0).otherwise(F.col("arrived")).cast("long").alias("inserted_rows"), F.when(~skipped, F.col("failure")).alias("error"), F.lit(sink.name).alias("table_name"), "headers",
    )
    if listed["unread"]:
        lines = {"ok": F.lit(False), "skipped": F.lit(False), "replaced": F.lit(False), "rows": F.lit(0).cast("long"), "inserted_rows": F.lit(0).cast("long"), "error": F.lit("source_read_failed"), "table_name": F.lit(sink.name)}
        outcomes = outcomes.unionByName(unread.select("reference", F.col("artifact_sha256").alias("sha256"), "size", *[c.alias(n) for n, c in lines.items()], F.lit(None).cast("array<string>").alias("headers")))
    of = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0))
    outcomes, sums = run.observed(outcomes, "outcomes", artifacts=F.count(F.lit(1)), ok=of("ok"), skipped=of("skipped"), rows=of("rows"), inserted=of("inserted_rows"))
    run.drop(identity, known, parsed)
    if stop is not None:
        raise LoadFailed("batch_failed")
    totals = {
        "artifact_count": sums["artifacts"], "success_count": sums["ok"], "failure_count": sums["artifacts"] - sums["ok"], "skipped_count": sums["skipped"], "total_rows": sums["rows"],
        "inserted_rows": sums["inserted"], "table_name": table.name,
    }
    return LoadResult(outcomes.drop("headers"), outcomes, sink, table, ddl(table), inserted, now, on_duplicate, report, totals)


def merged_table(live: Table, arriving: dict[str, tuple[int, str]]) -> Table:
    """The live columns, widened where what arrives (header: place, type) differs, then new ones by place."""
    old = {c.source_name: c for c in live.columns}
    headers = [*old, *(h for h, _ in sorted(arriving.items(), key=lambda x: (x[1][0], x[0])) if h not in old)]
    columns = []
    for header, name in zip(headers, unique_snake_names(headers), strict=True):
        was = old.get(header)
        kind = promoted(was.type if was else None, arriving[header][1], False) if header in arriving else was.type
        columns.append(Column(header, was.name if was else name, kind, was.comment if was else None))
    return Table(live.name, tuple(columns))


def commented(spark: SparkSession, table: Table, arriving: set[str], mapping: MappingDocument) -> tuple[Table, dict]:
    """The table with the mapping's comments on the columns that arrive, and the report of what matched."""
    columns = spark.createDataFrame([(c.source_name, c.name) for c in table.columns if c.source_name in arriving], "source_name string, db_name string")
    found: Attached = attached(mapping.frame(spark), columns, merge=mapping.kind == "pptx")
    report = {"path": mapping.reference, "format": mapping.kind, "matched": found.matched, "unmatched": found.unmatched}
    return table.commented(found.comments), report


def _stored(text: SparkColumn, column: Column, met: set[str]) -> SparkColumn:
    """The value by the table's type; in a widened column, the text of the value its artifact's type gives."""
    if column.type != "TEXT":
        return stored_value(text, column.type)
    if len(met) == 1:
        return types.text_form(text, next(iter(met)), signed=True)
    kind, out = F.try_element_at("kinds", F.lit(column.source_name)), text
    for name in sorted(met - {"TEXT"}):
        out = F.when(kind == name, types.text_form(text, name, signed=True)).otherwise(out)
    return out


def batch(spark: SparkSession, source: str, sink: Sink | None = None, recursive: bool = True, limit: int | None = None, **options) -> LoadResult:
    """All archives of a folder or glob, in path order. Without a sink it is a dry run, whose table stays in the shared folder."""
    found = scanned(spark, source, recursive)
    if limit is not None:
        first = found.select("path").orderBy("path").limit(max(0, limit))
        found = found.join(F.broadcast(first), "path", "left_semi") if limit <= 10_000 else found.join(first, "path", "left_semi")
    if sink is None:
        sink = SnapshotTable(spark, Run(spark, "dry-run").folder, DEFAULT_TABLE)
    return load(spark, sink, found.select("path", "content"), **options)


def first_headers(spark: SparkSession, source: str) -> list[str]:
    """Header texts of one archive, for a report of a load that skipped it."""
    found = parse(identified(scanned(spark, source)), "lenient").where("is_primary and is_header_row").select("headers").first()
    return list(found[0]) if found else []


def lineage_record(sha: str, size: int, modified_ns: int | None, rows: int, table: str, loaded_at: datetime) -> dict:
    return {
        "source_artifact_path": f"artifact:{sha[:16].lower()}", "source_artifact_sha256": sha, "source_artifact_size": size, "source_artifact_mtime_ns": modified_ns, "row_count": rows, "table_name": table,
        "loaded_at": loaded_at.isoformat(),
    }


def write_lineage(record: dict, path: str | Path) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(record, indent=2, ensure_ascii=False) + "\n", encoding="utf-8")
