"""Command line: inspect, propose, load, batch. JSON out; exit 0 well, 1 load failure, 2 bad use or bad artifact."""

from __future__ import annotations

import argparse
import json
import os
import sys
from pathlib import Path

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from gridloom.errors import GridloomError, LoadFailed, ParseError
from gridloom.limits import Budgets
from gridloom.operators.inspect import report_json, reports
from gridloom.operators.propose import propose
from gridloom.operators.tables import data_rows, long_cells, only_table
from gridloom.plans.ddl import DEFAULT_TABLE
from gridloom.plans.jdbc import JdbcTable
from gridloom.plans.load import MODES, batch, first_headers, write_lineage
from gridloom.plans.snapshot import SnapshotTable
from gridloom.session import Run, prepared
from gridloom.sources import mapping
from gridloom.sources.parse import parse
from gridloom.sources.scan import artifacts, identified, is_file, judged

STORE_VARIABLE, SOURCE_VARIABLE = "GRIDLOOM_STORE", "GRIDLOOM_SOURCE"


class MissingSource(GridloomError):
    code = "source_unavailable"


class _Parser(argparse.ArgumentParser):
    def error(self, message):
        print(json.dumps({"error_code": "invalid_argument"}), file=sys.stderr)
        raise SystemExit(2)


def header_list(text: str | None) -> list[str] | None:
    """Unset: None; blank or "none": no header required; else names split at commas."""
    if text is None:
        return None
    return [] if text.strip().lower() in ("", "none") else [h.strip() for h in text.split(",") if h.strip()]


def arguments() -> argparse.ArgumentParser:
    top = _Parser(prog="gridloom")
    commands = top.add_subparsers(dest="command", required=True, parser_class=_Parser)
    for name in ("inspect", "propose"):
        one = commands.add_parser(name)
        one.add_argument("source")
        one.add_argument("--pretty", action="store_true")
        one.add_argument("--max-source-bytes", type=int)
    for name in ("load", "batch"):
        one = commands.add_parser(name)
        one.add_argument("source", **({"nargs": "?", "default": os.environ.get(SOURCE_VARIABLE)} if name == "batch" else {}))
        one.add_argument("--store", default=os.environ.get(STORE_VARIABLE))
        one.add_argument("--table-name", default=DEFAULT_TABLE)
        one.add_argument("--column-mapping", "--column-comments", dest="column_mapping")
        one.add_argument("--on-duplicate", choices=MODES, default="skip")
        one.add_argument("--required-headers")
        one.add_argument("--json", action="store_true")
        one.add_argument("--dry-run", action="store_true")
        if name == "load":
            one.add_argument("--lineage-json")
            one.add_argument("--ddl-out")
        else:
            one.add_argument("--continue-on-error", action=argparse.BooleanOptionalAction, default=True)
            one.add_argument("--no-recursive", action="store_true")
            one.add_argument("--limit", type=int)
    return top


def _examined(spark: SparkSession, options: argparse.Namespace) -> dict:
    budgets = Budgets(**({"source_bytes": options.max_source_bytes} if options.max_source_bytes is not None else {}))
    found = judged(artifacts(spark, options.source, limit_bytes=budgets.source_bytes), budgets)
    refused = found.where("error_code is not null").select("error_code").first()
    if refused:
        raise ParseError(refused[0])
    run = Run(prepared(spark), "examined")
    rows = run.table(parse(identified(found), "strict", budgets), "rows")
    try:
        if rows.isEmpty():
            raise ParseError("source_read_failed")
        failed = rows.where("error_code is not null").select("error_code").first()
        if failed:
            raise ParseError(failed[0])
        if options.command == "inspect":
            return json.loads(report_json(reports(rows)).first()["report"])
        data = data_rows(only_table(rows))
        head = data.select("artifact_sha256", "headers").first()
        if head is None:
            raise ParseError("schema_proposal_failed")
        return propose(long_cells(data), head["headers"], head["artifact_sha256"]).to_dict()
    finally:
        run.drop(rows)


def load_summary(details: dict) -> dict:
    """What a load of one artifact prints: nothing of its values or of local paths."""
    return {
        "artifact_ref": details["lineage"]["source_artifact_path"], "data_row_count": details["data_row_count"], "headers": details["headers"], "inserted_rows": details["inserted_rows"],
        "queryable_row_count": details["queryable"]["db_row_count"], "sha256": details["source_sha256"], "skipped": details["skipped"], "table_name": details["table_name"],
    }


def batch_summary(totals: dict) -> dict:
    names = {"discovered": "artifact_count", "failure_count": "failure_count", "skipped_count": "skipped_count", "success_count": "success_count", "total_data_rows": "total_rows", "total_inserted_rows": "inserted_rows"}
    return {name: totals[of] for name, of in names.items()}


def _printed(summary: dict, as_json: bool) -> None:
    if as_json:
        print(json.dumps(summary, indent=2, ensure_ascii=False, default=str))
        return
    for key, value in summary.items():
        print(f"{key} ({len(value)}): {', '.join(value[:12])}" if isinstance(value, list) else f"{key}: {value}")


def _loaded(spark: SparkSession, options: argparse.Namespace) -> int:
    if options.command == "load" and not is_file(spark, options.source):
        raise MissingSource
    sink = None if options.dry_run else JdbcTable(spark, options.store, options.table_name) if options.store.startswith("jdbc:") else SnapshotTable(spark, options.store, options.table_name)
    extra = {"limit": options.limit, "recursive": not options.no_recursive, "continue_on_error": options.continue_on_error} if options.command == "batch" else {}
    named = mapping.load(options.column_mapping) if options.column_mapping else None
    done = batch(spark, options.source, sink, on_duplicate=options.on_duplicate, required=header_list(options.required_headers), mapping=named, **extra)
    totals = done.summary()
    if options.command == "batch":
        _printed(batch_summary(totals) | ({"column_mapping": done.mapping} if named else {}), options.json)
        return 1 if totals["failure_count"] or not totals["artifact_count"] else 0
    if totals["failure_count"]:
        raise LoadFailed("load_failed")
    details = done.details(headers=first_headers(spark, options.source) if totals["skipped_count"] else None, lineage_json=options.lineage_json)
    if options.ddl_out:
        Path(options.ddl_out).write_text(done.ddl + "\n", encoding="utf-8")
    if options.lineage_json:
        changed = Path(options.source).stat().st_mtime_ns if Path(options.source).is_file() else None
        write_lineage(details["lineage"] | {"source_artifact_mtime_ns": changed}, options.lineage_json)
    _printed(load_summary(details) | ({"column_mapping": done.mapping} if named else {}), options.json)
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    options = arguments().parse_args(argv)
    own = spark is None
    if options.command in ("load", "batch") and (not options.source or not (options.store or options.dry_run)):
        return _failed({"error_code": "invalid_argument"}, 2)
    examines = options.command in ("inspect", "propose")
    spark = spark or SparkSession.builder.appName("gridloom").getOrCreate()
    try:
        if not examines:
            return _loaded(spark, options)
        form = {"indent": 2} if options.pretty else {"separators": (",", ":")}
        print(json.dumps(_examined(spark, options), ensure_ascii=False, sort_keys=True, **form))
        return 0
    except MissingSource as error:
        return _failed(error.to_dict(), 2)
    except GridloomError as error:
        return _failed(error.to_dict(), 2 if examines else 1)
    except (PySparkException, Py4JError, OSError):
        # their texts repeat paths and values
        return _failed(ParseError("source_read_failed").to_dict() if examines else LoadFailed().to_dict(), 2 if examines else 1)
    finally:
        if own:
            spark.stop()


def _failed(error: dict, code: int) -> int:
    print(json.dumps(error, ensure_ascii=False, sort_keys=True), file=sys.stderr)
    return code
