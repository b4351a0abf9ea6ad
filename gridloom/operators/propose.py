"""Value-free schema proposals: evidence of each column, a conservative type, reasons for review."""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass, fields

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.errors import ProposalError
from gridloom.functions import naming, types
from gridloom.functions.text import digest
from gridloom.limits import ProposalPolicy
from gridloom.operators.tables import data_rows, long_cells, only_table

TYPES = ("text", "boolean", "date", "bigint", "numeric")


@dataclass(frozen=True)
class ColumnProposal:
    source_header_hash_sha256: str
    target_column_name: str
    proposed_type: str
    nullable: bool
    non_null_count: int
    distinct_count: int
    maximum_text_length: int
    maximum_numeric_precision: int | None
    maximum_numeric_scale: int | None
    review_reasons: tuple[str, ...]

    def to_dict(self) -> dict:
        return {**asdict(self), "review_reasons": list(self.review_reasons)}


@dataclass(frozen=True)
class SchemaProposal:
    schema_proposal_id: str
    proposal_version: str
    source_hash_sha256: str
    table_fingerprint_sha256: str
    columns: tuple[ColumnProposal, ...]

    def to_dict(self) -> dict:
        return {**asdict(self), "columns": [c.to_dict() for c in self.columns]}

    @property
    def review_required(self) -> bool:
        return any(c.review_reasons for c in self.columns)


def evidence(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Per ``keys``: counts, lengths, digits and the flags the type decision needs, from ``value``.

    ``value`` is stripped text, null where blank. One grouped aggregate; the distinct count is exact.
    """
    value = F.col("value")
    every = lambda condition: F.coalesce(F.bool_and(F.when(value.isNotNull(), condition)), F.lit(False))
    integer, decimal = value.rlike(types.SIGNED), value.rlike(types.DECIMAL)
    return cells.groupBy(*keys).agg(
        F.count("*").alias("total"),
        F.count(value).alias("non_null_count"),
        F.count_distinct(value).alias("distinct_count"),
        F.coalesce(F.max(F.length(value)), F.lit(0)).cast("long").alias("maximum_text_length"),
        F.max(F.length(types.whole_digits(value))).cast("long").alias("whole_digits"),
        F.max(F.length(types.whole_digits(value)) + F.length(types.fraction_digits(value))).cast("long").alias("all_digits"),
        F.max(F.length(types.fraction_digits(value))).cast("long").alias("fraction_digits"),
        every(F.lower(value).isin("true", "false")).alias("all_boolean"),
        every(types.proposal_date(value)).alias("all_date"),
        every(integer).alias("all_integer"),
        every(decimal).alias("all_decimal"),
        F.coalesce(F.bool_or((integer | decimal) & types.leading_zero(value)), F.lit(False)).alias("leading_zero"),
        every(F.when(integer, types.fits_int64(value)).otherwise(False)).alias("all_int64"),
    )


def _tokens(name: Column, tokens: frozenset[str]) -> Column:
    return F.arrays_overlap(F.split(name, "_"), F.array(*[F.lit(t) for t in sorted(tokens)]))


def decided(found: DataFrame, name: Column, complete: bool = True) -> DataFrame:
    """Adds proposed_type, nullable, precision, scale and review_reasons to column evidence.

    ``name``: the normalised header before it was fitted, whose tokens carry its meaning.
    """
    id_, dated = _tokens(name, types.IDENTIFIER_TOKENS), _tokens(name, types.DATE_TOKENS)
    number = F.col("all_integer") | F.col("all_decimal")
    kept_text = F.col("leading_zero") | id_
    kind = (
        F.when(F.col("non_null_count") == 0, "text")
        .when(F.col("all_boolean"), F.when(id_, "text").otherwise("boolean"))
        .when(F.col("all_date"), F.when(dated & ~id_, "date").otherwise("text"))
        .when(F.col("all_integer"), F.when(kept_text, "text").when(F.col("all_int64"), "bigint").otherwise("numeric"))
        .when(F.col("all_decimal"), F.when(kept_text, "text").otherwise("numeric"))
        .otherwise("text")
    )
    typed = found.withColumn("proposed_type", kind)
    some, plain = F.col("non_null_count") > 0, ~F.col("all_boolean") & ~F.col("all_date")
    as_number = some & plain & number
    reasons = [
        F.when(F.lit(not complete), F.lit("sample_only_nullability")),
        F.when(~some, F.lit("empty_column")),
        F.when(some & id_, F.lit("identifier_semantics")),
        F.when(some & ~F.col("all_boolean") & F.col("all_date") & (F.col("proposed_type") == "text"), F.lit("date_semantics_missing")),
        F.when(as_number & F.col("leading_zero"), F.lit("leading_zero_identifier")),
        F.when(as_number & F.col("all_integer") & (F.col("proposed_type") == "numeric"), F.lit("bigint_range_exceeded")),
        F.when(some & plain & ~number, F.lit("mixed_or_unrecognized_values")),
    ]
    sized = F.col("proposed_type").isin("bigint", "numeric")
    return typed.withColumns(
        {
            "nullable": F.lit(not complete) | (F.col("non_null_count") < F.col("total")) | ~some,
            "maximum_numeric_precision": F.when(sized, F.when(F.col("all_integer"), F.col("whole_digits")).otherwise(F.greatest(F.col("all_digits"), F.col("whole_digits")))),
            "maximum_numeric_scale": F.when(sized, F.when(F.col("all_integer"), F.lit(0).cast("long")).otherwise(F.col("fraction_digits"))),
            "review_reasons": F.array_compact(F.array(*reasons)),
        }
    )


def checked_headers(headers: list[str], policy: ProposalPolicy = ProposalPolicy()) -> list[tuple[str, str]]:  # noqa: B008
    """(normalised name, unique target name) of each header."""
    if not headers:
        raise ProposalError("invalid_input")
    if len(headers) > policy.columns:
        raise ProposalError("too_many_columns")
    taken, names = set(), []
    for position, header in enumerate(headers):
        if not isinstance(header, str):
            raise ProposalError("invalid_input")
        if len(header) > policy.header_chars:
            raise ProposalError("header_too_large")
        name = naming.proposal_name(header)
        if name in taken:
            name = naming.collision_name(name, header, position)
            if name in taken:
                raise ProposalError("invalid_input")
        taken.add(name)
        names.append((naming.proposal_words(header), name))
    return names


def propose(cells: DataFrame, headers: list[str], source_hash: str, policy: ProposalPolicy = ProposalPolicy(), complete: bool = True) -> SchemaProposal:  # noqa: B008
    """The proposal of one table: ``cells`` (ordinal, value) with a row for every cell.

    Only the evidence of at most ``policy.columns`` columns reaches the driver.
    """
    if not re.fullmatch(r"[0-9a-fA-F]{64}", source_hash or ""):
        raise ProposalError("invalid_source_hash")
    names = checked_headers(headers, policy)
    found = evidence(cells, ["ordinal"])
    table = cells.sparkSession.createDataFrame([(i, words) for i, (words, _) in enumerate(names)], "ordinal int, words string")
    rows = {r["ordinal"]: r for r in decided(table.join(found, "ordinal", "left").fillna(False).fillna(0), F.col("words"), complete).collect()}
    if any(r["total"] > policy.samples for r in rows.values()):
        raise ProposalError("too_many_samples")
    if any(r["maximum_text_length"] > policy.value_chars for r in rows.values()):
        raise ProposalError("sample_value_too_large")
    hashes = [naming.hashlib.sha256(h.encode()).hexdigest() for h in headers]
    columns = tuple(
        ColumnProposal(
            hashes[i], names[i][1], r["proposed_type"], r["nullable"], r["non_null_count"], r["distinct_count"], r["maximum_text_length"],
            r["maximum_numeric_precision"], r["maximum_numeric_scale"], tuple(r["review_reasons"]),
        )
        for i, r in sorted(rows.items())
    )
    return identified(columns, hashes, source_hash.lower(), policy.version)


#: Evidence of a column without a cell, as where a table has no rows.
EMPTY = {"total": 0, "non_null_count": 0, "distinct_count": 0, "maximum_text_length": 0} | dict.fromkeys(("all_boolean", "all_date", "all_integer", "all_decimal", "leading_zero", "all_int64"), False)
FIELDS = tuple(sorted(f.name for f in fields(ColumnProposal)))


def named_headers(policy: ProposalPolicy):
    """struct<code, names> of a table's headers: the error that they are, or position, words, name and hash of each."""

    @F.arrow_udf("code string, names array<struct<ordinal: int, words: string, target_column_name: string, source_header_hash_sha256: string>>")
    def of(headers: pa.Array) -> pa.Array:
        codes, names = [], []
        for listed in headers.to_pylist():
            try:
                found = checked_headers(listed, policy)
                codes.append(None)
                names.append([{"ordinal": i, "words": w, "target_column_name": n, "source_header_hash_sha256": naming.hashlib.sha256(listed[i].encode()).hexdigest()} for i, (w, n) in enumerate(found)])
            except ProposalError as error:
                codes.append(error.code)
                names.append(None)
        kind = pa.list_(pa.struct([("ordinal", pa.int32()), *[(n, pa.string()) for n in ("words", "target_column_name", "source_header_hash_sha256")]]))
        return pa.StructArray.from_arrays([pa.array(codes, pa.string()), pa.array(names, kind)], ["code", "names"])

    return of


def _json(value: Column) -> Column:
    """Canonical JSON of a column whose fields are in order of their names."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def proposals(rows: DataFrame, *carried: str, policy: ProposalPolicy = ProposalPolicy(), complete: bool = True) -> DataFrame:  # noqa: B008
    """The proposals of all artifacts at once: ids, fingerprint, canonical JSON, review flag, or an error code.

    ``rows`` are strictly parsed. One row a column is shuffled, and one grouped aggregate over the cells;
    the JSON is that of :meth:`SchemaProposal.to_dict`. Artifacts without exactly one table that has a
    header are ``schema_proposal_failed``.
    """
    heads = rows.where("coalesce(row_index, 0) = 0").withColumn("headers", F.when((F.col("table_count") == 1), F.col("headers")))
    heads = heads.groupBy("artifact_sha256").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("headers", "error_code", *carried)])
    named = heads.withColumn("found", named_headers(policy)("headers"))
    each = named.select("artifact_sha256", F.explode("found.names").alias("n")).select("artifact_sha256", "n.*")
    cells = long_cells(data_rows(only_table(rows)))
    judged = decided(each.join(evidence(cells, ["artifact_sha256", "ordinal"]), ["artifact_sha256", "ordinal"], "left").fillna(EMPTY), F.col("words"), complete)
    column = F.struct("ordinal", F.struct(*FIELDS).alias("column"))
    grouped = judged.groupBy("artifact_sha256").agg(F.sort_array(F.collect_list(column)).alias("columns"), F.max("total").alias("samples"), F.max("maximum_text_length").alias("longest"), F.bool_or(F.size("review_reasons") > 0).alias("review_required"))
    joined = named.join(grouped.withColumn("columns", F.transform("columns", lambda c: c["column"])), "artifact_sha256", "left")
    code = F.coalesce("error_code", F.when(F.col("headers").isNull(), "schema_proposal_failed"), "found.code", F.when(F.col("samples") > policy.samples, "too_many_samples"), F.when(F.col("longest") > policy.value_chars, "sample_value_too_large"))
    fingerprint = F.sha2(F.to_json(F.transform("found.names", lambda n: n["source_header_hash_sha256"])), 256)
    made = joined.withColumns({"code": code, "proposal_version": F.lit(policy.version), "source_hash_sha256": F.col("artifact_sha256"), "table_fingerprint_sha256": fingerprint})
    identity = _json(F.struct("columns", "proposal_version", "source_hash_sha256", "table_fingerprint_sha256"))
    made = made.withColumn("schema_proposal_id", F.concat(F.lit("schema_proposal_"), F.substring(F.sha2(identity, 256), 1, 32)))
    document = _json(F.struct("columns", "proposal_version", "schema_proposal_id", "source_hash_sha256", "table_fingerprint_sha256"))
    good = lambda c: F.when(F.col("code").isNull(), c)
    return made.select("artifact_sha256", *carried, *[good(F.col(c)).alias(c) for c in ("schema_proposal_id", "table_fingerprint_sha256")], good(document).alias("proposal"), good(F.col("review_required")).alias("review_required"), F.col("code").alias("error_code"))


def identified(columns: tuple[ColumnProposal, ...], header_hashes: list[str], source_hash: str, version: str) -> SchemaProposal:
    fingerprint = digest(header_hashes)
    identity = {"proposal_version": version, "source_hash_sha256": source_hash, "table_fingerprint_sha256": fingerprint, "columns": [c.to_dict() for c in columns]}
    return SchemaProposal(f"schema_proposal_{digest(identity)[:32]}", version, source_hash, fingerprint, columns)
