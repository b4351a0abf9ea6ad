"""Documents derived from a proposal: catalog graph, submission envelope, DBML text."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gridloom.errors import GridloomError
from gridloom.functions.naming import safe_identifier, table_name
from gridloom.functions.text import canonical_json, digest
from gridloom.operators.propose import TYPES, SchemaProposal

CONTRACT, TARGET, SOURCE = "1.0.0", "column-catalog", "gridloom"
NODES, EDGES, KEY_PREFIX = "/graph/nodes", "/graph/edges", "catalog_write_"
OPAQUE = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.:/-]{0,127}")
COLUMN_FIELDS = ("target_column_name", "proposed_type", "nullable", "non_null_count", "distinct_count", "maximum_text_length", "maximum_numeric_precision", "maximum_numeric_scale")


@dataclass(frozen=True)
class Manifest:
    manifest_id: str
    nodes: tuple[dict, ...]
    edges: tuple[dict, ...]

    def frames(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """(nodes, edges) with properties as canonical JSON."""
        nodes = [(i, n["node_id"], n["kind"], n["label"], canonical_json(n["properties"]), n["text"]) for i, n in enumerate(self.nodes)]
        edges = [(i, e["edge_type"], e["source_id"], e["target_id"], canonical_json(e["properties"])) for i, e in enumerate(self.edges)]
        return (
            spark.createDataFrame(nodes, "position int, node_id string, kind string, label string, properties string, text string"),
            spark.createDataFrame(edges, "position int, edge_type string, source_id string, target_id string, properties string"),
        )


def display_name(name: str) -> str:
    if not isinstance(name, str) or not name.strip() or any(ord(c) < 32 or ord(c) == 127 for c in name.strip()):
        raise GridloomError("invalid_catalog_name")
    return name.strip()


def manifest(proposal: SchemaProposal, name: str) -> Manifest:
    """A dataset node, a node for each column, an edge to each; named by the hash of its content."""
    name = display_name(name)
    dataset_id = f"{SOURCE}_dataset_{proposal.schema_proposal_id.removeprefix('schema_proposal_')}"
    shared = {"connector_contract_version": CONTRACT, "privacy_mode": "value_free"}
    dataset = {
        "node_id": dataset_id, "kind": "dataset", "label": name, "text": f"{name} schema proposal",
        "properties": shared | {
            "source_system": SOURCE, "source_hash_sha256": proposal.source_hash_sha256, "schema_proposal_id": proposal.schema_proposal_id, "proposal_version": proposal.proposal_version,
            "table_fingerprint_sha256": proposal.table_fingerprint_sha256, "column_count": len(proposal.columns), "review_required": proposal.review_required,
        },
    }
    nodes, edges = [dataset], []
    for column in proposal.columns:
        node_id = f"{dataset_id}_column_{column.target_column_name}"
        properties = {f: getattr(column, f) for f in COLUMN_FIELDS} | {"source_header_hash_sha256": column.source_header_hash_sha256, "review_reasons": list(column.review_reasons)}
        nodes.append({"node_id": node_id, "kind": "column", "label": column.target_column_name, "properties": shared | properties, "text": f"{name} {column.target_column_name} {column.proposed_type}"})
        edges.append({"edge_type": "contains_column", "source_id": dataset_id, "target_id": node_id, "properties": {"schema_proposal_id": proposal.schema_proposal_id, "privacy_mode": "value_free"}})
    identity = {"contract_version": CONTRACT, "target_system": TARGET, "source_hash_sha256": proposal.source_hash_sha256, "schema_proposal_id": proposal.schema_proposal_id, "nodes": nodes, "edges": edges}
    return Manifest(f"catalog_manifest_{digest(identity)[:32]}", tuple(nodes), tuple(edges))


def opaque(reference: str) -> str:
    if not isinstance(reference, str) or not OPAQUE.fullmatch(reference):
        raise GridloomError("invalid_reference")
    return reference


def context_text(text: str) -> str:
    if not isinstance(text, str) or not text or len(text) > 256 or text != text.strip() or any(ord(c) < 32 or ord(c) == 127 for c in text):
        raise GridloomError("invalid_context")
    return text


@dataclass(frozen=True)
class Envelope:
    envelope_id: str
    requests: tuple[dict, ...]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, r["method"], r["path"], r["idempotency_key"], canonical_json(r["body"])) for i, r in enumerate(self.requests)]
        return spark.createDataFrame(rows, "request_index int, method string, path string, idempotency_key string, body string")


def envelope(graph: Manifest, tenant: str, actor: str, approval: str) -> Envelope:
    """Ordered write requests, nodes before edges, each with a key that binds it to tenant and approval."""
    bound = {"manifest_id": graph.manifest_id, "tenant_id": opaque(tenant), "approval_reference": opaque(approval)}
    actor, requests = context_text(actor), []
    for path, items in ((NODES, graph.nodes), (EDGES, graph.edges)):
        for item in items:
            body = item | {"actor": actor}
            requests.append({"method": "POST", "path": path, "idempotency_key": f"{KEY_PREFIX}{digest(bound | {'path': path, 'body': body})[:32]}", "body": body})
    identity = {"contract_version": CONTRACT, "target_system": TARGET, **bound, "actor": actor, "requests": requests}
    return Envelope(f"catalog_handoff_{digest(identity)[:32]}", tuple(requests))


def dbml(proposal: SchemaProposal, name: str) -> str:
    """The proposal as one DBML table: safe names, known types, nullability, nothing else."""
    lines = []
    for column in proposal.columns:
        if column.proposed_type not in TYPES or not isinstance(column.nullable, bool):
            raise GridloomError("invalid_column")
        lines.append(f"  {safe_identifier(column.target_column_name)} {column.proposed_type}" + ("" if column.nullable else " [not null]"))
    return f"Table {safe_identifier(table_name(display_name(name)))} {{\n" + "\n".join(lines) + "\n}"
