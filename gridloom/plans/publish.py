"""Publishing an envelope, one request after the other on the driver: order and prefix matter."""

from __future__ import annotations

from abc import ABC, abstractmethod
from dataclasses import asdict, dataclass

from gridloom.errors import PublishFailed
from gridloom.plans.documents import CONTRACT, EDGES, KEY_PREFIX, NODES, OPAQUE, TARGET, Envelope

MOST_REQUESTS = 4096


@dataclass(frozen=True)
class Evidence:
    """The caller's word that the controls were passed, and where that is recorded."""

    actor_authenticated: bool
    tenant_authorized: bool
    approval_verified: bool
    immutable_audit_reference: str


@dataclass(frozen=True)
class Response:
    status_code: int
    remote_request_id: str
    accepted: bool


@dataclass(frozen=True)
class Receipt:
    request_index: int
    path: str
    idempotency_key: str
    status_code: int
    remote_request_id: str


@dataclass(frozen=True)
class Publication:
    """Evidence that every request was accepted; it holds no value of the source."""

    envelope_id: str
    immutable_audit_reference: str
    receipts: tuple[Receipt, ...]

    def to_dict(self) -> dict:
        shared = {"publisher_contract_version": CONTRACT, "envelope_id": self.envelope_id, "target_system": TARGET, "immutable_audit_reference": self.immutable_audit_reference, "privacy_mode": "value_free"}
        return shared | {"accepted_request_count": len(self.receipts), "requests": [asdict(r) for r in self.receipts]}


class Transport(ABC):
    @abstractmethod
    def send(self, request: dict) -> Response: ...


# The codes of failures, by what is wrong.
CONTROLS = (("actor_authenticated", "actor_authentication_required"), ("tenant_authorized", "tenant_authorization_required"), ("approval_verified", "approval_verification_required"))
NO_AUDIT, NO_ENVELOPE, NO_TRANSPORT, NO_LIMIT = "immutable_audit_reference_required", "invalid_envelope", "transport_required", "invalid_request_limit"
NO_REQUESTS, TOO_MANY, BAD_REQUEST, BAD_KEY = "no_catalog_requests", "request_limit_exceeded", "invalid_catalog_request", "invalid_idempotency_key"
LOST, BAD_RESPONSE, NOT_SUCCESS, NOT_ACCEPTED, NO_ID = "transport_failed", "invalid_transport_response", "remote_status_not_success", "remote_acceptance_required", "remote_request_id_required"


def _opaque(value: object) -> bool:
    return isinstance(value, str) and OPAQUE.fullmatch(value) is not None


def _objection(envelope: Envelope, evidence: Evidence, transport: Transport, most: int) -> str | None:
    """Why nothing may be sent at all."""
    if not isinstance(envelope, Envelope):
        return NO_ENVELOPE
    if not isinstance(transport, Transport):
        return NO_TRANSPORT
    if type(most) is not int or not 1 <= most <= MOST_REQUESTS:
        return NO_LIMIT
    missing = [code for control, code in CONTROLS if getattr(evidence, control) is not True]
    if missing or not _opaque(evidence.immutable_audit_reference):
        return next(iter(missing), NO_AUDIT)
    return NO_REQUESTS if not envelope.requests else TOO_MANY if len(envelope.requests) > most else None


def _sent(request: dict, transport: Transport) -> Response | str:
    """The response of an accepted request, or the code of what is wrong with it."""
    if request.get("method") != "POST" or request.get("path") not in (NODES, EDGES):
        return BAD_REQUEST
    key = request.get("idempotency_key")
    if not _opaque(key) or not key.startswith(KEY_PREFIX):
        return BAD_KEY
    try:
        response = transport.send(request)
    except Exception:  # whatever the caller's transport raises; its text may hold values
        return LOST
    if not isinstance(response, Response):
        return BAD_RESPONSE
    if type(response.status_code) is not int or not 200 <= response.status_code < 300:
        return NOT_SUCCESS
    if response.accepted is not True:
        return NOT_ACCEPTED
    return response if _opaque(response.remote_request_id) else NO_ID


def publish(envelope: Envelope, evidence: Evidence, transport: Transport, most: int = MOST_REQUESTS) -> Publication:
    """Check and send one request after the other, each once; the first that is not accepted ends it, and the error says how many were."""
    objection = _objection(envelope, evidence, transport, most)
    if objection:
        raise PublishFailed(objection)
    receipts: list[Receipt] = []
    for i, request in enumerate(envelope.requests):
        answer = _sent(request, transport)
        if isinstance(answer, str):
            raise PublishFailed(answer, i, len(receipts))
        receipts.append(Receipt(i, request["path"], request["idempotency_key"], answer.status_code, answer.remote_request_id))
    return Publication(envelope.envelope_id, evidence.immutable_audit_reference, tuple(receipts))
