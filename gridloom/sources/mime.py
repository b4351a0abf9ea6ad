"""Bytes of a web archive to its HTML document, strictly or leniently. No Spark here."""

from __future__ import annotations

import codecs
from dataclasses import dataclass, field
from email import message_from_bytes, policy
from email.message import Message

from gridloom.errors import LenientError, ParseError
from gridloom.limits import Budgets

# Header names, parameters, transfer encodings and byte order marks of the MIME rules.
SINGLETONS = ("Content-Type", "Content-ID", "Content-Location", "Content-Transfer-Encoding")
RELATED_PARAMETERS = ("boundary", "start", "type")
TRANSFER_ENCODINGS = ("", "7bit", "8bit", "binary", "base64", "quoted-printable")
BYTE_ORDER_MARKS = (
    (codecs.BOM_UTF32_LE, "utf-32"),
    (codecs.BOM_UTF32_BE, "utf-32"),
    (codecs.BOM_UTF8, "utf-8-sig"),
    (codecs.BOM_UTF16_LE, "utf-16"),
    (codecs.BOM_UTF16_BE, "utf-16"),
)


@dataclass(frozen=True)
class Document:
    html: str
    content_type: str
    location: str | None = None
    content_id: str | None = None
    notes: tuple[str, ...] = ()


@dataclass(frozen=True)
class Part:
    content_type: str
    location: str | None
    payload: bytes = field(repr=False)


def parameter_names(header: str) -> list[str]:
    """Names of the parameters of a Content-Type value, deaf to quoted strings and nested comments."""
    plain, at, depth, quoted = [], 0, 0, False
    while at < len(header):
        char = header[at]
        if char == "\\" and (quoted or depth):
            at += 2
            continue
        if depth:
            depth += (char == "(") - (char == ")")
        elif quoted:
            quoted = char != '"'
        elif char == '"':
            quoted = True
        elif char == "(":
            depth = 1
        else:
            plain.append(char)
        at += 1
    return [p.split("=")[0].strip().lower() for p in "".join(plain).split(";")[1:] if "=" in p]


def normal_id(value: str | None) -> str | None:
    """A Content-ID without its angle brackets; blank is None."""
    text = (value or "").strip()
    text = text[1:] if text.startswith("<") else text
    text = text[:-1] if text.endswith(">") else text
    return text.strip() or None


def _walk(message: Message, budgets: Budgets) -> list[Message]:
    """All parts below a message, parents first."""
    found, waiting = [], [(child, 1) for child in reversed(_children(message))]
    while waiting:
        part, depth = waiting.pop()
        if depth > budgets.mime_depth:
            raise ParseError("mime_nesting_too_deep")
        found.append(part)
        if len(found) > budgets.mime_parts:
            raise ParseError("too_many_mime_parts")
        waiting += [(child, depth + 1) for child in reversed(_children(part))]
    return found


def _children(message: Message) -> list[Message]:
    payload = message.get_payload() if message.is_multipart() else None
    return payload if isinstance(payload, list) else []


def _check_structure(message: Message, parts: list[Message]) -> None:
    if message.get_content_type() == "multipart/related":
        header = next((str(v) for k, v in message.raw_items() if k.lower() == "content-type"), "")
        names = parameter_names(header)
        if any(names.count(p) > 1 for p in RELATED_PARAMETERS):
            raise ParseError("invalid_mime")
    for part in (message, *parts):
        values = {name: part.get_all(name, []) for name in SINGLETONS}
        flawed = any(getattr(v, "defects", ()) for name in SINGLETONS[:3] for v in values[name])
        if part.defects or flawed or any(len(v) > 1 for v in values.values()):
            raise ParseError("invalid_mime")
    ids = [i for i in (normal_id(p.get("Content-ID")) for p in parts) if i is not None]
    if len(ids) != len(set(ids)):
        raise ParseError("ambiguous_html_root")


def _root(message: Message, parts: list[Message]) -> Message:
    kind = message.get_content_type()
    if kind == "text/html":
        return message
    if kind != "multipart/related":
        raise ParseError("invalid_mime")
    start = normal_id(message.get_param("start"))
    if start is None:
        candidates = _children(message)[:1]
    else:
        candidates = [p for p in parts if normal_id(p.get("Content-ID")) == start]
    if len(candidates) != 1 or candidates[0].is_multipart() or candidates[0].get_content_type() != "text/html":
        raise ParseError("missing_html_root")
    return candidates[0]


def _decoded(part: Message, budgets: Budgets) -> tuple[str, tuple[str, ...]]:
    encoding = str(part.get("Content-Transfer-Encoding", "")).strip().lower()
    notes: tuple[str, ...] = ()
    if encoding in TRANSFER_ENCODINGS:
        raw = part.get_payload(decode=True)
    else:
        notes = ("identity_transfer_encoding",)
        payload = part.get_payload()
        raw = payload.encode("utf-8", "surrogateescape") if isinstance(payload, str) else None
    if not isinstance(raw, bytes):
        raise ParseError("html_decode_failed")
    charset = part.get_content_charset()
    if charset is None:
        charset = next((name for mark, name in BYTE_ORDER_MARKS if raw.startswith(mark)), "utf-8")
    try:
        codecs.lookup(charset)
    except LookupError:
        raise ParseError("unknown_charset") from None
    try:
        html = raw.decode(charset)
    except (UnicodeError, LookupError):
        raise ParseError("html_decode_failed") from None
    if len(html) > budgets.html_chars:
        raise ParseError("html_too_large")
    return html, notes


def strict_document(data: bytes, budgets: Budgets = Budgets()) -> Document:  # noqa: B008
    """The HTML root of an archive; raises ParseError with the first rule that fails."""
    if not isinstance(data, bytes):
        raise ParseError("invalid_mime")
    if len(data) > budgets.source_bytes:
        raise ParseError("source_too_large")
    try:
        message = message_from_bytes(data, policy=policy.default)
    except RecursionError:
        raise ParseError("mime_nesting_too_deep") from None
    related = message.get_content_type() == "multipart/related"
    if related and message.is_multipart() and not _children(message):
        raise ParseError("missing_html_root")
    parts = _walk(message, budgets)
    _check_structure(message, parts)
    root = _root(message, parts)
    notes: tuple[str, ...] = ()
    if related:
        declared = message.get_param("type")
        if declared is None:
            notes = ("missing_related_type",)
        elif str(declared).strip().lower() != root.get_content_type():
            raise ParseError("invalid_mime")
    html, more = _decoded(root, budgets)
    location = root.get("Content-Location")
    return Document(html, root.get_content_type(), None if location is None else str(location), normal_id(root.get("Content-ID")), notes + more)


def looks_like_archive(data: bytes) -> bool:
    """Sniff of the lenient reader: MIME words early on, or HTML with a table not far off."""
    head = data[:4096].lower()
    return any(word in head for word in (b"mime-version:", b"content-type:", b"multipart/")) or b"<html" in head and b"<table" in data[:65536].lower()


def lenient_parts(data: bytes) -> list[Part]:
    """All leaf parts with a payload, in document order, with no structural checks."""
    if not data.strip() or not looks_like_archive(data):
        raise LenientError("not_an_archive")
    parts = []
    for part in message_from_bytes(data, policy=policy.compat32).walk():
        if part.is_multipart():
            continue
        payload = part.get_payload(decode=True)
        if payload is None:
            raw = part.get_payload()
            payload = raw.encode("utf-8", "replace") if isinstance(raw, str) else b""
        if payload:
            parts.append(Part(part.get_content_type(), part.get("Content-Location"), payload))
    if not parts and b"<html" in data.lower():
        parts.append(Part("text/html", None, data))
    if not parts:
        raise LenientError("no_parts")
    return parts


def lenient_html(data: bytes) -> bytes:
    """The largest HTML part, the first of equals; else the first part that begins like HTML."""
    parts = lenient_parts(data)
    pages = [p.payload for p in parts if p.content_type == "text/html"]
    if not pages:
        pages = [p.payload for p in parts if b"<html" in p.payload[:8192].lower() or b"<table" in p.payload[:8192].lower()][:1]
    if not pages:
        raise LenientError("no_html_part")
    return max(pages, key=len)
