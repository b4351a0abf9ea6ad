"""Errors with stable codes. Messages are fixed texts: they never repeat values, headers or paths."""

from __future__ import annotations

# The parse failure codes of the artifact contract.
PARSE_CODES = (
    "invalid_argument", "source_too_large", "source_read_failed", "invalid_mime", "too_many_mime_parts", "mime_nesting_too_deep",
    "missing_html_root", "ambiguous_html_root", "unknown_charset", "html_decode_failed", "html_too_large", "too_many_tables",
    "too_many_rows", "too_many_columns", "too_many_cells", "cell_text_too_large", "nested_table", "invalid_table_span", "schema_proposal_failed",
)
# The codes of proposal inputs.
PROPOSAL_CODES = ("invalid_source_hash", "invalid_input", "too_many_columns", "header_too_large", "too_many_samples", "sample_value_too_large")


def message(code: str) -> str:
    """A readable text that depends on the code alone."""
    return f"The artifact was rejected: {code.replace('_', ' ')}."


class GridloomError(ValueError):
    """Base of all errors; ``code`` is stable."""

    codes: tuple[str, ...] = ()
    code = "invalid_argument"

    def __init__(self, code: str | None = None):
        if code is not None:
            if self.codes and code not in self.codes:
                code = self.codes[0]
            self.code = code
        super().__init__(message(self.code))

    def to_dict(self) -> dict[str, str]:
        return {"error_code": self.code, "message": str(self)}


class ParseError(GridloomError):
    codes = PARSE_CODES


class ProposalError(GridloomError):
    codes = PROPOSAL_CODES


class LenientError(GridloomError):
    """The lenient reader found no document or no usable table."""

    code = "lenient_parse_failed"


class ValidationFailed(GridloomError):
    code = "validation_failed"


class NameError_(GridloomError):
    code = "invalid_name"


class UnsafeIdentifier(GridloomError):
    code = "unsafe_identifier"


class MappingFailed(GridloomError):
    code = "invalid_mapping"


class LoadFailed(GridloomError):
    code = "load_failed"


class PublishFailed(GridloomError):
    """Carries how far publication came, and nothing of any request."""

    def __init__(self, code: str, request_index: int | None = None, accepted: int = 0):
        super().__init__(code)
        self.request_index, self.accepted = request_index, accepted

    def to_dict(self) -> dict:
        return {"error_code": f"catalog_publisher_{self.code}", "request_index": self.request_index, "accepted_request_count": self.accepted}
