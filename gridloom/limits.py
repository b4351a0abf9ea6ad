"""Resource budgets of the parse stage and of schema proposals."""

from __future__ import annotations

from dataclasses import dataclass, fields

from gridloom.errors import ParseError


def _positive(holder) -> None:
    for field in fields(holder):
        value = getattr(holder, field.name)
        if isinstance(value, str):
            continue
        if isinstance(value, bool) or not isinstance(value, int) or value < 1:
            raise ParseError("invalid_argument")


@dataclass(frozen=True)
class Budgets:
    source_bytes: int = 250 * 1024 * 1024
    mime_parts: int = 256
    mime_depth: int = 64
    html_chars: int = 50_000_000
    tables: int = 128
    rows: int = 1_000_000
    columns: int = 4096
    cells: int = 10_000_000
    cell_chars: int = 1_000_000

    def __post_init__(self) -> None:
        _positive(self)


@dataclass(frozen=True)
class ProposalPolicy:
    version: str = "1.0.0"
    columns: int = 4096
    header_chars: int = 4096
    samples: int = 10_000
    value_chars: int = 1_000_000

    def __post_init__(self) -> None:
        _positive(self)


#: The lenient reader's only budget.
LENIENT_COLSPAN = 100_000
