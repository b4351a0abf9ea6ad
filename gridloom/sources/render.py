"""Relational rows to HTML tables and MIME archives, in SQL expressions only (fixtures and exports)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOUNDARY = "----gridloom"
#: Texts that a cell does not hold as they are: none at all, white space that is trimmed or joined, control characters; and those that may read as a number, day or truth value, which a whole column of them becomes.
ODD_TEXT = r"(?U)^(?!\p{L})|\s$|[\s\p{Cc}&&[^ ]]|  |^(?i:true|false|t|f|yes|no|y|n)$"
WORD_HEAD, WORD_TAIL = "=?utf-8?b?", "?="
ARCHIVE_HEAD = (
    f'MIME-Version: 1.0\nContent-Type: multipart/related; type="text/html"; boundary="{BOUNDARY}"\n\n'
    f"--{BOUNDARY}\nContent-Type: text/html; charset=utf-8\nContent-Transfer-Encoding: 8bit\nContent-Location: file:///export.htm\n\n"
)
ARCHIVE_TAIL = f"\n--{BOUNDARY}--\n"


def escaped(value: Column) -> Column:
    text = F.coalesce(value.cast("string"), F.lit(""))
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def worded(value: Column) -> Column:
    """A text for a cell; an odd one as an encoded word of mail (RFC 2047), so that a blank cell is no text, never an empty one."""
    word = F.concat(F.lit(WORD_HEAD), F.base64(F.encode(value, "utf-8")), F.lit(WORD_TAIL))
    return F.when(value.rlike(ODD_TEXT), word).otherwise(value)


def unworded(text: Column) -> Column:
    """The text of a cell that ``worded`` made; a cell's text never begins like an encoded word by itself, as that begins with no letter."""
    inner = F.replace(F.replace(text, F.lit(WORD_HEAD), F.lit("")), F.lit(WORD_TAIL), F.lit(""))
    return F.when(text.startswith(WORD_HEAD), F.decode(F.unbase64(inner), "utf-8")).otherwise(text)


def row(cells: list[Column], tag: str = "td") -> Column:
    return F.concat(F.lit("<tr>"), *[F.concat(F.lit(f"<{tag}>"), escaped(c), F.lit(f"</{tag}>")) for c in cells], F.lit("</tr>"))


def tables(rows: DataFrame, group: list[Column], order: list[Column], html_row: Column, header: str = "") -> DataFrame:
    """One row a group: its key columns and ``html``, the rows in order inside one table."""
    listed = F.sort_array(F.collect_list(F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)], html_row.alias("html"))))
    body = F.array_join(F.transform(listed, lambda x: x["html"]), "")
    return rows.groupBy(*group).agg(F.concat(F.lit(f"<html><body><table>{header}"), body, F.lit("</table></body></html>")).alias("html"))


def header_row(names: list[str], tag: str = "th") -> str:
    return "<tr>" + "".join(f"<{tag}>{n}</{tag}>" for n in names) + "</tr>"


def archive(html: Column, related_type: bool = True) -> Column:
    """A multipart/related archive around an HTML text, as bytes."""
    head = ARCHIVE_HEAD if related_type else ARCHIVE_HEAD.replace('; type="text/html"', "", 1)
    return F.encode(F.concat(F.lit(head), html, F.lit(ARCHIVE_TAIL)), "utf-8")
