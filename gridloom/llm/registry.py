"""The queries of this subpackage and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import op10_license_scan as licenses
from gridloom.llm import op11_fill_in_middle as infill
from gridloom.llm import op12_html_extract as pages
from gridloom.llm import op4_near_dedup as near
from gridloom.llm import op5_quality_rules as rules
from gridloom.llm import op6_decontaminate as leaks
from gridloom.llm import op8_line_dedup as lines
from gridloom.llm import op9_chat_format as chat
from gridloom.llm.op1_language_id import op1_language_id
from gridloom.llm.op13_whitening import op13_whitening
from gridloom.llm.op2_quality import op2_quality
from gridloom.llm.op3_packing import op3_packing
from gridloom.llm.op7_token_counts import op7_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_language_id, op2_quality, op3_packing, near.op4_near_dedup, rules.op5_quality_rules, leaks.op6_decontaminate, op7_token_counts, lines.op8_line_dedup, chat.op9_chat_format, licenses.op10_license_scan, infill.op11_fill_in_middle, pages.op12_html_extract, op13_whitening)}
ORACLE_SQL: dict[str, str] = {"op4_near_dedup": near.ORACLE_SQL, "op8_line_dedup": lines.ORACLE_SQL, "op5_quality_rules": rules.ORACLE_SQL, "op6_decontaminate": leaks.ORACLE_SQL, "op9_chat_format": chat.ORACLE_SQL, "op10_license_scan": licenses.ORACLE_SQL, "op11_fill_in_middle": infill.ORACLE_SQL, "op12_html_extract": pages.ORACLE_SQL}
