"""Type checks of cells: cheap enough for hundreds of millions, and the same verdicts."""

import contextlib
import io
import re

from gridloom.functions import types
from gridloom.plans import profile
from pyspark.sql import functions as F

#: Bytes of the longest method that the JVM compiles.
LONGEST = 8000


def test_checks_of_all_types_are_code_that_the_jvm_compiles(spark):
    """Longer methods are interpreted: the checks of a cell then take several times as long."""
    spark.conf.set("spark.sql.timeType.enabled", "true")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # whose plans show no code before they run
    try:
        cells = spark.range(100).select(F.lit("a").alias("artifact_sha256"), F.col("id").alias("row_no"), F.lit(0).alias("ordinal"), F.lit("h").alias("header"), F.col("id").cast("string").alias("value"))
        shown = io.StringIO()
        with contextlib.redirect_stdout(shown):
            cells.select(*[types.conforms(F.col("value"), t).alias(t) for t in types.LOAD_TYPES]).explain("codegen")
            profile.column_types(cells).explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
        assert sizes and max(sizes) < LONGEST
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_long_and_odd_numbers_and_days_behind_the_quick_checks(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    expected = {
        "NUMERIC": {"12345678901234567890": True, "123456789012345678901": False, "0000123456789012345678.5": True, "1.0000000000000000000": True, "1.0000000000000000001": False, "1_0,0.5": False, "1.": True, ".": False, "": False, None: None},
        "DATE": {"0000-01-01": False, "2026-2-3": True, "2026-02-30": False, "1.2.2026": True, "20260220": True, "2026220": False, None: None},
        "TIMESTAMP": {"20260220T0948": False, "20260220 09:48": True, "2026-02-20T09:48:09,25": True, "2026-2-3 1:2:3": True, "2026-02-20 24:00:00": False, None: None},
        "TIME": {"1:2": True, "09:48:09.123456": True, "09:48:09,123456": True, "09:48:09.1234567": False, "094809": True, "240000": False, None: None},
    }
    for kind, values in expected.items():
        rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", types.conforms(F.col("v"), kind).alias("ok")).collect()
        assert {r["v"]: r["ok"] for r in rows} == values


def test_kinds_are_those_of_the_first_rows_and_misfits_of_all(spark):
    values = {"n": ["1"] * 3 + ["x"], "d": ["2026-02-20", None, "2026-02-21", "2026-02-22"], "e": [None, None, None, "7"], "m": ["1", "1.5", "2", "3"]}
    rows = [("a", i + 1, at, h, v) for at, (h, column) in enumerate(values.items()) for i, v in enumerate(column)]
    found = profile.column_types(spark.createDataFrame(rows, "artifact_sha256 string, row_no long, ordinal int, header string, value string"), sample=3)
    assert {r["header"]: (r["kind"], r["misfit"]) for r in found.collect()} == {"n": ("BIGINT", True), "d": ("DATE", False), "e": ("TEXT", False), "m": ("NUMERIC", False)}
