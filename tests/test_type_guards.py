"""Cheap guards stand before the patterns of types; what lies at their edges must read as the patterns alone have it."""

from gridloom.functions import types
from gridloom.session import prepared
from pyspark.sql import functions as F

WANTED = {
    "DATE": {"2020-1-2": "2020-01-02", "2020/12/31": "2020-12-31", "20201231": "2020-12-31", "1.2.2020": "2020-02-01", "31.12.2020": "2020-12-31", "75462.67": None, "372772.98": None, "12345.6789": None, "1-2-2020": None, "12345678": None},
    "TIME": {"123059": "12:30:59", "1:2": "01:02:00", "12:30:59,5": "12:30:59.5", "12345678": None, "12305": None, "1230599": None},
    "BOOLEAN": {"FALSE": "false", "t": "true", "Yes": "true", "falsely": None},
    "BIGINT": {"1,234": "1234", "-12": "-12", "1,23": None, "12.0": None},
    "NUMERIC": {"99.99": "99.99", "5.": "5", ".5": "0.5", "1e5": "100000", "1,234.50": "1234.5", "1_0": "10", "1e30": None, "x1": None},
}


def test_guards_let_through_what_patterns_take(spark):
    prepared(spark)
    rows = [(kind, text, value) for kind, cases in WANTED.items() for text, value in cases.items()]
    read = F.coalesce(*[F.when(F.col("kind") == k, types.READERS[k](F.col("text")).cast("string")) for k in WANTED])
    plain = F.when(F.col("kind") == "NUMERIC", F.regexp_replace(F.regexp_replace(read, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")).otherwise(read)
    found = spark.createDataFrame(rows, "kind string, text string, value string").select("kind", "text", plain.alias("read"), "value").collect()
    assert [r for r in found if r.read != r.value] == []
