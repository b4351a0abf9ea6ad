"""Session settings the engine relies on, code in the workers, and tables in the shared folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from gridloom.errors import GridloomError

ROOT = Path(__file__).resolve().parents[1]
SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.python.filterPushdown.enabled": "true", "spark.sql.timeType.enabled": "true", "spark.sql.mapKeyDedupPolicy": "LAST_WIN"}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shipped(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers that do not see the driver's ``sys.path``."""
    context = spark.sparkContext
    if str(ROOT) not in os.environ.get("PYTHONPATH", "").split(":") and not getattr(context, "_gridloom_shipped", False):
        archive = Path(tempfile.mkdtemp(prefix="gridloom-")) / "gridloom_code.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted((ROOT / "gridloom").rglob("*.py")):
                out.write(source, source.relative_to(ROOT))
        context.addPyFile(str(archive))
        context._gridloom_shipped = True
    return spark


def prepared(spark: SparkSession) -> SparkSession:
    """Set what can be set at run time, and ship the package."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return shipped(spark)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a session in one process, as in tests, gets one of its own where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise GridloomError("shared_folder_required")
    if not hasattr(context, "_gridloom_folder"):
        context._gridloom_folder = "file://" + tempfile.mkdtemp(prefix="gridloom-")
    return context._gridloom_folder


class Run:
    """Tables of one run, in a folder of its own in the shared folder: they outlive executors.

    ``table`` writes and reads back, which ends the lineage; ``drop`` removes tables that nothing
    reads any more. What the result of a run reads itself has to stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self._paths = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", {}

    def observed(self, df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict]:
        """A table, and aggregates over its rows that ride on the write: no job of their own."""
        seen = Observation()
        table = self.table(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), name)
        return table, seen.get

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{len(self._paths)}"
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")  # the shuffle files behind the table go as soon as it is written
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before or "false")
        read = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(read)] = (path, read)
        return read

    def drop(self, *tables: DataFrame) -> None:
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        for table in tables:
            path = path_of(self._paths[id(table)][0])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
