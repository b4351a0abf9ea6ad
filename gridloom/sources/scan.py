"""Artifacts as rows: discovery, budget, identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.errors import ParseError
from gridloom.functions.text import artifact_reference, fingerprint
from gridloom.limits import Budgets
from gridloom.session import prepared
from gridloom.sources import archives

SUFFIX = ".mhtml"
#: The same for Spark's own reader.
GLOB = "*.[mM][hH][tT][mM][lL]"


def options(spark: SparkSession, source: str, **more: str) -> dict[str, str]:
    """Options of the archive source: partitions are planned as for Spark's own files."""
    size = lambda key, default: str(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key, default)))
    plan = {"partitionBytes": size("spark.sql.files.maxPartitionBytes", "128m"), "openBytes": size("spark.sql.files.openCostInBytes", "4m"), "parallelism": str(spark.sparkContext.defaultParallelism)}
    return {"path": source, "suffix": SUFFIX, **plan, **more}


def reachable(source: str) -> bool:
    """Whether the archive source can open this file system; others (a store that only Spark reads) go through Spark's reader."""
    try:
        archives.located(source)
    except Exception:  # noqa: BLE001  what is missing differs by file system
        return False
    return True


def artifacts(spark: SparkSession, source: str, recursive: bool = True, limit_bytes: int | None = None) -> DataFrame:
    """path, length and content of web archives: a file of any suffix, a folder, or a glob where no such path exists.

    Every file is a row, whatever its name. Content is null, and the file never opened, beyond ``limit_bytes``; it is null too where
    a file can't be read.
    """
    prepared(spark)
    if not reachable(source):
        return _by_spark(spark, source, recursive, limit_bytes)
    more = {"recursive": str(recursive).lower()} | ({} if limit_bytes is None else {"limitBytes": str(limit_bytes)})
    return spark.read.format(archives.registered(spark)).options(**options(spark, source, **more)).load().select("path", "length", "content")


def is_file(spark: SparkSession, source: str) -> bool:
    """Whether there is a file at this very path."""
    if reachable(source):
        system, place, _ = archives.located(source)
        return system.get_file_info(place).is_file
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(path) and system.getFileStatus(path).isFile()


def _by_spark(spark: SparkSession, source: str, recursive: bool, limit_bytes: int | None) -> DataFrame:
    """The same by Spark's reader. Names that it hides are an error, not left out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    try:
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        exists = system.exists(path)
        single = exists and system.getFileStatus(path).isFile()
        if not exists and not system.globStatus(path):
            return spark.createDataFrame([], "path string, length long, content binary")
        names = [path.getName()] if single else []
        if exists and not single:
            found = system.listFiles(path, recursive)
            while found.hasNext():
                names.append(found.next().getPath().getName())
    except Exception:  # noqa: BLE001  errors of the store would repeat paths
        raise ParseError("source_read_failed") from None
    if any(n[:1] in "_." and (single or n.lower().endswith(SUFFIX)) for n in names):
        raise ParseError("source_read_failed")
    reader = spark.read.format("binaryFile")
    if not single:
        reader = reader.option("pathGlobFilter", GLOB).option("recursiveFileLookup", str(recursive).lower())
    literal = "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in source) if exists else source
    files = reader.load(literal).select("path", "length", "content")
    if limit_bytes is None:
        return files
    return files.where(F.col("length") <= limit_bytes).unionByName(files.where(F.col("length") > limit_bytes).select("path", "length", F.lit(None).cast("binary").alias("content")))


def too_large(length: Column, budgets: Budgets = Budgets()) -> Column:  # noqa: B008
    return F.when(length > budgets.source_bytes, F.lit("source_too_large"))


def judged(files: DataFrame, budgets: Budgets = Budgets()) -> DataFrame:  # noqa: B008
    """Adds error_code: of files over the budget, whose content was not read, and of files that can't be read."""
    unread = F.when(F.col("content").isNull(), F.lit("source_read_failed"))
    return files.withColumn("error_code", F.coalesce(too_large(F.col("length"), budgets), unread))


def identified(files: DataFrame) -> DataFrame:
    """Adds artifact_sha256 and reference, before any Python sees the content."""
    sha = fingerprint(files["content"])
    return files.withColumn("artifact_sha256", sha).withColumn("reference", artifact_reference(F.col("artifact_sha256")))


def location_hash(location: Column) -> Column:
    return F.sha2(location, 256)
