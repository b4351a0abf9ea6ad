"""Continuous loading: new archives of a folder, micro-batch by micro-batch.

Each batch is committed with its number, so one that runs again after a failure between the commit and the stream's own
checkpoint is recognised without being read. Loads are idempotent by content hash besides: with ``availableNow`` the result
equals one batch load of the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gridloom.plans.load import load
from gridloom.plans.sink import Sink
from gridloom.session import prepared
from gridloom.sources import archives, scan

#: The local property in which Spark names the query that a batch belongs to; it lasts as long as its checkpoint.
QUERY_ID = "sql.streaming.queryId"


def arriving(spark: SparkSession, folder: str, checkpoint: str, files_at_a_time: int = 1000) -> DataFrame:
    """path, length and content of new files. Where only Spark can open the folder, its own source reads it, which skips hidden names."""
    prepared(spark)
    if scan.reachable(folder) and scan.reachable(checkpoint):
        name = archives.registered(spark)
        options = scan.options(spark, folder, ledger=f"{checkpoint.rstrip('/')}-ledger", filesAtATime=str(files_at_a_time))
        return spark.readStream.format(name).options(**options).load().select("path", "length", "content")
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    reader = reader.option("pathGlobFilter", scan.GLOB).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_at_a_time)
    return reader.load(folder).select("path", "length", "content")


def ingest(spark: SparkSession, folder: str, sink: Sink, checkpoint: str, continuous: bool = False, files_at_a_time: int = 1000, outcomes: str | None = None, **options) -> StreamingQuery:
    """A running query. ``continuous``: until it is stopped, with at most ``files_at_a_time`` files a batch; else until what is there now is loaded, as one batch.

    ``outcomes`` is a folder that gets the outcomes of each batch, late copies among them as skipped; a batch that runs again writes its own anew.
    """

    def one(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        done = sink.stamped(query) if query else None
        if done is None or done < number:
            result = load(spark, sink, batch, stamp=(query, number) if query else None, **options)
            if outcomes:
                result.outcomes.write.mode("overwrite").parquet(f"{outcomes}/batch={number}")

    at_a_time = files_at_a_time if continuous else 1 << 62
    writer = arriving(spark, folder, checkpoint, at_a_time).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime="1 minute") if continuous else writer.trigger(availableNow=True)).start()
