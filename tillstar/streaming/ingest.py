"""Structured Streaming ingestion of raw order-line files.

The reference loads whole CSV drops in batch runs. The streaming form watches a folder: the
stream carries the paths of new files; each micro-batch reads its files with the batch
reader, so columns are bound by every file's own header, and sends them through the same
extract -> stage -> upsert -> fact replacement as a batch run (``warehouse.run_etl``) inside
``foreachBatch``. File tracking and progress live in the query's checkpoint folder, so a
restarted query (or one whose executors were lost) resumes with the files not yet committed;
a re-delivered batch is harmless because dimension upserts and fact replacement are idempotent.

Use ``trigger(availableNow=True)`` for scheduled catch-up runs, a processing-time trigger
for continuous loading; ``max_files_per_trigger`` bounds a micro-batch, and with it the
paths that reach the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.clean import HEADER_TO_STAGING
from ..plans.warehouse import run_etl
from ..sources.csv import read_raw_csv

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def raw_stream(spark: SparkSession, folder: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Paths of new files under ``folder`` as a stream; contents are not read here."""
    return (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
            .option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", max_files_per_trigger)
            .load(folder).select("path"))


def read_files(spark: SparkSession, paths: list[str], encoding: str) -> DataFrame:
    """Files of one batch as one header-named frame: missing columns become NULL, others keep
    their place by name. A file without any known header is an error."""
    frames = []
    for path in paths:
        df = read_raw_csv(spark, path, encoding)
        if not set(df.columns) & set(HEADER_TO_STAGING):
            raise ValueError(f"{path} has none of the known headers")
        frames.append(df)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def start_ingest(spark: SparkSession, folder: str, warehouse_root: str, checkpoint: str,
                 available_now: bool = True, encoding: str = "windows-1252",
                 max_files_per_trigger: int = 100) -> StreamingQuery:
    """Load every new file batch onto the warehouse tables under ``warehouse_root``."""

    def load(batch: DataFrame, batch_id: int) -> None:
        paths = sorted(r["path"] for r in batch.distinct().collect())  # at most max_files_per_trigger
        if paths:
            run_etl(read_files(batch.sparkSession, paths, encoding), warehouse_root)

    writer = raw_stream(spark, folder, max_files_per_trigger).writeStream.foreachBatch(load).option(
        "checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
