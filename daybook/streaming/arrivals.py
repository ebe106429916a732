"""Catch up from new files: the stream's checkpoint is the mark of what has been processed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daybook.plans.daily import run_day
from daybook.sources.drops import PART_FILES
from daybook.sources.tables import Lake

# The file source's own columns; without the content column no file is opened.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def new_run_dates(lake: Lake, zone: str = "raw") -> DataFrame:
    """Stream of the run dates that new drop files belong to, taken from their paths."""
    files = (
        lake.spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", PART_FILES)
        .option("recursiveFileLookup", "true")
        .load(f"{lake.base}/{zone}")
    )
    run_date = F.regexp_extract("path", r"/runDate=(\d{4}-\d{2}-\d{2})/", 1)
    return files.select(run_date.alias("runDate")).where(F.col("runDate") != "")


def follow_drops(lake: Lake, checkpoint: str, zone: str = "raw", **options) -> StreamingQuery:
    """Run every date that received files since the last call, oldest first, then stop.

    A micro-batch only names run dates; each date is run whole from its folder, and runs are repeatable, so a batch
    that is delivered again changes nothing.
    """

    def run_batch(batch: DataFrame, _batch_id: int) -> None:
        for row in batch.distinct().orderBy("runDate").collect():
            run_day(lake, row["runDate"], **options)

    return (
        new_run_dates(lake, zone)
        .writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
