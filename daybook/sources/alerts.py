"""Alert records: one JSON document per attempt of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.schemas import ALERT, struct


def write_alerts(alerts: DataFrame, path: str) -> None:
    """Write records under ``pipeline=<name>/run=<date>/id=<run id>/``; only a record of the same run id is replaced.

    All ten fields stay in the document itself.
    """
    places = {"pipeline": "pipelineName", "run": "runDate", "id": "runId"}
    placed = alerts.select(*struct(ALERT).names, *[F.col(column).alias(place) for place, column in places.items()])
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*places).option("ignoreNullFields", "false").json(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(struct(ALERT)).option("recursiveFileLookup", "true").json(path)
