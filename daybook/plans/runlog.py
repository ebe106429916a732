"""Run log rows and alert records."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.runs import FAILED, SUCCESS, recent, run_status
from daybook.plans.counts import Counts
from daybook.schemas import LOG_TABLE, TABLES
from daybook.sources.alerts import write_alerts
from daybook.sources.tables import Lake

RUN_NAME = "daily_batch"


def logged(lake: Lake, layer: str, run_date: str, steps: Mapping[str, Callable[[], Counts]], at_once: int = 1) -> None:
    """Do the steps of a layer and append their log rows, one write for all of them.

    In order, the first failure is logged with its message and stops the rest. With ``at_once`` above 1 the steps, which
    work on tables of their own, run side by side; all of them finish and are logged. The first failure is raised again.
    """

    def attempt(step: tuple[str, Callable[[], Counts]]) -> tuple[tuple, Exception | None]:
        entity, work = step
        started, counts, error = datetime.now(timezone.utc), Counts(), None
        try:
            counts = work()
        except Exception as e:
            error = e
        ended = datetime.now(timezone.utc)
        state = (SUCCESS, *counts, int((ended - started).total_seconds()), "") if error is None else (FAILED, *counts, int((ended - started).total_seconds()), str(error))
        return (RUN_NAME, layer, entity, run_date, *state, started, ended), error

    done: list[tuple[tuple, Exception | None]] = []
    if at_once > 1:
        with ThreadPoolExecutor(at_once) as pool:
            done.extend(pool.map(attempt, steps.items()))
    else:
        for step in steps.items():
            done.append(attempt(step))
            if done[-1][1] is not None:
                break
    if done:
        lake.append(LOG_TABLE, lake.spark.createDataFrame([row for row, _ in done], TABLES[LOG_TABLE].schema).coalesce(1))
    for _, error in done:
        if error is not None:
            raise error


def recent_log(lake: Lake, k: int = 20) -> DataFrame:
    return recent(lake.read(LOG_TABLE), k, F.col("ended_at").desc())


def write_run_alert(
    lake: Lake, run_date: str, environment: str = "dev", export_csv: str = "", since: datetime | None = None
) -> None:
    """Derive the status of a run, or of its attempt ``since`` a time, from the log and store it as one JSON document."""
    log = lake.read(LOG_TABLE).where(F.col("runDate") == run_date)
    attempt = None
    if since is not None:
        log = log.where(F.col("started_at") >= F.lit(since))
        attempt = since.strftime("%Y%m%dT%H%M%S%fZ")
    write_alerts(run_status(log, environment, export_csv, attempt), f"{lake.base}/logs/alerts")
