"""One run date end to end, and catching up over several."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import partial

from pyspark.sql import functions as F

from daybook.operators.runs import SUCCESS, mark, run_plan
from daybook.plans.bronze import load_bronze
from daybook.plans.counts import Counts
from daybook.plans.gold import AGGREGATES, export_gold, load_gold
from daybook.plans.history import load_history
from daybook.plans.runlog import logged, write_run_alert
from daybook.plans.silver import load_silver
from daybook.schemas import ENTITIES, LOG_TABLE
from daybook.sources.drops import copy_drop
from daybook.sources.tables import Lake, checked_run_date

# Texts that switch the export on.
TRUE_TEXTS = ("true", "1", "yes", "y")


def is_true(value: str | bool) -> bool:
    return value if isinstance(value, bool) else value.strip().lower() in TRUE_TEXTS


def copy_landing(lake: Lake, entity: str, run_date: str) -> Counts:
    n_rows = copy_drop(lake.spark, lake.drop_path("landing", entity, run_date), lake.drop_path("raw", entity, run_date))
    return Counts(n_rows, n_rows, 0)


def run_day(
    lake: Lake,
    run_date: str,
    export_csv: str | bool = False,
    *,
    from_landing: bool = False,
    bronze_mode: str = "replace",
    environment: str = "dev",
    keep_newer: bool | None = None,
    allow_backdated: bool = False,
    at_once: int = 1,
) -> None:
    """Raw to bronze, silver, history and gold for one run date, in order; safe to repeat.

    Every step logs its counts; the first failure stops the rest. The alert record of the attempt is written on success
    and on failure. ``at_once`` steps of a layer run side by side. A date older than one whose clean rows are loaded comes late: it fills in what is missing, and clean
    rows that a later run wrote stay as they are; ``keep_newer=False`` overwrites them, as a plain merge does.
    """
    run_date = checked_run_date(run_date)
    export = is_true(export_csv)
    began = datetime.now(timezone.utc)
    if keep_newer is None:
        keep_newer = is_late(lake, run_date)

    def layer(name: str, steps: dict[str, Callable[[], Counts]]) -> None:
        logged(lake, name, run_date, steps, at_once)

    def alert() -> None:
        write_run_alert(lake, run_date, environment, "true" if export else "false", since=began)

    try:
        if from_landing:
            layer("raw", {name: partial(copy_landing, lake, name, run_date) for name in ENTITIES})
        layer("bronze", {name: partial(load_bronze, lake, e, run_date, bronze_mode) for name, e in ENTITIES.items()})
        layer("silver", {name: partial(load_silver, lake, e, run_date, keep_newer=keep_newer) for name, e in ENTITIES.items()})
        layer("history", {"policyholders": partial(load_history, lake, run_date, allow_backdated=allow_backdated)})
        layer("gold", {a.export_name: partial(load_gold, lake, a, run_date) for a in AGGREGATES})
        if export:
            layer("gold", {f"{a.export_name}_csv": partial(export_gold, lake, a, run_date) for a in AGGREGATES})
    except Exception as error:
        try:
            alert()
        except Exception as second:
            error.add_note(f"the alert record could not be written: {second}")
        raise
    alert()


def is_late(lake: Lake, run_date: str) -> bool:
    """Whether clean rows of a later run date have been loaded."""
    later = (F.col("layer") == "silver") & (F.col("status") == SUCCESS) & (F.col("runDate") > run_date)
    return not lake.read(LOG_TABLE).where(later).isEmpty()


def pending_runs(lake: Lake, last: str, today: str | None = None) -> list[str]:
    """Run dates after ``last`` up to today without a completed run; a handful of strings."""
    start = F.lit(checked_run_date(last)).cast("date")
    end = F.lit(checked_run_date(today or date.today().isoformat())).cast("date")
    steps = [a.export_name for a in AGGREGATES]
    return [r["runDate"] for r in run_plan(lake.read(LOG_TABLE), start, end, "gold", steps).collect()]


def completed_mark(lake: Lake, first: str, today: str | None = None) -> str:
    """The last run date before the first gap since ``first``: up to there every date is completed."""
    start, end = (F.lit(checked_run_date(d)).cast("date") for d in (first, today or date.today().isoformat()))
    steps = [a.export_name for a in AGGREGATES]
    return mark(lake.read(LOG_TABLE), start, end, "gold", steps).first()["mark"]


def run_range(lake: Lake, last: str, today: str | None = None, export_csv: str | bool = False, **options) -> list[str]:
    """Catch up: every pending run date, oldest first. The run log is the mark, so a crash resumes where it stopped.

    A date older than one already loaded comes late, see :func:`run_day`.
    """
    todo = pending_runs(lake, last, today)
    for run_date in todo:
        run_day(lake, run_date, export_csv, **options)
    return todo
