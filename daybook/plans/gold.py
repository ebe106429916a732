"""Clean tables to daily aggregates, and their CSV snapshots."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.aggregates import active_policies_daily, payments_daily, written_premium_daily
from daybook.plans.counts import Counts
from daybook.schemas import TABLES
from daybook.sources.drops import write_csv
from daybook.sources.tables import Lake


@dataclass(frozen=True)
class Aggregate:
    table: str
    source: str
    compute: Callable[..., DataFrame]

    @property
    def export_name(self) -> str:
        return TABLES[self.table].folder


AGGREGATES = (
    Aggregate("gold_written_premium_daily", "silver_policies", written_premium_daily),
    Aggregate("gold_payments_daily", "silver_payments", payments_daily),
    Aggregate("gold_active_policies_daily", "silver_policies", active_policies_daily),
)


def load_gold(lake: Lake, aggregate: Aggregate, run_date: str) -> Counts:
    """Replace one run of one aggregate; an empty result clears the run."""
    slice_ = lake.read_run(aggregate.source, run_date)
    result = aggregate.compute(slice_).withColumn("_loaded_at", F.current_timestamp())
    lake.replace_partition(aggregate.table, result, run_date)
    # Both counts read file footers only.
    return Counts(slice_.count(), lake.read_run(aggregate.table, run_date).count(), 0)


def full_refresh(lake: Lake, aggregate: Aggregate) -> DataFrame:
    """The aggregate over all runs together, not stored."""
    return aggregate.compute(lake.read(aggregate.source), by=())


def export_gold(lake: Lake, aggregate: Aggregate, run_date: str, one_file: bool = True) -> Counts:
    """CSV snapshot of one stored run: the stored rows are read back, the aggregate is not computed again.

    One file, written by one task, is what readers of a day's aggregates expect; ``one_file=False`` writes in parallel.
    """
    rows = lake.read_run(aggregate.table, run_date)
    write_csv(rows, lake.export_path(run_date, aggregate.export_name), one_file)
    n_rows = rows.count()
    return Counts(n_rows, n_rows, 0)
