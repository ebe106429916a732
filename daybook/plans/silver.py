"""Typed rows to clean, keyed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions.typing import as_text
from daybook.operators.dedupe import one_per_run_key
from daybook.operators.rules import SILVER_RULES
from daybook.plans.counts import Counts
from daybook.plans.merge import merge_run
from daybook.schemas import Entity
from daybook.sources.tables import Lake


def load_silver(
    lake: Lake, entity: Entity, run_date: str, *, undecided: bool = True, keep_newer: bool = False
) -> Counts:
    """Validate one run's rows, quarantine what fails, merge the rest by business key.

    ``rows valid`` counts after one row per key is kept. ``undecided=False`` drops rows whose rules are NULL instead of
    quarantining them. ``keep_newer`` protects rows that a later run has already written.
    """
    rules = SILVER_RULES[entity.name]
    bronze = lake.read_run(entity.bronze, run_date)

    # Rules that are plain comparisons let this scan skip row groups without a broken row.
    rejects = as_text(rules.rejects(bronze, undecided=undecided), entity.conversions)
    lake.replace_partition(entity.silver_rejects, rejects.hint("rebalance"), run_date)
    rejected = lake.read_run(entity.silver_rejects, run_date).count()
    if not rejected:
        lake.clear_partition(entity.silver_rejects, run_date)

    valid = one_per_run_key(rules.valid(bronze), entity).withColumn("_loaded_at", F.current_timestamp())
    merged = merge_run(lake, entity.silver, valid, run_date, keep_newer=keep_newer)
    # Counts of stored rows come from file footers.
    return Counts(bronze.count(), merged, rejected)
