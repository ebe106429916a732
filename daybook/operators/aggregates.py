"""Daily aggregates over the clean tables.

``by`` names further grouping columns; the default keeps runs apart, ``by=()`` is the full refresh over all runs. For one
run, filter the input first: the run column is then constant and the same plan answers it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.money import exact_sum
from daybook.schemas import RUN

# The status texts that count, and below the grouping columns and output names of the aggregates.
ACTIVE, CANCELLED = "Active", "Cancelled"


def written_premium_daily(policies: DataFrame, by: Sequence[str] = (RUN,)) -> DataFrame:
    """Premium and number of distinct policies per effective date, state and product.

    Spark spreads the distinct count over (group, policy) before it combines groups, so a hot group is not one task.
    """
    groups = (F.col("effective_date").alias("day"), "state", "product", *by)
    return policies.groupBy(*groups).agg(
        exact_sum("written_premium").alias("written_premium"),
        F.count_distinct(F.col("policy_id")).alias("policy_count"),
    )


def payments_daily(payments: DataFrame, by: Sequence[str] = (RUN,)) -> DataFrame:
    return payments.groupBy(F.col("payment_date").alias("day"), *by).agg(
        exact_sum("amount").alias("payments_total"), F.count(F.lit(1)).alias("payment_count")
    )


def active_policies_daily(policies: DataFrame, by: Sequence[str] = (RUN,)) -> DataFrame:
    """Active and cancelled policies per effective date; any other status counts in neither. Case matters."""
    return policies.groupBy(F.col("effective_date").alias("day"), *by).agg(
        F.count_if(F.col("status") == ACTIVE).alias("active_policies"),
        F.count_if(F.col("status") == CANCELLED).alias("cancelled_policies"),
    )
