"""Order-independent sums over DOUBLE money columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All digits that a double below 1e18 shows, and headroom to add whole parts and fractions apart without overflow.
EXACT = "decimal(36,18)"
WHOLE = "decimal(18,0)"


def _exact(column: str) -> Column:
    """The value as a decimal, if that is the same number; else NULL."""
    value = F.col(column).try_cast(EXACT)
    return F.when(value.cast("double") == F.col(column), value)


def parts(column: str) -> dict[str, Column]:
    """Columns whose sums make the total, under names that :func:`total` knows.

    ``_whole`` and ``_rest`` add up to the value; ``_inexact`` has what no decimal holds (NaN, infinities, from 1e18 on,
    beyond 18 fraction digits).
    """
    exact = _exact(column)
    whole = F.floor(exact).cast(WHOLE)
    return {"_whole": whole, "_rest": exact - whole, "_inexact": F.when(exact.isNull(), F.col(column))}


def total(whole: Column, rest: Column, inexact: Column) -> Column:
    """The total as DOUBLE from the sums of the parts; NULL if all of them are."""
    wide = "decimal(38,18)"
    # Beyond what one decimal holds, the fraction is below the precision of a double.
    exact = F.coalesce((whole.try_cast("decimal(20,0)") + rest).try_cast(wide).cast("double"), whole.cast("double") + rest.cast("double"))
    return F.when(inexact.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + inexact)


def exact_sum(column: str) -> Column:
    """Sum of a DOUBLE column that does not depend on row order, hence not on partitioning or retries.

    Values are added as decimals with all their digits; what a decimal cannot hold is added as DOUBLE next to it, so
    nothing is lost and nothing throws. NULL only if every value is NULL.
    """
    return total(*[F.sum(part) for part in parts(column).values()])
