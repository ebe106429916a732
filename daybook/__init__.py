"""Daily file drops to validated, keyed, historised and aggregated tables, on plain Spark."""

from daybook.sources.tables import Lake

__all__ = ["Lake"]
