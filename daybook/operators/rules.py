"""Declarative validation rules and the quarantine split."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import NamedTuple, Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.typing import read_as


class Rule(Protocol):
    def holds(self) -> Column:
        """True where the row satisfies the rule, FALSE or NULL elsewhere."""
        ...

    def broken(self) -> Column:
        """True where the row breaks the rule, NULL only where :meth:`undecided` is true."""
        ...

    def undecided(self) -> Column | None:
        """True where the rule cannot be decided; None if it always can."""
        ...


@dataclass(frozen=True)
class Present:
    column: str

    def holds(self) -> Column:
        return F.col(self.column).isNotNull()

    def broken(self) -> Column:
        return F.col(self.column).isNull()

    def undecided(self) -> None:
        return None


@dataclass(frozen=True)
class Readable:
    """Text, if present, must read as the type."""

    column: str
    sql_type: str

    def holds(self) -> Column:
        return F.col(self.column).isNull() | read_as(self.column, self.sql_type).isNotNull()

    def broken(self) -> Column:
        return F.col(self.column).isNotNull() & read_as(self.column, self.sql_type).isNull()

    def undecided(self) -> None:
        return None


@dataclass(frozen=True)
class Number:
    """The value must be there, read as a number, and not be below the bound (nor equal to it if ``exclusive``).

    NaN passes: Spark orders it above every number. ``text`` columns are parsed once for all three conditions; on typed
    columns the conditions stay simple comparisons, which Parquet scans use to skip row groups.
    """

    column: str
    bound: float
    exclusive: bool = False
    text: bool = False

    def holds(self) -> Column:
        value = read_as(self.column, "double") if self.text else F.col(self.column)
        return value > self.bound if self.exclusive else value >= self.bound

    def broken(self) -> Column:
        if self.text:
            return ~F.coalesce(self.holds(), F.lit(False))
        value = F.col(self.column)
        return value.isNull() | (value <= self.bound if self.exclusive else value < self.bound)

    def undecided(self) -> None:
        return None


@dataclass(frozen=True)
class HasLength:
    """The text must have this many characters; nothing can be said about a missing one."""

    column: str
    length: int

    def holds(self) -> Column:
        return F.length(self.column) == self.length

    def broken(self) -> Column:
        return F.length(self.column) != self.length

    def undecided(self) -> Column:
        return F.col(self.column).isNull()


class Split(NamedTuple):
    valid: DataFrame
    rejects: DataFrame


@dataclass(frozen=True)
class RuleSet:
    """Rules that must all hold, and the reason stamped on rows that break one.

    A row is valid when every rule is decided and none is broken, rejected when any is broken, and undecided when a
    rule is NULL and none is broken. Undecided rows are neither ``TRUE`` nor ``FALSE`` for a filter and would vanish
    from both sides of a plain split; they are rejected here under ``undecided_reason``.
    """

    reason: str
    rules: tuple[Rule, ...]
    undecided_reason: str

    def holds(self) -> Column:
        """True for valid rows, FALSE or NULL for all others."""
        return reduce(and_, (rule.holds() for rule in self.rules))

    def broken(self) -> Column:
        return reduce(or_, (rule.broken() for rule in self.rules))

    def rejected(self, *, undecided: bool = True) -> Column:
        """Broken, or undecided as well. Never hidden in a function call, so that scans can use it."""
        doubts = [d for d in (rule.undecided() for rule in self.rules) if d is not None] if undecided else []
        return reduce(or_, doubts, self.broken())

    def valid(self, df: DataFrame) -> DataFrame:
        return df.where(self.holds())

    def rejects(self, df: DataFrame, *, undecided: bool = True) -> DataFrame:
        """Rows on the other side, with reason and time. ``undecided=False`` leaves undecided rows out."""
        reason = F.when(self.broken(), F.lit(self.reason)).otherwise(F.lit(self.undecided_reason))
        return df.where(self.rejected(undecided=undecided)).withColumns(
            {"reject_reason": reason, "rejected_at": F.current_timestamp()}
        )

    def split(self, df: DataFrame, *, undecided: bool = True) -> Split:
        return Split(self.valid(df), self.rejects(df, undecided=undecided))


# Records that do not have the header's number of fields.
MALFORMED_REASON = {
    "policies": "POLICY_MALFORMED_RECORD",
    "policyholders": "POLICYHOLDER_MALFORMED_RECORD",
    "payments": "PAYMENT_MALFORMED_RECORD",
}

# The reasons below, as they stand in quarantine. Raw text rules: keys are there, values read as their types.
BRONZE_RULES = {
    "policies": RuleSet(
        "POLICY_BASIC_VALIDATION_FAILED",
        (Present("policy_id"), Readable("effective_date", "date"), Number("written_premium", 0.0, text=True)),
        "POLICY_BASIC_VALIDATION_UNKNOWN",
    ),
    "policyholders": RuleSet(
        "POLICYHOLDER_BASIC_VALIDATION_FAILED",
        (Present("holder_id"), Present("policy_id")),
        "POLICYHOLDER_BASIC_VALIDATION_UNKNOWN",
    ),
    "payments": RuleSet(
        "PAYMENT_BASIC_VALIDATION_FAILED",
        (Present("payment_id"), Readable("payment_date", "date"), Number("amount", 0.0, exclusive=True, text=True)),
        "PAYMENT_BASIC_VALIDATION_UNKNOWN",
    ),
}

# Business rules on typed rows, stricter than the raw ones.
SILVER_RULES = {
    "policies": RuleSet(
        "POLICY_SILVER_RULES_FAILED",
        (Present("policy_id"), Present("effective_date"), Number("written_premium", 0.0, exclusive=True), HasLength("state", 2)),
        "POLICY_SILVER_RULES_UNKNOWN",
    ),
    "policyholders": RuleSet(
        "POLICYHOLDER_SILVER_RULES_FAILED",
        (Present("holder_id"), Present("policy_id"), Present("full_name")),
        "POLICYHOLDER_SILVER_RULES_UNKNOWN",
    ),
    "payments": RuleSet(
        "PAYMENT_SILVER_RULES_FAILED",
        (Present("payment_id"), Present("policy_id"), Present("payment_date"), Number("amount", 0.0, exclusive=True)),
        "PAYMENT_SILVER_RULES_UNKNOWN",
    ),
}
