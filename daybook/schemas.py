"""Entities and tables: column lists, keys and partition columns in one place.

Everything that needs a column list (CSV check, DDL, writers, rules) derives it from here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Business columns of the three daily entities, in file order.
POLICIES = "policy_id string, product string, state string, effective_date date, written_premium double, status string, runDate string"
POLICYHOLDERS = "holder_id string, policy_id string, full_name string, address string, city string, state string, zip string, runDate string"
PAYMENTS = "payment_id string, policy_id string, amount double, payment_date date, method string, runDate string"

# Columns the layers add.
LINEAGE = "_sourceFile string, _runDate string"
REJECTION = "reject_reason string, rejected_at timestamp"
LOADED = "_loaded_at timestamp"
# Columns of the change history and of the daily aggregates, in table order.
HISTORY = (
    "holder_id string, policy_id string, full_name string, address string, city string, state string, zip string, "
    "attr_hash string, effective_start_date string, effective_end_date string, is_current boolean, "
    "runDate string, _sourceFile string, _runDate string, _loaded_at timestamp"
)
WRITTEN_PREMIUM = (
    "day date, state string, product string, written_premium double, policy_count bigint, _runDate string, _loaded_at timestamp"
)
PAYMENTS_DAILY = "day date, payments_total double, payment_count bigint, _runDate string, _loaded_at timestamp"
ACTIVE_POLICIES = "day date, active_policies bigint, cancelled_policies bigint, _runDate string, _loaded_at timestamp"
RUN_LOG = (
    "pipeline_name string, layer string, entity string, runDate string, status string, rows_read bigint, "
    "rows_valid bigint, rows_rejected bigint, duration_sec int, message string, started_at timestamp, ended_at timestamp"
)
ALERT = (
    "status string, environment string, pipelineName string, runId string, triggerTimeUtc string, runDate string, "
    "exportCsv string, activityName string, errorCode string, errorMessage string"
)

RUN = "_runDate"
OPEN_END = "9999-12-31"


_TYPES = {
    t.simpleString(): t
    for t in (StringType(), DateType(), DoubleType(), LongType(), IntegerType(), BooleanType(), TimestampType())
}


def struct(columns: str) -> StructType:
    """``name type, ...`` as a schema; unlike ``StructType.fromDDL`` it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[sql_type]) for name, sql_type in pairs])


def as_strings(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in schema])


@dataclass(frozen=True)
class Entity:
    """One daily file: its typed columns, its business key and how a duplicate is chosen."""

    name: str
    ddl: str
    key: tuple[str, ...]
    prefer_largest: tuple[str, ...] = ()
    current_table: str = ""
    tracked: tuple[str, ...] = ()

    @property
    def typed(self) -> StructType:
        return struct(self.ddl)

    @property
    def text(self) -> StructType:
        return as_strings(self.typed)

    @property
    def columns(self) -> list[str]:
        return self.typed.names

    @property
    def conversions(self) -> dict[str, str]:
        """Columns that are not text, with their SQL type."""
        return {f.name: f.dataType.simpleString() for f in self.typed if not isinstance(f.dataType, StringType)}

    @property
    def bronze(self) -> str:
        return f"bronze_{self.name}"

    @property
    def bronze_rejects(self) -> str:
        return f"rejects_{self.name}"

    @property
    def silver(self) -> str:
        return self.current_table or f"silver_{self.name}"

    @property
    def silver_rejects(self) -> str:
        return f"rejects_silver_{self.name}"


ENTITIES = {
    e.name: e
    for e in (
        Entity("policies", POLICIES, key=("policy_id", "effective_date"), prefer_largest=("written_premium",)),
        Entity(
            "policyholders",
            POLICYHOLDERS,
            key=("holder_id", "policy_id"),
            current_table="silver_policyholders_current",
            tracked=("full_name", "address", "city", "state", "zip"),
        ),
        Entity("payments", PAYMENTS, key=("payment_id",), prefer_largest=("payment_date", "amount")),
    )
}


@dataclass(frozen=True)
class Table:
    """One stored table; ``key`` is logical, ``partition`` is the storage layout."""

    name: str
    zone: str
    folder: str
    schema: StructType = field(hash=False)
    key: tuple[str, ...] = ()
    partition: str | None = RUN

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def storage_columns(self) -> list[str]:
        """Spark keeps the partition column last; positional inserts follow this order."""
        return [c for c in self.columns if c != self.partition] + ([self.partition] if self.partition else [])


def _entity_tables(e: Entity) -> list[Table]:
    typed = struct(f"{e.ddl}, {LINEAGE}")
    rejected = StructType(list(e.text) + list(struct(f"{LINEAGE}, {REJECTION}")))
    silver_folder = e.silver.removeprefix("silver_")
    return [
        Table(e.bronze, "bronze", e.name, typed),
        Table(e.bronze_rejects, "rejects", e.name, rejected),
        Table(e.silver, "silver", silver_folder, StructType(list(typed) + list(struct(LOADED))), key=e.key),
        Table(e.silver_rejects, "rejects", f"silver/{e.name}", rejected),
    ]


_holder = ENTITIES["policyholders"]
HISTORY_TABLE = "silver_policyholders_scd2"
LOG_TABLE = "ops_pipeline_run_log"

TABLES = {
    t.name: t
    for t in [
        *(t for e in ENTITIES.values() for t in _entity_tables(e)),
        Table(
            HISTORY_TABLE,
            "silver",
            "policyholders_scd2",
            struct(HISTORY),
            key=(*_holder.key, "effective_start_date"),
            partition="effective_end_date",
        ),
        Table(
            "gold_written_premium_daily",
            "gold",
            "written_premium_daily",
            struct(WRITTEN_PREMIUM),
            key=("day", "state", "product", RUN),
        ),
        Table(
            "gold_payments_daily",
            "gold",
            "payments_daily",
            struct(PAYMENTS_DAILY),
            key=("day", RUN),
        ),
        Table(
            "gold_active_policies_daily",
            "gold",
            "active_policies_daily",
            struct(ACTIVE_POLICIES),
            key=("day", RUN),
        ),
        Table(LOG_TABLE, "logs", "pipeline_run_log", struct(RUN_LOG), partition=None),
    ]
}
