"""Lake tables: external Parquet tables in the session catalog, replaced by partition.

Spark refuses ``MERGE`` and ``DELETE`` on Parquet tables, so the only mutations here are append, replace one partition,
replace the partitions present in a result, and clear. A replacement is written whole into a folder of its own,
``<table>/w=<id>/<partition>=<value>``; then the catalog entry of the partition is pointed at it, and only after that the
old files go. A job that dies before the switch leaves the old rows as they were; what it wrote is swept away by the next
replacement of that partition. Tasks may be retried freely. One writer at a time is assumed, as one run follows another.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.schemas import TABLES, Table
from daybook.session import make_folder, matching_folders, remove_path, session_setting, write_scratch
from daybook.sources.drops import drop_path

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def checked_run_date(value: str) -> str:
    """The run date, trimmed, if it is an ISO date. It ends up in paths and partition specifications."""
    value = (value or "").strip()
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
        raise ValueError(f"run date is required as YYYY-MM-DD, got {value!r}")
    date.fromisoformat(value)
    return value


def checked_partition(value: str) -> str:
    """A partition value that can stand in a path and in SQL as it is: dates and plain names."""
    if not re.fullmatch(r"[A-Za-z0-9_.\-]+", value or ""):
        raise ValueError(f"not a plain partition value: {value!r}")
    return value


class Lake:
    """All zones under one base folder, and the tables of one database."""

    def __init__(self, spark: SparkSession, base: str, database: str = "default"):
        self.spark = spark
        self.base = base.rstrip("/")
        self.database = database

    # Names and places

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def table_path(self, table: str) -> str:
        spec = TABLES[table]
        return f"{self.base}/{spec.zone}/{spec.folder}"

    def drop_path(self, zone: str, entity: str, run_date: str) -> str:
        return drop_path(f"{self.base}/{zone}", entity, run_date)

    def export_path(self, run_date: str, name: str) -> str:
        return f"{self.base}/gold_csv_exports/runDate={run_date}/{name}"

    def malformed_path(self, entity: str, run_date: str) -> str:
        return f"{self.base}/rejects/malformed/{entity}/runDate={run_date}"

    # Definition

    def create(self, tables: Iterable[str] = tuple(TABLES)) -> Lake:
        """Create what is missing. A table found on storage but new to the catalog gets its partitions registered."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.base}/tables'")
        for table in (TABLES[t] for t in tables):
            if not self.spark.catalog.tableExists(f"{self.database}.{table.name}"):
                found = not make_folder(self.spark, self.table_path(table.name))
                self.spark.sql(self.ddl(table))
                if found and table.partition:
                    for value, folder in self.folders(table.name).items():
                        self._point(table.name, value, folder)
        return self

    def ddl(self, table: Table) -> str:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
        partitioned = f" PARTITIONED BY (`{table.partition}`)" if table.partition else ""
        return (
            f"CREATE TABLE IF NOT EXISTS {self.name(table.name)} ({columns}) USING parquet{partitioned} "
            f"LOCATION '{self.table_path(table.name)}'"
        )

    def list_tables(self) -> DataFrame:
        return self.spark.sql(f"SHOW TABLES IN `{self.database}`")

    def describe(self, table: str) -> DataFrame:
        return self.spark.sql(f"DESCRIBE TABLE {self.name(table)}")

    def show_create(self, table: str) -> DataFrame:
        return self.spark.sql(f"SHOW CREATE TABLE {self.name(table)}")

    # Reading

    def read(self, table: str) -> DataFrame:
        """The table with its columns in the documented order."""
        return self.spark.table(self.name(table)).select(*TABLES[table].columns)

    def folders(self, table: str) -> dict[str, str]:
        """Where each partition's rows lie, found on storage alone.

        Should a crash have left two folders of one partition, the last one written counts; each holds a whole state.
        """
        leaf, found = f"{TABLES[table].partition}=*", {}
        for path in matching_folders(self.spark, f"{self.table_path(table)}/{{{leaf},w=*/{leaf}}}"):
            found.setdefault(path.rsplit("=", 1)[1], path)
        return dict(sorted(found.items()))

    def read_files(self, table: str) -> DataFrame:
        """The same rows straight from storage, for a reader without the catalog."""
        spec = TABLES[table]
        if not spec.partition:
            return self.spark.read.schema(spec.schema).parquet(self.table_path(table)).select(*spec.columns)
        paths = list(self.folders(table).values())
        if not paths:
            return self._no_rows(table)
        stored = StructType([f for f in spec.schema if f.name != spec.partition])
        value = F.regexp_extract("_metadata.file_path", f"/{spec.partition}=([^/]+)/[^/]+$", 1)
        rows = self.spark.read.schema(stored).option("recursiveFileLookup", "true").parquet(*paths)
        return rows.withColumn(spec.partition, F.when(value != "", value)).select(*spec.columns)

    def read_run(self, table: str, run_date: str) -> DataFrame:
        """One partition of a table that is stored by run: the filter prunes all other folders."""
        return self.read(table).where(F.col(TABLES[table].partition) == run_date)

    # Writing

    def append(self, table: str, df: DataFrame) -> None:
        """Positional append, columns brought into the table's order first."""
        df.select(*TABLES[table].storage_columns).write.mode("append").insertInto(self.name(table))

    def save_by_name(self, table: str, df: DataFrame) -> None:
        """Create the table from the data if it is absent, else append to it, columns matched by name."""
        df.write.mode("append").format("parquet").saveAsTable(self.name(table))

    def replace_partition(self, table: str, df: DataFrame, value: str) -> None:
        """Replace one partition by ``df``, also when ``df`` is empty or computed from the same table."""
        spec = TABLES[table]
        folder = f"{self._fresh(table)}/{spec.partition}={checked_partition(value)}"
        self._typed(table, df).drop(spec.partition).write.parquet(folder)
        self._switch(table, {value: folder})

    def overwrite_partitions(self, table: str, df: DataFrame, first: str | None = None) -> None:
        """Replace exactly the partitions that occur in ``df``, which may be computed from the same table.

        All of them are written before the first is switched; partition ``first`` is switched before the others.
        """
        spec, fresh = TABLES[table], self._fresh(table)
        self._typed(table, df).write.partitionBy(spec.partition).parquet(fresh)
        written = [path.rsplit("=", 1)[1] for path in matching_folders(self.spark, f"{fresh}/{spec.partition}=*")]
        values = sorted(written, key=lambda v: (v != first, v))
        self._switch(table, {v: f"{fresh}/{spec.partition}={checked_partition(v)}" for v in values})

    def clear_partition(self, table: str, value: str) -> None:
        """Delete one partition: its entry in the catalog, then its files."""
        partition = TABLES[table].partition
        self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION (`{partition}` = '{checked_partition(value)}')")
        self._sweep(table, value, keep=None)

    def clear(self, table: str) -> None:
        """Delete all rows. ``TRUNCATE`` is refused on external tables, an empty full overwrite is not."""
        if TABLES[table].partition:
            for row in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect():
                self.clear_partition(table, row[0].split("=", 1)[1])
            return
        with session_setting(self.spark, OVERWRITE_MODE, "static"):
            empty = self._no_rows(table).select(*TABLES[table].storage_columns)
            empty.write.insertInto(self.name(table), overwrite=True)

    def _fresh(self, table: str) -> str:
        return f"{self.table_path(table)}/w={uuid.uuid4().hex}"

    def _typed(self, table: str, df: DataFrame) -> DataFrame:
        """The table's columns with its types, as an insert would cast them."""
        types = {f.name: f.dataType for f in TABLES[table].schema}
        return df.select(*[F.col(c).cast(types[c]).alias(c) for c in TABLES[table].storage_columns])

    def _point(self, table: str, value: str, folder: str) -> None:
        place = f"PARTITION (`{TABLES[table].partition}` = '{checked_partition(value)}')"
        self.spark.sql(f"ALTER TABLE {self.name(table)} ADD IF NOT EXISTS {place} LOCATION '{folder}'")
        self.spark.sql(f"ALTER TABLE {self.name(table)} {place} SET LOCATION '{folder}'")

    def _switch(self, table: str, folders: dict[str, str]) -> None:
        """Point the catalog at new folders, then delete what the partitions had before."""
        for value, folder in folders.items():
            self._point(table, value, folder)
        for value, folder in folders.items():
            self._sweep(table, value, keep=folder)

    def _sweep(self, table: str, value: str, keep: str | None) -> None:
        """Delete a partition's folders but one, among them what a writer that died has left."""
        base, leaf = self.table_path(table), f"{TABLES[table].partition}={value}"
        for path in matching_folders(self.spark, f"{base}/{{{leaf},w=*/{leaf}}}"):
            above = path.rsplit("/", 2)[1]
            if keep is not None and path.endswith(keep.removeprefix(base)):
                continue
            remove_path(self.spark, path)
            if above.startswith("w=") and not matching_folders(self.spark, f"{base}/{above}/*=*"):
                remove_path(self.spark, f"{base}/{above}")

    def _no_rows(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], TABLES[table].schema)

    @contextmanager
    def staged(self, df: DataFrame, label: str) -> Iterator[DataFrame]:
        """Rows written once and read back for the steps in the block, then removed."""
        rows, path = write_scratch(df, label)
        try:
            yield rows
        finally:
            remove_path(self.spark, path)
