"""Keyed tables in hash buckets of their key: a merge moves the batch to the table, not the table to the batch.

Storage has two levels. A slot, the key's hash modulo a fixed number, is the partition: a merge reads and rewrites only
the slots that its batch falls into. Inside, rows are in Spark buckets of the same key, sorted: the join of table and
batch takes each bucket as it lies, and only the batch is shuffled. The rewritten slots go to a fresh folder and are then
switched to, as in :mod:`daybook.sources.tables`.

The layout by run (:mod:`daybook.plans.merge`) suits tables that are read by run; this one suits tables that are merged
into every day and read whole or by key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.schemas import Table
from daybook.session import matching_folders, remove_path
from daybook.sources.tables import Lake

SLOT = "_slot"


class KeyedStore:
    """One keyed table of a lake; ``slots`` and ``buckets`` are fixed for its life."""

    def __init__(self, lake: Lake, table: Table, slots: int = 64, buckets: int = 64):
        self.lake, self.spark, self.table, self.slots, self.buckets = lake, lake.spark, table, slots, buckets
        self.key, self.columns = list(table.key), table.columns
        self.name = f"`{lake.database}`.`{table.name}_by_key`"
        self.path = f"{lake.base}/{table.zone}/{table.folder}_by_key"

    def create(self) -> KeyedStore:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.table.schema)
        key = ", ".join(f"`{k}`" for k in self.key)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, `{SLOT}` int) USING parquet PARTITIONED BY (`{SLOT}`) "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.columns)

    def slot(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.slots)).cast("int")

    def merged(self, rows: DataFrame, slots: list[int]) -> DataFrame:
        """The slots after the merge: one full outer join by key, in which a row of the batch replaces the table's."""
        target = self.spark.table(self.name).where(F.col(SLOT).isin(slots)).alias("t")
        batch = rows.withColumn("_new", F.lit(True)).alias("s")
        same_key = F.lit(True)
        for k in self.key:
            same_key = same_key & (F.col(f"t.{k}") == F.col(f"s.{k}"))
        both = target.join(batch, same_key, "full_outer")
        return both.select(*[F.when(F.col("s._new"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in (*self.columns, SLOT)])

    def merge(self, batch: DataFrame) -> int:
        """Upsert ``batch`` (one row per key, no NULL in it) and return how many slots were rewritten."""
        types = {f.name: f.dataType for f in self.table.schema}
        typed = batch.select(*[F.col(c).cast(types[c]).alias(c) for c in self.columns]).withColumn(SLOT, self.slot())
        with self.lake.staged(typed, f"{self.table.name}_by_key") as rows:
            touched = sorted(r[SLOT] for r in rows.select(SLOT).distinct().collect())
            if touched:
                self._replace(self.merged(rows, touched), touched)
        return len(touched)

    def _replace(self, rows: DataFrame, slots: list[int]) -> None:
        fresh, written = f"{self.path}/w={uuid.uuid4().hex}", f"`{self.lake.database}`.`fresh_{uuid.uuid4().hex}`"
        # Tasks hold a bucket each: rows are sorted where they are, and every slot gets one file per bucket.
        writer = rows.write.format("parquet").partitionBy(SLOT).bucketBy(self.buckets, *self.key).sortBy(*self.key)
        try:
            writer.option("path", fresh).saveAsTable(written)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {written}")
        for slot in slots:
            place, folder = f"PARTITION (`{SLOT}` = {slot})", f"{fresh}/{SLOT}={slot}"
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {place} LOCATION '{folder}'")
            self.spark.sql(f"ALTER TABLE {self.name} {place} SET LOCATION '{folder}'")
        for slot in slots:
            for path in matching_folders(self.spark, f"{self.path}/w=*/{SLOT}={slot}"):
                if not path.endswith(f"{fresh.removeprefix(self.path)}/{SLOT}={slot}"):
                    remove_path(self.spark, path)
        for folder in matching_folders(self.spark, f"{self.path}/w=*"):
            if not matching_folders(self.spark, f"{folder}/{SLOT}=*"):
                remove_path(self.spark, folder)
