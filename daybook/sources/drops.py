"""Daily file drops: delimited text, one folder per entity and run date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daybook.operators.checks import require_columns
from daybook.schemas import RUN, Entity
from daybook.session import matching_folders

# The dialect of landing and raw files.
DIALECT = {"sep": ",", "quote": '"', "escape": "\\", "header": "true"}
PART_FILES = "part-*.csv"

# The CSV writer trims values unless told otherwise; a copy must not.
UNTRIMMED = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# The whole record, where it does not have as many fields as the header; else NULL.
MALFORMED = "_malformed"
# Folder beside a copy's part files; readers of the drop pass over names with an underscore.
ASIDE = "_malformed"
ASIDE_RECORD = "record string, _sourceFile string"


def drop_path(base: str, entity: str, run_date: str) -> str:
    return f"{base}/{entity}/runDate={run_date}"


def read_text(
    spark: SparkSession, path: str, *, part_files_only: bool = False, malformed: bool = False, multi_line: bool = True
) -> DataFrame:
    """A folder of delimited files as text columns named by the header; empty values are NULL.

    The names come from the first file. Every file is then held to them (``enforceSchema`` off), so a file with other
    or re-ordered columns fails the read and cannot shift values. ``part_files_only`` takes the part files of all
    sub-folders and no partition columns from folder names. ``malformed`` adds a column with the whole record where it
    has more or fewer fields than the header.

    Quoted values may hold line breaks. Spark then reads a file in one task, and drops come in many part files;
    ``multi_line=False`` splits files, for drops known to have no such values. A record with one is then two malformed
    ones.
    """
    options = DIALECT | ({"pathGlobFilter": PART_FILES, "recursiveFileLookup": "true"} if part_files_only else {})
    options |= {"multiLine": str(multi_line).lower()}
    names = spark.read.options(**options).csv(path).columns
    schema = StructType([StructField(n, StringType()) for n in names])
    if malformed:
        # Fields are counted only if no column is pruned away.
        options |= {"columnNameOfCorruptRecord": MALFORMED, "columnPruning": "false"}
        schema = StructType([*schema, StructField(MALFORMED, StringType())])
    return spark.read.schema(schema).options(**options, enforceSchema="false").csv(path)


def read_drop(spark: SparkSession, path: str, entity: Entity, run_date: str, *, multi_line: bool = True) -> DataFrame:
    """One entity's drop for one run as text, with the file each row came from and the run that loads it.

    The run date column inside the file is data and may differ from the run that loads it. A record with too many or too
    few fields stands whole in the last column; what fields it has are in the others. Records that :func:`copy_drop` laid
    aside are among them.
    """
    rows = require_columns(read_text(spark, path, malformed=True, multi_line=multi_line), entity.columns)
    rows = rows.select(*entity.columns, F.col("_metadata.file_path").alias("_sourceFile"), MALFORMED)
    if matching_folders(spark, f"{path}/{ASIDE}"):
        aside = spark.read.schema(ASIDE_RECORD).json(f"{path}/{ASIDE}")
        none = [F.lit(None).cast("string").alias(c) for c in entity.columns]
        rows = rows.unionByName(aside.select(*none, "_sourceFile", F.col("record").alias(MALFORMED)))
    return rows.select(*entity.columns, "_sourceFile", F.lit(run_date).alias(RUN), MALFORMED)


def copy_drop(spark: SparkSession, source: str, target: str, *, multi_line: bool = True) -> int:
    """Landing to raw: same rows and columns, every field quoted. A rerun replaces the copy. Returns the records read.

    Records with too many or too few fields do not fit the columns. They are laid aside whole, in a folder beside the
    copy's files, where :func:`read_drop` finds them. Only a drop that has some is read a second time.
    """
    seen = Observation()
    rows = read_text(spark, source, part_files_only=True, malformed=True, multi_line=multi_line)
    counted = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.count(MALFORMED).alias("malformed"))
    fitting = counted.where(F.col(MALFORMED).isNull()).drop(MALFORMED)
    fitting.write.mode("overwrite").options(**DIALECT, **UNTRIMMED, quoteAll="true").csv(target)
    if seen.get["malformed"]:
        # The fields go along: Spark reads no drop for its broken records alone.
        fields = F.to_json(F.struct(*[c for c in rows.columns if c != MALFORMED]))
        aside = rows.where(F.col(MALFORMED).isNotNull()).select(
            F.col(MALFORMED).alias("record"), F.col("_metadata.file_path").alias("_sourceFile"), fields.alias("fields")
        )
        aside.write.mode("overwrite").json(f"{target}/{ASIDE}")
    return seen.get["n"]


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV snapshot with header, replacing the folder: as many files as there are tasks, or one that a single task writes."""
    out = df.coalesce(1) if one_file else df
    out.write.mode("overwrite").options(**DIALECT, **UNTRIMMED).csv(path)


def write_drop(df: DataFrame, base: str, entity: str, run_date: str, one_file: bool = False) -> None:
    write_csv(df, drop_path(base, entity, run_date), one_file)
