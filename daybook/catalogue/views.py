"""The three daily entities derived from the star tables, with the faults the rules look for.

Every row of the source tables takes part. Keys, dates and amounts come from the data; a fault replaces the value for
the keys divisible by some prime. The same text runs on Spark and on the checking engine.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.schemas import RUN

POLICIES = """
SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat('P', CAST(o_orderkey AS STRING)) END AS policy_id,
 substr(o_orderpriority, 3) AS product,
 CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 83 = 0 THEN 'TEX' WHEN o_custkey % 5 = 0 THEN 'TX'
  WHEN o_custkey % 5 = 1 THEN 'CA' WHEN o_custkey % 5 = 2 THEN 'FL' WHEN o_custkey % 5 = 3 THEN 'NY' ELSE 'IL' END AS state,
 CASE WHEN o_orderkey % 103 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN 'not-a-date'
  ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS effective_date,
 CASE WHEN o_orderkey % 79 = 0 THEN 'abc' WHEN o_orderkey % 73 = 0 THEN NULL WHEN o_orderkey % 71 = 0 THEN '-1.00'
  WHEN o_orderkey % 67 = 0 THEN '0.00' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS written_premium,
 CASE WHEN o_orderstatus = 'P' THEN 'Cancelled' WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Expired' END AS status,
 concat('2026-02-0', CAST(1 + o_orderkey % 7 AS STRING)) AS runDate
FROM {orders}
"""

# Two snapshots. On the second day every third address differs; some customers leave after day 1, some join on day 2.
POLICYHOLDERS = """
SELECT CASE WHEN c_custkey % 59 = 0 THEN NULL ELSE concat('H', CAST(c_custkey AS STRING)) END AS holder_id,
 concat('P', CAST(c_custkey AS STRING)) AS policy_id,
 CASE WHEN c_custkey % 61 = 0 THEN NULL ELSE c_name END AS full_name,
 CASE WHEN r.d = 2 AND c_custkey % 3 = 0 THEN concat(CAST(c_custkey AS STRING), ' Oak St')
  ELSE concat(CAST(c_custkey AS STRING), ' Main St') END AS address,
 n_name AS city, CASE WHEN c_custkey % 2 = 0 THEN 'TX' ELSE 'CA' END AS state,
 CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE CAST(70000 + c_custkey % 29999 AS STRING) END AS zip,
 concat('2026-02-0', CAST(r.d AS STRING)) AS runDate
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey <both days>
WHERE NOT (r.d = 1 AND c_custkey % 10 = 9) AND NOT (r.d = 2 AND c_custkey % 10 = 8)
"""

# Seven snapshots. Addresses change back and forth, a state moves for good, holders come, go and return, and some stand
# twice in a snapshot, the second time with another address.
POLICYHOLDERS_WEEK = """
SELECT CASE WHEN c_custkey % 59 = 0 THEN NULL ELSE concat('H', CAST(c_custkey AS STRING)) END AS holder_id,
 concat('P', CAST(c_custkey AS STRING)) AS policy_id,
 CASE WHEN c_custkey % 61 = 0 THEN NULL ELSE c_name END AS full_name,
 CASE WHEN r.d > 7 THEN concat(CAST(c_custkey AS STRING), ' Elm St')
  WHEN (c_custkey + r.d) % 5 = 0 THEN concat(CAST(c_custkey AS STRING), ' Oak St')
  ELSE concat(CAST(c_custkey AS STRING), ' Main St') END AS address,
 n_name AS city, CASE WHEN c_custkey % 11 = 0 AND (r.d - 1) % 7 >= 3 THEN 'NY' WHEN c_custkey % 2 = 0 THEN 'TX' ELSE 'CA' END AS state,
 CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE CAST(70000 + c_custkey % 29999 AS STRING) END AS zip,
 concat('2026-02-0', CAST(1 + (r.d - 1) % 7 AS STRING)) AS runDate
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey <both weeks>
WHERE (r.d <= 7 OR c_custkey % 37 = 0) AND NOT (c_custkey + (r.d - 1) % 7) % 6 = 0
"""

PAYMENTS = """
SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL
  ELSE concat('PMT', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) END AS payment_id,
 CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE concat('P', CAST(l_orderkey AS STRING)) END AS policy_id,
 CASE WHEN l_orderkey % 79 = 0 THEN 'abc' WHEN l_orderkey % 71 = 0 THEN '0.00'
  ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS amount,
 CASE WHEN l_orderkey % 103 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN 'not-a-date'
  ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS payment_date,
 CASE WHEN l_returnflag = 'A' THEN 'ACH' WHEN l_returnflag = 'N' THEN 'CC' ELSE 'CHECK' END AS method,
 concat('2026-02-0', CAST(1 + l_orderkey % 7 AS STRING)) AS runDate
FROM {lineitem}
"""

TEXTS = {
    "policies": POLICIES,
    "policyholders": POLICYHOLDERS,
    "policyholders_week": POLICYHOLDERS_WEEK,
    "payments": PAYMENTS,
}
STAR_TABLES = ("orders", "customer", "nation", "lineitem")

# Rows of one customer in two weeks, and how many such rows a task makes at most, whatever the size of the files.
WEEK_ROWS = 14
TASK_ROWS = 500_000

_DAYS_SPARK = "LATERAL VIEW explode(array(1, 2)) r AS d"
_DAYS_ORACLE = "JOIN (SELECT 1 AS d UNION ALL SELECT 2 AS d) r ON TRUE"
_WEEKS_SPARK = "LATERAL VIEW explode(sequence(1, 14)) r AS d"
_WEEKS_ORACLE = "JOIN (SELECT CAST(unnest(generate_series(1, 14)) AS INTEGER) AS d) r ON TRUE"


def raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The entity as text, stamped with the run that loads it."""
    text = TEXTS[entity].replace("<both days>", _DAYS_SPARK).replace("<both weeks>", _WEEKS_SPARK)
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in STAR_TABLES if f"{{{t}}}" in text}
    if entity == "policyholders_week":
        tables["customer"] = spread(tables["customer"], WEEK_ROWS)
    return spark.sql(text, **tables).withColumn(RUN, F.col("runDate"))


def spread(rows: DataFrame, times: int) -> DataFrame:
    """The same rows over so many tasks that ``times`` as many are at most TASK_ROWS a task; the count reads file footers.

    Rows are dealt out by their place in the file, so a repeated or missing key does not gather in one task.
    """
    tasks = ceil(rows.count() * times / TASK_ROWS)
    if tasks < 2:
        return rows
    return rows.withColumn("_at", F.monotonically_increasing_id()).repartition(tasks, "_at").drop("_at")


def oracle(entity: str) -> str:
    text = TEXTS[entity].replace("<both days>", _DAYS_ORACLE).replace("<both weeks>", _WEEKS_ORACLE)
    return f"SELECT *, runDate AS _runDate FROM ({text.format(**{t: t for t in STAR_TABLES})})"
