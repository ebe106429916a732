"""The same results as plain SQL for an independent engine, written against the star tables directly."""

from __future__ import annotations

from daybook.catalogue.views import oracle as raw

# Column values: raw text to typed, typed to text.
TYPED = {
    "policies": "policy_id, product, state, TRY_CAST(effective_date AS DATE) AS effective_date, "
    "TRY_CAST(written_premium AS DOUBLE) AS written_premium, status, runDate, _runDate",
    "policyholders": "holder_id, policy_id, full_name, address, city, state, zip, runDate, _runDate",
    "payments": "payment_id, policy_id, TRY_CAST(amount AS DOUBLE) AS amount, "
    "TRY_CAST(payment_date AS DATE) AS payment_date, method, runDate, _runDate",
}
TEXT = {
    "policies": "policy_id, product, state, CAST(effective_date AS VARCHAR) AS effective_date, "
    "CAST(written_premium AS VARCHAR) AS written_premium, status, runDate, _runDate",
    "policyholders": TYPED["policyholders"],
    "payments": "payment_id, policy_id, CAST(amount AS VARCHAR) AS amount, "
    "CAST(payment_date AS VARCHAR) AS payment_date, method, runDate, _runDate",
}

BRONZE_VALID = {
    "policies": "policy_id IS NOT NULL AND (effective_date IS NULL OR TRY_CAST(effective_date AS DATE) IS NOT NULL) "
    "AND coalesce(TRY_CAST(written_premium AS DOUBLE) >= 0, FALSE)",
    "policyholders": "holder_id IS NOT NULL AND policy_id IS NOT NULL",
    "payments": "payment_id IS NOT NULL AND coalesce(TRY_CAST(amount AS DOUBLE) > 0, FALSE) "
    "AND (payment_date IS NULL OR TRY_CAST(payment_date AS DATE) IS NOT NULL)",
}
SILVER_VALID = {
    "policies": "policy_id IS NOT NULL AND effective_date IS NOT NULL AND written_premium > 0 AND length(state) = 2",
    "policyholders": "holder_id IS NOT NULL AND policy_id IS NOT NULL AND full_name IS NOT NULL",
    "payments": "payment_id IS NOT NULL AND policy_id IS NOT NULL AND amount > 0 AND payment_date IS NOT NULL",
}
# Rows whose only doubt is a missing state are undecided, not failed.
SILVER_FAILED = {
    "policies": "policy_id IS NULL OR effective_date IS NULL OR written_premium IS NULL OR written_premium <= 0 "
    "OR coalesce(length(state), 2) <> 2",
    "policyholders": f"NOT ({SILVER_VALID['policyholders']})",
    "payments": "payment_id IS NULL OR policy_id IS NULL OR amount IS NULL OR amount <= 0 OR payment_date IS NULL",
}
SILVER_REJECTED = {**SILVER_FAILED, "policies": f"({SILVER_FAILED['policies']}) OR state IS NULL"}

# Reasons as they stand in quarantine.
BRONZE_REASON = {
    "policies": "POLICY_BASIC_VALIDATION_FAILED",
    "policyholders": "POLICYHOLDER_BASIC_VALIDATION_FAILED",
    "payments": "PAYMENT_BASIC_VALIDATION_FAILED",
}
SILVER_REASON = {
    "policies": "POLICY_SILVER_RULES_FAILED",
    "policyholders": "POLICYHOLDER_SILVER_RULES_FAILED",
    "payments": "PAYMENT_SILVER_RULES_FAILED",
}
SILVER_DOUBT = {
    "policies": "POLICY_SILVER_RULES_UNKNOWN",
    "policyholders": "POLICYHOLDER_SILVER_RULES_UNKNOWN",
    "payments": "PAYMENT_SILVER_RULES_UNKNOWN",
}
SURVIVOR = {
    "policies": "written_premium DESC NULLS LAST, product NULLS FIRST, state NULLS FIRST, status NULLS FIRST",
    "policyholders": "full_name, address NULLS FIRST, city NULLS FIRST, state NULLS FIRST, zip NULLS FIRST",
    "payments": "payment_date DESC, amount DESC, policy_id, method NULLS FIRST",
}


# Business keys, stated here apart from the code under test.
KEY = {"policies": "policy_id, effective_date", "policyholders": "holder_id, policy_id", "payments": "payment_id"}
WEEK = "policyholders_week"


def bronze(e: str, source: str | None = None) -> str:
    return f"SELECT {TYPED[e]} FROM ({raw(source or e)}) WHERE {BRONZE_VALID[e]}"


def bronze_rejects(e: str) -> str:
    return f"SELECT *, '{BRONZE_REASON[e]}' AS reject_reason FROM ({raw(e)}) WHERE NOT ({BRONZE_VALID[e]})"


def clean(e: str, source: str | None = None) -> str:
    return (
        f"SELECT * FROM ({bronze(e, source)}) WHERE {SILVER_VALID[e]} "
        f"QUALIFY row_number() OVER (PARTITION BY {KEY[e]}, _runDate ORDER BY {SURVIVOR[e]}) = 1"
    )


def silver_rejects(e: str) -> str:
    return f"SELECT {TEXT[e]}, '{SILVER_REASON[e]}' AS reject_reason FROM ({bronze(e)}) WHERE {SILVER_FAILED[e]}"


def _upserted(e: str, column: str, was: str, becomes: str) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in KEY[e].split(", "))
    return f"""
WITH clean AS MATERIALIZED ({clean(e)}), old AS MATERIALIZED (SELECT * FROM clean WHERE _runDate <= '2026-02-04'),
new AS MATERIALIZED (SELECT * REPLACE ('2026-02-05' AS _runDate) FROM clean WHERE _runDate > '2026-02-04'
 UNION ALL SELECT * REPLACE ('{becomes}' AS {column}, '2026-02-05' AS _runDate) FROM old WHERE {column} = '{was}')
SELECT * FROM old t WHERE NOT EXISTS (SELECT 1 FROM new s WHERE {on}) UNION ALL SELECT * FROM new"""


_DAYS = f"""
clean AS ({clean("policyholders")}),
hashed AS (SELECT *, sha256(coalesce(full_name, '') || '||' || coalesce(address, '') || '||' || coalesce(city, '')
 || '||' || coalesce(state, '') || '||' || coalesce(zip, '')) AS attr_hash FROM clean),
versions AS (SELECT *, _runDate AS effective_start_date, '9999-12-31' AS effective_end_date, TRUE AS is_current FROM hashed),
v1 AS (SELECT * FROM versions WHERE _runDate = '2026-02-01'), v2 AS (SELECT * FROM versions WHERE _runDate = '2026-02-02'),
changes AS (SELECT v2.*, v1.effective_start_date AS replaced_start FROM v2 LEFT JOIN v1 USING (holder_id, policy_id)
 WHERE v1.attr_hash IS NULL OR v1.attr_hash <> v2.attr_hash),
expired AS (SELECT v1.* REPLACE ('2026-02-02' AS effective_end_date, FALSE AS is_current) FROM v1
 JOIN (SELECT holder_id, policy_id FROM changes) USING (holder_id, policy_id)),
history AS (SELECT * FROM expired UNION ALL SELECT * EXCLUDE (replaced_start) FROM changes
 UNION ALL SELECT * FROM v1 WHERE NOT EXISTS
 (SELECT 1 FROM changes c WHERE c.holder_id = v1.holder_id AND c.policy_id = v1.policy_id))"""


def _sum(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def written_premium(run: str) -> str:
    return (
        f"SELECT effective_date AS day, state, product, {run}{_sum('written_premium')} AS written_premium, "
        f"count(DISTINCT policy_id) AS policy_count FROM ({clean('policies')}) GROUP BY ALL"
    )


def payments(where: str = "TRUE") -> str:
    return (
        f"SELECT payment_date AS day, _runDate, {_sum('amount')} AS payments_total, count(*) AS payment_count "
        f"FROM ({clean('payments')}) WHERE {where} GROUP BY ALL"
    )


def _counts(holders: str = "policyholders") -> str:
    parts = []
    for e, key in KEY.items():
        source = holders if e == "policyholders" else e
        parts.append(
            f"SELECT 'bronze' AS layer, '{e}' AS entity, runDate, count(*) AS rows_read, "
            f"count(*) FILTER ({BRONZE_VALID[e]}) AS rows_valid, count(*) FILTER (NOT ({BRONZE_VALID[e]})) AS rows_rejected "
            f"FROM ({raw(source)}) GROUP BY runDate"
        )
        parts.append(
            f"SELECT 'silver' AS layer, '{e}' AS entity, runDate, count(*) AS rows_read, "
            f"count(DISTINCT ({key})) FILTER ({SILVER_VALID[e]}) AS rows_valid, "
            f"count(*) FILTER ({SILVER_REJECTED[e]}) AS rows_rejected FROM ({bronze(e, source)}) GROUP BY runDate"
        )
    return " UNION ALL ".join(parts)


# Each version is the first row of an island of equal fingerprints; it ends where the next island starts.
_WEEK_HISTORY = f"""
SELECT * EXCLUDE (before), coalesce(lead(_runDate) OVER (PARTITION BY holder_id, policy_id ORDER BY _runDate), '9999-12-31') AS effective_end_date,
 lead(_runDate) OVER (PARTITION BY holder_id, policy_id ORDER BY _runDate) IS NULL AS is_current, _runDate AS effective_start_date
FROM (SELECT *, lag(attr_hash) OVER (PARTITION BY holder_id, policy_id ORDER BY _runDate) AS before FROM
 (SELECT *, sha256(coalesce(full_name, '') || '||' || coalesce(address, '') || '||' || coalesce(city, '')
  || '||' || coalesce(state, '') || '||' || coalesce(zip, '')) AS attr_hash FROM ({clean("policyholders", WEEK)})))
WHERE before IS NULL OR before <> attr_hash"""

_FIRST_LOADED = f"""
WITH clean AS MATERIALIZED ({clean("policies")}), old AS MATERIALIZED (SELECT * FROM clean WHERE _runDate <= '2026-02-04'),
new AS MATERIALIZED (SELECT * REPLACE ('2026-02-05' AS _runDate) FROM clean WHERE _runDate > '2026-02-04'
 UNION ALL SELECT * REPLACE ('Active' AS status, '2026-02-05' AS _runDate) FROM old WHERE status = 'Cancelled')
SELECT coalesce(s.policy_id, t.policy_id) AS policy_id, CASE WHEN s.policy_id IS NULL THEN t.product ELSE s.product END AS product,
 CASE WHEN s.policy_id IS NULL THEN t.state ELSE s.state END AS state, coalesce(s.effective_date, t.effective_date) AS effective_date,
 CASE WHEN s.policy_id IS NULL THEN t.written_premium ELSE s.written_premium END AS written_premium,
 CASE WHEN s.policy_id IS NULL THEN t.status ELSE s.status END AS status, CASE WHEN s.policy_id IS NULL THEN t.runDate ELSE s.runDate END AS runDate,
 CASE WHEN s.policy_id IS NULL THEN t._runDate ELSE s._runDate END AS _runDate,
 CASE WHEN t.policy_id IS NULL THEN '2026-02-05' ELSE '2026-02-04' END AS first_loaded
FROM old t FULL JOIN new s ON t.policy_id = s.policy_id AND t.effective_date = s.effective_date"""

_ENDORSED = f"""
WITH p AS MATERIALIZED (SELECT policy_id, effective_date, product FROM ({clean("policies")})),
d AS (SELECT * FROM p UNION ALL SELECT policy_id, CAST(effective_date + INTERVAL 180 DAY AS DATE), product || ' PLUS' FROM p
 WHERE CAST(substr(policy_id, 2) AS BIGINT) % 3 = 0),
v AS MATERIALIZED (SELECT *, lead(effective_date) OVER (PARTITION BY policy_id ORDER BY effective_date) AS until FROM d)
SELECT f.payment_date AS day, v.product, {_sum("f.amount")} AS total, count(*) AS n_facts
FROM ({clean("payments")}) f JOIN v ON f.policy_id = v.policy_id AND f.payment_date >= v.effective_date
 AND (v.until IS NULL OR f.payment_date < v.until) GROUP BY ALL"""

_BY_HOLDER_STATE = f"""
WITH h AS MATERIALIZED ({_WEEK_HISTORY})
SELECT f._runDate, h.state, count(*) AS n_payments FROM ({clean("payments")}) f JOIN h ON f.policy_id = h.policy_id
 AND f._runDate >= h.effective_start_date AND f._runDate < h.effective_end_date GROUP BY ALL"""

# Of the whole daily path: clean payments lie in the last run that holds their key.
_LAST_RUN = "QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY _runDate DESC) = 1"

_LOG = f"""
log AS (SELECT *, rows_rejected * 100 >= 6.0 * rows_read AS failed FROM ({_counts()}))"""

RUN_STATUS = f"""
WITH {_LOG}, firsts AS (SELECT * FROM log WHERE failed
 QUALIFY row_number() OVER (PARTITION BY runDate ORDER BY layer, entity) = 1)
SELECT CASE WHEN f.runDate IS NULL THEN 'Success' ELSE 'Failure' END AS status, 'dev' AS environment,
 'daily_batch' AS pipelineName, 'daily_batch-' || r.runDate AS runId, r.runDate || 'T00:00:00Z' AS triggerTimeUtc,
 r.runDate, 'false' AS exportCsv, coalesce(f.layer || '/' || f.entity, '') AS activityName,
 CASE WHEN f.runDate IS NULL THEN '' ELSE 'STEP_FAILED' END AS errorCode,
 coalesce(CAST(f.rows_rejected AS VARCHAR) || ' rows rejected', '') AS errorMessage
FROM (SELECT DISTINCT runDate FROM log) r LEFT JOIN firsts f ON f.runDate = r.runDate"""

RUN_PLAN = f"""
WITH {_LOG}, done AS (SELECT runDate FROM log WHERE layer = 'bronze' GROUP BY runDate
 HAVING NOT bool_or(failed) AND count(DISTINCT entity) FILTER (entity IN ('policies', 'payments')) = 2),
days AS (SELECT CAST(CAST(unnest(generate_series(DATE '2026-01-31', DATE '2026-02-10', INTERVAL 1 DAY)) AS DATE) AS VARCHAR)
 AS runDate)
SELECT runDate FROM days WHERE runDate NOT IN (SELECT runDate FROM done)"""

_LISTED = "holder_id, policy_id, effective_start_date, effective_end_date, is_current"
_HOLDER_KEY = "t.holder_id = s.holder_id AND t.policy_id = s.policy_id"

ORACLE: dict[str, str] = {
    "q01_bronze_policies": bronze("policies"),
    "q02_bronze_policies_rejects": bronze_rejects("policies"),
    "q03_bronze_holders": bronze("policyholders"),
    "q04_bronze_holders_rejects": bronze_rejects("policyholders"),
    "q05_bronze_payments": bronze("payments"),
    "q06_bronze_payments_rejects": bronze_rejects("payments"),
    "q07_silver_policies": clean("policies"),
    "q08_silver_policies_rejects": silver_rejects("policies"),
    "q09_silver_payments": clean("payments"),
    "q10_silver_payments_rejects": silver_rejects("payments"),
    "q11_silver_holders": clean("policyholders"),
    "q12_silver_holders_rejects": silver_rejects("policyholders"),
    "q13_upsert_policies": _upserted("policies", "status", "Cancelled", "Active"),
    "q14_upsert_payments": _upserted("payments", "method", "CHECK", "ACH"),
    "q15_upsert_holders": f"""
WITH clean AS ({clean("policyholders")}), old AS (SELECT * FROM clean WHERE _runDate = '2026-02-01'),
new AS (SELECT * FROM clean WHERE _runDate = '2026-02-02')
SELECT * FROM old t WHERE NOT EXISTS (SELECT 1 FROM new s WHERE {_HOLDER_KEY}) UNION ALL SELECT * FROM new""",
    "q16_holder_hash": f"WITH {_DAYS} SELECT holder_id, policy_id, _runDate, attr_hash FROM hashed",
    "q17_holder_changes": f"WITH {_DAYS} SELECT * FROM changes",
    "q18_scd2_expired": f"WITH {_DAYS} SELECT * FROM expired",
    "q19_scd2_history": f"WITH {_DAYS} SELECT * FROM history",
    "q20_gold_written_premium": written_premium("_runDate, ") + " ORDER BY _runDate, day, state, product",
    "q21_gold_payments": payments() + " ORDER BY _runDate, day",
    "q22_gold_active": "SELECT effective_date AS day, _runDate, count(*) FILTER (status = 'Active') AS active_policies, "
    f"count(*) FILTER (status = 'Cancelled') AS cancelled_policies FROM ({clean('policies')}) GROUP BY ALL "
    "ORDER BY _runDate, day",
    "q23_gold_rerun": payments("_runDate NOT IN ('2026-02-03', '2026-02-05', '2026-02-07')")
    + " UNION ALL "
    + payments("_runDate = '2026-02-03' AND method = 'CC'"),
    "q24_run_counts": _counts(),
    "q25_rows_per_run": f"SELECT _runDate, count(*) AS n_rows FROM ({bronze('policies')}) GROUP BY _runDate",
    "q26_recent_runs": f"SELECT * FROM ({_counts()}) ORDER BY runDate DESC, layer, entity LIMIT 20",
    "q27_scd2_listing": f"WITH {_DAYS} SELECT {_LISTED} FROM history ORDER BY holder_id, policy_id, effective_start_date",
    "q28_gold_export": payments(),
    "q29_raw_copy": f"SELECT * EXCLUDE (_runDate) FROM ({raw('policies')})",
    "q30_run_plan": RUN_PLAN,
    "q31_gold_full_refresh": written_premium(""),
    "q32_duplicate_keys": f"SELECT payment_id, _runDate, count(*) AS n_rows FROM ({bronze('payments')}) "
    f"WHERE {SILVER_VALID['payments']} GROUP BY payment_id, _runDate HAVING count(*) > 1",
    "q33_run_status": RUN_STATUS,
    "q34_table_merge": _upserted("policies", "status", "Cancelled", "Active"),
    "q35_table_history": f"WITH {_DAYS} SELECT * FROM history",
    "q36_fact_dimension_daily": f"""
SELECT p.payment_date AS day, d.product, {_sum("p.amount")} AS total, count(*) AS n_facts
FROM ({clean("payments")}) p JOIN ({clean("policies")}) d ON p.policy_id = d.policy_id GROUP BY ALL""",
    "q37_scd2_current": f"WITH {_DAYS} SELECT * FROM history WHERE is_current",
    "q38_upsert_keep_newer": f"""
SELECT * FROM ({clean("policyholders")})
QUALIFY row_number() OVER (PARTITION BY holder_id, policy_id ORDER BY _runDate DESC) = 1""",
    "q39_history_of_days": _WEEK_HISTORY,
    "q40_table_history_week": _WEEK_HISTORY,
    "q41_upsert_first_loaded": _FIRST_LOADED,
    "q42_endorsed_daily": _ENDORSED,
    "q43_payments_by_holder_state": _BY_HOLDER_STATE,
    "q52_keyed_store_merge": _upserted("policies", "status", "Cancelled", "Active"),
    "q55_saved_by_name": clean("policyholders", WEEK),
    "q53_premium_from_states": written_premium(""),
    "q54_policies_per_state": f"SELECT state, {_sum('written_premium')} AS written_premium, count(DISTINCT policy_id) AS policy_count "
    f"FROM ({clean('policies')}) GROUP BY state",
    "q44_day_bronze_payments": bronze("payments"),
    "q45_day_rejects_policies": f"SELECT {TEXT['policies']}, CASE WHEN {SILVER_FAILED['policies']} THEN "
    f"'POLICY_SILVER_RULES_FAILED' ELSE 'POLICY_SILVER_RULES_UNKNOWN' END AS reject_reason FROM ({bronze('policies')}) "
    f"WHERE {SILVER_REJECTED['policies']}",
    "q46_day_silver_payments": f"SELECT * FROM ({clean('payments')}) {_LAST_RUN}",
    "q47_day_history": _WEEK_HISTORY,
    "q48_day_gold_export": written_premium("_runDate, "),
    "q49_day_log": f"SELECT 'daily_batch' AS pipeline_name, *, 'SUCCESS' AS status FROM ({_counts(WEEK)})",
    "q50_day_alerts": f"""
SELECT DISTINCT 'Success' AS status, 'dev' AS environment, 'daily_batch' AS pipelineName, 'daily_batch-' || runDate AS runId, runDate,
 'true' AS exportCsv, '' AS activityName, '' AS errorCode, '' AS errorMessage FROM ({raw("policies")})""",
    "q51_day_pending": f"""
SELECT runDate, 'pending' AS state FROM
 (SELECT CAST(CAST(unnest(generate_series(DATE '2026-01-31', DATE '2026-02-10', INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS runDate)
WHERE runDate NOT IN (SELECT runDate FROM ({raw("policies")}))
UNION ALL SELECT max(runDate), 'mark' FROM ({raw("policies")})""",
}
