"""DuckDB SQL giving the expected result of each query in the catalog.

Written from the rules of the operators, not from the Spark code. Queries
without an entry (models of all columns) are compared in the tests by other means.
"""

from __future__ import annotations

TELEMETRY = """
telemetry AS (
  SELECT event_id,
         CASE WHEN event_id % 20 < 18 THEN 'VHOT00' || (event_id % 5) ELSE 'V' || user_id END
           AS vehicle_id,
         'M' || ((CASE WHEN event_id % 20 < 18 THEN event_id % 5 ELSE user_id END) % 4)
           AS vehicle_model,
         ts AS event_time,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS engine_temp_c,
         CAST(event_id % 1100 AS DOUBLE) / CAST(10 AS DOUBLE) AS speed_kmph,
         CAST(event_id % 50 AS DOUBLE) / CAST(10 AS DOUBLE) AS miles_driven
  FROM events
)"""

_ADDON_SQL = ",\n".join(
    f"""  CASE WHEN (c*17)%9 < 2 THEN 'No internet service'
       WHEN (c*{m})%100 < {r} THEN 'Yes' ELSE 'No' END AS {name}"""
    for name, m, r in [
        ("online_security", 19, 30),
        ("online_backup", 23, 35),
        ("device_protection", 29, 35),
        ("tech_support", 31, 30),
        ("streaming_tv", 41, 40),
        ("streaming_movies", 43, 40),
    ]
)

# The clean customer table, straight from the keys.
CUSTOMERS = f"""
source AS (SELECT *, c_custkey AS c FROM customer),
customers AS (
SELECT
  'C' || c AS customer_id,
  CAST((c*37)%73 AS INTEGER) AS tenure_months,
  CAST(1825 + (c*7919)%10000 AS DOUBLE) / CAST(100 AS DOUBLE) AS monthly_charges,
  CASE WHEN (c*37)%73 = 0 THEN CAST(1825 + (c*7919)%10000 AS DOUBLE) / CAST(100 AS DOUBLE)
       ELSE CAST(((c*37)%73)*20 AS DOUBLE) END AS total_charges,
  CASE WHEN (c*13)%101 = 0 THEN NULL
       WHEN (c*11)%7 = 0 THEN 'one_year'
       WHEN (c*11)%7 = 1 THEN 'two_year'
       ELSE 'month_to_month' END AS contract_type,
  CASE (c*5)%4 WHEN 0 THEN 'electronic_check' WHEN 1 THEN 'mailed_check'
       WHEN 2 THEN 'bank_transfer' ELSE 'credit_card' END AS payment_method,
  CASE WHEN (c*17)%9 < 2 THEN 'none' WHEN (c*17)%9 < 5 THEN 'dsl' ELSE 'fiber_optic' END
    AS internet_service,
{_ADDON_SQL},
  CASE WHEN (c*47)%100 < 16 THEN 1 ELSE 0 END AS senior_citizen,
  CASE WHEN (c*53)%100 < 48 THEN 1 ELSE 0 END AS partner,
  CASE WHEN (c*59)%100 < 30 THEN 1 ELSE 0 END AS dependents,
  CASE WHEN (c*61)%100 < 90 THEN 1 ELSE 0 END AS phone_service,
  CASE WHEN (c*61)%100 < 90 AND (c*67)%100 < 42 THEN 1 ELSE 0 END AS multiple_lines,
  CASE WHEN (c*71)%100 < 59 THEN 1 ELSE 0 END AS paperless_billing,
  CASE WHEN (CASE WHEN (c*11)%7 > 1 THEN 40 ELSE 0 END)
          + (CASE WHEN (c*17)%9 >= 5 THEN 20 ELSE 0 END)
          - (c*37)%73 + (c*6151)%100 > 85 THEN 1 ELSE 0 END AS churn,
  c_custkey, c_nationkey, c_mktsegment, c_acctbal
FROM source)"""

COLUMNS = """customer_id, tenure_months, monthly_charges, total_charges, contract_type,
 payment_method, internet_service, online_security, online_backup, device_protection,
 tech_support, streaming_tv, streaming_movies, senior_citizen, partner, dependents,
 phone_service, multiple_lines, paperless_billing, churn"""

# Derived columns over a relation `filled` whose inputs are already defaulted.
DERIVED = """
  CASE WHEN tenure_months <= -1 OR tenure_months > 10000 THEN NULL
       WHEN tenure_months <= 6 THEN 0 WHEN tenure_months <= 12 THEN 1
       WHEN tenure_months <= 24 THEN 2 WHEN tenure_months <= 48 THEN 3 ELSE 4 END
    AS tenure_bucket,
  total_charges / (tenure_months + 1) AS charges_per_tenure_month,
  monthly_charges - total_charges / (tenure_months + 1) AS monthly_rate_deviation,
  (online_security IS NOT DISTINCT FROM 'Yes')::INTEGER
    + (online_backup IS NOT DISTINCT FROM 'Yes')::INTEGER
    + (device_protection IS NOT DISTINCT FROM 'Yes')::INTEGER
    + (tech_support IS NOT DISTINCT FROM 'Yes')::INTEGER
    + (streaming_tv IS NOT DISTINCT FROM 'Yes')::INTEGER
    + (streaming_movies IS NOT DISTINCT FROM 'Yes')::INTEGER AS num_addon_services,
  (contract_type IS NOT DISTINCT FROM 'month_to_month')::INTEGER AS is_month_to_month,
  CASE WHEN monthly_charges > 80 THEN 1 ELSE 0 END AS high_value_customer,
  CASE internet_service WHEN 'dsl' THEN 1 WHEN 'fiber_optic' THEN 2 ELSE 0 END
    AS internet_service_encoded,
  CASE payment_method WHEN 'electronic_check' THEN 0 WHEN 'mailed_check' THEN 1
       WHEN 'bank_transfer' THEN 2 WHEN 'credit_card' THEN 3 ELSE -1 END
    AS payment_method_encoded"""

MODEL_COLUMNS = """tenure_months, monthly_charges, total_charges, senior_citizen, partner,
 dependents, phone_service, multiple_lines, paperless_billing, internet_service_encoded,
 tenure_bucket, charges_per_tenure_month, monthly_rate_deviation, num_addon_services,
 is_month_to_month, high_value_customer, payment_method_encoded"""

FILLED = """
filled AS (SELECT * REPLACE (CAST(tenure_months AS DOUBLE) AS tenure_months) FROM customers)"""

FAULTY = f"""
faulty AS (SELECT {COLUMNS} FROM (SELECT * REPLACE (
  CASE c_nationkey WHEN 3 THEN -1 WHEN 4 THEN 101 ELSE tenure_months END AS tenure_months,
  CASE WHEN c_acctbal < 0 THEN -monthly_charges ELSE monthly_charges END AS monthly_charges,
  CASE WHEN c_nationkey IN (11, 12) THEN NULL ELSE total_charges END AS total_charges,
  CASE WHEN c_nationkey = 7 THEN 'not_a_real_contract' ELSE contract_type END AS contract_type,
  CASE WHEN c_nationkey = 9 THEN 2 ELSE partner END AS partner,
  CASE WHEN c_nationkey = 13 THEN NULL ELSE tech_support END AS tech_support)
 FROM customers))"""

FAILED = """
checked AS (SELECT customer_id, concat_ws(',',
  CASE WHEN customer_id IS NULL THEN 'customer_id' END,
  CASE WHEN tenure_months IS NULL OR tenure_months < 0 OR tenure_months > 100
       THEN 'tenure_months' END,
  CASE WHEN monthly_charges IS NULL OR monthly_charges < 0 THEN 'monthly_charges' END,
  CASE WHEN total_charges IS NULL OR total_charges < 0 THEN 'total_charges' END,
  CASE WHEN contract_type IS NULL
         OR contract_type NOT IN ('month_to_month','one_year','two_year')
       THEN 'contract_type' END,
  CASE WHEN tech_support IS NULL THEN 'tech_support' END,
  CASE WHEN partner NOT BETWEEN 0 AND 1 THEN 'partner' END) AS failed_fields
 FROM faulty)"""

SPLIT = """
hashed AS (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY
    CAST('0x' || substr(md5(customer_id), 1, 15) AS BIGINT)) AS place FROM customers),
per_class AS (SELECT churn, count(*) AS n FROM customers GROUP BY churn),
total AS (SELECT CAST(sum(n) AS BIGINT) AS n,
   CAST(ceil(CAST('0.15' AS DOUBLE) * sum(n)) AS BIGINT) AS test FROM per_class),
total2 AS (SELECT n, test, n - test AS rest, CAST(ceil(CAST('0.15' AS DOUBLE)
   / (CAST(1 AS DOUBLE) - CAST('0.15' AS DOUBLE)) * (n - test)) AS BIGINT) AS val FROM total),
kept1 AS (SELECT p.churn, p.n, p.n * t.rest // t.n AS whole, row_number() OVER (
     ORDER BY p.n * t.rest % t.n DESC, p.churn) AS nth, t.rest AS goal
   FROM per_class p, total2 t),
rest AS (SELECT churn, n, whole + CASE WHEN nth <= goal - sum(whole) OVER () THEN 1 ELSE 0 END
   AS m FROM kept1),
kept2 AS (SELECT r.churn, r.n, r.m, r.m * (t.rest - t.val) // t.rest AS whole,
     row_number() OVER (ORDER BY r.m * (t.rest - t.val) % t.rest DESC, r.churn) AS nth,
     t.rest - t.val AS goal
   FROM rest r, total2 t),
sizes AS (SELECT churn, n - m AS test, n - (whole
     + CASE WHEN nth <= goal - sum(whole) OVER () THEN 1 ELSE 0 END) AS test_val FROM kept2),
split AS (SELECT h.*, CASE WHEN place <= test THEN 'test' WHEN place <= test_val THEN 'val'
     ELSE 'train' END AS split
   FROM hashed h JOIN sizes s ON h.churn = s.churn)"""

PARTS = """
placed AS (SELECT *, row_number() OVER (ORDER BY c_custkey) <=
     CAST(floor(count(*) OVER () * CAST('0.9' AS DOUBLE)) AS BIGINT) AS is_initial
   FROM customers),
initial AS (SELECT * EXCLUDE is_initial FROM placed WHERE is_initial),
incoming AS (SELECT * EXCLUDE is_initial FROM placed WHERE NOT is_initial),
corrected AS (SELECT * REPLACE (monthly_charges + 1 AS monthly_charges) FROM customers
   WHERE c_acctbal < 0)"""

VEHICLES = """
vehicles AS (SELECT vehicle_id, vehicle_model,
    CAST(sum(CAST(engine_temp_c AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_engine_temp_c,
    count(*) AS total_readings
  FROM telemetry WHERE engine_temp_c IS NOT NULL GROUP BY ALL)"""

MODEL_SUMMARY = f"""WITH {TELEMETRY}
SELECT vehicle_model,
  CAST(sum(CAST(engine_temp_c AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_engine_temp_c,
  count(*) AS reading_count,
  CAST(sum(CAST(miles_driven AS DECIMAL(18,2))) AS DOUBLE) AS total_miles_driven
FROM telemetry WHERE engine_temp_c IS NOT NULL GROUP BY vehicle_model"""

ITERATED = f"""WITH {TELEMETRY}
SELECT vehicle_id, vehicle_model, engine_temp_c, miles_driven,
{", ".join(
    f"engine_temp_c + CAST('0.001' AS DOUBLE) * CAST({i} AS DOUBLE) AS temp_adj_{i}"
    for i in range(1, 61)
)}
FROM telemetry WHERE engine_temp_c IS NOT NULL"""

_BATCH_COLUMNS = f"{COLUMNS}, batch_id"

MERGED = f"""WITH {CUSTOMERS}, {PARTS},
everything AS (
  SELECT {COLUMNS}, 0 AS batch_id, 0 AS place FROM initial
  UNION ALL SELECT {COLUMNS}, 1, 0 FROM incoming
  UNION ALL SELECT {COLUMNS}, 1, 1 FROM corrected
  UNION ALL SELECT {COLUMNS}, 1, 2 FROM
    (SELECT * REPLACE (monthly_charges + 1 AS monthly_charges) FROM corrected
     WHERE c_nationkey < 5))
SELECT {_BATCH_COLUMNS} FROM everything
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY batch_id DESC, place DESC) = 1"""

INGESTED = f"""WITH {CUSTOMERS}, {PARTS},
everything AS (
  SELECT {COLUMNS}, 0 AS batch_id FROM initial
  UNION ALL SELECT {COLUMNS}, 1 FROM incoming
  UNION ALL SELECT {COLUMNS}, 2 FROM corrected)
SELECT {COLUMNS}, CAST(batch_id AS BIGINT) AS batch_id FROM everything
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY batch_id DESC) = 1"""

# A table after four batches, and all their rows.
CHANGED = f"""WITH {CUSTOMERS}, {PARTS},
everything AS (
  SELECT {COLUMNS}, 0 AS batch_id FROM initial
  UNION ALL SELECT {COLUMNS}, 1 FROM incoming
  UNION ALL SELECT {COLUMNS}, 2 FROM corrected
  UNION ALL SELECT {COLUMNS}, 3 FROM
    (SELECT * REPLACE (monthly_charges + 1 AS monthly_charges) FROM corrected
     WHERE c_nationkey < 5)),
changed AS (SELECT * FROM everything
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY batch_id DESC) = 1)"""

STREAMED = f"""WITH {CUSTOMERS}, {PARTS},
everything AS (
  SELECT {COLUMNS}, 1 AS batch_id FROM initial
  UNION ALL SELECT {COLUMNS}, 2 FROM {{second}}
  UNION ALL SELECT {COLUMNS}, 3 FROM corrected),
rows AS (SELECT batch_id, CAST(count(*) AS BIGINT) AS rows_of_batch FROM everything GROUP BY batch_id),
latest AS (SELECT {COLUMNS}, CAST(batch_id AS BIGINT) AS batch_id FROM everything
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY batch_id DESC) = 1)"""


def _auc(relation: str, score: str, label: str, groups: str = "") -> str:
    """Rank-sum AUC with average ranks for ties."""
    by = f"{groups}," if groups else ""
    part = f"PARTITION BY {groups}" if groups else ""
    tail = f"GROUP BY {groups}" if groups else ""
    return f"""
SELECT {by}
  CASE WHEN sum({label}) = 0 OR sum({label}) = count(*) THEN NULL ELSE
    CAST(sum(CASE WHEN {label} = 1 THEN twice_rank ELSE 0 END)
         - sum({label}) * (sum({label}) + 1) AS DOUBLE)
    / (2 * CAST(sum({label}) AS DOUBLE) * CAST(count(*) - sum({label}) AS DOUBLE)) END AS roc_auc,
  CAST(sum({label}) AS BIGINT) AS n_positive,
  CAST(count(*) - sum({label}) AS BIGINT) AS n_negative
FROM (SELECT *, 2 * rank() OVER ({part} ORDER BY {score})
        + count(*) OVER (PARTITION BY {by} {score}) - 1 AS twice_rank FROM {relation}) ranked
{tail}"""


SCORED = """
scored AS (SELECT d.doc_id, d.source, d.n_chars, l.quality,
    CASE WHEN d.n_chars > 400 THEN 1 ELSE 0 END AS predicted
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def _missing(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows,
            CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS missing_fraction FROM telemetry"""
        for c in columns
    )


_CLEAN_NAMES = [name.strip() for name in COLUMNS.replace("\n", " ").split(",")]

ISSUES = f"""
fractions AS ({" UNION ALL ".join(
    f"SELECT {i} AS nth, '{c}' AS column_name, 'missing' AS kind, "
    f"CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS value FROM faulty"
    for i, c in enumerate(_CLEAN_NAMES)
)} UNION ALL {" UNION ALL ".join(
    f"SELECT {100 + i}, '{c}', 'negative', CAST(count(*) FILTER ({c} < 0) AS DOUBLE) FROM faulty"
    for i, c in enumerate(["tenure_months", "monthly_charges", "total_charges"])
)}),
issues AS (SELECT *, CASE kind WHEN 'missing'
    THEN 'Column ''' || column_name || ''' has ' || printf('%.2f', round(value * 100, 2))
         || '% missing values (> 5% threshold)'
    ELSE 'Column ''' || column_name || ''' has ' || CAST(value AS BIGINT)
         || ' out-of-range (negative) values' END AS message
  FROM fractions WHERE (kind = 'missing' AND value > CAST('0.05' AS DOUBLE))
     OR (kind = 'negative' AND value > 0))"""

_DRIFT_FEATURES = ["tenure_months", "monthly_charges", "total_charges", "senior_citizen"]


def _drift(train: str, recent: str, groups: str = "") -> str:
    by = f"{groups}," if groups else ""
    tail = f"GROUP BY {groups}" if groups else ""
    branches = " UNION ALL ".join(
        f"""SELECT {by} '{f}' AS feature, m AS train_mean, r AS recent_mean,
          CASE WHEN s = 0 THEN 0 ELSE abs(r - m) / s END AS z
        FROM (SELECT {by} avg(CAST({f} AS DOUBLE)) AS r FROM {recent} {tail}) now,
             (SELECT avg(CAST({f} AS DOUBLE)) AS m, stddev_samp(CAST({f} AS DOUBLE)) AS s
              FROM {train}) past"""
        for f in _DRIFT_FEATURES
    )
    return f"""SELECT {by} feature, round(train_mean, 3) AS train_mean,
      round(recent_mean, 3) AS recent_mean, round(z, 3) AS drift_zscore,
      coalesce(z > 2, false) AS flagged
    FROM ({branches}) scores"""


RULES = """
ruled AS (SELECT *, -tenure_months AS baseline_score,
   CASE WHEN contract_type = 'month_to_month' THEN 40 ELSE 0 END
   + CASE WHEN internet_service = 'fiber_optic' THEN 20 ELSE 0 END - tenure_months
     AS candidate_score FROM customers)"""


def _reason(candidate: str, reference: str, split: str, words: tuple[str, str, str, str]) -> str:
    subject, name, won, lost = words
    c = f"coalesce(CAST({candidate} AS VARCHAR), 'undefined')"
    r = f"coalesce(CAST({reference} AS VARCHAR), 'undefined')"
    floor_ok = f"coalesce({candidate} >= CAST('0.8' AS DOUBLE), false)"
    near = f"coalesce({reference} - {candidate} <= CAST('0.01' AS DOUBLE), false)"
    return f"""CASE WHEN {floor_ok} AND {near}
      THEN '{won}: {split} ROC AUC ' || {c} || ' >= 0.8 and within 0.01 of {name} (' || {r} || ').'
      ELSE '{lost}: ' || concat_ws('; ',
        CASE WHEN NOT {floor_ok} THEN '{subject} {split} ROC AUC ' || {c} || ' < floor 0.8' END,
        CASE WHEN NOT {near} THEN '{subject} {split} ROC AUC ' || {c}
          || ' regresses more than 0.01 vs {name} ' || {r} END) END"""


_INNER = _reason(
    "candidate_val_auc",
    "baseline_val_auc",
    "val",
    ("candidate", "baseline", "Promoted candidate", "Kept baseline"),
)
_OUTER = _reason(
    "new_test_auc",
    "production_auc",
    "test",
    (
        "retrained model''s",
        "current production model",
        "Promoted retrained model",
        "Kept current production model",
    ),
)


def _passes(candidate: str, reference: str) -> str:
    return (
        f"coalesce({candidate} >= CAST('0.8' AS DOUBLE) "
        f"AND {reference} - {candidate} <= CAST('0.01' AS DOUBLE), false)"
    )


PROMOTION = f"""WITH {CUSTOMERS}, {RULES.replace("FROM customers", "FROM split")
    .replace("ruled AS", f"{SPLIT.strip()}, ruled AS")},
long AS (
  SELECT c_nationkey, split, churn, 'baseline' AS model, baseline_score AS score
    FROM ruled WHERE split <> 'train'
  UNION ALL SELECT c_nationkey, split, churn, 'candidate', candidate_score
    FROM ruled WHERE split <> 'train'),
areas AS ({_auc("long", "score", "churn", "c_nationkey, model, split")}),
metrics AS (SELECT c_nationkey,
  max(round(roc_auc, 4)) FILTER (model = 'baseline' AND split = 'val') AS baseline_val_auc,
  max(round(roc_auc, 4)) FILTER (model = 'baseline' AND split = 'test') AS baseline_test_auc,
  max(round(roc_auc, 4)) FILTER (model = 'candidate' AND split = 'val') AS candidate_val_auc,
  max(round(roc_auc, 4)) FILTER (model = 'candidate' AND split = 'test') AS candidate_test_auc
  FROM areas GROUP BY c_nationkey),
deployed AS (SELECT * FROM ruled WHERE c_nationkey IN
  (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)),
incumbent_areas AS ({_auc("deployed", "candidate_score", "churn", "c_nationkey")}),
picked AS (SELECT *,
  {_passes("candidate_val_auc", "baseline_val_auc")} AS candidate_promoted,
  {_INNER} AS selection_reason FROM metrics),
chosen AS (SELECT *,
  CASE WHEN candidate_promoted THEN 'random_forest' ELSE 'logistic_regression' END AS model_type,
  CASE WHEN candidate_promoted THEN candidate_test_auc ELSE baseline_test_auc END AS new_test_auc
  FROM picked),
compared AS (SELECT c.*, round(i.roc_auc, 4) AS production_auc, i.c_nationkey IS NULL AS vacant
  FROM chosen c LEFT JOIN incumbent_areas i ON c.c_nationkey = i.c_nationkey)
SELECT * EXCLUDE (vacant),
  vacant OR coalesce({_passes("new_test_auc", "production_auc")}, FALSE) AS promoted,
  CASE WHEN vacant
    THEN 'No model currently in production; deploying retrained model.'
    ELSE {_OUTER} END AS promotion_reason
FROM compared"""

_SEGMENT = "c_nationkey, c_mktsegment"

RETRAIN = f"""WITH {CUSTOMERS}, {RULES},
numbered AS (SELECT *, row_number() OVER (ORDER BY c_custkey) <=
   CAST(floor(count(*) OVER () * CAST('0.8' AS DOUBLE)) AS BIGINT) AS is_old FROM ruled),
old_rows AS (SELECT * FROM numbered WHERE is_old),
recent AS (SELECT * FROM numbered WHERE NOT is_old),
old_auc AS ({_auc("old_rows", "candidate_score", "churn", _SEGMENT)}),
new_auc AS ({_auc("recent", "candidate_score", "churn", _SEGMENT)}),
drift AS (SELECT {_SEGMENT}, coalesce(max(drift_zscore), 0) AS z
   FROM ({_drift("customers", "recent", _SEGMENT)}) d GROUP BY {_SEGMENT}),
ages AS (SELECT {_SEGMENT}, date_diff('day', max(o_orderdate),
      (SELECT max(o_orderdate) FROM orders)) AS days
   FROM ruled JOIN orders ON c_custkey = o_custkey GROUP BY {_SEGMENT}),
segments AS (SELECT DISTINCT {_SEGMENT} FROM ruled),
signals AS (SELECT s.c_nationkey, s.c_mktsegment, CAST(a.days AS INTEGER)
      AS days_since_last_training,
   coalesce(round(o.roc_auc, 4), 0) AS production_auc,
   round(n.roc_auc, 4) AS recent_labeled_auc, coalesce(d.z, 0) AS drift_zscore
   FROM segments s LEFT JOIN ages a USING ({_SEGMENT}) LEFT JOIN old_auc o USING ({_SEGMENT}) LEFT JOIN new_auc n USING ({_SEGMENT})
   LEFT JOIN drift d USING ({_SEGMENT})),
reasons AS (SELECT *,
   CASE WHEN days_since_last_training >= 7
     THEN days_since_last_training || ' days of new data >= minimum 7' END AS by_age,
   CASE WHEN production_auc - recent_labeled_auc >= CAST('0.03' AS DOUBLE)
     THEN 'recent labeled AUC dropped by '
       || CAST(CAST(production_auc - recent_labeled_auc AS DECIMAL(18,3)) AS VARCHAR)
       || ' >= threshold 0.03' END AS by_auc,
   CASE WHEN drift_zscore >= 2 THEN 'drift z-score '
       || CAST(CAST(CAST(drift_zscore AS DECIMAL(18,3)) AS DECIMAL(18,2)) AS VARCHAR)
       || ' >= threshold 2.0' END AS by_drift
   FROM signals)
SELECT * EXCLUDE (by_age, by_auc, by_drift),
   concat_ws(' | ', by_age, by_auc, by_drift) AS triggered_by,
   by_age IS NOT NULL OR by_auc IS NOT NULL OR by_drift IS NOT NULL AS should_retrain
FROM reasons"""

REGISTRY = """
registry AS (SELECT o_orderkey AS sequence, 'v' || o_orderkey AS model_version,
  o_orderpriority AS segment, o_orderstatus = 'F' AS promoted, o_totalprice FROM orders)"""

LATENCY_ALL = """WITH requests AS (SELECT ts, value,
    event_type = 'error' OR value > 200 AS failed FROM events),
good AS (SELECT list_sort(list(value)) AS v, count(*) AS n FROM requests WHERE NOT failed)
SELECT count(*) AS n_requests, count(*) FILTER (failed) AS n_errors,
  CAST(max(epoch_us(ts) + CAST(round(value * 1000) AS BIGINT)) - min(epoch_us(ts)) AS DOUBLE)
    / CAST(1000000 AS DOUBLE) AS wall_seconds,
  count(*) / (CAST(max(epoch_us(ts) + CAST(round(value * 1000) AS BIGINT)) - min(epoch_us(ts))
    AS DOUBLE) / CAST(1000000 AS DOUBLE)) AS requests_per_second,
  CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (NOT failed) AS DOUBLE)
    / count(*) FILTER (NOT failed) AS mean_ms,
  (SELECT (v[(n - 1) // 2 + 1] + v[n // 2 + 1]) / 2 FROM good) AS p50_ms,
  (SELECT v[least(CAST(floor(n * CAST('0.95' AS DOUBLE)) AS BIGINT), n - 1) + 1] FROM good)
    AS p95_ms,
  max(value) FILTER (NOT failed) AS max_ms
FROM requests"""

LATENCY = """WITH requests AS (SELECT event_type, ts, value,
    event_type = 'error' OR value > 200 AS failed FROM events),
sorted AS (SELECT event_type, value,
    row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS place,
    count(*) OVER (PARTITION BY event_type) AS n FROM requests WHERE NOT failed),
quantiles AS (SELECT event_type,
    (max(value) FILTER (place = (n - 1) // 2) + max(value) FILTER (place = n // 2)) / 2 AS p50_ms,
    max(value) FILTER (place = least(CAST(floor(n * CAST('0.95' AS DOUBLE)) AS BIGINT), n - 1))
      AS p95_ms
  FROM sorted GROUP BY event_type),
overall AS (SELECT event_type, count(*) AS n_requests,
    count(*) FILTER (failed) AS n_errors,
    CAST(max(epoch_us(ts) + CAST(round(value * 1000) AS BIGINT)) - min(epoch_us(ts)) AS DOUBLE)
      / CAST(1000000 AS DOUBLE) AS wall_seconds,
    CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (NOT failed) AS DOUBLE)
      / nullif(count(*) FILTER (NOT failed), 0) AS mean_ms,
    max(value) FILTER (NOT failed) AS max_ms
  FROM requests GROUP BY event_type)
SELECT o.event_type, n_requests, n_errors, wall_seconds,
   n_requests / wall_seconds AS requests_per_second, mean_ms, p50_ms, p95_ms, max_ms
FROM overall o LEFT JOIN quantiles q ON o.event_type = q.event_type"""

FORMULA_SCORES = f"""WITH {CUSTOMERS}, {FAULTY}, {FAILED}
SELECT customer_id, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS churn_prediction,
  round(p, 4) AS churn_probability, 'v1' AS model_version, 'formula' AS model_type
FROM (SELECT f.customer_id, monthly_charges / (monthly_charges + tenure_months) AS p
  FROM faulty f JOIN checked c ON f.customer_id = c.customer_id
  WHERE c.failed_fields = '') valid"""

# Customers of two kinds (x): a model can only learn the share of churn in each.
def two_groups(*rounds: tuple[int, int]) -> str:
    values = ", ".join(f"({r}, {high}, {low})" for r, (high, low) in enumerate(rounds))
    return f"""{CUSTOMERS}, {SPLIT},
rounds AS (SELECT * FROM (VALUES {values}) v(r, high, low)),
grouped AS (SELECT r, customer_id, churn, split, CASE WHEN (c_custkey * 89) % 101
    < CASE WHEN churn = 1 THEN high ELSE low END THEN 1 ELSE 0 END AS x FROM split, rounds),
shares AS (SELECT r, x, avg(churn) AS share FROM grouped WHERE split = 'train' GROUP BY r, x),
measured AS (SELECT g.r, split, count(*) AS n_samples,
    round(avg(CASE WHEN (share > 0.5) = (churn = 1) THEN 1 ELSE 0 END), 4) AS accuracy,
    round((1 + avg(g.x) FILTER (churn = 1) - avg(g.x) FILTER (churn = 0)) / 2, 4) AS roc_auc
  FROM grouped g JOIN shares s ON g.r = s.r AND g.x = s.x WHERE split <> 'train'
  GROUP BY g.r, split)"""


# Newton steps for the summed log loss plus w * w / 2 over 17 equal columns, that is
# w * w / 34 for their sum; z is the scaled column's value in either group.
TWO_GROUP_SCORES = f"""WITH RECURSIVE {two_groups((85, 20))},
cells AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(x) AS DOUBLE) AS n1,
    CAST(sum(churn * x) AS DOUBLE) AS y1, CAST(sum(churn * (1 - x)) AS DOUBLE) AS y0
  FROM grouped WHERE split = 'train'),
data AS (SELECT n - n1 AS n0, n1, y0, y1, -sqrt(n1 / (n - n1)) AS z0, sqrt((n - n1) / n1) AS z1
  FROM cells),
steps(i, b, w) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
  UNION ALL
  SELECT i + 1, b - (h22 * gb - h12 * gw) / (h11 * h22 - h12 * h12),
    w - (h11 * gw - h12 * gb) / (h11 * h22 - h12 * h12)
  FROM (SELECT i, b, w, e0 + e1 AS gb, z0 * e0 + z1 * e1 + w / 17 AS gw,
      v0 + v1 AS h11, z0 * v0 + z1 * v1 AS h12, z0 * z0 * v0 + z1 * z1 * v1
        + CAST(1 AS DOUBLE) / 17 AS h22
    FROM (SELECT *, n0 * p0 - y0 AS e0, n1 * p1 - y1 AS e1,
        n0 * p0 * (1 - p0) AS v0, n1 * p1 * (1 - p1) AS v1
      FROM (SELECT *, 1 / (1 + exp(-b - w * z0)) AS p0, 1 / (1 + exp(-b - w * z1)) AS p1
        FROM steps, data WHERE i < 30) a) c) d),
fitted AS (SELECT 1 / (1 + exp(-b - w * z0)) AS p0, 1 / (1 + exp(-b - w * z1)) AS p1
  FROM steps, data WHERE i = 30)
SELECT customer_id, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS churn_prediction,
  round(round(p, 4), 3) AS churn_probability, 'v0' AS model_version,
  'logistic_regression' AS model_type
FROM (SELECT customer_id, CASE WHEN x = 1 THEN p1 ELSE p0 END AS p FROM grouped, fitted) scored"""

# In each round both models order the groups alike, so their areas are equal.
RETRAIN_TWO_GROUPS = f"""WITH {two_groups((75, 30), (95, 8), (80, 25))},
areas AS (SELECT r, max(roc_auc) FILTER (split = 'val') AS val,
    max(roc_auc) FILTER (split = 'test') AS test,
    max(n_samples) FILTER (split = 'test') AS n_samples FROM measured GROUP BY r),
first AS (SELECT test FROM areas WHERE r = 0),
second AS (SELECT a.test, a.test >= 0.8 AND f.test - a.test <= 0.01 AS promoted
  FROM areas a, first f WHERE a.r = 1),
third AS (SELECT a.test >= 0.8
    AND CASE WHEN s.promoted THEN s.test ELSE f.test END - a.test <= 0.01 AS promoted
  FROM areas a, first f, second s WHERE a.r = 2),
attempts AS (SELECT CAST(r AS BIGINT) AS sequence,
    CASE WHEN val >= 0.8 THEN 'random_forest' ELSE 'logistic_regression' END AS model_type,
    CASE r WHEN 0 THEN true WHEN 1 THEN s.promoted ELSE t.promoted END AS promoted,
    a.test AS roc_auc, n_samples
  FROM areas a, second s, third t)
SELECT *, CASE WHEN NOT promoted THEN 'rejected'
  WHEN sequence = max(CASE WHEN promoted THEN sequence END) OVER () THEN 'production'
  ELSE 'archived' END AS status FROM attempts"""

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

ORACLES = {
    "telemetry_model_summary": MODEL_SUMMARY,
    "telemetry_from_csv": MODEL_SUMMARY,
    "telemetry_skew_profile": f"""WITH {TELEMETRY},
counts AS (SELECT vehicle_id, count(*) AS n_rows FROM telemetry
  WHERE engine_temp_c IS NOT NULL GROUP BY vehicle_id)
SELECT vehicle_id, n_rows,
  CAST(n_rows AS DOUBLE) / (SELECT CAST(sum(n_rows) AS DOUBLE) FROM counts) AS share_of_rows,
  CAST(n_rows AS DOUBLE) / (SELECT CAST(median(n_rows) AS DOUBLE) FROM counts) AS times_median
FROM counts""",
    "telemetry_plain_avg": f"WITH {TELEMETRY}, {VEHICLES} SELECT * FROM vehicles",
    "telemetry_salted_avg": f"WITH {TELEMETRY}, {VEHICLES} SELECT * FROM vehicles",
    "telemetry_selective_salt": f"WITH {TELEMETRY}, {VEHICLES} SELECT * FROM vehicles",
    "registry_as_of": """WITH promoted AS (
  SELECT o_orderpriority AS segment, o_orderdate AS trained_on, 'v' || max(o_orderkey) AS model_version
  FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL)
SELECT o.o_orderkey, o.o_orderpriority AS segment, o.o_orderdate, p.model_version, p.trained_on
FROM orders o ASOF LEFT JOIN promoted p ON o.o_orderpriority = p.segment AND o.o_orderdate >= p.trained_on
WHERE o.o_orderstatus <> 'F'""",
    "segment_models": f"""WITH {CUSTOMERS}
SELECT c_nationkey, senior_citizen, count(*) AS n_rows,
  floor(avg(churn) * 10000 + CAST('0.500001' AS DOUBLE)) / 10000 AS probability
FROM customers GROUP BY c_nationkey, senior_citizen""",
    "telemetry_top_vehicles": f"""WITH {TELEMETRY}, {VEHICLES} SELECT * FROM vehicles
ORDER BY total_readings DESC, vehicle_id, vehicle_model LIMIT 10""",
    "telemetry_hash_layout": f"WITH {TELEMETRY}, {VEHICLES} SELECT * FROM vehicles",
    "telemetry_range_layout": f"""WITH {TELEMETRY}
SELECT *, CAST(event_time AS DATE) AS event_day FROM telemetry""",
    "telemetry_iterated": ITERATED,
    "telemetry_iterated_checkpointed": ITERATED,
    "customer_clean": f"WITH {CUSTOMERS} SELECT {COLUMNS} FROM customers",
    "customer_clean_from_csv": f"WITH {CUSTOMERS} SELECT {COLUMNS} FROM customers",
    "customer_churn_rate": f"""WITH {CUSTOMERS}
SELECT CAST(sum(churn) AS DOUBLE) / count(*) AS churn_rate FROM customers""",
    "customer_features": f"""WITH {CUSTOMERS}, {FILLED}
SELECT {COLUMNS}, {DERIVED} FROM filled""",
    "customer_model_matrix": f"""WITH {CUSTOMERS}, {FILLED},
matrix AS (SELECT {COLUMNS}, {DERIVED} FROM filled)
SELECT customer_id, {MODEL_COLUMNS} FROM matrix""",
    "customer_partial_input": f"""WITH {CUSTOMERS},
filled AS (SELECT customer_id, CAST(tenure_months AS DOUBLE) AS tenure_months,
  CAST(0 AS DOUBLE) AS monthly_charges, CAST(0 AS DOUBLE) AS total_charges,
  '0' AS contract_type, '0' AS payment_method, '0' AS internet_service,
  '0' AS online_security, '0' AS online_backup, '0' AS device_protection,
  '0' AS tech_support, '0' AS streaming_tv, '0' AS streaming_movies,
  0 AS senior_citizen, 0 AS partner, 0 AS dependents, 0 AS phone_service,
  0 AS multiple_lines, 0 AS paperless_billing, 0 AS churn FROM customers),
matrix AS (SELECT {COLUMNS}, {DERIVED} FROM filled)
SELECT customer_id, {MODEL_COLUMNS} FROM matrix""",
    "record_validation": f"""WITH {CUSTOMERS}, {FAULTY}, {FAILED}
SELECT customer_id, failed_fields, failed_fields = '' AS is_valid FROM checked""",
    "positional_split": f"""WITH {CUSTOMERS}, {PARTS}
SELECT customer_id, CASE WHEN is_initial THEN 'initial' ELSE 'incoming' END AS part
FROM placed""",
    "positional_split_text": f"""WITH {CUSTOMERS},
named AS (SELECT customer_id, c_custkey, 'store:/exports/of/customers/by/part-0000'
     || CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE c_custkey % 5 END || '-of-many.csv' AS path
   FROM customers)
SELECT customer_id, path, CASE WHEN row_number() OVER (ORDER BY path, c_custkey) <=
     CAST(floor(count(*) OVER () * CAST('0.9' AS DOUBLE)) AS BIGINT)
   THEN 'initial' ELSE 'incoming' END AS part
FROM named""",
    "csv_loose_numbers": f"""WITH {CUSTOMERS}
SELECT customer_id, CASE WHEN c_custkey % 5 < 2 THEN tenure_months END AS tenure_months
FROM customers""",
    "split_tables": f"""WITH {CUSTOMERS}, {PARTS}
SELECT {COLUMNS}, 'initial' AS part FROM initial
UNION ALL SELECT {COLUMNS}, 'incoming' FROM incoming""",
    "stratified_split": f"""WITH {CUSTOMERS}, {SPLIT}
SELECT customer_id, churn, split FROM split""",
    "stratified_split_sizes": f"""WITH {CUSTOMERS}, {SPLIT}
SELECT churn, split, count(*) AS n_rows FROM split GROUP BY churn, split""",
    "merge_latest": MERGED,
    "merge_latest_incremental": MERGED,
    "concat_batches": f"""WITH {CUSTOMERS}, {PARTS}
SELECT customer_id, tenure_months, churn, CAST(NULL AS INTEGER) AS c_nationkey FROM initial
UNION ALL SELECT customer_id, NULL, churn, c_nationkey FROM incoming""",
    "stream_ingest": INGESTED,
    "ingest_redelivered": STREAMED.format(second="incoming") + """
SELECT * FROM latest JOIN rows USING (batch_id)""",
    "ingest_odd_names": STREAMED.format(second="(SELECT * FROM initial WHERE false)") + """
SELECT * REPLACE (CAST(least(batch_id, 2) AS BIGINT) AS batch_id) FROM latest""",
    "ingestion_log_counts": f"""WITH {CUSTOMERS}, {PARTS}
SELECT CAST(0 AS BIGINT) AS batch_id, 'ingested' AS status, '' AS missing_columns,
  count(*) AS n_rows FROM initial
UNION ALL SELECT 1, 'ingested', '', count(*) FROM incoming
UNION ALL SELECT 2, 'ingested', '', count(*) FROM corrected
UNION ALL SELECT 2, 'rejected', 'contract_type', 0""",
    "table_round_trip": f"""WITH {CUSTOMERS}, {PARTS}
SELECT {COLUMNS}, 0 AS version FROM initial
UNION ALL SELECT {COLUMNS}, 1 FROM incoming""",
    "table_deltas": f"""{CHANGED}
SELECT *, 3 AS version FROM changed
UNION ALL SELECT *, 1 FROM everything WHERE batch_id < 2""",
    "table_compaction": f"""{CHANGED}
SELECT * REPLACE (CASE WHEN tenure_months = 5 THEN 1 ELSE churn END AS churn,
                  CASE WHEN tenure_months = 5 THEN 4 ELSE batch_id END AS batch_id) FROM changed""",
    "recent_rows": f"""WITH {CUSTOMERS}
SELECT {COLUMNS} FROM customers ORDER BY c_custkey DESC LIMIT 400""",
    "missing_fractions": f"WITH {TELEMETRY} "
    + _missing(
        [
            "event_id",
            "vehicle_id",
            "vehicle_model",
            "event_time",
            "engine_temp_c",
            "speed_kmph",
            "miles_driven",
        ]
    ),
    "quality_issues": f"""WITH {CUSTOMERS}, {FAULTY}, {ISSUES}
SELECT column_name, kind, value, message FROM issues""",
    "quality_report": f"""WITH {CUSTOMERS}, {FAULTY}, {ISSUES}
SELECT (SELECT count(*) FROM faulty) AS n_rows_checked,
  coalesce(string_agg(message, ' | ' ORDER BY nth), '') AS issues, count(*) = 0 AS passed
FROM issues""",
    "stream_quality": f"""WITH {CUSTOMERS}, {FAULTY}, {ISSUES}
SELECT (SELECT count(*) FROM faulty) AS n_rows_checked,
  coalesce(string_agg(message, ' | ' ORDER BY nth), '') AS issues, count(*) = 0 AS passed
FROM issues""",
    "drift_report": f"""WITH {CUSTOMERS},
recent AS (SELECT * FROM customers ORDER BY c_custkey DESC LIMIT 400)
{_drift("customers", "recent")}""",
    "drift_from_profiles": f"""WITH {CUSTOMERS},
recent AS (SELECT * FROM customers ORDER BY c_custkey DESC LIMIT 400)
{_drift("customers", "recent")}""",
    "drift_of_latest_batch": f"""WITH {CUSTOMERS},
recent AS (SELECT * FROM customers WHERE c_nationkey = (SELECT max(c_nationkey) FROM customers))
{_drift("customers", "recent")}""",
    "drift_by_batch": f"WITH {CUSTOMERS} {_drift('customers', 'customers', 'c_nationkey')}",
    "drift_by_batch_summary": f"""WITH {CUSTOMERS},
report AS ({_drift("customers", "customers", "c_nationkey")})
SELECT c_nationkey, coalesce(max(drift_zscore), 0) AS max_drift_zscore,
  bool_or(flagged) AS drift_detected FROM report GROUP BY c_nationkey""",
    "stream_drift": f"WITH {CUSTOMERS}, {PARTS} {_drift('initial', 'incoming')}",
    "roc_auc": f"WITH {SCORED} {_auc('scored', 'n_chars', 'quality')}",
    "roc_auc_infinite": f"""WITH {SCORED}, extreme AS (
  SELECT source, quality, CASE doc_id % 7 WHEN 0 THEN 'inf'::DOUBLE WHEN 1 THEN '-inf'::DOUBLE
    ELSE CAST(n_chars AS DOUBLE) END AS score FROM scored)
{_auc("extreme", "score", "quality", "source")}""",
    "roc_auc_by_source": f"WITH {SCORED} {_auc('scored', 'n_chars', 'quality', 'source')}",
    "accuracy": f"""WITH {SCORED}
SELECT CAST(count(*) FILTER (predicted = quality) AS DOUBLE) / count(*) AS accuracy,
  count(*) AS n_samples FROM scored""",
    "accuracy_by_source": f"""WITH {SCORED}
SELECT source, CAST(count(*) FILTER (predicted = quality) AS DOUBLE) / count(*) AS accuracy,
  count(*) AS n_samples FROM scored GROUP BY source""",
    "latency_summary": LATENCY,
    "latency_summary_overall": LATENCY_ALL,
    "header_check": f"""WITH {CUSTOMERS},
good AS (SELECT count(*) AS n_rows, count(contract_type) AS n_contracts FROM customers)
SELECT 'expected' AS export, 'ingested' AS status, '' AS missing_columns, * FROM good
UNION ALL SELECT 'rearranged', 'ingested', '', * FROM good
UNION ALL SELECT 'misnamed', 'rejected', 'churn,contract_type', 0, 0""",
    "scaled_features": f"""WITH {CUSTOMERS}, {FILLED},
matrix AS (SELECT {COLUMNS}, {DERIVED} FROM filled)
SELECT customer_id, {", ".join(
    f"round(coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0), 6) + 0 AS {c}"
    for c in [name.strip() for name in MODEL_COLUMNS.split(",")]
)} FROM matrix""",
    "train_evaluate_two_groups": f"""WITH {two_groups((85, 20))}
SELECT model, split, accuracy, roc_auc, n_samples
FROM measured, (VALUES ('baseline'), ('candidate')) models(model)""",
    "batch_scores_two_groups": TWO_GROUP_SCORES,
    "stream_scores_two_groups": TWO_GROUP_SCORES,
    "retrain_cycle_two_groups": RETRAIN_TWO_GROUPS,
    "formula_scores": FORMULA_SCORES,
    "stream_formula_scores": FORMULA_SCORES,
    "promotion_decisions": PROMOTION,
    "retrain_decisions": RETRAIN,
    "retrain_log": RETRAIN,
    "registry_current": f"""WITH {REGISTRY} SELECT * FROM registry WHERE promoted
QUALIFY row_number() OVER (PARTITION BY segment ORDER BY sequence DESC) = 1""",
    "registry_status": f"""WITH {REGISTRY}
SELECT sequence, segment, CASE WHEN NOT promoted THEN 'rejected'
  WHEN sequence = max(CASE WHEN promoted THEN sequence END) OVER (PARTITION BY segment)
  THEN 'production' ELSE 'archived' END AS status FROM registry""",
    "stream_quarantine": f"""WITH {CUSTOMERS}, {FAULTY}, {FAILED}
SELECT customer_id, failed_fields FROM checked WHERE failed_fields <> ''""",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES
    ),
}
