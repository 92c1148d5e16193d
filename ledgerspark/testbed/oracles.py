"""The testbed queries in plain SQL over the same tables, written independently."""

from __future__ import annotations

TXN = """
txn AS (
  SELECT
    CASE WHEN l_quantity = 7 THEN NULL
         ELSE concat(l_orderkey, '-', l_linenumber) END AS transaction_id,
    CASE WHEN l_linenumber = 7 AND round(l_tax * 100) = 1 THEN NULL
         ELSE l_shipdate END AS created_at_timestamp,
    CASE WHEN round(l_discount * 100) = 9 AND round(l_tax * 100) = 7 THEN -l_extendedprice
         WHEN round(l_discount * 100) = 5 AND round(l_tax * 100) = 2 THEN NULL
         WHEN round(l_discount * 100) = 3 AND round(l_tax * 100) = 4 THEN 0.0
         ELSE l_extendedprice END::DOUBLE AS amount,
    CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN 'GBP'
         WHEN round(l_discount * 100) = 2 AND round(l_tax * 100) = 6 THEN 'USD'
         ELSE 'EUR' END AS currency,
    CASE WHEN round(l_discount * 100) = 10 AND round(l_tax * 100) = 8 THEN NULL
         ELSE s_name END AS charged_partner,
    CASE WHEN l_returnflag = 'R' THEN 'cancelled' ELSE 'processed' END AS status
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
)"""

STG = (
    TXN
    + """,
stg AS (
  SELECT
    transaction_id,
    strftime(created_at_timestamp, '%m/%d/%Y %H:%M:%S') AS created_at_raw,
    amount, currency, charged_partner, status,
    created_at_timestamp AS created_at,
    day(created_at_timestamp)::INTEGER AS day,
    dayname(created_at_timestamp) AS day_name,
    week(created_at_timestamp)::INTEGER AS week_of_year,
    (month(created_at_timestamp) = 12
      OR (month(created_at_timestamp) = 1 AND day(created_at_timestamp) <= 7))
      AS is_festive_season,
    md5(concat(coalesce(transaction_id, '_dbt_utils_surrogate_key_null_'), '-',
               coalesce(charged_partner, '_dbt_utils_surrogate_key_null_')))
      AS transaction_partner_sk
  FROM txn
)"""
)


def _quality(amount_test: str = "amount <= 0") -> str:
    return (
        STG
        + f""",
counted AS (
  SELECT *,
    CASE WHEN transaction_id IS NULL THEN 0
         ELSE count(*) OVER (PARTITION BY transaction_id) END::BIGINT
      AS transaction_id_occurrences,
    (count(*) OVER (PARTITION BY transaction_partner_sk))::BIGINT
      AS transaction_partner_sk_occurrences,
    year(created_at)::INTEGER AS year,
    month(created_at)::INTEGER AS month
  FROM stg
),
quality AS (
  SELECT *,
    transaction_id IS NULL AS has_null_transaction_id,
    transaction_id_occurrences > 1 AS has_duplicate_transaction_id,
    transaction_partner_sk_occurrences > 1 AS has_duplicate_transaction_partner_key,
    charged_partner IS NULL AS has_missing_partner,
    created_at IS NULL AS has_missing_created_at,
    {amount_test} AS has_non_positive_amount,
    (transaction_id IS NULL OR transaction_id_occurrences > 1
      OR transaction_partner_sk_occurrences > 1 OR charged_partner IS NULL
      OR created_at IS NULL OR {amount_test}) AS is_rejected,
    concat_ws(',',
      CASE WHEN transaction_id IS NULL THEN 'null_transaction_id' END,
      CASE WHEN transaction_id_occurrences > 1 THEN 'duplicate_transaction_id' END,
      CASE WHEN transaction_partner_sk_occurrences > 1
           THEN 'duplicate_transaction_partner_key' END,
      CASE WHEN charged_partner IS NULL THEN 'missing_partner' END,
      CASE WHEN created_at IS NULL THEN 'missing_created_at' END,
      CASE WHEN {amount_test} THEN 'non_positive_amount' END) AS rejection_reason
  FROM counted
),
accepted AS (SELECT * FROM quality WHERE NOT is_rejected),
rejected AS (SELECT * FROM quality WHERE is_rejected)"""
    )


QUALITY = _quality()

ACCEPTED_LIST = """transaction_partner_sk, transaction_id, created_at_raw, amount, currency,
  charged_partner, status, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
  year, month, day, day_name, week_of_year, is_festive_season"""
FLAG_LIST = """transaction_id_occurrences, transaction_partner_sk_occurrences,
  has_null_transaction_id, has_duplicate_transaction_id,
  has_duplicate_transaction_partner_key, has_missing_partner, has_missing_created_at,
  has_non_positive_amount, is_rejected, rejection_reason"""
STG_LIST = """transaction_id, created_at_raw, amount, currency, charged_partner, status,
  strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, day, day_name, week_of_year,
  is_festive_season, transaction_partner_sk"""

MONTHLY = f"""WITH {QUALITY}
SELECT charged_partner AS partner,
  strftime(date_trunc('month', created_at), '%Y-%m-%d') AS month,
  round(sum(CASE WHEN currency = 'EUR' THEN amount
                 WHEN currency = 'GBP' THEN amount / 0.8466166015625::DOUBLE END
        )::DECIMAL(38,10), 2)::DOUBLE AS total_premium
FROM accepted WHERE status = 'processed'
GROUP BY 1, 2"""

MONTH_TOTALS = """
SELECT year(created_at_timestamp)::INTEGER AS year,
  month(created_at_timestamp)::INTEGER AS month,
  count(*)::BIGINT AS n_rows,
  round(sum(amount)::DECIMAL(38,10), 2)::DOUBLE AS amount
FROM {source} GROUP BY 1, 2"""

FILES = """
files AS (
  SELECT doc_id, concat('landing/', source, '/', doc_id) AS path, n_chars AS size_bytes,
    sha256(text) AS content_digest,
    DATE '2012-01-01' + floor(n_chars / 30)::INTEGER AS first_day
  FROM documents
),
now AS (
  SELECT doc_id, path, size_bytes, content_digest,
    (year(first_day) * 10000 + month(first_day) * 100 + day(first_day))::INTEGER AS file_date,
    (year(first_day) * 100 + month(first_day))::INTEGER AS month_id
  FROM files
),
old AS (
  SELECT path, size_bytes + toxic AS size_bytes,
    CASE WHEN toxic = 1 THEN NULL
         WHEN quality = 0 THEN sha256(content_digest)
         ELSE content_digest END AS content_digest,
    file_date,
    CASE WHEN quality = 1 THEN month_id
         WHEN month_id % 100 = 12 THEN month_id + 89
         ELSE month_id + 1 END AS month_id
  FROM now JOIN labels USING (doc_id)
),
changed AS (
  SELECT now.*, old.month_id AS old_month_id FROM now JOIN old USING (path)
  WHERE CASE WHEN old.content_digest IS NOT NULL
             THEN now.content_digest <> old.content_digest
             ELSE now.size_bytes <> old.size_bytes END
),
seen AS (
  SELECT coalesce(old.content_digest, now.content_digest) AS content_digest
  FROM old JOIN now USING (path)
),
fresh AS (
  SELECT *, row_number() OVER (PARTITION BY content_digest ORDER BY file_date, path) AS copy
  FROM now WHERE path NOT IN (SELECT path FROM old)
),
unseen AS (
  SELECT * FROM fresh
  WHERE copy = 1 AND content_digest NOT IN (SELECT content_digest FROM seen)
),
impacted AS (
  SELECT month_id FROM changed UNION SELECT old_month_id FROM changed
)"""

EVENT_SIDES = """
sides AS (
  SELECT event_id, user_id, event_type, value, props,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type <> 'error' AS stored,
    event_type IN ('click', 'error') AS updated
  FROM events
)"""

ORDER_RUNS = """
runs AS (
  SELECT o_orderpriority, max(o_orderkey) AS run_at, count(*) AS rows_written,
    CASE WHEN left(o_orderpriority, 1) = '5' THEN 'skipped' ELSE 'completed' END
      AS silver_status
  FROM orders GROUP BY o_orderpriority
)"""



def bronze_rows(factor: str) -> str:
    """Raw rows with their dates; ``factor`` scales the amounts."""
    return f"""WITH {TXN}
SELECT transaction_id, strftime(created_at_timestamp, '%m/%d/%Y %H:%M:%S') AS created_at,
  amount * {factor} AS amount, currency, charged_partner, status,
  year(created_at_timestamp)::INTEGER AS year, month(created_at_timestamp)::INTEGER AS month,
  day(created_at_timestamp)::INTEGER AS day
FROM txn"""


LOADS = f"""WITH {TXN},
r AS (
  SELECT coalesce(year(created_at_timestamp) * 100 + month(created_at_timestamp), 0) AS m,
    status = 'processed' AS first FROM txn),
second AS (SELECT DISTINCT m FROM r WHERE NOT first)
SELECT 'completed' AS silver_status, 'premium_transaction' AS table_name,
  (SELECT count(*) FROM r WHERE first)::BIGINT AS rows_written, 'replace' AS write_mode,
  false AS was_skipped, NULL::VARCHAR AS skip_reason,
  (SELECT string_agg(m::VARCHAR, ',' ORDER BY m) FROM (SELECT DISTINCT m FROM r WHERE first)) AS months,
  0::BIGINT AS still_pending
UNION ALL SELECT 'completed', 'premium_transaction',
  (SELECT count(*) FROM r WHERE m IN (SELECT m FROM second)), 'replace', false, NULL,
  (SELECT string_agg(m::VARCHAR, ',' ORDER BY m) FROM second), 0
UNION ALL SELECT 'skipped', 'premium_transaction', 0, 'replace', true,
  'no_pending_bronze_partitions', '', 0"""

# The second build: every row, and the processed rows of first days once more.
BUILDS = f"""{STG},
first AS (SELECT * FROM stg WHERE status = 'processed'),
twice AS (SELECT * FROM stg UNION ALL SELECT * FROM first WHERE day = 1)"""


def _accepted_of(source: str) -> str:
    return f"""SELECT transaction_partner_sk, transaction_id, amount, currency, charged_partner,
  status, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
FROM (SELECT *, count(*) OVER (PARTITION BY transaction_id) AS a,
    count(*) OVER (PARTITION BY transaction_partner_sk) AS b FROM {source})
WHERE transaction_id IS NOT NULL AND a = 1 AND b = 1 AND charged_partner IS NOT NULL
  AND created_at IS NOT NULL AND amount > 0"""


ORACLES: dict[str, str] = {
    "monthly_partner_premiums": MONTHLY,
    "eur_mart_from_currency_totals": MONTHLY,
    "report_export": f"""SELECT *, row_number() OVER (ORDER BY month DESC, partner ASC) AS position
FROM ({MONTHLY})""",
    "end_to_end_from_files": MONTHLY,
    "monthly_partner_premiums_by_currency": f"""WITH {QUALITY}
SELECT charged_partner AS partner,
  strftime(date_trunc('month', created_at), '%Y-%m-%d') AS month, currency,
  round(sum(amount)::DECIMAL(38,10), 2)::DOUBLE AS total_premium
FROM accepted WHERE status = 'processed' GROUP BY 1, 2, 3""",
    "dim_partner": f"""WITH {QUALITY}
SELECT DISTINCT md5(charged_partner) AS partner_sk, charged_partner AS partner_name
FROM accepted WHERE charged_partner IS NOT NULL""",
    "dim_date": f"""WITH {QUALITY}
SELECT DISTINCT strftime(created_at, '%Y%m%d')::BIGINT AS date_sk,
  strftime(created_at, '%Y-%m-%d') AS full_date, year, month, day, day_name, week_of_year,
  is_festive_season
FROM accepted WHERE created_at IS NOT NULL""",
    "fct_transaction": f"""WITH {QUALITY},
partners AS (
  SELECT DISTINCT md5(charged_partner) AS partner_sk, charged_partner AS partner_name
  FROM accepted WHERE charged_partner IS NOT NULL
)
SELECT transaction_partner_sk AS transaction_sk, transaction_id, partner_sk,
  strftime(created_at, '%Y%m%d')::BIGINT AS date_sk, created_at_raw,
  strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, amount, currency, status
FROM accepted LEFT JOIN partners ON charged_partner = partner_name""",
    "staging_surrogate_key": f"WITH {STG} SELECT {STG_LIST} FROM stg",
    "transaction_quality": f"WITH {QUALITY} SELECT {ACCEPTED_LIST}, {FLAG_LIST} FROM quality",
    "accepted_transactions": f"WITH {QUALITY} SELECT {ACCEPTED_LIST} FROM accepted",
    "rejected_transactions": f"WITH {QUALITY} SELECT {ACCEPTED_LIST}, {FLAG_LIST} FROM rejected",
    "unclassified_transactions": f"""WITH {QUALITY}
SELECT {ACCEPTED_LIST} FROM quality WHERE is_rejected IS NULL""",
    "null_amount_rejected": f"""WITH {_quality("(amount IS NULL OR amount <= 0)")}
SELECT is_rejected, rejection_reason, count(*)::BIGINT AS n_rows FROM quality GROUP BY 1, 2""",
    "parse_event_time": f"""WITH {TXN}
SELECT strftime(created_at_timestamp, '%m/%d/%Y %H:%M:%S') AS created_at, amount,
  strftime(strptime(strftime(created_at_timestamp, '%m/%d/%Y %H:%M:%S'),
                    '%m/%d/%Y %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed,
  year(created_at_timestamp)::INTEGER AS year, month(created_at_timestamp)::INTEGER AS month,
  day(created_at_timestamp)::INTEGER AS day
FROM txn""",
    "time_features": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
  dayname(o_orderdate) AS day_name, week(o_orderdate)::INTEGER AS week_of_year,
  month(o_orderdate) = 12 OR (month(o_orderdate) = 1 AND day(o_orderdate) <= 7)
    AS is_festive_season
FROM orders""",
    "event_time_features": """
SELECT event_id, dayname(ts) AS day_name, week(ts)::INTEGER AS week_of_year,
  month(ts) = 12 OR (month(ts) = 1 AND day(ts) <= 7) AS is_festive_season
FROM events""",
    "fx_normalize": f"""WITH {TXN}
SELECT transaction_id, currency, amount,
  CASE WHEN currency = 'EUR' THEN amount
       WHEN currency = 'GBP' THEN amount / 0.8466166015625::DOUBLE END AS amount_eur
FROM txn""",
    "filename_date": """
SELECT o_orderkey,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN year(o_orderdate) END::INTEGER AS year,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN month(o_orderdate) END::INTEGER AS month,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN day(o_orderdate) END::INTEGER AS day
FROM orders""",
    "day_coverage": f"""WITH {TXN}
SELECT year, month, coalesce(string_agg(day, ',' ORDER BY day), '') AS days
FROM (SELECT DISTINCT year(created_at_timestamp)::INTEGER AS year,
        month(created_at_timestamp)::INTEGER AS month,
        day(created_at_timestamp)::INTEGER AS day FROM txn)
GROUP BY year, month""",
    "missing_days": f"""WITH {TXN},
odd AS (
  SELECT DISTINCT created_at_timestamp::DATE AS d FROM txn
  WHERE day(created_at_timestamp) % 2 = 1
),
months AS (SELECT DISTINCT date_trunc('month', d)::DATE AS m FROM odd),
expected AS (
  SELECT m, unnest(generate_series(m, CASE WHEN m = DATE '2001-06-01' THEN DATE '2001-06-15'
    ELSE last_day(m) END, INTERVAL 1 DAY))::DATE AS d FROM months
),
gaps AS (SELECT e.m, day(e.d)::INTEGER AS d FROM expected e ANTI JOIN odd USING (d))
SELECT year(m)::INTEGER AS year, month(m)::INTEGER AS month,
  coalesce(string_agg(d, ',' ORDER BY d), '') AS missing_days
FROM months LEFT JOIN gaps USING (m) GROUP BY m""",
    "month_range": f"""WITH {TXN},
spans AS (
  SELECT charged_partner, date_trunc('month', min(created_at_timestamp)) AS a,
    date_trunc('month', max(created_at_timestamp)) AS b
  FROM txn GROUP BY charged_partner
)
SELECT charged_partner,
  strftime(unnest(generate_series(a, b, INTERVAL 1 MONTH)), '%Y-%m-%d') AS month FROM spans""",
    "available_months": f"""WITH {TXN}
SELECT DISTINCT strftime(date_trunc('month', created_at_timestamp), '%Y-%m-%d') AS month
FROM txn WHERE created_at_timestamp IS NOT NULL""",
    "backfill_plan": f"""WITH {TXN}, {ORDER_RUNS},
requested AS (
  SELECT strftime(unnest(generate_series(
    date_trunc('month', min(o_orderdate)) - INTERVAL 3 MONTH,
    date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)), '%Y-%m') AS month
  FROM orders
),
available AS (
  SELECT DISTINCT strftime(created_at_timestamp, '%Y-%m') AS month FROM txn
  WHERE created_at_timestamp IS NOT NULL
),
loaded AS (
  SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders
  WHERE o_orderpriority = (SELECT max_by(o_orderpriority, run_at) FROM runs)
)
SELECT 'requested' AS status, month FROM requested
UNION ALL SELECT 'available', month FROM available
UNION ALL SELECT 'selected', month FROM requested SEMI JOIN available USING (month)
UNION ALL SELECT 'not_available', month FROM requested ANTI JOIN available USING (month)
UNION ALL SELECT 'latest_loaded', month FROM loaded""",
    "run_summary": f"""WITH {ORDER_RUNS}
SELECT run_at::BIGINT AS run_at, silver_status = 'completed' AS has_new_data,
  rows_written::BIGINT AS rows_written, silver_status, o_orderpriority AS table_name
FROM runs""",
    "payload_dates": """
SELECT concat('premium_transaction_', o_orderkey, '_2024_02_29.json') AS path,
  CASE WHEN o_orderstatus = 'P' THEN 20240229
       ELSE strftime(o_orderdate, '%Y%m%d')::INTEGER END::INTEGER AS file_date,
  CASE WHEN o_orderstatus = 'P' THEN '202402'
       WHEN o_orderstatus = 'O' THEN concat(strftime(o_orderdate, '%Y%m'), ',',
         strftime(o_orderdate::DATE + 40, '%Y%m'))
       ELSE concat('0,', strftime(o_orderdate, '%Y%m')) END AS months
FROM orders""",
    "content_dedupe": f"""WITH {FILES},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY content_digest ORDER BY file_date, path) AS copy
  FROM now
)
SELECT path, content_digest, file_date FROM ranked WHERE copy = 1""",
    "changed_files": f"""WITH {FILES}
SELECT path, false AS is_new FROM changed UNION ALL SELECT path, true FROM unseen""",
    "ignored_duplicates": f"""WITH {FILES}
SELECT path, content_digest FROM fresh WHERE path NOT IN (SELECT path FROM unseen)""",
    "impacted_months": f"WITH {FILES} SELECT month_id FROM impacted",
    "impacted_files": f"""WITH {FILES}
SELECT path, file_date FROM now
WHERE month_id IN (SELECT month_id FROM impacted) OR path IN (SELECT path FROM unseen)""",
    "manifest_merge": f"""WITH {FILES}
SELECT path, size_bytes, content_digest, file_date, month_id::VARCHAR AS months FROM old
UNION ALL
SELECT path, size_bytes, content_digest, file_date, month_id::VARCHAR FROM unseen""",
    "check_not_null": f"WITH {STG} SELECT {STG_LIST} FROM stg WHERE charged_partner IS NULL",
    "check_unique": f"""WITH {STG}
SELECT transaction_id, count(*)::BIGINT AS n_records FROM stg
WHERE transaction_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "check_accepted_values": f"""WITH {STG}
SELECT currency, count(*)::BIGINT AS n_records FROM stg
WHERE currency NOT IN ('EUR', 'GBP') GROUP BY 1""",
    "check_relationships": f"""WITH {QUALITY}
SELECT transaction_id AS from_field, count(*)::BIGINT AS n_records FROM stg
WHERE transaction_id NOT IN (SELECT transaction_id FROM accepted)
GROUP BY 1""",
    "check_unique_combination": f"""WITH {STG}
SELECT transaction_id, charged_partner, count(*)::BIGINT AS n_records FROM stg
GROUP BY 1, 2 HAVING count(*) > 1""",
    "check_row_counts": f"""WITH {QUALITY},
sizes AS (
  SELECT count(*)::BIGINT AS base_row_count,
    (count(*) FILTER (NOT is_rejected))::BIGINT AS accepted_row_count,
    (count(*) FILTER (is_rejected))::BIGINT AS rejected_row_count
  FROM quality
)
SELECT * FROM sizes WHERE base_row_count <> accepted_row_count + rejected_row_count""",
    "check_no_overlap": f"""WITH {STG}
SELECT a.transaction_id AS overlapping_key, count(*)::BIGINT AS n_pairs
FROM stg a JOIN stg b ON a.transaction_id = b.transaction_id
WHERE a.status = 'processed' AND b.status <> 'processed' GROUP BY 1""",
    "bronze_append": f"WITH {TXN} {MONTH_TOTALS.format(source='txn')}",
    "json_ingest": f"WITH {TXN} {MONTH_TOTALS.format(source='txn')}",
    "incremental_ingest": f"WITH {TXN} {MONTH_TOTALS.format(source='txn')}",
    "pending_after_ingest": f"""WITH {TXN}
SELECT year, month, coalesce(string_agg(day, ',' ORDER BY day), '') AS days
FROM (SELECT DISTINCT year(created_at_timestamp)::INTEGER AS year,
        month(created_at_timestamp)::INTEGER AS month,
        day(created_at_timestamp)::INTEGER AS day FROM txn)
GROUP BY year, month""",
    "manifest_after_ingest": f"""WITH {TXN}
SELECT DISTINCT coalesce(year(created_at_timestamp) * 100 + month(created_at_timestamp), 0)
  ::INTEGER AS month_id, 0::BIGINT AS files_not_described
FROM txn""",
    "bronze_rebuild": f"""WITH {TXN},
kept AS (
  SELECT * FROM txn
  WHERE created_at_timestamp IS NULL OR year(created_at_timestamp) <> 1997
    OR (currency = 'EUR' AND month(created_at_timestamp) <> 5)
)
{MONTH_TOTALS.format(source='kept')}""",
    "table_replace": f"""WITH {EVENT_SIDES}
SELECT event_id, user_id, event_type, ts, props, value * 2 AS value FROM sides WHERE updated""",
    "table_append": f"""WITH {EVENT_SIDES}
SELECT event_id, user_id, event_type, ts, props, value FROM sides WHERE stored
UNION ALL SELECT event_id, user_id, event_type, ts, props, value * 2 FROM sides WHERE updated""",
    "table_upsert": f"""WITH {EVENT_SIDES}
SELECT event_id, user_id, event_type, ts, props, CASE WHEN updated THEN value * 2 ELSE value END AS value
FROM sides WHERE stored OR updated""",
    "incremental_merge": f"""WITH {EVENT_SIDES}
SELECT event_id, user_id, event_type, ts, props, CASE WHEN updated THEN value * 2 ELSE value END AS value
FROM sides WHERE stored OR updated""",
    "table_upsert_by_month": """
WITH sides AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderstatus <> 'P' AS stored,
    o_orderstatus <> 'O' AND year(o_orderdate) = 1997 AS updated
  FROM orders
),
merged AS (
  SELECT o_orderkey, o_orderstatus,
    CASE WHEN updated THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
    CASE WHEN updated AND o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 MONTH
         ELSE o_orderdate END AS d
  FROM sides WHERE stored OR updated
)
SELECT o_orderkey, o_orderstatus, o_totalprice,
  strftime(d, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
  year(d)::INTEGER AS year, month(d)::INTEGER AS month
FROM merged""",
    "warehouse_checks": f"""WITH {QUALITY},
c AS (
  SELECT
    (SELECT count(*) FROM quality WHERE is_rejected IS NULL) AS unclassified,
    (SELECT count(*) FROM rejected WHERE has_non_positive_amount IS NULL) AS unknown_amounts,
    (SELECT count(*) FROM (
       SELECT 1 FROM accepted WHERE status = 'processed'
       GROUP BY charged_partner, date_trunc('month', created_at)
       HAVING count(*) FILTER (currency IN ('EUR', 'GBP')) = 0)) AS null_totals,
    (SELECT count(DISTINCT currency) FROM accepted
      WHERE currency NOT IN ('EUR', 'GBP')) AS odd_currencies,
    (SELECT count(DISTINCT currency) FROM accepted
      WHERE currency NOT IN ('EUR', 'GBP') AND status = 'processed') AS odd_reported
)
SELECT relation, "check", column_name, failures::BIGINT AS failures FROM (
  SELECT 'stg_premium__transactions' AS relation, 'not_null' AS "check",
    'transaction_partner_sk' AS column_name, 0 AS failures
  UNION ALL SELECT 'premium_transactions', 'not_null', unnest(['transaction_partner_sk',
    'transaction_id', 'currency', 'charged_partner', 'created_at', 'amount']), 0
  UNION ALL SELECT 'premium_transactions', 'unique',
    unnest(['transaction_partner_sk', 'transaction_id']), 0
  UNION ALL SELECT 'premium_transactions', 'accepted_values', 'currency', odd_currencies FROM c
  UNION ALL SELECT 'premium_transactions', 'row_counts_match', '',
    CASE WHEN unclassified > 0 THEN 1 ELSE 0 END FROM c
  UNION ALL SELECT 'premium_transactions', 'no_overlap', 'transaction_partner_sk', 0
  UNION ALL SELECT 'premium_rejected_transactions', 'not_null',
    unnest(['transaction_partner_sk', 'transaction_id_occurrences',
    'transaction_partner_sk_occurrences', 'is_rejected', 'rejection_reason']), 0
  UNION ALL SELECT 'premium_rejected_transactions', 'not_null', 'has_non_positive_amount',
    unknown_amounts FROM c
  UNION ALL SELECT 'dim_partner', unnest(['not_null', 'unique']), 'partner_sk', 0
  UNION ALL SELECT 'dim_partner', unnest(['not_null', 'unique']), 'partner_name', 0
  UNION ALL SELECT 'dim_date', unnest(['not_null', 'unique']), 'date_sk', 0
  UNION ALL SELECT 'dim_date', unnest(['not_null', 'unique']), 'full_date', 0
  UNION ALL SELECT 'fct_transaction', 'not_null', unnest(['transaction_sk', 'transaction_id',
    'partner_sk', 'date_sk', 'amount']), 0
  UNION ALL SELECT 'fct_transaction', 'unique', 'transaction_sk', 0
  UNION ALL SELECT 'fct_transaction', 'relationships', unnest(['partner_sk', 'date_sk']), 0
  UNION ALL SELECT 'monthly_partner_premiums', 'not_null', unnest(['partner', 'month']), 0
  UNION ALL SELECT 'monthly_partner_premiums', 'not_null', 'total_premium', null_totals FROM c
  UNION ALL SELECT 'monthly_partner_premiums', 'unique_combination', 'partner,month', 0
  UNION ALL SELECT 'monthly_partner_premiums_by_currency', 'not_null',
    unnest(['partner', 'month', 'currency', 'total_premium']), 0
  UNION ALL SELECT 'monthly_partner_premiums_by_currency', 'unique_combination',
    'partner,month,currency', 0
  UNION ALL SELECT 'monthly_partner_premiums_by_currency', 'accepted_values', 'currency',
    odd_reported FROM c
)""",
    "ingest_correction_with_copies": bronze_rows("CASE WHEN status = 'processed' THEN 2 ELSE 1 END"),
    "ingest_after_archiving": bronze_rows("CASE WHEN status = 'processed' THEN 1 ELSE 2 END"),
    "append_second_file_same_month": bronze_rows("1"),
    "ingest_run_log": LOADS,
    "schema_drift_report": f"""WITH {TXN}
SELECT field, frozen_type, observed_type, status,
  (SELECT count(*) FROM txn WHERE status <> 'processed')::BIGINT AS rows_without_status
FROM (VALUES ('status', 'string', NULL, 'missing'), ('channel', NULL, 'string', 'added'))
  AS d(field, frozen_type, observed_type, status)""",
    "ingest_acknowledged_copies": f"""WITH {TXN}
SELECT count(*)::BIGINT AS n_rows, 0::INTEGER AS not_ignored_first, 0::INTEGER AS ignored_again,
  0::INTEGER AS files_without_a_copy
FROM txn WHERE status = 'processed'""",
    "warehouse_sync_two_builds": f"WITH {BUILDS} {_accepted_of('twice')}",
    "warehouse_merge_two_builds": f"""WITH {BUILDS},
a AS ({_accepted_of('first')}),
b AS ({_accepted_of('twice')})
SELECT * FROM b UNION ALL
SELECT * FROM a WHERE transaction_partner_sk NOT IN (SELECT transaction_partner_sk FROM b)""",
    "published_views": f"""WITH {QUALITY},
m AS ({MONTHLY.split(QUALITY, 1)[1]})
SELECT 'stg_premium__transactions' AS relation, count(*) AS n_rows FROM stg
UNION ALL SELECT 'premium_transaction_quality', count(*) FROM quality
UNION ALL SELECT 'premium_transactions', count(*) FROM accepted
UNION ALL SELECT 'premium_rejected_transactions', count(*) FROM rejected
UNION ALL SELECT 'dim_partner', count(DISTINCT charged_partner) FROM accepted
UNION ALL SELECT 'dim_date', count(DISTINCT created_at::DATE) FROM accepted
UNION ALL SELECT 'fct_transaction', count(*) FROM accepted
UNION ALL SELECT 'monthly_partner_premiums', count(*) FROM m
UNION ALL SELECT 'monthly_partner_premiums_by_currency', count(*) FROM (
  SELECT DISTINCT charged_partner, currency, date_trunc('month', created_at) FROM accepted
  WHERE status = 'processed')""",
}
