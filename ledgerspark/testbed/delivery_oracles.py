"""SQL of the queries over several deliveries."""

from __future__ import annotations

from ledgerspark.testbed.oracles import (
    ACCEPTED_LIST,
    FILES,
    FLAG_LIST,
    MONTHLY,
    ORACLES as SINGLE,
    QUALITY,
    TXN,
    bronze_rows,
)

# What the trusted table holds after the three deliveries.
DELIVERED = (
    TXN.replace("txn AS (", "raw AS (", 1)
    + """,
txn AS (
  SELECT transaction_id, created_at_timestamp,
    CASE WHEN date_trunc('month', created_at_timestamp) = DATE '1996-05-01' THEN 2 * amount
         ELSE amount END AS amount,
    currency, charged_partner, status
  FROM raw
  WHERE (status = 'processed' OR year(created_at_timestamp) = 1997)
    AND (created_at_timestamp IS NULL OR currency = 'EUR'
      OR date_trunc('month', created_at_timestamp) <> DATE '1996-05-01')
  UNION ALL
  SELECT transaction_id, created_at_timestamp + INTERVAL 40 DAY, amount, currency,
    charged_partner, status
  FROM raw
  WHERE status = 'processed' AND year(created_at_timestamp) = 1997
    AND day(created_at_timestamp) = 1
)"""
)


def _delivered(sql: str) -> str:
    return sql.replace(TXN, DELIVERED)


BY_CURRENCY = SINGLE["monthly_partner_premiums_by_currency"].split(QUALITY, 1)[1]

ORACLES: dict[str, str] = {
    "incremental_quality": _delivered(
        f"WITH {QUALITY} SELECT {ACCEPTED_LIST}, {FLAG_LIST} FROM quality"
    ),
    "incremental_marts": _delivered(
        f"""WITH {QUALITY},
eur AS ({MONTHLY.split(QUALITY, 1)[1]}),
by_currency AS ({BY_CURRENCY})
SELECT partner, month, NULL::VARCHAR AS currency, total_premium FROM eur
UNION ALL SELECT partner, month, currency, total_premium FROM by_currency"""
    ),
    "incremental_star": _delivered(
        f"""WITH {QUALITY}
SELECT transaction_partner_sk AS transaction_sk, transaction_id, charged_partner AS partner_name,
  strftime(created_at, '%Y-%m-%d') AS full_date, week_of_year, amount, status
FROM accepted"""
    ),
    "ingest_removed_copy": bronze_rows("CASE WHEN status = 'processed' THEN 1 ELSE 2 END"),
    "split_json_ingest": bronze_rows("1"),
    "large_file_manifest": f"""WITH {TXN},
whole AS (
  SELECT min(year(created_at_timestamp) * 10000 + month(created_at_timestamp) * 100
    + day(created_at_timestamp))::INTEGER AS file_date, count(*) AS n_records FROM txn)
SELECT DISTINCT file_date, n_records, 2::BIGINT AS n_files,
  coalesce(year(created_at_timestamp) * 100 + month(created_at_timestamp), 0)::INTEGER AS month_id
FROM txn, whole""",
    "ordered_file_set": f"""WITH {FILES}
SELECT path, file_date, row_number() OVER (ORDER BY file_date, path) AS position FROM now""",
    "schema_evolution": f"""WITH {TXN}
SELECT transaction_id, strftime(created_at_timestamp, '%m/%d/%Y %H:%M:%S') AS created_at, amount,
  currency, charged_partner, CASE WHEN status = 'processed' THEN status END AS status,
  CASE WHEN status <> 'processed' THEN 'branch' END AS channel,
  year(created_at_timestamp)::INTEGER AS year, month(created_at_timestamp)::INTEGER AS month,
  day(created_at_timestamp)::INTEGER AS day
FROM txn""",
    "compacted_table": """
SELECT o_orderkey, o_totalprice, o_orderpriority, 1::INTEGER AS n_writes,
  (year(o_orderdate) * 100 + month(o_orderdate))::INTEGER AS month_id
FROM orders""",
    "concurrent_commits": """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice * 2 ELSE o_totalprice + 1 END AS o_totalprice,
  o_orderpriority, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month
FROM orders""",
    "bitmap_backfill": f"""WITH {TXN},
m AS (
  SELECT charged_partner AS feed, date_trunc('month', created_at_timestamp) AS m, status FROM txn
  WHERE created_at_timestamp IS NOT NULL
),
requested AS (
  SELECT feed, unnest(generate_series(min(m) - INTERVAL 3 MONTH, max(m), INTERVAL 1 MONTH)) AS m FROM m GROUP BY feed
),
available AS (SELECT DISTINCT feed, m FROM m),
found AS (
  SELECT feed, 'requested' AS status, m FROM requested
  UNION ALL SELECT feed, 'available', m FROM available
  UNION ALL (SELECT feed, 'selected', m FROM requested INTERSECT SELECT feed, 'selected', m FROM available)
  UNION ALL (SELECT feed, 'not_available', m FROM requested EXCEPT SELECT feed, 'not_available', m FROM available)
  UNION ALL SELECT DISTINCT feed, 'latest_loaded', m FROM m WHERE status = 'processed'
)
SELECT feed, status, strftime(m, '%Y-%m') AS month FROM found""",
}
