"""Listings, ledgers and sidecars derived from the sample tables, as SQL both engines read the same way."""

from __future__ import annotations

# One listed file per event: regular names, sidecars, hidden files, odd case, strangers and late names.
LISTING = """
SELECT event_id, user_id, dir_id, business_date,
       CASE WHEN event_id % 11 = 0 THEN concat('.', event_type, '_', ymd, '.csv')
            WHEN event_id % 7 = 0 THEN concat('Claims_', ymd, '_', CAST(event_id AS STRING), '.CSV')
            WHEN event_id % 5 = 0 THEN concat('invoices_', CAST(event_id AS STRING), '.csv')
            WHEN user_id % 6 = 0 THEN concat('policies_', ymd, '.csv.gpg')
            WHEN user_id % 6 = 1 THEN concat('policies_', ymd, '.csv.sha256')
            WHEN user_id % 6 = 2 AND CAST(substr(ymd, 7, 2) AS INT) % 4 = 0 THEN concat('claims_late_', ymd, '.csv.gpg')
            WHEN user_id % 6 = 2 THEN concat('claims_', ymd, '.csv.gpg')
            WHEN user_id % 6 = 3 THEN concat('claims_', ymd, '.csv.sha256')
            WHEN user_id % 6 = 4 THEN concat('premiums_', ymd, '.csv')
            ELSE concat('reinsurance_', ymd, '.csv') END AS file_name
FROM (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS business_date,
             replace(CAST(CAST(ts AS DATE) AS STRING), '-', '') AS ymd,
             CASE WHEN event_id % 3 = 1 THEN 'reports' ELSE 'inbound' END AS dir_id
      FROM {events}) AS e
"""

# Ledger entries, one per order: a customer's file is recorded again and again, now and then a directory is reset.
LEDGER = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'inbound' ELSE 'reports' END AS dir_id,
       concat('policies_', CAST(o_custkey AS STRING), '.csv') AS file_name,
       CAST(o_orderdate AS DATE) AS business_date,
       concat('bronze/inbound/policies/', CAST(o_orderkey AS STRING)) AS uri,
       CASE WHEN o_orderkey % 5003 = 2500 THEN 'reset' WHEN o_orderkey % 7 = 0 THEN 'rejected' ELSE 'landed' END
         AS outcome,
       o_orderkey AS recorded_at,
       substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) AS month
FROM {orders}
"""

# One file per document, and a sidecar `<hex>  <name>` whose digest is wrong for every 17th. `digest_of_*` are filled in
# with each engine's SHA-256 of the text.
SIDECARS = """
SELECT concat('doc_', CAST(doc_id AS STRING), '.csv') AS file_name, doc_id, text,
       concat(upper(CASE WHEN doc_id % 17 = 0 THEN digest_of_altered ELSE digest_of_text END),
              '  doc_', CAST(doc_id AS STRING), '.csv') AS sidecar_text
FROM {documents}
"""

LAYER_PARTITIONS = """
SELECT DISTINCT CASE o_orderkey % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'dead_letter' ELSE 'silver' END AS layer,
       CAST(o_orderdate AS DATE) AS partition_date
FROM {orders}
"""
