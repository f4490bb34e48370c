"""Raw feed rows derived from the sample warehouse tables.

The mappings add deterministic dirt: padded identifiers, wrong case, null tokens, bad dates and numbers, repeated keys
and values beyond the clip bounds. The same text runs on Spark and on other SQL engines.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

# One business date for the feeds without a date of their own, and the day ages are measured against.
SAMPLE_DATE = date(2026, 5, 14)

TABLES = {
    "policies": ["orders", "customer"],
    "claims": ["events"],
    "premiums": ["lineitem"],
    "reinsurance": ["lineitem", "supplier", "part"],
}

def padded(number: str, width: int) -> str:
    """A number as text with zeros before it up to a width; longer numbers keep all their digits."""
    text = f"CAST({number} AS STRING)"
    return f"concat(repeat('0', {width} - length({text})), {text})"


MAPPINGS = {
    "policies": f"""
SELECT CASE WHEN o_orderkey % 10 = 3 THEN concat(' pol-', {padded('o_orderkey', 8)}, ' ')
            ELSE concat('POL-', {padded('o_orderkey', 8)}) END AS policy_id,
       c_name AS insured_name,
       CASE WHEN o_orderkey % 97 = 0 THEN '31/12/1999' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END
         AS policy_start_date,
       CAST(CAST(o_orderdate AS DATE) + 365 AS STRING) AS policy_end_date,
       CASE WHEN o_orderkey % 89 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS STRING) END
         AS premium_amount,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'auto ' WHEN 'BUILDING' THEN 'PROPERTY' WHEN 'FURNITURE' THEN 'LIFE'
            WHEN 'HOUSEHOLD' THEN 'HEALTH' ELSE 'LIABILITY' END AS coverage_type,
       CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE CAST(CAST((o_orderkey % 121) / 100.0 AS DECIMAL(5,2)) AS STRING) END
         AS risk_score,
       CASE WHEN o_orderkey % 5 = 0 THEN 'NULL' ELSE concat('BRK-', {padded('o_custkey % 50', 3)}) END
         AS broker_id,
       CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'EXPIRED' ELSE 'PENDING' END AS status,
       DATE '2026-05-14' AS _business_date,
       concat('policies_', {padded('CAST(floor(o_orderkey / 3) AS BIGINT)', 10)}, '.csv') AS _source_file,
       {padded('o_orderkey', 12)} AS _ord
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
""",
    "claims": f"""
SELECT concat('CLM-', {padded('event_id', 8)}) AS claim_id,
       concat('POL-', {padded('user_id', 8)}) AS policy_id,
       concat('User ', CAST(user_id AS STRING)) AS claimant_name,
       CASE WHEN event_id % 4 = 1 THEN 'None' ELSE concat('ADJ-', CAST(event_id % 20 AS STRING)) END AS adjuster_id,
       CAST(CAST(ts AS DATE) AS STRING) AS incident_date,
       CAST(CAST(ts AS DATE) + CAST(event_id % 41 - 3 AS INT) AS STRING) AS reported_date,
       CASE event_type WHEN 'view' THEN 'THEFT' WHEN 'signup' THEN 'MEDICAL' WHEN 'purchase' THEN 'accident'
            WHEN 'error' THEN 'FIRE' ELSE 'FLOOD' END AS claim_type,
       CASE event_id % 7 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'IN_REVIEW' WHEN 2 THEN ' approved'
            WHEN 3 THEN 'PARTIALLY_APPROVED' WHEN 4 THEN 'DENIED' WHEN 5 THEN 'CLOSED' ELSE 'APPEALED' END AS status,
       CASE WHEN event_id % 17 = 0 THEN '0' ELSE CAST(CAST(value AS DECIMAL(12,2)) AS STRING) END AS claimed_amount,
       CASE WHEN event_id % 4 = 0 THEN ''
            ELSE CAST(CAST(value AS DECIMAL(12,2)) * CAST(event_id % 3 AS INT) AS STRING) END AS approved_amount,
       CASE WHEN event_id % 3 = 0 THEN '' ELSE '5.00' END AS deductible_applied,
       CASE event_id % 6 WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN '1' WHEN 3 THEN '0' WHEN 4 THEN 'yes'
            ELSE '' END AS fraud_flag,
       CAST(ts AS DATE) AS _business_date,
       concat('claims_', {padded('CAST(floor(event_id / 3) AS BIGINT)', 10)}, '.csv') AS _source_file,
       {padded('event_id', 12)} AS _ord
FROM {{events}}
""",
    "premiums": f"""
SELECT concat('PRM-', {padded('l_orderkey * 10 + l_linenumber', 8)}) AS premium_id,
       concat('POL-', {padded('l_orderkey', 8)}) AS policy_id,
       CASE WHEN l_linestatus = 'O' THEN '' ELSE CAST(CAST(l_shipdate AS DATE) + 10 AS STRING) END AS payment_date,
       CAST(CAST(l_shipdate AS DATE) AS STRING) AS due_date,
       CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS STRING) AS amount_due,
       CASE WHEN l_linestatus = 'O' THEN ''
            ELSE CAST(CAST(CAST(l_extendedprice AS DECIMAL(14,2)) - CAST(l_quantity AS DECIMAL(14,2))
                           AS DECIMAL(14,2)) AS STRING) END AS amount_paid,
       CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_tax * 100 AS DECIMAL(14,2)) AS STRING) ELSE 'nan' END AS late_fee,
       CASE l_linenumber WHEN 1 THEN 'BANK_TRANSFER' WHEN 2 THEN 'CREDIT_CARD' WHEN 3 THEN 'DEBIT_CARD'
            WHEN 4 THEN 'CHEQUE' WHEN 5 THEN 'DIRECT_DEBIT' ELSE 'OTHER' END AS payment_method,
       CASE WHEN l_partkey % 3 = 0 THEN 'eur' WHEN l_partkey % 3 = 1 THEN 'USD' ELSE 'GBP' END AS currency,
       CAST(l_linenumber AS STRING) AS instalment_number, '12' AS instalment_total,
       CASE WHEN l_linestatus = 'F' THEN 'PAID' WHEN l_returnflag = 'R' THEN 'OVERDUE' ELSE 'pending' END AS status,
       DATE '2026-05-14' AS _business_date,
       concat('premiums_', {padded('CAST(floor(l_orderkey / 2) AS BIGINT)', 10)}, '.csv')
         AS _source_file,
       concat_ws('|', CAST(CAST(l_shipdate AS DATE) AS STRING), {padded('l_partkey', 10)},
                 {padded('l_suppkey', 10)},
                 CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS STRING), CAST(CAST(l_tax AS DECIMAL(4,2)) AS STRING),
                 l_returnflag, l_linestatus) AS _ord
FROM {{lineitem}}
""",
    "reinsurance": f"""
SELECT concat('RI-', {padded('l_orderkey * 10 + l_linenumber', 8)}) AS ri_record_id,
       concat('pol-', {padded('l_orderkey', 8)}) AS policy_id,
       CASE WHEN l_partkey % 2 = 0 THEN '' ELSE concat('CLM-', {padded('l_partkey', 8)}) END AS claim_id,
       concat('RNS-', {padded('l_suppkey', 6)}) AS reinsurer_id, s_name AS reinsurer_name,
       concat('TRT-', CAST(l_suppkey % 9 AS STRING)) AS treaty_id,
       CASE p_type WHEN 'STANDARD' THEN 'quota_share' WHEN 'ECONOMY' THEN 'SURPLUS' WHEN 'MEDIUM' THEN 'EXCESS_OF_LOSS'
            WHEN 'PROMO' THEN 'STOP_LOSS' ELSE 'FACULTATIVE' END AS treaty_type,
       CAST(CAST(l_shipdate AS DATE) AS STRING) AS cession_date,
       CAST(CAST(l_quantity * 2.5 AS DECIMAL(8,2)) AS STRING) AS cession_percentage,
       CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS STRING) AS ceded_premium,
       CASE WHEN l_partkey % 11 = 0 THEN '0' ELSE CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * 10 AS STRING) END
         AS ceded_liability,
       CASE WHEN l_returnflag = 'N' THEN ''
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_linenumber + l_partkey % 12 AS INT) AS STRING) END
         AS recovered_amount,
       CASE WHEN l_returnflag = 'A' THEN 'eur' ELSE 'USD' END AS currency,
       CASE WHEN l_linestatus = 'F' THEN 'SETTLED' ELSE 'ACTIVE' END AS status,
       DATE '2026-05-14' AS _business_date,
       concat('reinsurance_', {padded('CAST(floor(l_orderkey / 2) AS BIGINT)', 10)}, '.csv')
         AS _source_file,
       concat_ws('|', CAST(CAST(l_shipdate AS DATE) AS STRING), {padded('l_partkey', 10)},
                 {padded('l_suppkey', 10)}, CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS STRING),
                 l_returnflag, l_linestatus, CAST(CAST(l_quantity AS INT) AS STRING)) AS _ord
FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey JOIN {{part}} ON l_partkey = p_partkey
""",
}

SAMPLE_ORDER = ["_ord"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt_out(rows: DataFrame) -> DataFrame:
    """Rows of a scan with fewer splits than cores, dealt out evenly, so that all cores take part in parsing them.

    A table of one small file is one split. Larger scans are left as they are; `_ord` keeps the order of rows.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def raw_sample(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Raw text rows of one feed with `_business_date`, `_source_file` and the row order `_ord`."""
    frames = {name: table(spark, sf_dir, name) for name in TABLES[entity]}
    frames[TABLES[entity][0]] = dealt_out(frames[TABLES[entity][0]])
    return spark.sql(MAPPINGS[entity], **frames)


def raw_sql(entity: str) -> str:
    """The mapping over plain table names."""
    return MAPPINGS[entity].format(**{name: name for name in TABLES[entity]})
