"""The registered queries once more as plain SQL over the sample tables, written apart from the operators."""

from __future__ import annotations

from coverlake.checks import inputs
from coverlake.sources.samples import raw_sql

NUMBER = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
SILVER_TOKENS = "'', 'None', 'nan', 'NaN', 'NULL'"
GATE_TOKENS = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', "
    "'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)
DAY = "DATE '2026-05-14'"


def cell(c: str) -> str:
    return f"(CASE WHEN {c} IN ({SILVER_TOKENS}) THEN NULL ELSE {c} END)"


def code(c: str) -> str:
    return f"trim(upper({cell(c)}))"


def day(c: str) -> str:
    return f"(CASE WHEN length({c}) = 10 THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE) END)"


def number(c: str) -> str:
    return f"(CASE WHEN regexp_full_match(trim({c}), '{NUMBER}') THEN TRY_CAST(trim({c}) AS DOUBLE) END)"


def whole(c: str) -> str:
    return f"CAST((CASE WHEN {number(c)} = floor({number(c)}) THEN {number(c)} END) AS INTEGER)"


def flag(c: str) -> str:
    return (
        f"(CASE WHEN lower({c}) IN ('true', '1', 'yes') THEN true "
        f"WHEN lower({c}) IN ('false', '0', 'no') THEN false END)"
    )


def within(c: str, low: float, high: float) -> str:
    low, high = f"CAST({low} AS DOUBLE)", f"CAST({high} AS DOUBLE)"
    return f"(CASE WHEN {c} < {low} THEN {low} WHEN {c} > {high} THEN {high} ELSE {c} END)"


TYPED = {
    "policies": f"""
SELECT {code('policy_id')} AS policy_id, {cell('insured_name')} AS insured_name,
       {day('policy_start_date')} AS policy_start_date, {day('policy_end_date')} AS policy_end_date,
       {number('premium_amount')} AS premium_amount, {code('coverage_type')} AS coverage_type,
       {within(number('risk_score'), 0, 1)} AS risk_score, {cell('broker_id')} AS broker_id, {code('status')} AS status,
       _business_date, _source_file, _ord
FROM raw""",
    "claims": f"""
SELECT {code('claim_id')} AS claim_id, {code('policy_id')} AS policy_id, {cell('claimant_name')} AS claimant_name,
       {cell('adjuster_id')} AS adjuster_id, {day('incident_date')} AS incident_date,
       {day('reported_date')} AS reported_date, {code('claim_type')} AS claim_type, {code('status')} AS status,
       {number('claimed_amount')} AS claimed_amount, {number('approved_amount')} AS approved_amount,
       {number('deductible_applied')} AS deductible_applied, {flag('fraud_flag')} AS fraud_flag,
       _business_date, _source_file, _ord
FROM raw""",
    "premiums": f"""
SELECT {code('premium_id')} AS premium_id, {code('policy_id')} AS policy_id, {day('payment_date')} AS payment_date,
       {day('due_date')} AS due_date, {number('amount_due')} AS amount_due, {number('amount_paid')} AS amount_paid,
       {number('late_fee')} AS late_fee, {cell('payment_method')} AS payment_method, {code('currency')} AS currency,
       {whole('instalment_number')} AS instalment_number, {whole('instalment_total')} AS instalment_total,
       {code('status')} AS status, _business_date, _source_file, _ord
FROM raw""",
    "reinsurance": f"""
SELECT {code('ri_record_id')} AS ri_record_id, {code('policy_id')} AS policy_id, {cell('claim_id')} AS claim_id,
       {cell('reinsurer_id')} AS reinsurer_id, {cell('reinsurer_name')} AS reinsurer_name,
       {cell('treaty_id')} AS treaty_id, {code('treaty_type')} AS treaty_type, {day('cession_date')} AS cession_date,
       {within(number('cession_percentage'), 0, 100)} AS cession_percentage,
       {number('ceded_premium')} AS ceded_premium, {number('ceded_liability')} AS ceded_liability,
       {number('recovered_amount')} AS recovered_amount, {code('currency')} AS currency, {code('status')} AS status,
       _business_date, _source_file, _ord
FROM raw""",
}

KEYS = {"policies": "policy_id", "claims": "claim_id", "premiums": "premium_id", "reinsurance": "ri_record_id"}

DERIVED = {
    "policies": """CAST(date_diff('day', policy_start_date, policy_end_date) AS INTEGER) AS policy_duration_days,
       premium_amount AS annual_premium_eur""",
    "claims": f"""CAST(CASE WHEN date_diff('day', incident_date, reported_date) < 0 THEN 0
            ELSE date_diff('day', incident_date, reported_date) END AS INTEGER) AS days_to_report,
       CASE WHEN claimed_amount > 0 THEN {within('(approved_amount / claimed_amount)', 0, 1)} END AS approval_rate""",
    "premiums": f"""amount_paid - amount_due AS payment_variance,
       CAST(CASE WHEN status = 'OVERDUE' THEN date_diff('day', due_date, {DAY}) END AS INTEGER) AS days_overdue""",
    "reinsurance": f"""ceded_liability * (1 - cession_percentage / 100) AS retained_liability,
       CASE WHEN ceded_liability > 0 THEN {within('(recovered_amount / ceded_liability)', 0, 1)} END
         AS recovery_ratio""",
}


def silver(entity: str, raw: str | None = None) -> str:
    """Silver rows with `_ord` still in place."""
    key = KEYS[entity]
    return f"""
WITH raw AS ({raw or raw_sql(entity)}), typed AS ({TYPED[entity]}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY _business_date, {key} ORDER BY _ord DESC) AS rn FROM typed)
SELECT * EXCLUDE (rn), {DERIVED[entity]}, sha256(coalesce({key}, 'None')) AS _row_hash FROM ranked WHERE rn = 1"""


def over_silver(entity: str, select: str, rest: str = "") -> str:
    return f"WITH silver AS ({silver(entity)}) SELECT {select} FROM silver {rest}"


def first_of(entity: str, keys: str, select: str) -> str:
    return f"""WITH silver AS ({silver(entity)}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY _ord) AS first_rank FROM silver)
SELECT {select}, {DAY} AS load_date FROM ranked WHERE first_rank = 1"""


def total(c: str) -> str:
    return f"coalesce(CAST(sum(CAST({c} AS DECIMAL(38, 8))) AS DOUBLE), 0)"


GOLD = {
    "dim_policy": first_of(
        "policies",
        "policy_id",
        """policy_id, insured_name, coverage_type, status, policy_start_date, policy_end_date, policy_duration_days,
  annual_premium_eur, risk_score, broker_id, coalesce(status = 'ACTIVE', false) AS is_active""",
    ),
    "dim_claimant": first_of(
        "claims",
        "policy_id, claimant_name",
        """policy_id, claimant_name, adjuster_id,
  CAST(('0x' || substr(sha256(policy_id || '|' || claimant_name), 1, 15)) AS BIGINT) % 1000000000 AS claimant_sk""",
    ),
    "dim_reinsurer": first_of("reinsurance", "reinsurer_id", "reinsurer_id, reinsurer_name"),
    "fact_premiums": over_silver(
        "premiums",
        """premium_id, policy_id, due_date, payment_date, amount_due, amount_paid, late_fee, payment_variance,
  days_overdue, instalment_number, instalment_total, payment_method, currency, status, _business_date, _row_hash,
  _business_date AS ingestion_date, coalesce(status = 'PAID', false) AS is_paid,
  coalesce(status = 'OVERDUE', false) AS is_overdue""",
    ),
    "fact_claims": over_silver(
        "claims",
        """claim_id, policy_id, incident_date, reported_date, claim_type, status, claimed_amount, approved_amount,
  deductible_applied, days_to_report, approval_rate, fraud_flag, adjuster_id, _business_date, _row_hash,
  _business_date AS ingestion_date, coalesce(fraud_flag, false) AS is_fraud,
  coalesce(approved_amount, 0) - coalesce(deductible_applied, 0) AS net_claim_cost""",
    ),
    "fact_reinsurance": over_silver(
        "reinsurance",
        """ri_record_id, policy_id, claim_id, reinsurer_id, treaty_id, treaty_type, cession_date, cession_percentage,
  ceded_premium, ceded_liability, recovered_amount, retained_liability, recovery_ratio, currency, status,
  _business_date, _row_hash, _business_date AS ingestion_date""",
    ),
    "agg_daily_premium_summary": f"""WITH silver AS ({silver('premiums')}),
grouped AS (SELECT status, currency, count(DISTINCT policy_id) AS policy_count, count(premium_id) AS premium_count,
                   {total('amount_due')} AS total_amount_due, {total('amount_paid')} AS total_amount_paid
            FROM silver GROUP BY status, currency)
SELECT *, CASE WHEN total_amount_due <> 0 THEN {within('(total_amount_paid / total_amount_due)', 0, 1)} END
         AS collection_rate,
       {DAY} AS business_date, CASE WHEN status = 'OVERDUE' THEN premium_count ELSE 0 END AS overdue_count
FROM grouped""",
    "agg_claim_by_status": over_silver(
        "claims",
        f"""claim_type, status, count(claim_id) AS claim_count, {total('claimed_amount')} AS total_claimed_eur,
  {total('approved_amount')} AS total_approved_eur,
  CAST(round_even(avg(days_to_report), 1) AS DOUBLE) AS avg_days_to_report,
  count(*) FILTER (WHERE fraud_flag) AS fraud_count, {DAY} AS business_date""",
        "GROUP BY claim_type, status",
    ),
    "agg_reinsurer_exposure": over_silver(
        "reinsurance",
        f"""reinsurer_id, reinsurer_name, treaty_type, currency, count(ri_record_id) AS cession_count,
  {total('ceded_premium')} AS total_ceded_premium_eur, {total('ceded_liability')} AS total_ceded_liability_eur,
  {total('retained_liability')} AS total_retained_liability, {total('recovered_amount')} AS total_recovered_eur,
  CAST(round_even(CAST(sum(CAST(recovery_ratio AS DECIMAL(28, 12))) AS DOUBLE) / nullif(count(recovery_ratio), 0), 4)
       AS DOUBLE) AS avg_recovery_ratio, {DAY} AS business_date""",
        "GROUP BY reinsurer_id, reinsurer_name, treaty_type, currency",
    ),
}

# Per entity: (column, kind, nullable, [(check, failing condition over the value v)]).
POLICY = ("str_matches(^POL-[0-9]{8}$)", "NOT regexp_matches(v, '^POL-[0-9]{8}$')")
CLAIM = ("str_matches(^CLM-[0-9]{8}$)", "NOT regexp_matches(v, '^CLM-[0-9]{8}$')")
CURRENCY = ("str_matches(^[A-Z]{3}$)", "NOT regexp_matches(v, '^[A-Z]{3}$')")
NONNEGATIVE = ("greater_than_or_equal_to(0)", "v < 0")
POSITIVE = ("greater_than(0)", "v <= 0")
UNDER_10M = ("less_than(10000000)", "v >= 10000000")
UNDER_50M = ("less_than(50000000)", "v >= 50000000")
MONTHS = [("greater_than_or_equal_to(1)", "v < 1"), ("less_than_or_equal_to(12)", "v > 12")]


def since(d: str) -> tuple[str, str]:
    return (f"since({d})", f"v < DATE '{d}'")


def member(*values: str) -> tuple[str, str]:
    return ("isin", "v NOT IN (" + ", ".join(f"'{x}'" for x in values) + ")")


GATE = {
    "policies": [
        ("policy_id", "text", False, [POLICY]),
        ("insured_name", "text", False, []),
        ("policy_start_date", "date", False, [since("2000-01-01")]),
        ("policy_end_date", "date", False, []),
        ("premium_amount", "double", False, [POSITIVE, UNDER_10M]),
        ("coverage_type", "text", False, [member("LIFE", "HEALTH", "AUTO", "PROPERTY", "LIABILITY")]),
        ("risk_score", "double", True, [("in_range(0.0, 1.0)", "(v < 0 OR v > 1)")]),
        ("status", "text", False, [member("ACTIVE", "CANCELLED", "EXPIRED", "PENDING")]),
    ],
    "claims": [
        ("claim_id", "text", False, [CLAIM]),
        ("policy_id", "text", False, [POLICY]),
        ("claimant_name", "text", False, []),
        ("incident_date", "date", False, [since("2020-01-01")]),
        ("reported_date", "date", False, [since("2020-01-01")]),
        ("claim_type", "text", False,
         [member("ACCIDENT", "THEFT", "FIRE", "FLOOD", "LIABILITY", "MEDICAL", "DEATH", "OTHER")]),
        ("status", "text", False,
         [member("OPEN", "IN_REVIEW", "APPROVED", "PARTIALLY_APPROVED", "DENIED", "CLOSED", "APPEALED")]),
        ("claimed_amount", "double", False, [NONNEGATIVE, UNDER_50M]),
        ("approved_amount", "double", True, [NONNEGATIVE, UNDER_50M]),
        ("deductible_applied", "double", True, [NONNEGATIVE]),
    ],
    "premiums": [
        ("premium_id", "text", False,
         [("str_matches(^PRM-[0-9]{8}$)", "NOT regexp_matches(v, '^PRM-[0-9]{8}$')")]),
        ("policy_id", "text", False, [POLICY]),
        ("payment_date", "date", True, [since("2000-01-01")]),
        ("due_date", "date", False, [since("2000-01-01")]),
        ("amount_due", "double", False, [POSITIVE, UNDER_10M]),
        ("amount_paid", "double", True, [NONNEGATIVE, UNDER_10M]),
        ("late_fee", "double", True, [NONNEGATIVE]),
        ("payment_method", "text", True,
         [member("BANK_TRANSFER", "CREDIT_CARD", "DEBIT_CARD", "CHEQUE", "DIRECT_DEBIT", "OTHER")]),
        ("currency", "text", False, [CURRENCY]),
        ("instalment_number", "int", False, MONTHS),
        ("instalment_total", "int", False, MONTHS),
        ("status", "text", False, [member("PENDING", "PAID", "OVERDUE", "PARTIALLY_PAID", "WAIVED", "REFUNDED")]),
    ],
    "reinsurance": [
        ("ri_record_id", "text", False, [("str_matches(^RI-[0-9]{8}$)", "NOT regexp_matches(v, '^RI-[0-9]{8}$')")]),
        ("policy_id", "text", False, [POLICY]),
        ("claim_id", "text", True, [CLAIM]),
        ("reinsurer_id", "text", False,
         [("str_matches(^RNS-[A-Z0-9]{6}$)", "NOT regexp_matches(v, '^RNS-[A-Z0-9]{6}$')")]),
        ("reinsurer_name", "text", False, []),
        ("treaty_id", "text", False, []),
        ("treaty_type", "text", False,
         [member("QUOTA_SHARE", "SURPLUS", "EXCESS_OF_LOSS", "STOP_LOSS", "FACULTATIVE")]),
        ("cession_date", "date", False, [since("2000-01-01")]),
        ("cession_percentage", "double", False, [("in_range(0, 100)", "(v < 0 OR v > 100)")]),
        ("ceded_premium", "double", False, [NONNEGATIVE]),
        ("ceded_liability", "double", False, [NONNEGATIVE]),
        ("recovered_amount", "double", True, [NONNEGATIVE]),
        ("currency", "text", False, [CURRENCY]),
        ("status", "text", False, [member("ACTIVE", "SETTLED", "DISPUTED", "CANCELLED", "PENDING_RECOVERY")]),
    ],
}

VALUES = {"text": lambda c: c, "date": day, "double": number, "int": number}


def failures(entity: str) -> str:
    """One row per failed test, with the row's order so that bad rows can be counted."""
    parts = []
    key_text = f"(CASE WHEN {KEYS[entity]} IN ({GATE_TOKENS}) THEN NULL ELSE {KEYS[entity]} END)"
    for column, kind, nullable, checks in GATE[entity]:
        t = f"(CASE WHEN {column} IN ({GATE_TOKENS}) THEN NULL ELSE {column} END)"
        base = f"SELECT _source_file, _rn, {key_text} AS row_key, {t} AS t, {VALUES[kind](t)} AS v FROM raw"
        tests = [] if nullable else [("not_nullable", "t IS NULL")]
        if kind != "text":
            tests.append(("coerce_dtype", "t IS NOT NULL AND v IS NULL"))
        tests += [(name, f"v IS NOT NULL AND {bad}") for name, bad in checks]
        for name, bad in tests:
            parts.append(
                f"SELECT _source_file AS source_file, _rn, row_key, '{column}' AS column_name, '{name}' AS check_name, "
                f"t AS failure_value FROM ({base}) AS b WHERE {bad}"
            )
    key = KEYS[entity]
    parts.append(
        f"SELECT _source_file, _rn, k, '{key}', 'field_uniqueness', k FROM (SELECT _source_file, _rn, {key} AS k, "
        f"count(*) OVER (PARTITION BY _source_file, {key}) AS n FROM raw) AS u WHERE n > 1 AND k IS NOT NULL"
    )
    return "\nUNION ALL ".join(parts)


def gate_ctes(entity: str) -> str:
    return f"""raw AS MATERIALIZED (SELECT *, row_number() OVER () AS _rn FROM ({raw_sql(entity)}) AS m),
failed AS MATERIALIZED ({failures(entity)})"""


def file_columns(entity: str) -> str:
    columns = {
        "policies": "policy_id,insured_name,policy_start_date,policy_end_date,premium_amount,coverage_type,risk_score,"
        "broker_id,status",
        "claims": "claim_id,policy_id,claimant_name,adjuster_id,incident_date,reported_date,claim_type,status,"
        "claimed_amount,approved_amount,deductible_applied,fraud_flag",
        "premiums": "premium_id,policy_id,payment_date,due_date,amount_due,amount_paid,late_fee,payment_method,currency,"
        "instalment_number,instalment_total,status",
        "reinsurance": "ri_record_id,policy_id,claim_id,reinsurer_id,reinsurer_name,treaty_id,treaty_type,cession_date,"
        "cession_percentage,ceded_premium,ceded_liability,recovered_amount,currency,status",
    }
    return columns[entity]


def file_stats(entity: str) -> str:
    return f"""SELECT * FROM (WITH {gate_ctes(entity)},
bad AS (SELECT source_file, count(DISTINCT _rn) AS n FROM failed GROUP BY source_file),
files AS (SELECT _source_file AS source_file, count(*) AS n FROM raw GROUP BY _source_file)
SELECT files.source_file, '{entity}' AS file_type, files.n AS rows_raw, files.n - coalesce(bad.n, 0) AS rows_valid,
       coalesce(bad.n, 0) AS rows_dropped, '{file_columns(entity)}' AS columns, bad.n IS NULL AS accepted
FROM files LEFT JOIN bad USING (source_file)) AS {entity}_stats"""


ALL_STATS = "\nUNION ALL ".join(file_stats(e) for e in KEYS)


def per_entity(build) -> str:
    return "\nUNION ALL ".join(f"SELECT * FROM ({build(e)}) AS part_{e}" for e in KEYS)


def repeated_keys(entity: str) -> str:
    key = KEYS[entity]
    return f"""SELECT _source_file AS source_file, {key} AS key_value, count(*) AS n FROM ({raw_sql(entity)}) AS m
WHERE {key} NOT IN ({GATE_TOKENS}) GROUP BY ALL HAVING count(*) > 1"""


def unparsed(entity: str, rows: str | None = None) -> str:
    columns = {
        "policies": [("policy_start_date", day), ("policy_end_date", day), ("premium_amount", number),
                     ("risk_score", number)],
        "claims": [("incident_date", day), ("reported_date", day), ("claimed_amount", number),
                   ("approved_amount", number), ("deductible_applied", number)],
        "premiums": [("payment_date", day), ("due_date", day), ("amount_due", number), ("amount_paid", number),
                     ("late_fee", number), ("instalment_number", whole), ("instalment_total", whole)],
        "reinsurance": [("cession_date", day), ("cession_percentage", number), ("ceded_premium", number),
                        ("ceded_liability", number), ("recovered_amount", number)],
    }[entity]
    return "\nUNION ALL ".join(
        f"SELECT '{entity}' AS entity, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {cell(c)} IS NOT NULL AND {parse(c)} IS NULL) AS bad_values "
        f"FROM {rows or f'({raw_sql(entity)}) AS m'}"
        for c, parse in columns
    )


def dropped(entity: str) -> str:
    key = KEYS[entity]
    return f"""WITH raw AS ({raw_sql(entity)}), keyed AS (SELECT _business_date, _source_file, {code(key)} AS k FROM raw),
files AS (SELECT _business_date, k, _source_file, count(*) AS n FROM keyed GROUP BY ALL),
ids AS (SELECT _business_date, k, sum(n) AS n, count(*) AS f FROM files GROUP BY ALL)
SELECT _business_date, CAST(sum(n) AS BIGINT) AS rows_in, CAST(sum(n) - sum(f) AS BIGINT) AS dropped_within_file,
       CAST(sum(f) - count(*) AS BIGINT) AS dropped_across_files, count(*) AS rows_kept, '{entity}' AS entity
FROM ids GROUP BY _business_date"""


LISTING = inputs.LISTING.replace("{events}", "events")
VISIBLE = f"SELECT DISTINCT dir_id, business_date, file_name FROM ({LISTING}) AS l WHERE NOT starts_with(file_name, '.')"

EXPECTED = f"""SELECT dir_id, business_date, entity, kind,
       concat(entity, '_', strftime(business_date, '%Y%m%d'), suffix) AS file_name
FROM (SELECT DISTINCT business_date FROM ({LISTING}) AS l) AS dates,
     (VALUES ('inbound', 'policies', 'data', '.csv.gpg'), ('inbound', 'policies', 'checksum', '.csv.sha256'),
             ('inbound', 'claims', 'data', '.csv.gpg'), ('inbound', 'claims', 'checksum', '.csv.sha256'),
             ('reports', 'premiums', 'data', '.csv'), ('reports', 'reinsurance', 'data', '.csv'))
       AS due(dir_id, entity, kind, suffix)"""

ARRIVALS = f"""SELECT coalesce(e.dir_id, a.dir_id) AS dir_id, coalesce(e.business_date, a.business_date) AS business_date,
       coalesce(e.file_name, a.file_name) AS file_name, e.file_name IS NOT NULL AS due, a.file_name IS NOT NULL AS here
FROM ({EXPECTED}) AS e FULL JOIN ({VISIBLE}) AS a
  ON e.dir_id = a.dir_id AND e.business_date = a.business_date AND e.file_name = a.file_name"""

ENTITY = """CASE WHEN starts_with(lower(file_name), 'policies') THEN 'policies'
            WHEN starts_with(lower(file_name), 'claims') THEN 'claims'
            WHEN starts_with(lower(file_name), 'premiums') THEN 'premiums'
            WHEN starts_with(lower(file_name), 'reinsurance') THEN 'reinsurance' END"""

NEW_FILES = f"""WITH l AS ({LISTING})
SELECT DISTINCT dir_id, file_name FROM l WHERE event_id % 2 = 1 AND NOT EXISTS (
  SELECT 1 FROM l AS seen WHERE seen.event_id % 2 = 0 AND seen.dir_id = l.dir_id AND seen.file_name = l.file_name)"""

LEDGER = inputs.LEDGER.replace("{orders}", "orders")


def current(entries: str) -> str:
    return f"""WITH entries AS ({entries}),
resets AS (SELECT dir_id, max(recorded_at) AS reset_at FROM entries WHERE outcome = 'reset' GROUP BY dir_id),
live AS (SELECT entries.* FROM entries LEFT JOIN resets USING (dir_id)
         WHERE outcome <> 'reset' AND (reset_at IS NULL OR recorded_at > reset_at)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY dir_id, file_name ORDER BY recorded_at DESC) AS rn FROM live)
SELECT dir_id, file_name, business_date, uri, outcome, recorded_at FROM ranked WHERE rn = 1"""


SIDECARS = (
    inputs.SIDECARS.replace("{documents}", "documents")
    .replace("digest_of_altered", "sha256(concat(text, '!'))")
    .replace("digest_of_text", "sha256(text)")
)

CLAIM_STATS = file_stats("claims")
CLAIM_URI = "concat('gs://lake/bronze/inbound/claims/year=2026/month=05/day=14/', source_file)"

MONTHLY_PREMIUMS = f"""SELECT * REPLACE (CAST(date_trunc('month', CAST(due_date AS DATE)) AS DATE) AS _business_date)
FROM ({raw_sql('premiums')}) AS m"""

LARGE_SUMS = """
WITH c AS (SELECT event_type, event_id % 2 AS odd, CAST(CAST(value AS DECIMAL(12, 2)) * 100 AS BIGINT) AS cents FROM events)
SELECT event_type, odd, CAST(CASE WHEN odd = 0 THEN 3 * count(cents) ELSE 2 * count(cents) END AS BIGINT) AS amounts,
       CASE WHEN odd = 0 THEN CAST(CAST(sum(cents) AS DECIMAL(30, 0)) / 1000000 AS DOUBLE)
            ELSE CAST(concat(CAST(sum(cents) AS VARCHAR), 'E20') AS DOUBLE) END AS total
FROM c GROUP BY event_type, odd
"""

GOLD_TOTALS = "\nUNION ALL ".join(
    f"""SELECT '{name}' AS table_name, count(*) AS n_rows,
       coalesce(CAST(sum(CAST(CAST({amount} AS DOUBLE) AS DECIMAL(38, 8))) AS DOUBLE), 0) AS total,
       '{'skipped' if name.startswith('fact') else 'ok'}' AS second_status FROM ({GOLD[name]}) AS g"""
    for name, amount in {
        "dim_policy": "annual_premium_eur", "dim_claimant": "claimant_sk", "dim_reinsurer": "length(reinsurer_name)",
        "fact_premiums": "amount_due", "fact_claims": "claimed_amount", "fact_reinsurance": "ceded_premium",
        "agg_daily_premium_summary": "premium_count", "agg_claim_by_status": "claim_count",
        "agg_reinsurer_exposure": "cession_count",
    }.items()
)

FILE_CHECKSUMS = """
WITH w AS (SELECT doc_id AS n, text AS content FROM documents),
s AS (
  SELECT concat('doc_', CAST(n AS VARCHAR), '.csv') AS file_name,
         sha256(concat(content, CASE WHEN n % 17 = 0 THEN '!' ELSE '' END)) AS expected,
         CASE WHEN n % 19 <> 0 THEN sha256(content) END AS actual
  FROM w WHERE n % 13 <> 0)
SELECT file_name, expected, actual, coalesce(expected = actual, false) AS ok FROM s
"""

ORACLES: dict[str, str] = {
    "gold_load": GOLD_TOTALS,
    "file_checksums": FILE_CHECKSUMS,
    "large_sums": LARGE_SUMS,
    "silver_metrics": f"""WITH raw AS (
  SELECT * REPLACE (CASE WHEN claimed_amount LIKE '%7' THEN 'x' ELSE claimed_amount END AS claimed_amount) FROM ({raw_sql('claims')}) AS m),
twice AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE status = 'OPEN'),
bad AS ({unparsed('claims', 'twice')}),
n AS (SELECT count(*) AS n, (SELECT count(*) FROM raw) AS kept FROM twice)
SELECT 'bad_values' AS metric, column_name, bad_values AS value FROM bad
UNION ALL SELECT 'rows_in', NULL, n FROM n UNION ALL SELECT 'rows_kept', NULL, kept FROM n
UNION ALL SELECT 'rows_dropped', NULL, n - kept FROM n""",
    "violation_positions": f"""WITH raw AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY _source_file ORDER BY _ord) - 1 AS _rn
  FROM (SELECT * EXCLUDE (_source_file), strftime(_business_date, '%Y%m') AS _source_file FROM ({raw_sql('claims')}) AS m)),
failed AS MATERIALIZED ({failures('claims')})
SELECT source_file, _rn AS row_number, row_key, column_name, check_name, failure_value FROM failed""",
    **{f"silver_{e}": f"SELECT * EXCLUDE (_ord) FROM ({silver(e)}) AS s" for e in KEYS},
    **GOLD,
    **{
        f"violations_{e}": f"WITH {gate_ctes(e)} SELECT source_file, CAST(NULL AS BIGINT) AS row_number, row_key, column_name, check_name, failure_value FROM failed"
        for e in KEYS
    },
    "file_stats": ALL_STATS,
    "duplicate_keys": per_entity(repeated_keys),
    "gate_files": f"""SELECT file_type, count(*) FILTER (WHERE accepted) AS accepted_files,
       count(*) FILTER (WHERE NOT accepted) AS rejected_files,
       CAST(coalesce(sum(rows_raw) FILTER (WHERE accepted), 0) AS BIGINT) AS accepted_rows
FROM ({ALL_STATS}) AS s GROUP BY file_type""",
    "routed_rows": f"""SELECT claim_id, r._source_file AS source_file,
       CASE WHEN accepted THEN 'bronze' ELSE 'dead_letter' END AS route
FROM ({raw_sql('claims')}) AS r JOIN ({CLAIM_STATS}) AS s ON r._source_file = s.source_file""",
    "parse_failures": "\nUNION ALL ".join(unparsed(e) for e in KEYS),
    "dedup_dropped": per_entity(dropped),
    "expected_files": EXPECTED,
    "arrival_report": f"""SELECT dir_id, business_date, count(*) FILTER (WHERE due) AS expected_files,
       count(*) FILTER (WHERE here) AS actual_files, count(*) FILTER (WHERE due AND NOT here) AS missing_files,
       count(*) FILTER (WHERE here AND NOT due) AS unexpected_files,
       count(*) FILTER (WHERE due AND NOT here) = 0 AS is_complete
FROM ({ARRIVALS}) AS a GROUP BY dir_id, business_date""",
    "missing_files": f"SELECT dir_id, business_date, file_name FROM ({ARRIVALS}) AS a WHERE due AND NOT here",
    "unexpected_files": f"SELECT dir_id, business_date, file_name FROM ({ARRIVALS}) AS a WHERE here AND NOT due",
    "entity_inference": f"""SELECT dir_id, file_name, entity, CASE WHEN (dir_id = 'inbound') =
       (entity IN ('policies', 'claims')) THEN entity END AS directory_entity
FROM (SELECT dir_id, file_name, {ENTITY} AS entity FROM ({VISIBLE}) AS v) AS e""",
    "files_per_entity": f"""SELECT {ENTITY} AS entity, count(*) AS files FROM ({VISIBLE}) AS v
WHERE {ENTITY} IS NOT NULL GROUP BY 1""",
    "file_kinds": f"""SELECT dir_id, CASE WHEN starts_with(file_name, '.') THEN 'hidden'
       WHEN ends_with(file_name, '.sha256') THEN 'sidecar' WHEN ends_with(file_name, '.gpg') THEN 'encrypted'
       WHEN ends_with(file_name, '.csv') THEN 'data' ELSE 'other' END AS kind, count(*) AS files,
       count(DISTINCT regexp_replace(regexp_replace(file_name, '[.]gpg$', ''), '[.]sha256$', '')) AS data_names
FROM ({LISTING}) AS l GROUP BY 1, 2""",
    "new_files": NEW_FILES,
    "landed_names": f"""SELECT dir_id, file_name FROM ({VISIBLE}) AS v UNION ALL
SELECT dir_id, concat(file_name, '.gpg') FROM ({VISIBLE}) AS v WHERE dir_id = 'inbound' AND ends_with(file_name, '.csv')""",
    "pending_dates": f"""WITH entries AS ({LEDGER}),
resets AS (SELECT dir_id, max(recorded_at) AS reset_at FROM entries WHERE outcome = 'reset' GROUP BY dir_id),
done AS (SELECT DISTINCT entries.dir_id, business_date FROM entries LEFT JOIN resets USING (dir_id)
         WHERE outcome = 'landed' AND (reset_at IS NULL OR recorded_at > reset_at))
SELECT DISTINCT dir_id AS scope, business_date FROM entries
WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.dir_id = entries.dir_id AND done.business_date = entries.business_date)""",
    "forced_dates": f"SELECT DISTINCT dir_id AS scope, business_date FROM ({LEDGER}) AS e",
    "ledger_state": current(LEDGER),
    "ledger_snapshot": current(LEDGER),
    "ledger_lookback": current(f"SELECT * FROM ({LEDGER}) AS e WHERE month >= '1997-10'"),
    "ledger_summary": f"""WITH live AS ({current(LEDGER)}), counts AS (SELECT dir_id, count(*) AS n FROM live GROUP BY 1),
written AS (SELECT dir_id, max(recorded_at) AS last_updated FROM ({LEDGER}) AS e GROUP BY 1)
SELECT dir_id, coalesce(n, 0) AS processed, coalesce(n, 0) = 0 AS is_first_run, last_updated
FROM written LEFT JOIN counts USING (dir_id)""",
    "expired_partitions": f"""SELECT layer, partition_date FROM ({inputs.LAYER_PARTITIONS.replace('{orders}', 'orders')}) AS p
WHERE (layer = 'bronze' AND partition_date < DATE '1998-06-01' - 90)
   OR (layer = 'dead_letter' AND partition_date < DATE '1998-06-01' - 30)""",
    "checksum_report": f"""WITH files AS ({SIDECARS})
SELECT s.file_name, lower(split_part(s.sidecar_text, ' ', 1)) AS expected, sha256(d.text) AS actual,
       coalesce(lower(split_part(s.sidecar_text, ' ', 1)) = sha256(d.text), false) AS ok
FROM (SELECT * FROM files WHERE doc_id % 13 <> 0) AS s
LEFT JOIN (SELECT * FROM files WHERE doc_id % 19 <> 0) AS d USING (file_name)""",
    "audit_rows": f"""SELECT 'sample-run' AS run_id, {DAY} AS business_date, {CLAIM_URI} AS gcs_uri, file_type, rows_valid,
       rows_dropped, 'inbound' AS dir_id, 'lake/bronze/inbound/claims/year=2026/month=05/day=14' AS gcs_prefix
FROM ({CLAIM_STATS}) AS s WHERE accepted""",
    "run_summary": f"""SELECT CASE WHEN accepted THEN 'ok' WHEN rows_valid > 0 THEN 'error' ELSE 'skipped' END AS status,
       count(*) AS steps FROM ({ALL_STATS}) AS s GROUP BY 1""",
    "run_report": f"""WITH s AS ({CLAIM_STATS}), n AS (SELECT count(*) FILTER (WHERE accepted) AS ok FROM s)
SELECT 'directories' AS item, CAST(2 AS BIGINT) AS n UNION ALL SELECT 'bronze_files', ok FROM n
UNION ALL SELECT 'silver_entities', ok FROM n UNION ALL SELECT 'gold_tables', ok FROM n""",
    "directory_report": f"""WITH files AS (SELECT DISTINCT dir_id, file_name FROM ({VISIBLE}) AS v), fresh AS ({NEW_FILES})
SELECT dir_id, (SELECT count(*) FROM files WHERE files.dir_id = d.dir_id) AS listed_files,
       (SELECT count(*) FROM fresh WHERE fresh.dir_id = d.dir_id) AS new_files,
       (SELECT count(*) FROM fresh WHERE fresh.dir_id = d.dir_id AND {ENTITY} IS NOT NULL) AS uploaded_files,
       CASE WHEN dir_id = 'inbound' THEN 'INCREMENTAL' ELSE 'FULL LOAD' END AS mode
FROM (SELECT DISTINCT dir_id FROM files) AS d""",
    "partition_replace": f"""SELECT claim_id, claim_type, claimed_amount, _business_date AS ingestion_date,
       CASE WHEN day(_business_date) % 2 = 0 THEN 2 ELSE 1 END AS load_no
FROM ({silver('claims')}) AS s WHERE day(_business_date) % 9 <> 0""",
    "truncate_load": f"SELECT * FROM ({GOLD['dim_policy']}) AS d WHERE is_active",
    "backfill_silver": f"""SELECT * EXCLUDE (_ord, _source_file) FROM ({silver('premiums', MONTHLY_PREMIUMS)}) AS s""",
    "landed_cells": f"""SELECT claim_id, concat('  ', claimant_name, ' ') AS claimant_name, adjuster_id, status, claimed_amount,
       nullif(approved_amount, '') AS approved_amount, '   ' AS _note, strftime(_business_date, '%Y%m') AS month
FROM ({raw_sql('claims')}) AS m""",
    "bronze_partitions": f"""SELECT _business_date AS business_date, count(*) AS n_rows, count(claim_id) AS n_ids,
       count(adjuster_id) AS n_adjusters FROM ({raw_sql('claims')}) AS m GROUP BY 1""",
    "stream_incremental_silver": f"SELECT * EXCLUDE (_ord, _source_file) FROM ({silver('claims')}) AS s",
}
