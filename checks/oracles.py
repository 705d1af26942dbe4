"""DuckDB SQL that states each query's result independently of the Spark code.

Every text starts from the driver's tables. Shared steps are common table
expressions; a query names the last ones it needs.
"""

from __future__ import annotations

NUMBER = r"\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)\s*"
DATE = r"\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}:\d{2})?\s*"
AS_OF = "timestamp '2000-01-01'"


def number(column: str) -> str:
    return f"CASE WHEN regexp_full_match({column}, '{NUMBER}') THEN try_cast({column} AS DOUBLE) END"


def date(column: str) -> str:
    return f"CASE WHEN regexp_full_match({column}, '{DATE}') THEN try_cast(replace(trim({column}), 'T', ' ') AS TIMESTAMP) END"


def sha(text: str, length: int) -> str:
    return f"substr(sha256({text}), 1, {length})"


def dollars(cents: str) -> str:
    whole = f"CAST(floor({cents}) AS BIGINT)"
    return f"({whole} // 100) || '.' || lpad(CAST({whole} % 100 AS VARCHAR), 2, '0')"


def app_id(length: int = 8) -> str:
    return (
        "CASE WHEN applicant_ssn IS NULL THEN 'APP-UNKNOWN'"
        f" ELSE 'APP-' || {sha('applicant_ssn', length)} END"
    )


def row_key(prefix: str, *columns: str) -> str:
    parts = " || chr(31) || ".join(f"coalesce(CAST({c} AS VARCHAR), chr(30))" for c in columns)
    return f"'{prefix}' || sha256({parts})"


STEPS: dict[str, str] = {}

STEPS["raw_applications"] = f"""
SELECT
  CASE WHEN o_orderkey % 97 <> 0 THEN 'LN' || o_orderkey END AS application_id,
  CASE WHEN o_custkey % 101 <> 0 THEN 'S' || o_custkey END AS applicant_ssn,
  c_name AS applicant_full_name,
  CASE WHEN o_custkey % 53 = 0 THEN 'bad-date'
       ELSE '19' || (50 + o_custkey % 45) || '-06-15' END AS applicant_date_of_birth,
  CASE WHEN o_custkey % 7 = 0 THEN NULL WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS applicant_gender,
  c_mktsegment AS applicant_marital_status,
  CASE o_custkey % 4 WHEN 0 THEN 'Bachelor' WHEN 1 THEN 'Master'
       WHEN 2 THEN 'High School' ELSE 'PhD' END AS applicant_level_of_education,
  CASE WHEN o_orderkey % 71 = 0 THEN NULL
       WHEN o_orderkey % 3 = 0 THEN '+44 7911 ' || (100000 + o_orderkey)
       ELSE '(555) 123-' || (1000 + o_orderkey % 9000) END AS applicant_phone_number,
  'c' || o_custkey || '@example.com' AS applicant_email,
  'NATION_' || c_nationkey AS applicant_state,
  'City ' || (o_custkey % 300) AS applicant_city,
  CASE o_orderkey % 4 WHEN 0 THEN 'Full-time' WHEN 1 THEN 'Part-time'
       WHEN 2 THEN 'Self-employed' END AS employment_type,
  'Employer ' || (o_custkey % 200) AS employer_name,
  CAST(1000 + (o_custkey * 131) % 9000 AS VARCHAR) AS monthly_income_usd,
  CAST((o_orderkey * 7) % 240 AS VARCHAR) AS employment_duration_months,
  'Kin ' || o_custkey AS next_of_kin_name,
  CASE o_custkey % 3 WHEN 0 THEN 'Spouse' WHEN 1 THEN 'Parent' ELSE 'Sibling' END AS next_of_kin_relationship,
  '+1 ' || (2000000 + o_custkey) AS next_of_kin_phone,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || CASE o_orderkey % 3
    WHEN 0 THEN ' 10:30:00' WHEN 1 THEN 'T23:59:59' ELSE '' END AS application_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Personal' WHEN '2-HIGH' THEN 'Business'
       WHEN '3-MEDIUM' THEN 'Auto' WHEN '5-LOW' THEN 'Mortgage' ELSE 'Other' END AS loan_type,
  CASE o_orderstatus WHEN 'F' THEN 'Debt consolidation' WHEN 'O' THEN 'Home improvement'
       ELSE 'Education' END AS loan_purpose,
  CASE WHEN o_orderkey % 89 = 0 THEN 'not_a_number'
       ELSE {dollars('o_totalprice * o_totalprice / 25000')} END AS loan_amount_requested_usd,
  CASE o_orderkey % 5 WHEN 1 THEN '12' WHEN 2 THEN '24' WHEN 3 THEN '36' WHEN 4 THEN '60' END AS loan_term_months,
  CASE WHEN o_orderkey % 17 <> 0 THEN CAST((o_orderkey % 13) * 0.75::DOUBLE AS VARCHAR) END AS interest_rate
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN (VALUES (1), (2)) AS copies(n) ON n = 1 OR o_orderkey % 50 = 1
"""

STEPS["raw_repayments"] = f"""
SELECT
  'LN' || l_orderkey AS loan_application_id,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS repayment_date,
  {dollars('l_extendedprice * 10')} AS amount_paid_usd,
  CASE WHEN l_linenumber <> 7 THEN CAST(CAST(l_quantity AS INTEGER) - 1 AS VARCHAR) END AS days_overdue,
  CASE l_returnflag WHEN 'A' THEN 'Paid' WHEN 'N' THEN 'Late' ELSE 'Defaulted' END AS payment_status
FROM lineitem
"""

STEPS["raw_credit"] = """
SELECT
  'S' || c_custkey AS applicant_ssn,
  CASE WHEN c_custkey % 29 <> 0 THEN CAST(300 + (c_custkey * 37) % 551 AS VARCHAR) END AS credit_score,
  CAST(c_custkey % 100 AS VARCHAR) AS credit_utilization_pct,
  CAST(c_custkey % 4 AS VARCHAR) AS delinquent_accounts,
  CASE WHEN c_custkey % 41 = 0 THEN 'bad-date' ELSE '2024-01-10' END AS bureau_pull_date
FROM customer
"""

STEPS["raw_credit_by_application"] = """
SELECT
  CASE WHEN o_orderkey % 97 <> 0 THEN 'LN' || o_orderkey END AS application_id,
  'S' || o_custkey AS applicant_ssn,
  CASE WHEN o_orderkey % 29 <> 0
       THEN CAST(300 + (o_orderkey * 41 + n * 13) % 551 AS VARCHAR) END AS credit_score,
  CAST(o_orderkey % 100 AS VARCHAR) AS credit_utilization_pct,
  CAST(o_orderkey % 4 AS VARCHAR) AS delinquent_accounts,
  CASE WHEN o_orderkey % 41 = 0 THEN 'bad-date' ELSE '2024-01-10' END AS bureau_pull_date
FROM orders JOIN (VALUES (1), (2)) AS copies(n) ON n = 1 OR o_orderkey % 40 = 1
"""

STEPS["apps"] = f"""
SELECT * REPLACE (
  {date('application_date')} AS application_date,
  {date('applicant_date_of_birth')} AS applicant_date_of_birth,
  {number('loan_amount_requested_usd')} AS loan_amount_requested_usd,
  {number('monthly_income_usd')} AS monthly_income_usd,
  {number('loan_term_months')} AS loan_term_months,
  {number('interest_rate')} AS interest_rate,
  nullif(regexp_replace(applicant_phone_number, '[^0-9+]', '', 'g'), '') AS applicant_phone_number)
FROM (SELECT DISTINCT * FROM raw_applications) AS d
WHERE application_id IS NOT NULL
"""

STEPS["repayments"] = f"""
SELECT loan_application_id, repayment_date, amount_paid_usd, days_overdue, payment_status,
  loan_application_id AS application_id,
  coalesce(repayment_date > {AS_OF}, false) AS is_future_dated,
  days_overdue > 30 AS is_delinquent
FROM (
  SELECT loan_application_id, payment_status,
    {date('repayment_date')} AS repayment_date,
    {number('amount_paid_usd')} AS amount_paid_usd,
    coalesce({number('days_overdue')}, 0) AS days_overdue
  FROM (SELECT DISTINCT * FROM raw_repayments) AS d
  WHERE loan_application_id IS NOT NULL AND repayment_date IS NOT NULL) AS p
"""



def cleaned_credit(raw: str, application: str) -> str:
    return f"""
SELECT *, CASE
    WHEN credit_score > 299 AND credit_score <= 579 THEN 'Poor'
    WHEN credit_score > 579 AND credit_score <= 669 THEN 'Fair'
    WHEN credit_score > 669 AND credit_score <= 739 THEN 'Good'
    WHEN credit_score > 739 AND credit_score <= 799 THEN 'Very Good'
    WHEN credit_score > 799 AND credit_score <= 850 THEN 'Exceptional' END AS credit_band
FROM (
  SELECT applicant_ssn, {application} AS application_id,
    {number('credit_score')} AS credit_score,
    {number('credit_utilization_pct')} AS credit_utilization_pct,
    {number('delinquent_accounts')} AS delinquent_accounts,
    {date('bureau_pull_date')} AS bureau_pull_date
  FROM (SELECT DISTINCT * FROM {raw}) AS d
  WHERE {application} IS NOT NULL) AS p
"""


STEPS["credit"] = cleaned_credit("raw_credit", "applicant_ssn")
STEPS["credit_by_application"] = cleaned_credit("raw_credit_by_application", "application_id")

ATTRIBUTES = (
    "applicant_ssn, applicant_full_name, applicant_date_of_birth, applicant_gender,"
    " applicant_marital_status, applicant_level_of_education"
)
UNNAMED = ATTRIBUTES.removeprefix("applicant_ssn, ")
EMPLOYMENT = (
    "application_id, employment_type, employer_name, monthly_income_usd,"
    " employment_duration_months"
)
CONTACT = (
    "application_id, applicant_email, applicant_phone_number, applicant_state, applicant_city"
)
KIN = "application_id, next_of_kin_name, next_of_kin_relationship, next_of_kin_phone"

STEPS["applicants"] = f"""
SELECT *, {app_id()} AS applicant_id FROM (SELECT DISTINCT {ATTRIBUTES} FROM apps) AS d
"""


def first_per_application(columns: str) -> str:
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in columns.split(",")[1:])
    return (
        f"SELECT {columns} FROM apps"
        f" QUALIFY row_number() OVER (PARTITION BY application_id ORDER BY {order}) = 1"
    )


STEPS["employment"] = first_per_application(EMPLOYMENT)
STEPS["contacts"] = first_per_application(CONTACT)
STEPS["kin"] = first_per_application(KIN)

PAYMENT = """
round_even(CASE WHEN interest_rate / 100 / 12 > 0 THEN loan_amount_requested_usd * (
    (interest_rate / 100 / 12) * pow(1 + interest_rate / 100 / 12, coalesce(loan_term_months, 60))
    / (pow(1 + interest_rate / 100 / 12, coalesce(loan_term_months, 60)) - 1))
  ELSE loan_amount_requested_usd / nullif(coalesce(loan_term_months, 60), 0) END, 2)
"""

FACT = "application_date, loan_type, loan_amount_requested_usd, loan_purpose, loan_term_months, interest_rate"

STEPS["fact_with_ssn"] = f"""
SELECT a.application_id, d.applicant_id, {FACT}, {PAYMENT} AS estimated_monthly_payment_usd,
  a.applicant_ssn
FROM apps a LEFT JOIN applicants d
  ON a.applicant_ssn IS NOT DISTINCT FROM d.applicant_ssn
 AND a.applicant_full_name IS NOT DISTINCT FROM d.applicant_full_name
 AND a.applicant_date_of_birth IS NOT DISTINCT FROM d.applicant_date_of_birth
 AND a.applicant_gender IS NOT DISTINCT FROM d.applicant_gender
 AND a.applicant_marital_status IS NOT DISTINCT FROM d.applicant_marital_status
 AND a.applicant_level_of_education IS NOT DISTINCT FROM d.applicant_level_of_education
"""

STEPS["fact"] = "SELECT * EXCLUDE (applicant_ssn) FROM fact_with_ssn"

UNNAMED_ORDER = ", ".join(f"{c.strip()} NULLS FIRST" for c in UNNAMED.split(","))
STEPS["numbered"] = f"""
SELECT *, printf('APP-%06d', row_number() OVER (ORDER BY {UNNAMED_ORDER}) - 1) AS applicant_id
FROM (SELECT DISTINCT {UNNAMED} FROM apps) AS d
"""

STEPS["registered"] = f"""
SELECT * EXCLUDE (early), row_number() OVER (ORDER BY early DESC, applicant_key) - 1 AS applicant_number,
  printf('APP-%06d', row_number() OVER (ORDER BY early DESC, applicant_key) - 1) AS applicant_id
FROM (
  SELECT *, {row_key("", *[c.strip() for c in UNNAMED.split(",")])} AS applicant_key
  FROM (
    SELECT {UNNAMED}, bool_or(CAST(substr(application_id, 3) AS BIGINT) % 4 = 1) AS early
    FROM apps GROUP BY {UNNAMED}
  ) AS d
) AS keyed
"""

STEPS["staged_with_ssn"] = """
SELECT applicant_ssn, application_id, applicant_id, loan_type, loan_amount_requested_usd, loan_term_months,
  interest_rate, loan_purpose, estimated_monthly_payment_usd,
  CAST(application_date AS DATE) AS application_date
FROM fact_with_ssn
"""
STEPS["staged"] = "SELECT * EXCLUDE (applicant_ssn) FROM staged_with_ssn"

STEPS["summary"] = """
SELECT application_id,
  CAST(count(*) AS BIGINT) AS total_payments_made,
  round_even(sum(amount_paid_usd), 2) AS total_amount_paid_usd,
  max(repayment_date) AS last_payment_date,
  CAST(sum(CASE WHEN is_delinquent THEN 1 ELSE 0 END) AS BIGINT) AS delinquent_payment_count,
  max(CASE WHEN payment_status = 'Defaulted' THEN 1 ELSE 0 END) AS has_defaulted
FROM repayments GROUP BY application_id
"""


def mart(loans: str, bureau: str, key: str) -> str:
    """Loans with what their repayments and bureau rows add."""
    return f"""
SELECT loan.application_id, loan.applicant_id, loan.loan_type, loan.loan_amount_requested_usd,
  loan.loan_term_months, loan.interest_rate, loan.loan_purpose,
  loan.estimated_monthly_payment_usd, loan.application_date,
  CASE WHEN loan.loan_amount_requested_usd > 50000 THEN 'LARGE'
       WHEN loan.loan_amount_requested_usd > 10000 THEN 'MEDIUM'
       WHEN loan.loan_amount_requested_usd > 1000 THEN 'SMALL' ELSE 'MICRO' END AS loan_segment,
  paid.payments AS total_payments_made, paid.amount AS total_amount_paid_usd,
  paid.last_payment_date, paid.late AS delinquent_payment_count, paid.defaulted AS has_defaulted,
  round_even(loan.loan_amount_requested_usd - paid.amount, 2) AS outstanding_balance_usd,
  score.credit_score, score.credit_band, score.credit_utilization_pct, score.delinquent_accounts,
  (paid.late > 0 OR score.credit_band IN ('Poor', 'Fair')) AS is_high_risk
FROM {loans} AS loan
JOIN (
  SELECT ids.application_id AS id, coalesce(total_payments_made, 0) AS payments,
    coalesce(total_amount_paid_usd, 0) AS amount, last_payment_date,
    coalesce(delinquent_payment_count, 0) AS late, coalesce(has_defaulted, 0) = 1 AS defaulted
  FROM (SELECT DISTINCT application_id FROM {loans}) AS ids LEFT JOIN summary USING (application_id)
) AS paid ON paid.id = loan.application_id
LEFT JOIN {bureau} AS score ON score.{key} = loan.{key}
"""


STEPS["mart"] = mart("staged_with_ssn", "credit", "applicant_ssn")

REPORT_BAND = """
CASE WHEN credit_score < 580 THEN 'Poor' WHEN credit_score BETWEEN 580 AND 669 THEN 'Fair'
     WHEN credit_score BETWEEN 670 AND 739 THEN 'Good'
     WHEN credit_score BETWEEN 740 AND 799 THEN 'Very Good' ELSE 'Excellent' END
"""

STEPS["band_report"] = f"""
WITH scored AS (SELECT applicant_ssn, {REPORT_BAND} AS credit_band FROM credit),
paid AS (SELECT loan_application_id, payment_status <> 'Paid' AS unpaid FROM repayments)
SELECT credit_band, CAST(count(DISTINCT application_id) AS BIGINT) AS total_loans,
  CAST(count_if(unpaid) AS BIGINT) AS defaults
FROM scored JOIN applicants USING (applicant_ssn) JOIN fact_with_ssn USING (applicant_ssn)
JOIN paid ON loan_application_id = application_id
GROUP BY credit_band
"""

# The older schema.
LEGACY_NAMES = {
    "applicant_email": "applicant_email_address",
    "next_of_kin_name": "next_of_kin_full_name",
    "next_of_kin_phone": "next_of_kin_phone_number",
    "loan_term_months": "repayment_tenure_months",
}
_RENAMED = ", ".join(f"{old} AS {new}" for old, new in LEGACY_NAMES.items())

STEPS["legacy_apps"] = f"""
SELECT * REPLACE (
  {date('application_date')} AS application_date,
  {date('applicant_date_of_birth')} AS applicant_date_of_birth,
  regexp_replace(applicant_phone_number, '[^0-9]', '', 'g') AS applicant_phone_number,
  regexp_replace(next_of_kin_phone_number, '[^0-9]', '', 'g') AS next_of_kin_phone_number)
FROM (
  SELECT DISTINCT * RENAME ({_RENAMED}) FROM raw_applications
  WHERE application_id IS NOT NULL AND applicant_ssn IS NOT NULL
    AND applicant_gender IS NOT NULL AND applicant_phone_number IS NOT NULL
    AND employment_type IS NOT NULL AND loan_term_months IS NOT NULL
    AND interest_rate IS NOT NULL) AS d
"""

STEPS["legacy_repayments"] = f"""
SELECT * REPLACE ({date('repayment_date')} AS repayment_date)
FROM (SELECT DISTINCT * FROM raw_repayments WHERE days_overdue IS NOT NULL) AS d
"""

STEPS["legacy_credit"] = """
SELECT DISTINCT * FROM raw_credit WHERE credit_score IS NOT NULL
"""

STEPS["legacy_applicant"] = f"""
SELECT *, {row_key('Ap', *[c.strip() for c in ATTRIBUTES.split(',')])} AS applicant_id
FROM (SELECT DISTINCT {ATTRIBUTES} FROM legacy_apps) AS d
"""

STEPS["legacy_keyed"] = f"""
SELECT a.*, d.applicant_id
FROM legacy_apps a LEFT JOIN legacy_applicant d
  ON a.applicant_ssn = d.applicant_ssn AND a.applicant_full_name = d.applicant_full_name
 AND a.applicant_date_of_birth IS NOT DISTINCT FROM d.applicant_date_of_birth
 AND a.applicant_gender = d.applicant_gender
 AND a.applicant_marital_status = d.applicant_marital_status
 AND a.applicant_level_of_education = d.applicant_level_of_education
"""


def legacy_dim(key: str, prefix: str, *columns: str) -> str:
    return (
        f"SELECT *, {row_key(prefix, *columns)} AS {key}"
        f" FROM (SELECT DISTINCT {', '.join(columns)} FROM legacy_keyed) AS d"
    )


STEPS["legacy_employment"] = legacy_dim(
    "employment_id", "Em",
    "employment_type", "employer_name", "monthly_income_usd", "applicant_id",
)
STEPS["legacy_contact"] = legacy_dim(
    "contact_info_id", "Ci",
    "applicant_city", "applicant_state", "applicant_phone_number",
    "applicant_email_address", "applicant_id",
)
STEPS["legacy_kin"] = legacy_dim(
    "next_of_kin_id", "Nk",
    "next_of_kin_full_name", "next_of_kin_relationship", "next_of_kin_phone_number",
    "applicant_id",
)
STEPS["legacy_fact"] = """
SELECT application_id, applicant_id, application_date, loan_type, loan_amount_requested_usd,
  loan_purpose, repayment_tenure_months
FROM legacy_keyed
"""

NEEDS = {
    "raw_applications": (),
    "raw_repayments": (),
    "raw_credit": (),
    "raw_credit_by_application": (),
    "apps": ("raw_applications",),
    "repayments": ("raw_repayments",),
    "credit": ("raw_credit",),
    "applicants": ("apps",),
    "employment": ("apps",),
    "contacts": ("apps",),
    "kin": ("apps",),
    "credit_by_application": ("raw_credit_by_application",),
    "fact_with_ssn": ("apps", "applicants"),
    "fact": ("fact_with_ssn",),
    "numbered": ("apps",),
    "registered": ("apps",),
    "staged_with_ssn": ("fact_with_ssn",),
    "staged": ("staged_with_ssn",),
    "summary": ("repayments",),
    "mart": ("staged_with_ssn", "summary", "credit"),
    "band_report": ("credit", "applicants", "fact_with_ssn", "repayments"),
    "legacy_apps": ("raw_applications",),
    "legacy_repayments": ("raw_repayments",),
    "legacy_credit": ("raw_credit",),
    "legacy_applicant": ("legacy_apps",),
    "legacy_keyed": ("legacy_apps", "legacy_applicant"),
    "legacy_employment": ("legacy_keyed",),
    "legacy_contact": ("legacy_keyed",),
    "legacy_kin": ("legacy_keyed",),
    "legacy_fact": ("legacy_keyed",),
}


def sql(final: str, *steps: str) -> str:
    """``final`` behind the steps it names and all that those need."""
    ordered: list[str] = []

    def add(step: str) -> None:
        for need in NEEDS[step]:
            add(need)
        if step not in ordered:
            ordered.append(step)

    for step in steps:
        add(step)
    ctes = ", ".join(f"{s} AS MATERIALIZED ({STEPS[s].strip()})" for s in ordered)
    return f"WITH {ctes} {final.strip()}"


def whole(step: str) -> str:
    return sql(f"SELECT * FROM {step}", step)


def check(name: str, column: str, failed: str, table: str, severity: str = "critical") -> str:
    return (
        f"SELECT '{name}' AS check_name, '{column}' AS column_name, '{severity}' AS severity,"
        f" CAST(count(*) FILTER (WHERE {failed}) AS BIGINT) AS failed_rows,"
        f" CAST(count(*) AS BIGINT) AS total_rows,"
        f" count(*) FILTER (WHERE {failed}) = 0 AS passed FROM {table}"
    )


def unique(column: str, table: str, severity: str = "critical") -> str:
    groups = (
        f"(SELECT {column}, count(*) AS n FROM {table}"
        f" WHERE {column} IS NOT NULL GROUP BY {column}) AS g"
    )
    return check("unique", column, "n > 1", groups, severity)


def orphans(column: str, table: str, target: str, key: str, severity: str = "critical") -> str:
    missing = f"{table} t WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {target} d WHERE d.{key} = t.{column})"
    return (
        f"SELECT 'references' AS check_name, '{column}' AS column_name,"
        f" '{severity}' AS severity, CAST(count(*) AS BIGINT) AS failed_rows,"
        f" CAST(count(DISTINCT {column}) AS BIGINT) AS total_rows, count(*) = 0 AS passed"
        f" FROM {missing}"
    )


def checks(*parts: str, steps: tuple[str, ...]) -> str:
    return sql(" UNION ALL ".join(parts), *steps)


def counts(tables: dict[str, str], steps: tuple[str, ...]) -> str:
    return sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {step}"
            for name, step in tables.items()
        ),
        *steps,
    )


def in_table(part: str, name: str) -> str:
    return f"SELECT *, '{name}' AS table_name FROM ({part}) AS p"


TYPES = "('Personal', 'Business', 'Auto', 'Mortgage', 'Student', 'Other')"
AMOUNT = "loan_amount_requested_usd"

_FACT_SEQUENTIAL = f"""
SELECT a.application_id, d.applicant_id, {FACT}, {PAYMENT} AS estimated_monthly_payment_usd
FROM apps a LEFT JOIN numbered d
  ON a.applicant_full_name IS NOT DISTINCT FROM d.applicant_full_name
 AND a.applicant_date_of_birth IS NOT DISTINCT FROM d.applicant_date_of_birth
 AND a.applicant_gender IS NOT DISTINCT FROM d.applicant_gender
 AND a.applicant_marital_status IS NOT DISTINCT FROM d.applicant_marital_status
 AND a.applicant_level_of_education IS NOT DISTINCT FROM d.applicant_level_of_education
"""

INVALID_AMOUNT = (
    "loan_amount_requested_usd IS NULL OR loan_amount_requested_usd <= 0 OR loan_amount_requested_usd > 500000"
)
REJECTED = f"""
    SELECT 'loan_applications' AS source, 'valid_amount(loan_amount_requested_usd)' AS failed_checks, application_id
    FROM apps WHERE {INVALID_AMOUNT}
    UNION ALL
    SELECT 'loan_repayments', 'expression_is_true(amount_paid_usd)', application_id
    FROM repayments WHERE amount_paid_usd < 0
    UNION ALL
    SELECT 'credit_bureau', 'valid_score(credit_score)', application_id
    FROM credit WHERE credit_score < 300 OR credit_score > 850
"""
LOADED = ("dim_employment", "dim_contact_info", "dim_next_of_kin", "fact_loans")
WRITTEN = {
    "fact_loans": "SELECT * FROM fact",
    "dim_applicants": "SELECT * FROM applicants",
    "dim_employment": (
        "SELECT * FROM employment UNION ALL SELECT * FROM employment WHERE application_id LIKE '%77'"
    ),
    "dim_contact_info": (
        "SELECT * FROM contacts UNION ALL SELECT * REPLACE ('GONE' || application_id AS application_id)"
        " FROM contacts WHERE application_id LIKE '%88'"
    ),
    "dim_next_of_kin": "SELECT * FROM kin",
    "fact_repayments": "SELECT * FROM repayments",
}


def loaded_unique(table: str, column: str) -> str:
    return f"""
        SELECT 'unique' AS check_name, '{column}' AS column_name, 'critical' AS severity,
          count(*) FILTER (n > 1) AS failed_rows, count(*) AS total_rows,
          count(*) FILTER (n > 1) = 0 AS passed, '{table}' AS table_name
        FROM (SELECT count(*) AS n FROM ({WRITTEN[table]}) WHERE {column} IS NOT NULL GROUP BY {column})
    """


def loaded_reference(table: str, column: str, target: str, severity: str = "critical") -> str:
    return f"""
        SELECT 'references', '{column}', '{severity}', CAST(coalesce(sum(n), 0) AS BIGINT), count(*),
          coalesce(sum(n), 0) = 0, '{table}'
        FROM (SELECT {column} AS key, count(*) AS n FROM ({WRITTEN[table]}) WHERE {column} IS NOT NULL GROUP BY ALL)
        WHERE key NOT IN (SELECT {column} FROM ({WRITTEN[target]}) WHERE {column} IS NOT NULL)
    """


ORACLES: dict[str, str] = {
    "clean_applications": whole("apps"),
    "clean_repayments": whole("repayments"),
    "clean_credit": whole("credit"),
    "dim_applicants": whole("applicants"),
    "dim_applicants_sequential": whole("numbered"),
    "dim_applicants_long_id": sql(
        f"SELECT * REPLACE ({app_id(32)} AS applicant_id) FROM applicants", "applicants"
    ),
    "dim_applicant_collisions": sql(
        f"""SELECT {app_id()} AS applicant_id,
              CAST(count(DISTINCT applicant_ssn) AS BIGINT) AS ssn_count
            FROM apps WHERE applicant_ssn IS NOT NULL
            GROUP BY 1 HAVING count(DISTINCT applicant_ssn) > 1""",
        "apps",
    ),
    "dim_employment": whole("employment"),
    "dim_contact_info": whole("contacts"),
    "dim_next_of_kin": whole("kin"),
    "fact_loans": whole("fact"),
    "fact_loans_joined": whole("fact"),
    "fact_loans_sequential": sql(_FACT_SEQUENTIAL, "apps", "numbered"),
    "stg_loans": whole("staged"),
    "repayments_summary": whole("summary"),
    "loan_performance_mart": whole("mart"),
    "loan_performance_mart_loaded": whole("mart"),
    "loan_performance_mart_by_application": sql(
        mart("staged", "credit_by_application", "application_id"),
        "staged", "summary", "credit_by_application",
    ),
    "loan_segment_slim": sql(
        f"""SELECT application_id, applicant_id, {AMOUNT},
              CASE WHEN {AMOUNT} > 5000 THEN 'HIGH_VALUE'
                   WHEN {AMOUNT} > 1000 THEN 'MEDIUM_VALUE' ELSE 'LOW_VALUE' END AS loan_segment
            FROM staged""",
        "staged",
    ),
    "report_total_by_application": sql(
        f"""SELECT application_id, round_even(sum({AMOUNT}), 2) AS total_repayment FROM fact
            GROUP BY application_id
            ORDER BY total_repayment DESC NULLS LAST, application_id NULLS FIRST LIMIT 10""",
        "fact",
    ),
    "report_default_by_band": whole("band_report"),
    "report_default_rate_by_band": sql(
        """SELECT *, CAST(defaults AS DOUBLE) / nullif(total_loans, 0) AS defaults_per_loan
           FROM band_report""",
        "band_report",
    ),
    "report_education": sql(
        """SELECT applicant_level_of_education, CAST(count(*) AS BIGINT) AS total_applicants
           FROM applicants GROUP BY 1""",
        "applicants",
    ),
    "report_income_by_employment": sql(
        "SELECT employment_type, avg(monthly_income_usd) AS avg_income FROM employment GROUP BY 1",
        "employment",
    ),
    "report_monthly_applications": sql(
        """SELECT CAST(year(application_date) AS INTEGER) AS year,
             CAST(month(application_date) AS INTEGER) AS month,
             CAST(count(*) AS BIGINT) AS total_applications
           FROM fact GROUP BY 1, 2""",
        "fact",
    ),
    "report_repaid_by_income": sql(
        """SELECT e.monthly_income_usd, round_even(sum(r.amount_paid_usd), 2) AS total_repaid
           FROM employment e JOIN fact l ON e.application_id = l.application_id
           JOIN repayments r ON l.application_id = r.loan_application_id
           GROUP BY e.monthly_income_usd""",
        "employment", "fact", "repayments",
    ),
    "report_state": sql(
        """SELECT applicant_state, CAST(count(*) AS BIGINT) AS total_applicants
           FROM contacts GROUP BY 1""",
        "contacts",
    ),
    "report_kin": sql(
        """SELECT next_of_kin_relationship, CAST(count(*) AS BIGINT) AS frequency
           FROM kin GROUP BY 1""",
        "kin",
    ),
    "credit_band_distribution": sql(
        """SELECT credit_band, CAST(count(*) AS BIGINT) AS rows_in_band
           FROM credit WHERE credit_band IS NOT NULL GROUP BY 1""",
        "credit",
    ),
    "dq_loan_amounts": sql(
        f"""SELECT CAST(sum(bad) AS BIGINT) AS invalid_rows, CAST(count(*) AS BIGINT) AS total_rows,
              CAST(sum(bad) AS DOUBLE) / count(*) * 100 AS invalid_pct,
              NOT (sum(bad) > count(*) * 0.2) AS passed
            FROM (SELECT CASE WHEN {AMOUNT} IS NULL OR {AMOUNT} <= 0 OR {AMOUNT} > 500000
                         THEN 1 ELSE 0 END AS bad FROM apps) AS b""",
        "apps",
    ),
    "dq_repayments": sql(
        """SELECT CAST(count(*) FILTER (WHERE amount_paid_usd < 0) AS BIGINT) AS negative_rows,
             CAST(count(*) FILTER (WHERE is_future_dated) AS BIGINT) AS future_rows,
             CAST(count(*) AS BIGINT) AS total_rows,
             count(*) FILTER (WHERE amount_paid_usd < 0) = 0 AS passed
           FROM repayments""",
        "repayments",
    ),
    "dq_credit": sql(
        """SELECT CAST(count(*) FILTER (WHERE credit_score < 300 OR credit_score > 850) AS BIGINT)
             AS invalid_rows, CAST(count(*) AS BIGINT) AS total_rows,
             count(*) FILTER (WHERE credit_score < 300 OR credit_score > 850) = 0 AS passed
           FROM credit""",
        "credit",
    ),
    "dq_fact_schema": sql(
        """SELECT 'application_id' AS required_column, true AS present,
             CAST(count(*) FILTER (WHERE application_id IS NULL) AS BIGINT) AS null_rows,
             CAST(count(*) AS BIGINT) AS total_rows FROM fact""",
        "fact",
    ),
    "dq_not_null": checks(
        *[
            check("not_null", c, f"{c} IS NULL", "fact")
            for c in ("application_id", "applicant_id", AMOUNT, "loan_type")
        ],
        steps=("fact",),
    ),
    "dq_unique": checks(
        unique("application_id", "fact"),
        unique("applicant_ssn", "applicants"),
        unique("applicant_ssn", "credit"),
        steps=("fact", "applicants", "credit"),
    ),
    "dq_accepted_values": checks(
        check("accepted_values", "loan_type", "loan_type NOT IN ('Personal', 'Business', 'Auto')", "fact"),
        check(
            "accepted_values", "credit_band",
            "credit_band IS NOT NULL AND credit_band NOT IN ('Poor', 'Fair', 'Good')", "credit",
        ),
        steps=("fact", "credit"),
    ),
    "dq_expression": checks(
        check("expression_is_true", AMOUNT, f"NOT ({AMOUNT} > 0)", "fact"),
        check(
            "expression_is_true", "interest_rate",
            "loan_term_months > 12 AND NOT (interest_rate > 0)", "fact",
        ),
        steps=("fact",),
    ),
    "dq_between": checks(
        check("not_null", "application_id", "application_id IS NULL", "fact"),
        check("not_null", "applicant_id", "applicant_id IS NULL", "fact"),
        check("between", AMOUNT, f"{AMOUNT} < 0 OR {AMOUNT} > 100000", "fact"),
        steps=("fact",),
    ),
    "dq_orphans": checks(
        orphans("applicant_id", "fact", "applicants", "applicant_id"),
        orphans("application_id", "repayments", "fact", "application_id"),
        steps=("fact", "applicants", "repayments"),
    ),
    "dq_staging_suite": checks(
        *[
            check("not_null", c, f"{c} IS NULL", "staged")
            for c in ("application_id", "applicant_id", AMOUNT, "loan_type", "application_date")
        ],
        check("expression_is_true", AMOUNT, f"NOT ({AMOUNT} > 0)", "staged"),
        check("accepted_values", "loan_type", f"loan_type NOT IN {TYPES}", "staged"),
        unique("application_id", "staged"),
        steps=("staged",),
    ),
    "dq_mart_suite": checks(
        *[
            check("not_null", c, f"{c} IS NULL", "mart")
            for c in ("application_id", "applicant_id", "loan_segment", "is_high_risk")
        ],
        check(
            "accepted_values", "loan_segment",
            "loan_segment NOT IN ('MICRO', 'SMALL', 'MEDIUM', 'LARGE')", "mart",
        ),
        check(
            "expression_is_true", "outstanding_balance_usd", "outstanding_balance_usd < 0",
            "mart", "warning",
        ),
        check(
            "accepted_values", "credit_band",
            "credit_band NOT IN ('Poor', 'Fair', 'Good', 'Very Good', 'Exceptional')", "mart",
        ),
        unique("application_id", "mart"),
        steps=("mart",),
    ),
    "dq_documented_suite": checks(
        in_table(unique("application_id", "employment"), "dim_employment"),
        in_table(unique("application_id", "contacts"), "dim_contact_info"),
        in_table(unique("application_id", "kin"), "dim_next_of_kin"),
        in_table(check("not_null", "application_id", "application_id IS NULL", "fact"), "fact_loans"),
        in_table(
            check("between", AMOUNT, f"{AMOUNT} < 100 OR {AMOUNT} > 500000", "fact", "warning"),
            "fact_loans",
        ),
        in_table(orphans("applicant_id", "fact", "applicants", "applicant_id"), "fact_loans"),
        in_table(
            check("not_flagged", "is_future_dated", "is_future_dated", "repayments", "warning"),
            "fact_repayments",
        ),
        in_table(
            orphans("application_id", "repayments", "fact", "application_id", "warning"),
            "fact_repayments",
        ),
        steps=("employment", "contacts", "kin", "fact", "applicants", "repayments"),
    ),
    "pipeline_row_counts": counts(
        {
            "raw_loan_applications": "raw_applications",
            "raw_loan_repayments": "raw_repayments",
            "raw_credit_bureau": "raw_credit",
            "fact_loans": "fact",
            "dim_applicants": "applicants",
            "dim_employment": "employment",
            "dim_contact_info": "contacts",
            "dim_next_of_kin": "kin",
            "fact_repayments": "repayments",
            "dim_credit_bureau": "credit",
        },
        ("fact", "employment", "contacts", "kin", "repayments", "credit"),
    ),
    "legacy_clean_applications": whole("legacy_apps"),
    "legacy_clean_repayments": whole("legacy_repayments"),
    "legacy_clean_credit": whole("legacy_credit"),
    "legacy_applicants": whole("legacy_applicant"),
    "legacy_employment": whole("legacy_employment"),
    "legacy_contact_info": whole("legacy_contact"),
    "legacy_next_of_kin": whole("legacy_kin"),
    "legacy_loan_fact": whole("legacy_fact"),
    "legacy_loan_fact_joined": whole("legacy_fact"),
    "legacy_row_counts": counts(
        {
            "loan_repayments": "legacy_repayments",
            "loan_applications": "legacy_apps",
            "applicant": "legacy_applicant",
            "employment": "legacy_employment",
            "contact_info": "legacy_contact",
            "next_of_kin": "legacy_kin",
            "loan_application_fact": "legacy_fact",
            "credit_bureau": "legacy_credit",
        },
        (
            "legacy_repayments", "legacy_employment", "legacy_contact", "legacy_kin",
            "legacy_fact", "legacy_credit",
        ),
    ),
    "csv_roundtrip": whole("contacts"),
    "csv_recleaned": whole("repayments"),
    "table_roundtrip": whole("employment"),
    "csv_rejected_lines": """
        SELECT CASE WHEN o_orderkey % 7 = 0
                    THEN o_orderkey || ',"C, ' || o_custkey || '",' || o_orderstatus || ',EXTRA'
                    ELSE o_orderkey || ',C' || o_custkey END AS line,
          3 AS expected_fields,
          CASE WHEN o_orderkey % 7 = 0 THEN 4 ELSE 2 END AS found_fields,
          CASE WHEN o_orderkey % 7 = 0 THEN 'too many fields' ELSE 'too few fields' END AS problem
        FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0
    """,
    "csv_kept_rows": """
        SELECT CAST(o_orderkey AS VARCHAR) AS "order",
          CASE WHEN o_orderkey % 13 = 0 THEN 'C "' || o_custkey || '"' ELSE 'C' || o_custkey END AS customer,
          o_orderstatus AS status
        FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0
    """,
    "csv_first_in_file": """
        SELECT CAST(l_orderkey AS VARCHAR) AS application_id, CAST(l_linenumber AS VARCHAR) AS line_number,
          CAST(CAST(trunc(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS cents
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_linenumber AS VARCHAR) DESC,
          trunc(l_extendedprice * 100) DESC) = 1
    """,
    "load_written_rows": sql(
        """
        SELECT load, rows_written, rows_held FROM (
          SELECT count(*) FILTER (is_odd) AS a, count(*) FILTER (NOT is_odd) AS b
          FROM (SELECT CAST(substr(application_id, 3) AS BIGINT) % 4 = 1 AS is_odd FROM employment)
        ), LATERAL (VALUES ('truncate', a, a), ('append', b, a + b), ('append again', b, a + 2 * b),
          ('day', a, a), ('next day', b, a + b), ('next day again', b, a + b)) AS t(load, rows_written, rows_held)
        """,
        "employment",
    ),
    "load_day_repeated": sql(
        """
        SELECT *, CASE WHEN CAST(substr(application_id, 3) AS BIGINT) % 4 = 1 THEN 'run-3' ELSE 'run-2' END AS _run_id,
          CASE WHEN CAST(substr(application_id, 3) AS BIGINT) % 4 = 1
               THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS _load_date
        FROM employment
        """,
        "employment",
    ),
    "load_as_unit": sql(
        "SELECT * FROM employment JOIN contacts USING (application_id)", "employment", "contacts"
    ),
    "rejected_rows": sql(f"SELECT * FROM ({REJECTED})", "apps", "repayments", "credit"),
    "rejected_rows_per_check": sql(
        f"SELECT source, failed_checks AS failed_check, count(*) AS rejected_rows FROM ({REJECTED}) GROUP BY ALL",
        "apps", "repayments", "credit",
    ),
    "applications_kept": sql(f"SELECT * FROM apps WHERE NOT ({INVALID_AMOUNT})", "apps"),
    "dim_applicants_registered": whole("registered"),
    "fact_loans_registered": sql(
        _FACT_SEQUENTIAL.replace("numbered", "registered"), "apps", "registered"
    ),
    "repayments_summary_by_days": sql(
        "SELECT * FROM summary WHERE application_id IS NOT NULL", "summary"
    ),
    "loan_performance_mart_by_days": whole("mart"),
    "dq_loaded_suite": sql(
        " UNION ALL ".join(
            [
                *[loaded_unique(t, "application_id") for t in LOADED[:4]],
                loaded_unique("dim_applicants", "applicant_id"),
                loaded_reference("fact_loans", "applicant_id", "dim_applicants"),
                *[loaded_reference(t, "application_id", "fact_loans") for t in LOADED[:3]],
                *[loaded_reference("fact_loans", "application_id", t) for t in LOADED[:3]],
                loaded_reference("fact_repayments", "application_id", "fact_loans", "warning"),
            ]
        ),
        "fact", "applicants", "employment", "contacts", "kin", "repayments",
    ),
}
