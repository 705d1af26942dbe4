"""Raw lending sources derived from order, customer and line-item tables.

Every order becomes a loan application, every line item a repayment and every
customer a bureau record. Values are text, as in a CSV; gaps, bad values and
exact copies are put in so that the cleaners have work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanlake.operators.joins import keyed_join



def dollars(cents: str) -> str:
    """Text of an amount with two places, from whole cents, so that no rounding differs."""
    whole = f"cast(floor({cents}) as bigint)"
    return f"concat({whole} div 100, '.', lpad({whole} % 100, 2, '0'))"


APPLICATIONS = {
    "application_id": "if(k % 97 = 0, null, concat('LN', k))",
    "applicant_ssn": "if(u % 101 = 0, null, concat('S', u))",
    "applicant_full_name": "c_name",
    "applicant_date_of_birth": "if(u % 53 = 0, 'bad-date', concat('19', 50 + u % 45, '-06-15'))",
    "applicant_gender": "case when u % 7 = 0 then null when u % 2 = 0 then 'F' else 'M' end",
    "applicant_marital_status": "c_mktsegment",
    "applicant_level_of_education": (
        "case u % 4 when 0 then 'Bachelor' when 1 then 'Master'"
        " when 2 then 'High School' else 'PhD' end"
    ),
    "applicant_phone_number": (
        "case when k % 71 = 0 then null when k % 3 = 0 then concat('+44 7911 ', 100000 + k)"
        " else concat('(555) 123-', 1000 + k % 9000) end"
    ),
    "applicant_email": "concat('c', u, '@example.com')",
    "applicant_state": "concat('NATION_', c_nationkey)",
    "applicant_city": "concat('City ', u % 300)",
    "employment_type": (
        "case k % 4 when 0 then 'Full-time' when 1 then 'Part-time'"
        " when 2 then 'Self-employed' end"
    ),
    "employer_name": "concat('Employer ', u % 200)",
    "monthly_income_usd": "cast(1000 + (u * 131) % 9000 as string)",
    "employment_duration_months": "cast((k * 7) % 240 as string)",
    "next_of_kin_name": "concat('Kin ', u)",
    "next_of_kin_relationship": (
        "case u % 3 when 0 then 'Spouse' when 1 then 'Parent' else 'Sibling' end"
    ),
    "next_of_kin_phone": "concat('+1 ', 2000000 + u)",
    "application_date": (
        "concat(cast(cast(o_orderdate as date) as string),"
        " case k % 3 when 0 then ' 10:30:00' when 1 then 'T23:59:59' else '' end)"
    ),
    "loan_type": (
        "case o_orderpriority when '1-URGENT' then 'Personal' when '2-HIGH' then 'Business'"
        " when '3-MEDIUM' then 'Auto' when '5-LOW' then 'Mortgage' else 'Other' end"
    ),
    "loan_purpose": (
        "case o_orderstatus when 'F' then 'Debt consolidation'"
        " when 'O' then 'Home improvement' else 'Education' end"
    ),
    "loan_amount_requested_usd": (
        "if(k % 89 = 0, 'not_a_number',"
        f" {dollars('o_totalprice * o_totalprice / 25000')})"
    ),
    "loan_term_months": (
        "case k % 5 when 1 then '12' when 2 then '24' when 3 then '36' when 4 then '60' end"
    ),
    "interest_rate": "if(k % 17 = 0, null, cast((k % 13) * 0.75D as string))",
}

REPAYMENTS = {
    "loan_application_id": "concat('LN', l_orderkey)",
    "repayment_date": "cast(cast(l_shipdate as date) as string)",
    "amount_paid_usd": dollars("l_extendedprice * 10"),
    "days_overdue": "if(l_linenumber = 7, null, cast(cast(l_quantity as int) - 1 as string))",
    "payment_status": (
        "case l_returnflag when 'A' then 'Paid' when 'N' then 'Late' else 'Defaulted' end"
    ),
}

CREDIT = {
    "applicant_ssn": "concat('S', u)",
    "credit_score": "if(u % 29 = 0, null, cast(300 + (u * 37) % 551 as string))",
    "credit_utilization_pct": "cast(u % 100 as string)",
    "delinquent_accounts": "cast(u % 4 as string)",
    "bureau_pull_date": "if(u % 41 = 0, 'bad-date', '2024-01-10')",
}

# Bureau rows that know their application; every 40th has two of them.
CREDIT_BY_APPLICATION = {
    "application_id": "if(k % 97 = 0, null, concat('LN', k))",
    "applicant_ssn": "concat('S', u)",
    "credit_score": "if(k % 29 = 0, null, cast(300 + (k * 41 + copy * 13) % 551 as string))",
    "credit_utilization_pct": "cast(k % 100 as string)",
    "delinquent_accounts": "cast(k % 4 as string)",
    "bureau_pull_date": "if(k % 41 = 0, 'bad-date', '2024-01-10')",
}

# Stated so that no job has to read a file footer for them.
TABLE_TYPES = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_returnflag string, l_shipdate timestamp_ntz"
    ),
}

# Column names of the older source files.
LEGACY_NAMES = {
    "applicant_email": "applicant_email_address",
    "next_of_kin_name": "next_of_kin_full_name",
    "next_of_kin_phone": "next_of_kin_phone_number",
    "loan_term_months": "repayment_tenure_months",
}


def header(name: str) -> str:
    """Column title as a spreadsheet would show it."""
    return name.replace("_usd", "_(USD)").replace("_", " ").title().replace("Usd", "USD")


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} as `{header(name)}`" for name, expr in columns.items()])


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder.rstrip('/')}/{name}.parquet"
    return spark.read.schema(TABLE_TYPES[name]).parquet(path)


def line_items(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "lineitem")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").withColumnsRenamed({"o_orderkey": "k", "o_custkey": "u"})


def raw_credit_by_application(spark: SparkSession, folder: str) -> DataFrame:
    copies = orders(spark, folder).selectExpr(
        "*", "explode(sequence(1, if(k % 40 = 1, 2, 1))) as copy"
    )
    return _project(copies, CREDIT_BY_APPLICATION)


def raw_sources(spark: SparkSession, folder: str, *, legacy: bool = False) -> dict[str, DataFrame]:
    customers = _table(spark, folder, "customer").withColumnRenamed("c_custkey", "u")
    applications = keyed_join(orders(spark, folder), customers, "u", "inner").selectExpr(
        "*", "explode(sequence(1, if(k % 50 = 1, 2, 1))) as copy"
    )
    columns = APPLICATIONS
    if legacy:
        columns = {LEGACY_NAMES.get(name, name): expr for name, expr in columns.items()}
    return {
        "loan_applications": _project(applications, columns),
        "loan_repayments": _project(line_items(spark, folder), REPAYMENTS),
        "credit_bureau": _project(customers, CREDIT),
    }
