import pytest

from loanlake.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    return session


def text_frame(spark, columns, rows):
    """Frame of text columns, as a CSV gives them."""
    types = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame(rows, types)


LOAN_COLUMNS = [
    "application_id",
    "applicant_ssn",
    "Applicant Full Name",
    "applicant_date_of_birth",
    "application_date",
    "loan_type",
    "loan_amount_requested_usd",
    "loan_term_months",
    "interest_rate",
    "applicant_phone_number",
    "employment_type",
    "monthly_income_usd",
]
INES = (
    "APP001", "900-10-0001", "Ines Okafor", "1979-11-02", "2024-01-09", "Personal",
    "14200", "36", "6.1", "+31 20 555 0188", "Full-time", "4700",
)
TEO = (
    "APP002", "900-10-0002", "Teo Lindqvist", "1993-07-19", "2024-02-12", "Business",
    "31500", "60", "8.4", "(020) 555-0142", "Self-employed", "7300",
)
MARA = (
    "APP003", "900-10-0003", "Mara Whitlow", "bad-date", "2024-03-21", "Auto",
    "not_a_number", "24", "5.2", None, "Part-time", "2900",
)


@pytest.fixture(scope="session")
def loans(spark):
    return text_frame(spark, LOAN_COLUMNS, [INES, TEO, MARA, INES])


@pytest.fixture(scope="session")
def repayments(spark):
    return text_frame(
        spark,
        ["application_id", "repayment_date", "amount_paid_usd", "days_overdue", "payment_status"],
        [
            ("APP001", "2024-02-09", "410", "0", "Paid"),
            ("APP001", "2024-03-09", "410", "0", "Paid"),
            ("APP002", "2024-03-28", "615", "41", "Late"),
            (None, "2024-04-02", "75", "0", "Paid"),
        ],
    )


@pytest.fixture(scope="session")
def credit(spark):
    return text_frame(
        spark,
        [
            "application_id", "credit_score", "total_accounts", "delinquent_accounts",
            "credit_utilization_pct", "bureau_pull_date",
        ],
        [
            ("APP001", "731", "6", "0", "22.5", "2024-01-05"),
            ("APP002", "604", "9", "2", "58.4", "2024-02-08"),
            ("APP003", "688", "4", "1", "39.0", "bad-date"),
        ],
    )
