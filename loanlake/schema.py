"""Column contracts of the raw sources and of the tables built from them."""

# Raw source files.
SOURCE_FILES = {
    "loan_applications": "loan_applications.csv",
    "loan_repayments": "loan_repayments.csv",
    "credit_bureau": "credit_bureau_data.csv",
}

# Texts that a CSV cell may hold in place of a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Columns that are parsed, per source. Any of them may be absent.
APPLICATION_DATES = ("application_date", "applicant_date_of_birth")
APPLICATION_NUMBERS = (
    "loan_amount_requested_usd",
    "monthly_income_usd",
    "annual_income_usd",
    "loan_term_months",
    "interest_rate",
)
APPLICATION_PHONES = ("applicant_phone_number",)
CREDIT_NUMBERS = (
    "credit_score",
    "number_of_credit_accounts",
    "number_of_derogatory_marks",
    "credit_utilization_pct",
    "delinquent_accounts",
)

# Columns of the star schema.
APPLICANT_ATTRIBUTES = (
    "applicant_ssn",
    "applicant_full_name",
    "applicant_date_of_birth",
    "applicant_gender",
    "applicant_marital_status",
    "applicant_level_of_education",
)
EMPLOYMENT_COLUMNS = (
    "application_id",
    "employment_type",
    "employer_name",
    "monthly_income_usd",
    "employment_duration_months",
)
CONTACT_COLUMNS = (
    "application_id",
    "applicant_email",
    "applicant_phone_number",
    "applicant_state",
    "applicant_city",
    "applicant_address",
)
KIN_COLUMNS = (
    "application_id",
    "next_of_kin_name",
    "next_of_kin_relationship",
    "next_of_kin_phone",
    "next_of_kin_email",
)
FACT_COLUMNS = (
    "application_id",
    "applicant_id",
    "application_date",
    "loan_type",
    "loan_amount_requested_usd",
    "loan_purpose",
    "loan_term_months",
    "interest_rate",
)
STAGING_TYPES = {
    "application_id": "string",
    "applicant_id": "string",
    "loan_type": "string",
    "loan_amount_requested_usd": "double",
    "loan_term_months": "double",
    "interest_rate": "double",
    "loan_purpose": "string",
    "estimated_monthly_payment_usd": "double",
}
MART_CREDIT_TYPES = {
    "credit_score": "double",
    "credit_band": "string",
    "credit_utilization_pct": "double",
    "delinquent_accounts": "double",
}

# Columns of the older star schema.
LEGACY_APPLICATION_PHONES = ("applicant_phone_number", "next_of_kin_phone_number")
LEGACY_EMPLOYMENT_COLUMNS = (
    "employment_type",
    "employer_name",
    "duration_of_employment_years",
    "monthly_income_usd",
    "bank_account_number",
)
LEGACY_CONTACT_COLUMNS = (
    "applicant_street_address",
    "applicant_city",
    "applicant_state",
    "applicant_zip_code",
    "applicant_phone_number",
    "applicant_email_address",
)
LEGACY_KIN_COLUMNS = (
    "next_of_kin_full_name",
    "next_of_kin_relationship",
    "next_of_kin_phone_number",
)
LEGACY_FACT_COLUMNS = (
    "application_id",
    "applicant_id",
    "application_date",
    "loan_type",
    "loan_amount_requested_usd",
    "loan_purpose",
    "repayment_tenure_months",
)

# Class limits. A loan is of the first size it exceeds the limit of.
LOAN_SEGMENT_ABOVE = {50000: "LARGE", 10000: "MEDIUM", 1000: "SMALL"}
SMALLEST_SEGMENT = "MICRO"
VALUE_TIER_ABOVE = {5000: "HIGH_VALUE", 1000: "MEDIUM_VALUE"}
LOWEST_TIER = "LOW_VALUE"
# Bands of the cleaned scores: above the first limit, up to and with the second.
CREDIT_BAND_LIMITS = (
    ("Poor", 299, 579),
    ("Fair", 579, 669),
    ("Good", 669, 739),
    ("Very Good", 739, 799),
    ("Exceptional", 799, 850),
)
# Bands of the default report: below the limit, between the limits, or any other.
REPORT_BANDS = (
    ("Poor", None, 580),
    ("Fair", 580, 669),
    ("Good", 670, 739),
    ("Very Good", 740, 799),
    ("Excellent", None, None),
)
HIGH_RISK_BANDS = ("Poor", "Fair")

# Accepted categories and limits of the quality checks.
LOAN_TYPES = ("Personal", "Business", "Auto", "Mortgage", "Student", "Other")
LOAN_SEGMENTS = ("MICRO", "SMALL", "MEDIUM", "LARGE")
CREDIT_BANDS = ("Poor", "Fair", "Good", "Very Good", "Exceptional")
MAX_LOAN_AMOUNT = 500000
MAX_INVALID_SHARE = 0.2
MIN_CREDIT_SCORE = 300
MAX_CREDIT_SCORE = 850
SUITE_AMOUNT_RANGE = (0, 100000)
DOCUMENTED_AMOUNT_RANGE = (100, 500000)
DELINQUENT_AFTER_DAYS = 30
DEFAULT_TERM_MONTHS = 60
