"""Named queries over the derived lending sources, one per operator or table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake import schema
from loanlake.functions.ids import ID_LENGTH
from loanlake.operators import clean, quality
from loanlake.operators.joins import keyed_join
from loanlake.operators.rejects import rejects_per_check
from loanlake.operators.rows import keep_one
from loanlake.plans import deltas, gate, legacy, mart, registry, reports, star
from loanlake.plans.pipeline import star_tables
from loanlake.session import shared_dir, stage
from loanlake.sources.files import CsvScan, read_csv, scan_csv
from loanlake.sources.loads import load_day, publish
from loanlake.sources.tables import (
    LoadError,
    count_rows,
    read_table,
    write_counted,
    write_csv,
    write_table,
)
from loanlake.sources.tpch_lending import (
    line_items,
    orders,
    raw_credit_by_application,
    raw_sources,
)

AS_OF = "2000-01-01"
SSN = ["applicant_ssn"]
LOAN_COLUMNS = (*SSN, *schema.FACT_COLUMNS)


class Lending:
    """Lazy plans of the cleaned sources and the star over one data folder.

    The dimensions and the reports on them remove duplicates on their own few
    columns, so they read the applications without the full-row distinct. Reports
    that need loans and dimensions take both from the distinct rows, whose shuffle
    Spark then runs once.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return raw_sources(self.spark, self.folder)

    @cached_property
    def raw_legacy(self) -> dict[str, DataFrame]:
        return raw_sources(self.spark, self.folder, legacy=True)

    @cached_property
    def applications(self) -> DataFrame:
        return clean.clean_applications(self.raw["loan_applications"])

    @cached_property
    def application_rows(self) -> DataFrame:
        return clean.clean_applications(self.raw["loan_applications"], distinct=False)

    @cached_property
    def loan_rows(self) -> DataFrame:
        """The columns of ``applications`` that loans are made of."""
        return clean.clean_applications(self.raw["loan_applications"], columns=LOAN_COLUMNS)

    @cached_property
    def repayments(self) -> DataFrame:
        as_of = F.lit(AS_OF).cast("timestamp_ntz")
        return clean.clean_repayments(self.raw["loan_repayments"], as_of=as_of)

    @cached_property
    def credit(self) -> DataFrame:
        return clean.clean_credit(self.raw["credit_bureau"])

    @cached_property
    def applicants(self) -> DataFrame:
        return star.applicant_dim(self.application_rows)

    @cached_property
    def employment(self) -> DataFrame:
        return star.employment_dim(self.application_rows)

    @cached_property
    def contacts(self) -> DataFrame:
        return star.contact_dim(self.application_rows)

    @cached_property
    def kin(self) -> DataFrame:
        return star.kin_dim(self.application_rows)

    @cached_property
    def fact(self) -> DataFrame:
        return star.loan_fact(self.applications)

    @cached_property
    def staged(self) -> DataFrame:
        return mart.stage_loans(self.fact)

    @cached_property
    def fact_with_ssn(self) -> DataFrame:
        return star.loan_fact(self.applications, carry=SSN)

    @cached_property
    def credit_by_application(self) -> DataFrame:
        return clean.clean_credit(raw_credit_by_application(self.spark, self.folder))

    @cached_property
    def performance(self) -> DataFrame:
        staged = mart.stage_loans(self.fact_with_ssn, carry=SSN)
        return mart.loan_performance(
            staged, self.repayments, self.credit, credit_key="applicant_ssn"
        )

    @cached_property
    def legacy_applications(self) -> DataFrame:
        return clean.legacy_clean_applications(self.raw_legacy["loan_applications"])

    @cached_property
    def legacy_keyed(self) -> DataFrame:
        return legacy.with_applicant(self.legacy_applications)


def _without_ssn(x: Lending) -> DataFrame:
    return star.applicant_dim(x.application_rows.drop("applicant_ssn"))


def _fact_sequential(x: Lending) -> DataFrame:
    apps = x.applications.drop("applicant_ssn")
    return star.loan_fact(apps, star.applicant_dim(apps))


def _legacy_fact_joined(x: Lending) -> DataFrame:
    applicants = legacy.legacy_applicants(x.legacy_applications)
    return legacy.legacy_loan_fact(legacy.with_applicant(x.legacy_applications, applicants))


def _mart_by_application(x: Lending) -> DataFrame:
    return mart.loan_performance(x.staged, x.repayments, x.credit_by_application)


def _band_sides(x: Lending) -> tuple[DataFrame, ...]:
    applicants = star.applicant_dim(x.applications)
    return x.credit, applicants, x.fact_with_ssn, x.repayments


def _repaid_by_income(x: Lending) -> DataFrame:
    employment = star.employment_dim(x.applications)
    return reports.repaid_by_income(employment, x.fact, x.repayments)


def _not_null(x: Lending) -> DataFrame:
    columns = ["application_id", "applicant_id", "loan_amount_requested_usd", "loan_type"]
    return quality.run_row_checks(x.fact, [quality.not_null(c) for c in columns])


def _unique(x: Lending) -> DataFrame:
    return quality.all_results(
        quality.unique(x.fact, "application_id"),
        quality.unique(x.applicants, "applicant_ssn"),
        quality.unique(x.credit, "applicant_ssn"),
    )


def _accepted_values(x: Lending) -> DataFrame:
    fact = quality.run_row_checks(
        x.fact, [quality.accepted_values("loan_type", ["Personal", "Business", "Auto"])]
    )
    credit = quality.run_row_checks(
        x.credit,
        [
            quality.accepted_values(
                "credit_band", ["Poor", "Fair", "Good"], "credit_band is not null"
            )
        ],
    )
    return quality.all_results(fact, credit)


def _expression(x: Lending) -> DataFrame:
    return quality.run_row_checks(
        x.fact,
        [
            quality.expression_is_true(
                "loan_amount_requested_usd", "loan_amount_requested_usd > 0"
            ),
            quality.expression_is_true(
                "interest_rate", "interest_rate > 0", where="loan_term_months > 12"
            ),
        ],
    )


def _orphans(x: Lending) -> DataFrame:
    return quality.all_results(
        quality.references(x.fact, "applicant_id", x.applicants, "applicant_id"),
        quality.references(x.repayments, "application_id", x.fact, "application_id"),
    )


def _fact_schema(x: Lending) -> DataFrame:
    """Required fact column present, and how many rows lack a value in it."""
    gate.validate_fact(x.fact)
    return x.fact.agg(
        F.lit("application_id").alias("required_column"),
        F.lit("application_id" in x.fact.columns).alias("present"),
        F.count_if(F.col("application_id").isNull()).alias("null_rows"),
        F.count("*").alias("total_rows"),
    )


def _suite_documented(x: Lending) -> DataFrame:
    return gate.documented_suite(
        {
            "fact_loans": x.fact,
            "dim_applicants": x.applicants,
            "dim_employment": x.employment,
            "dim_contact_info": x.contacts,
            "dim_next_of_kin": x.kin,
            "fact_repayments": x.repayments,
        }
    )


def _row_counts(x: Lending) -> DataFrame:
    """Rows of the raw sources and of the seven output tables."""
    cleaned = {
        "loan_applications": stage(x.applications, "counted_applications"),
        "loan_repayments": x.repayments,
        "credit_bureau": x.credit,
    }
    raw = {f"raw_{name}": df for name, df in x.raw.items()}
    return count_rows({**raw, **star_tables(cleaned)})


def _legacy_row_counts(x: Lending) -> DataFrame:
    apps = stage(x.legacy_applications, "counted_legacy_applications")
    repayments = clean.legacy_clean_repayments(x.raw_legacy["loan_repayments"])
    credit = clean.legacy_clean_credit(x.raw_legacy["credit_bureau"])
    return count_rows(legacy.legacy_tables(apps, repayments, credit))


def _csv_roundtrip(x: Lending) -> DataFrame:
    path = f"{shared_dir(x.spark)}/loanlake/csv-{uuid.uuid4().hex}"
    return read_csv(x.spark, write_csv(x.contacts, path), multi_line=True)


def _fresh(x: Lending, what: str) -> tuple[str, str]:
    """A new table name and the folder of such tables."""
    return f"loanlake_{what}_{uuid.uuid4().hex}", f"{shared_dir(x.spark)}/loanlake"


def _read_and_drop(x: Lending, *names: str) -> list[DataFrame]:
    """What tables hold, kept as staged files, so that the catalogue is left as it was."""
    read = [stage(read_table(x.spark, name), name, compression=deltas.CODEC) for name in names]
    for name in names:
        x.spark.sql(f"DROP TABLE {name}")
    return read


def _table_roundtrip(x: Lending) -> DataFrame:
    name, location = _fresh(x, "employment")
    write_table(x.employment, name, location=location)
    return _read_and_drop(x, name)[0]


def _loaded_mart(x: Lending) -> DataFrame:
    """The mart as a run loads it: staged, written as a table and read again."""
    name, location = _fresh(x, "mart")
    write_table(x.performance, name, location=location)
    return _read_and_drop(x, name)[0]


RAGGED_LINE = '''
    case when k % 7 = 0 then concat(k, ',"C, ', u, '",', o_orderstatus, ',EXTRA')
         when k % 11 = 0 then concat(k, ',C', u)
         when k % 13 = 0 then concat(k, ',"C ""', u, '""",', o_orderstatus)
         else concat(k, ',C', u, ',', o_orderstatus) end as `order,customer,status`
'''


def _ragged(x: Lending) -> CsvScan:
    """Orders as the lines of a CSV, some with a field too many or one missing."""
    path = f"{shared_dir(x.spark)}/loanlake/csv-{uuid.uuid4().hex}"
    lines = orders(x.spark, x.folder).selectExpr(RAGGED_LINE)
    # One column without quoting: the lines are written as they are.
    lines.write.csv(path, header=True, sep="\u0001", quote="", escapeQuotes=False)
    return scan_csv(x.spark, path, on_bad_rows="reject")


def _first_in_file(x: Lending) -> DataFrame:
    """First row of every order in a CSV that has the last line item first."""
    path = f"{shared_dir(x.spark)}/loanlake/csv-{uuid.uuid4().hex}"
    lines = line_items(x.spark, x.folder).selectExpr(
        "cast(l_orderkey as string) as application_id",
        "cast(l_linenumber as string) as line_number",
        "cast(cast(l_extendedprice * 100 as bigint) as string) as cents",
    )
    falling = [F.desc("line_number"), F.desc(F.col("cents").cast("long"))]
    write_csv(lines.orderBy(*falling, "application_id"), path)
    return keep_one(scan_csv(x.spark, path, order=True, watch=False).rows, "application_id")


ODD = "cast(substr(application_id, 3) as bigint) % 4 = 1"


def _halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(ODD), df.where(f"not {ODD}")


def _daily(x: Lending) -> DataFrame:
    """Two days are loaded, and the first of them again."""
    name, location = _fresh(x, "days")
    first, second = _halves(stage(x.employment, "employment"))
    days = date(2024, 1, 1), date(2024, 1, 2)
    load_day(first, name, days[0], "run-1", location=location)
    load_day(second, name, days[1], "run-2", location=location)
    load_day(first, name, days[0], "run-3", location=location)
    return _read_and_drop(x, name)[0]


def _written_rows(x: Lending) -> DataFrame:
    """Rows written and rows held, as overwriting, appending and daily loads tell them."""
    name, location = _fresh(x, "counted")
    days = f"{name}_days"
    first, second = _halves(stage(x.employment, "employment"))
    told = {
        "truncate": write_counted(first, name, location=location),
        "append": write_counted(second, name, mode="WRITE_APPEND", location=location),
        "append again": write_counted(second, name, mode="WRITE_APPEND", location=location),
        "day": load_day(first, days, date(2024, 1, 1), "run-1", location=location),
        "next day": load_day(second, days, date(2024, 1, 2), "run-2", location=location),
        "next day again": load_day(second, days, date(2024, 1, 2), "run-3", location=location),
    }
    for table in (name, days):
        x.spark.sql(f"DROP TABLE {table}")
    rows = [(load, one.rows, one.total) for load, one in told.items()]
    return x.spark.createDataFrame(rows, "load string, rows_written long, rows_held long")


def _published(x: Lending) -> DataFrame:
    """Dimensions shown as one unit; the failing load after it changes neither."""
    name, location = _fresh(x, "unit")
    first, second = f"{name}_employment", f"{name}_contacts"
    tables = {first: x.employment, second: x.contacts}
    checks = {second: lambda df: quality.unique(df, "application_id")}
    publish(tables, run_id=f"{name}-1", location=location, checks=checks)
    worse = {first: x.employment.limit(1), second: x.contacts.unionByName(x.contacts)}
    try:
        publish(worse, run_id=f"{name}-2", location=location, checks=checks)
    except LoadError:
        pass
    else:
        raise AssertionError("repeated keys were published")
    shown = [stage(read_table(x.spark, view), view) for view in (first, second)]
    for view in (first, second):
        x.spark.sql(f"DROP VIEW {view}")
    return keyed_join(shown[0], shown[1], "application_id", "inner")


def _set_aside(x: Lending) -> tuple[dict[str, DataFrame], DataFrame]:
    return gate.set_aside(
        {
            "loan_applications": x.applications,
            "loan_repayments": x.repayments,
            "credit_bureau": x.credit,
        }
    )


def _rejected_rows(x: Lending) -> DataFrame:
    _, rejects = _set_aside(x)
    key = F.get_json_object("row_json", "$.application_id").alias("application_id")
    return rejects.select("source", "failed_checks", key)


def _loaded_suite(x: Lending) -> DataFrame:
    """Key checks on written tables in which repeated and unknown keys were planted."""
    name, location = _fresh(x, "star")
    tables = {
        "fact_loans": x.fact,
        "dim_applicants": x.applicants,
        "dim_employment": x.employment,
        "dim_contact_info": x.contacts,
        "dim_next_of_kin": x.kin,
        "fact_repayments": x.repayments,
    }
    for table, df in tables.items():
        write_table(df, f"{name}_{table}", location=location)
    repeated = x.employment.where("application_id like '%77'")
    write_table(repeated, f"{name}_dim_employment", mode="WRITE_APPEND", location=location)
    unknown = x.contacts.where("application_id like '%88'").withColumn(
        "application_id", F.concat(F.lit("GONE"), "application_id")
    )
    write_table(unknown, f"{name}_dim_contact_info", mode="WRITE_APPEND", location=location)
    written = {table: read_table(x.spark, f"{name}_{table}") for table in tables}
    found = stage(gate.loaded_suite(written), "loaded-suite")
    for table in tables:
        x.spark.sql(f"DROP TABLE {name}_{table}")
    return found


def _registered(x: Lending) -> str:
    """Registry table without SSNs: half of the applications, then all, then all again."""
    name, location = _fresh(x, "registry")
    apps = x.applications.drop("applicant_ssn")
    for rows in (_halves(apps)[0], apps, apps):
        registry.register_applicants(rows, name, location=location)
    return name


def _fact_registered(x: Lending) -> DataFrame:
    known = _read_and_drop(x, _registered(x))[0]
    return star.loan_fact(x.applications.drop("applicant_ssn"), registry.dimension(known))


LATER = "day(repayment_date) > 15"


def _states_by_days(x: Lending) -> str:
    """State table after two days; the second is applied twice, the first time cut short."""
    name, location = _fresh(x, "states")
    rows = stage(x.repayments, "repayments")
    later = F.coalesce(F.expr(LATER), F.lit(False))
    days = date(2024, 1, 1), date(2024, 1, 2)
    deltas.apply_day(rows.where(~later), days[0], name, location=location)
    deltas.apply_day(rows.where(later).where(ODD), days[1], name, location=location)
    deltas.apply_day(rows.where(later), days[1], name, location=location)
    return name


def _summary_by_days(x: Lending) -> DataFrame:
    return deltas.summary_of(_read_and_drop(x, _states_by_days(x))[0])


def _mart_by_days(x: Lending) -> DataFrame:
    """The mart, made from the first day and refreshed for what the second has touched."""
    states, location = _fresh(x, "states")
    name = f"{states}_mart"
    loans = mart.stage_loans(star.loan_fact(x.loan_rows, carry=SSN), carry=SSN)
    loans = stage(loans, "loans", compression=deltas.CODEC)
    rows = stage(x.repayments.select(*deltas.READ), "repayments", compression=deltas.CODEC)
    later = F.coalesce(F.expr(LATER), F.lit(False))
    for day, part in ((1, rows.where(~later)), (2, rows.where(later))):
        touched = deltas.apply_day(part, date(2024, 1, day), states, location=location)
        deltas.refresh_mart(
            loans, x.credit, states, name, touched, credit_key="applicant_ssn", location=location
        )
    x.spark.sql(f"DROP TABLE {states}")
    return _read_and_drop(x, name)[0].drop(deltas.BUCKET)


def _cleaned_csv(x: Lending) -> DataFrame:
    """Cleaned repayments landed as CSV and cleaned again: nothing may change."""
    path = f"{shared_dir(x.spark)}/loanlake/csv-{uuid.uuid4().hex}"
    landed = write_csv(x.repayments.drop("application_id"), path)
    again = read_csv(x.spark, landed, multi_line=True)
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return clean.clean_repayments(again, as_of=as_of)


QUERIES: dict[str, Callable[[Lending], DataFrame]] = {
    "clean_applications": lambda x: x.applications,
    "clean_repayments": lambda x: x.repayments,
    "clean_credit": lambda x: x.credit,
    "dim_applicants": lambda x: x.applicants,
    "dim_applicants_sequential": _without_ssn,
    "dim_applicants_long_id": lambda x: star.applicant_dim(
        x.application_rows, id_length=4 * ID_LENGTH
    ),
    "dim_applicant_collisions": lambda x: star.id_collisions(x.applicants),
    "dim_employment": lambda x: x.employment,
    "dim_contact_info": lambda x: x.contacts,
    "dim_next_of_kin": lambda x: x.kin,
    "fact_loans": lambda x: x.fact,
    "fact_loans_joined": lambda x: star.loan_fact(x.applications, x.applicants),
    "fact_loans_sequential": _fact_sequential,
    "stg_loans": lambda x: x.staged.drop("_loaded_at"),
    "repayments_summary": lambda x: mart.summarise_repayments(x.repayments),
    "loan_performance_mart": lambda x: x.performance,
    "loan_performance_mart_loaded": _loaded_mart,
    "loan_performance_mart_by_application": _mart_by_application,
    "loan_segment_slim": lambda x: mart.loan_tiers(x.staged),
    "report_total_by_application": lambda x: reports.total_by_application(x.fact),
    "report_default_by_band": lambda x: reports.default_by_band(*_band_sides(x)),
    "report_default_rate_by_band": lambda x: reports.default_rate_by_band(*_band_sides(x)),
    "report_education": lambda x: reports.applicants_by_education(x.applicants),
    "report_income_by_employment": lambda x: reports.income_by_employment(x.employment),
    "report_monthly_applications": lambda x: reports.applications_per_month(x.fact),
    "report_repaid_by_income": _repaid_by_income,
    "report_state": lambda x: reports.applicants_by_state(x.contacts),
    "report_kin": lambda x: reports.kin_relationships(x.kin),
    "credit_band_distribution": lambda x: clean.credit_band_distribution(x.credit),
    "dq_loan_amounts": lambda x: gate.amount_quality(x.applications),
    "dq_repayments": lambda x: gate.repayment_quality(x.repayments),
    "dq_credit": lambda x: gate.credit_quality(x.credit),
    "dq_fact_schema": _fact_schema,
    "dq_not_null": _not_null,
    "dq_unique": _unique,
    "dq_accepted_values": _accepted_values,
    "dq_expression": _expression,
    "dq_between": lambda x: gate.loan_suite(x.fact),
    "dq_orphans": _orphans,
    "dq_staging_suite": lambda x: gate.staging_suite(x.staged),
    "dq_mart_suite": lambda x: gate.mart_suite(stage(x.performance, "mart")),
    "dq_documented_suite": _suite_documented,
    "pipeline_row_counts": _row_counts,
    "legacy_clean_applications": lambda x: x.legacy_applications,
    "legacy_clean_repayments": lambda x: clean.legacy_clean_repayments(
        x.raw_legacy["loan_repayments"]
    ),
    "legacy_clean_credit": lambda x: clean.legacy_clean_credit(x.raw_legacy["credit_bureau"]),
    "legacy_applicants": lambda x: legacy.legacy_applicants(x.legacy_applications),
    "legacy_employment": lambda x: legacy.legacy_employment(x.legacy_keyed),
    "legacy_contact_info": lambda x: legacy.legacy_contact_info(x.legacy_keyed),
    "legacy_next_of_kin": lambda x: legacy.legacy_next_of_kin(x.legacy_keyed),
    "legacy_loan_fact": lambda x: legacy.legacy_loan_fact(x.legacy_keyed),
    "legacy_loan_fact_joined": _legacy_fact_joined,
    "legacy_row_counts": _legacy_row_counts,
    "csv_roundtrip": _csv_roundtrip,
    "csv_recleaned": _cleaned_csv,
    "table_roundtrip": _table_roundtrip,
    "csv_rejected_lines": lambda x: _ragged(x).rejects.drop("file"),
    "csv_kept_rows": lambda x: _ragged(x).rows,
    "csv_first_in_file": _first_in_file,
    "load_written_rows": _written_rows,
    "load_day_repeated": _daily,
    "load_as_unit": _published,
    "rejected_rows": _rejected_rows,
    "rejected_rows_per_check": lambda x: rejects_per_check(_set_aside(x)[1]),
    "applications_kept": lambda x: _set_aside(x)[0]["loan_applications"],
    "dq_loaded_suite": _loaded_suite,
    "dim_applicants_registered": lambda x: _read_and_drop(x, _registered(x))[0],
    "fact_loans_registered": _fact_registered,
    "repayments_summary_by_days": _summary_by_days,
    "loan_performance_mart_by_days": _mart_by_days,
}


def run_query(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](Lending(spark, folder))
