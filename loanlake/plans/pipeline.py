"""One run: read, clean, model, validate, land as CSV, load as tables."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from datetime import date, datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loanlake.functions.ids import ID_LENGTH
from loanlake.functions.parse import ISO
from loanlake.operators import clean, quality
from loanlake.plans import gate as gates
from loanlake.plans import mart, star
from loanlake.plans.gate import ValidationError
from loanlake.plans.legacy import legacy_tables
from loanlake.schema import SOURCE_FILES
from loanlake.session import stage
from loanlake.sources.files import scan_sources
from loanlake.sources.loads import load_days, publish
from loanlake.sources.tables import Written, land_csv, load_all, load_counted, row_counts

log = logging.getLogger(__name__)


def new_run_id(prefix: str = "run") -> str:
    return f"{prefix}-{datetime.now(timezone.utc):%Y%m%d-%H%M%S}"


def clean_sources(
    raw: Mapping[str, DataFrame],
    as_of: Column | None = None,
    date_formats: Iterable[str] = (ISO,),
    dropped: Observation | None = None,
) -> dict[str, DataFrame]:
    formats = tuple(date_formats)
    return {
        "loan_applications": clean.clean_applications(
            raw["loan_applications"], date_formats=formats, dropped=dropped
        ),
        "loan_repayments": clean.clean_repayments(
            raw["loan_repayments"], as_of=as_of, date_formats=formats
        ),
        "credit_bureau": clean.clean_credit(raw["credit_bureau"], date_formats=formats),
    }


def star_tables(
    cleaned: Mapping[str, DataFrame], id_length: int = ID_LENGTH
) -> dict[str, DataFrame]:
    """The seven output tables from cleaned sources."""
    apps = cleaned["loan_applications"]
    applicants = star.applicant_dim(apps, id_length=id_length)
    by_hash = "applicant_ssn" in apps.columns
    return {
        "fact_loans": star.loan_fact(
            apps, None if by_hash else applicants, id_length=id_length
        ),
        "dim_applicants": applicants,
        "dim_employment": star.employment_dim(apps),
        "dim_contact_info": star.contact_dim(apps),
        "dim_next_of_kin": star.kin_dim(apps),
        "fact_repayments": cleaned["loan_repayments"],
        "dim_credit_bureau": cleaned["credit_bureau"],
    }


def mart_tables(
    cleaned: Mapping[str, DataFrame],
    *,
    id_length: int = ID_LENGTH,
    credit_key: str = "application_id",
    on_failed: str = "raise",
) -> dict[str, DataFrame]:
    """Staging view, performance mart and slim mart, staged and checked.

    A critical check of either suite that fails raises, before anything is
    loaded; ``on_failed="report"`` only logs it, as warnings always are.
    """
    apps = cleaned["loan_applications"]
    carry = ["applicant_ssn"] if credit_key == "applicant_ssn" else []
    if "applicant_ssn" in apps.columns:
        fact = star.loan_fact(apps, id_length=id_length, carry=carry)
    else:
        fact = star.loan_fact(apps, star.applicant_dim(apps), carry=carry)
    staged = stage(mart.stage_loans(fact, carry), "stg_loans")
    performance = mart.loan_performance(
        staged, cleaned["loan_repayments"], cleaned["credit_bureau"], credit_key=credit_key
    )
    performance = stage(performance, "fact_loan_performance")
    for suite in (gates.staging_suite(staged), gates.mart_suite(performance)):
        for found in quality.failures(suite, quality.WARNING):
            log.warning("check failed: %s", found)
        if critical := quality.failures(suite):
            if on_failed == "raise":
                raise ValidationError("; ".join(critical))
            log.error("checks failed: %s", "; ".join(critical))
    return {
        "stg_loans": staged.drop(*carry),
        "fact_loan_performance": performance,
        "fact_loan_segments": mart.loan_tiers(staged),
    }


def written_checks(tables: Mapping[str, DataFrame]) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Suites that read the tables of a unit after they are written."""
    suites = {
        "stg_loans": gates.staging_suite,
        "fact_loan_performance": gates.mart_suite,
        "fact_loans": partial(quality.unique, column="application_id"),
        "dim_employment": partial(quality.unique, column="application_id"),
        "dim_contact_info": partial(quality.unique, column="application_id"),
        "dim_next_of_kin": partial(quality.unique, column="application_id"),
    }
    return {name: suite for name, suite in suites.items() if name in tables}


def run_files(
    spark: SparkSession,
    folder: str,
    files: Mapping[str, str] = SOURCE_FILES,
    *,
    on_bad_rows: str = "reject",
    rejects: str | None = None,
    multi_line: bool = False,
    **options,
) -> dict:
    """``run`` over the CSV sources of a folder, with a report of their lines.

    The summary tells lines, columns and bad lines of every source, all counted
    while the sources are cleaned. Bad lines are written to the folder ``rejects``
    as parquet, if there are any; only then are the sources read again for them.
    """
    scans = scan_sources(
        spark, folder, files, on_bad_rows=on_bad_rows, multi_line=multi_line, order=True
    )
    summary = run({name: scan.rows for name, scan in scans.items()}, **options)
    sources = {}
    for name, scan in scans.items():
        told = scan.found.get
        columns = len(scan.rows.columns) - 1
        log.info("read %s: %d lines, %d columns, %d bad", name, told["lines"], columns, told["bad"])
        sources[name] = {"lines": told["lines"], "columns": columns, "bad": told["bad"]}
    bad = [
        scan.rejects.select(F.lit(name).alias("source"), "*")
        for name, scan in scans.items()
        if sources[name]["bad"]
    ]
    if bad and rejects:
        quality.all_results(*bad).write.mode("overwrite").parquet(rejects)
    return summary | {"sources": sources}


def run_report(
    raw: Mapping[str, DataFrame], cleaned: Mapping[str, DataFrame], dropped: Observation
) -> dict:
    """Raw and dropped rows, payments dated in the future, rows per credit band."""
    repayments = cleaned["loan_repayments"]
    bands = clean.credit_band_distribution(cleaned["credit_bureau"])
    return {
        "raw_rows": row_counts(raw),
        "dropped_applications": dropped.get["dropped"],
        "future_dated_repayments": repayments.where("is_future_dated").count(),
        "credit_bands": {r["credit_band"]: r["rows_in_band"] for r in bands.collect()},
    }


def run(
    raw: Mapping[str, DataFrame],
    *,
    landing: str | None = None,
    database: str | None = None,
    location: str | None = None,
    mode: str = "cloud",
    write_mode: str = "WRITE_TRUNCATE",
    dry_run: bool = False,
    as_of: Column | None = None,
    date_formats: Iterable[str] = (ISO,),
    id_length: int = ID_LENGTH,
    marts: bool = False,
    credit_key: str = "application_id",
    on_failed_checks: str = "raise",
    report: bool = False,
    set_aside: bool = False,
    load_date: date | None = None,
    as_unit: bool = False,
) -> dict:
    """Run the pipeline and return its summary.

    The cleaned sources are staged once, as most outputs read them; a run that
    writes stages the modelled tables too, so that landing and loading copy them
    instead of computing each twice. Validation comes before any output.
    ``mode="local"`` lands CSV files but loads no tables.

    ``marts`` adds the staging view and the marts to the output and acts on their
    suites (see ``mart_tables``); ``report`` adds what the cleaners met to the
    summary, and the rows that each load wrote beside those that its table holds. ``date_formats``, ``id_length`` and ``credit_key`` go to the cleaners,
    the star and the mart.

    ``set_aside`` takes rows that fail a rule out of the sources and adds them to the
    output as ``rejected_rows`` (see ``gate.set_aside``). ``load_date`` loads the
    tables as that day's partitions, which replaces what an earlier run of the day
    has loaded (``load_day``). ``as_unit`` writes to a folder of the run below
    ``location``, checks what was written, and shows all tables or none
    (``publish``). Without either, tables are written as ``write_mode`` says.
    """
    if as_unit and (load_date or not location):
        raise ValueError("a load as one unit needs a location and no load date")
    started = time.monotonic()
    run_id = new_run_id()
    log.info("run %s started", run_id)
    dropped = Observation(f"dropped-{run_id}-{uuid.uuid4().hex}")
    cleaned = clean_sources(raw, as_of, date_formats, dropped if report else None)
    cleaned = {name: stage(df, name) for name, df in cleaned.items()}
    rejects = {}
    if set_aside:
        cleaned, rejected = gates.set_aside(cleaned)
        rejects = {"rejected_rows": rejected}
    tables = star_tables(cleaned, id_length) | rejects
    gates.gate(
        cleaned["loan_applications"],
        cleaned["loan_repayments"],
        cleaned["credit_bureau"],
        tables["fact_loans"],
    )
    already = {"fact_repayments", "dim_credit_bureau"}
    if marts:
        checked = mart_tables(
            cleaned, id_length=id_length, credit_key=credit_key, on_failed=on_failed_checks
        )
        already |= set(checked)
        tables |= checked
    if dry_run:
        loaded = {name: Written(0, rows) for name, rows in row_counts(tables).items()}
    else:
        tables = {n: df if n in already else stage(df, n) for n, df in tables.items()}
        if landing:
            land_csv(tables, landing)
        place = {"database": database, "location": location}
        if mode == "local":
            loaded = {name: Written(0, 0) for name in tables}
        elif load_date:
            loaded = load_days(tables, load_date, run_id, **place)
        elif as_unit:
            loaded = publish(tables, run_id=run_id, checks=written_checks(tables), **place)
        else:
            loaded = load_counted(tables, mode=write_mode, run_id=run_id, **place)
    summary = {
        "status": "success",
        "run_id": run_id,
        "mode": mode,
        "dry_run": dry_run,
        "elapsed_seconds": round(time.monotonic() - started, 2),
        "tables_loaded": {name: one.total for name, one in loaded.items()},
    }
    if not report:
        return summary
    return summary | {
        "report": run_report(raw, cleaned, dropped),
        "rows_written": {name: one.rows for name, one in loaded.items()},
    }


def run_legacy(
    raw: Mapping[str, DataFrame],
    *,
    landing: str | None = None,
    database: str | None = None,
    location: str | None = None,
    load: bool = True,
) -> dict:
    """The older run: no validation, and a table that cannot be written is only logged."""
    cleaned = {
        "loan_applications": clean.legacy_clean_applications(raw["loan_applications"]),
        "loan_repayments": clean.legacy_clean_repayments(raw["loan_repayments"]),
        "credit_bureau": clean.legacy_clean_credit(raw["credit_bureau"]),
    }
    cleaned = {name: stage(df, f"legacy_{name}") for name, df in cleaned.items()}
    tables = legacy_tables(
        cleaned["loan_applications"], cleaned["loan_repayments"], cleaned["credit_bureau"]
    )
    tables = {n: df if n in cleaned else stage(df, f"legacy_{n}") for n, df in tables.items()}
    if landing:
        land_csv(tables, landing)
    if load:
        load_all(tables, on_error="continue", database=database, location=location)
    return {"status": "success", "tables_processed": row_counts(tables)}
