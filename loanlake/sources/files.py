"""File sources: raw CSV as text, parquet, and the set of configured sources."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from loanlake.schema import NULL_TOKENS, SOURCE_FILES


def nulls_from_tokens(df: DataFrame, tokens=NULL_TOKENS) -> DataFrame:
    """Replace the texts that stand for a missing value by NULL in text columns."""

    def clean(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.StringType):
            return c
        return F.when(~c.isin(*tokens), c).alias(field.name)

    return df.select(*[clean(f) for f in df.schema])


#: Column of a scanned file that says where a row stands in it.
ORDER = "source_order"
_BAD = "_bad_line"
#: What is done about lines whose number of fields differs from the header's.
POLICIES = ("raise", "reject", "pad")


@dataclass(frozen=True)
class CsvScan:
    """Rows of a CSV source and the lines that do not fit its header.

    ``found`` has the number of ``lines`` and of ``bad`` ones once the first plan
    over ``rows`` has run, so no pass is spent on counting. ``rejects`` has
    ``file``, ``line``, ``expected_fields``, ``found_fields`` and ``problem``.
    """

    rows: DataFrame
    rejects: DataFrame
    found: Observation


def field_count(line: Column) -> Column:
    """Fields of a CSV line; separators inside quotes do not count."""
    bare = F.regexp_replace(line, '"([^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def scan_csv(
    spark: SparkSession,
    path: str,
    *,
    on_bad_rows: str = "raise",
    multi_line: bool = False,
    null_tokens=NULL_TOKENS,
    order: bool = False,
    watch: bool = True,
) -> CsvScan:
    """Read a CSV against its own header; every line has to have as many fields.

    The header of the first file is the schema, every column text, and the header
    of each other file must agree with it. Lines with too many or too few fields,
    or with a quote that is never closed, make the plan fail (``"raise"``), are
    left out of ``rows`` (``"reject"``), or are cut and padded (``"pad"``); in any
    case ``rejects`` tells them. Blank lines are no rows. Lines are told apart while
    they are parsed, so there is no second pass, but no column of the file can be
    skipped either.

    ``order`` adds ``source_order``: place of the file among the files of ``path`` by
    name, start of the split and place in it, numbered by the scan itself, so that the
    rows of a scan can be put in the order of their files after any shuffle.
    ``watch=False`` does not count lines.
    """
    if on_bad_rows not in POLICIES:
        raise ValueError(f"unknown policy for bad rows: {on_bad_rows}")
    names = spark.read.csv(path, header=True, escape='"', multiLine=multi_line).columns
    if not names:
        raise ValueError(f"{path} has no header")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, _BAD]])
    named = not any(re.fullmatch(r"_c\d+", name) for name in names)
    # A parser that skips columns would not see how many fields a line has.
    parsed = spark.read.schema(schema).option("columnPruning", False).csv(
        path,
        header=True,
        escape='"',
        multiLine=multi_line,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=_BAD,
        enforceSchema=not named,
    )
    # Not a bare null test: the scan would evaluate that before it knows the line is bad.
    # The first column is read along, as a plan may not need the bad lines alone.
    first = F.col(f"`{names[0]}`")
    bad = F.coalesce(F.octet_length(_BAD) >= 0, F.octet_length(first) < 0, F.lit(False))
    rejects = parsed.where(bad).select(
        F.col("_metadata.file_path").alias("file"),
        F.col(_BAD).alias("line"),
        F.lit(len(names)).alias("expected_fields"),
        field_count(F.col(_BAD)).alias("found_fields"),
    )
    rejects = rejects.withColumn(
        "problem",
        F.when(F.col("found_fields") > len(names), "too many fields")
        .when(F.col("found_fields") < len(names), "too few fields")
        .otherwise("unreadable"),
    )
    found = Observation(f"csv-{uuid.uuid4().hex}")
    kept = numbered_rows(parsed, path) if order else parsed
    if watch:
        kept = kept.observe(found, F.count("*").alias("lines"), F.count_if(bad).alias("bad"))
    if on_bad_rows == "raise":
        told = F.concat(F.lit(f"line of {path} does not fit its header: "), F.col(_BAD))
        kept = kept.where(F.when(bad, F.raise_error(told).cast("boolean")).otherwise(True))
    elif on_bad_rows == "reject":
        kept = kept.where(~bad)
    return CsvScan(nulls_from_tokens(kept.drop(_BAD), null_tokens), rejects, found)


def numbered_rows(scan: DataFrame, path: str) -> DataFrame:
    """Rows of a file scan with ``source_order``, where a number stands for the file's name.

    A path in every row would be most of what a task sorts. The files are listed, not
    read, to number their names; that list, one row per file, is sent to all tasks.
    """
    listed = scan.sparkSession.read.format("binaryFile").load(path)
    files = listed.select(F.col("_metadata.file_path").alias("_path"))
    numbered = files.select("_path", F.row_number().over(W.orderBy("_path")).alias("_file"))
    placed = scan.select(
        "*",
        F.col("_metadata.file_path").alias("_scanned"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    place = F.struct(
        F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_row").alias("row")
    )
    joined = placed.join(F.broadcast(numbered), F.col("_scanned") == F.col("_path"), "left")
    return joined.select(*[f"`{c}`" for c in scan.columns], place.alias(ORDER))


def read_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """Rows of ``scan_csv``: a header, every column as text, types from declared contracts.

    Inference would need a second pass over the file and make a column's type
    depend on its content. ``multi_line`` is for quoted line breaks only: it
    stops Spark from splitting a file. A missing path fails at once, a line that
    does not fit the header when it is read.
    """
    return scan_csv(spark, path, watch=False, **options).rows


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_sources(
    spark: SparkSession,
    folder: str,
    files: Mapping[str, str] = SOURCE_FILES,
    *,
    fmt: str = "csv",
    **options,
) -> dict[str, DataFrame]:
    """All configured sources by name; nothing is read until a plan runs."""
    readers = {"csv": read_csv, "parquet": read_parquet}
    root = folder.rstrip("/")
    return {
        name: readers[fmt](spark, f"{root}/{file}", **options)
        for name, file in files.items()
    }


def scan_sources(
    spark: SparkSession, folder: str, files: Mapping[str, str] = SOURCE_FILES, **options
) -> dict[str, CsvScan]:
    """All configured CSV sources by name, with the lines that do not fit their headers."""
    root = folder.rstrip("/")
    return {name: scan_csv(spark, f"{root}/{file}", **options) for name, file in files.items()}
