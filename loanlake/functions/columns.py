"""Column-name rules and projections that tolerate absent columns."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# A run of these characters becomes one underscore.
SEPARATORS = r"[\s()-]+"


def _standard(name: str) -> str:
    return re.sub(SEPARATORS, "_", name.strip().lower()).strip("_")


def _legacy_repayments(name: str) -> str:
    return re.sub(r"[()]", "", name.replace(" ", "_")).lower()


def _legacy_applications(name: str) -> str:
    return _legacy_repayments(name.strip())


def _legacy_credit(name: str) -> str:
    return name.replace(" ", "_").lower()


NAME_STYLES = {
    "standard": _standard,
    "legacy_repayments": _legacy_repayments,
    "legacy_applications": _legacy_applications,
    "legacy_credit": _legacy_credit,
}


def normalise_names(names: Iterable[str], style: str = "standard") -> list[str]:
    """Apply a naming style; two columns that end up with one name are an error."""
    result = [NAME_STYLES[style](n) for n in names]
    clashes = sorted(n for n, times in Counter(result).items() if times > 1)
    if clashes:
        raise ValueError(f"columns clash after renaming: {', '.join(clashes)}")
    return result


def rename_columns(df: DataFrame, style: str = "standard") -> DataFrame:
    return df.toDF(*normalise_names(df.columns, style))


def available(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in wanted if c in present]


def select_available(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    return df.select(*available(df, wanted))


def select_typed(df: DataFrame, types: Mapping[str, str]) -> list:
    """Columns of ``types`` as expressions; absent ones become typed nulls."""
    present = set(df.columns)
    return [
        (F.col(c) if c in present else F.lit(None).cast(t)).alias(c)
        for c, t in types.items()
    ]


def keys_first(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, *[c for c in df.columns if c not in keys])
