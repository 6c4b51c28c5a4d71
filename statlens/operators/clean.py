"""Cleaning an indicator frame to comparable rows.

An indicator frame has one row per (entity, year): countries, group rows
(continents, income groups) and ``World`` all share the entity column.  The
cleaning steps are plain projections and filters; written before any
aggregate, Catalyst pushes the year and label predicates into the file scan
(``PushedFilters``) and prunes the columns (``ReadSchema``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlens.functions.columns import qcol, quote, require_columns, select_renamed, sql_in

# Fixed values from the reference analysis (kept as defaults of the operators).
DEFAULT_YEAR = 2021
INCOME_GROUPS = [
    "High-income countries",
    "Low-income countries",
    "Lower-middle-income countries",
    "Upper-middle-income countries",
    "World",
]
CONTINENTS = ["Africa", "Asia", "Australia", "Europe", "North America", "South America"]
CONTINENT_ALSO_COUNTRY = ["Australia"]


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL (or a NaN in a float column) in ``subset`` (F2).

    With no subset every column counts, as in ``df.na.drop()`` after a
    ``select``.
    """
    if subset is not None:
        require_columns(df, subset)
    return df.na.drop(how="any", subset=list(subset) if subset is not None else None)


def _label_filter(df: DataFrame, label_col: str, labels, keep: bool) -> DataFrame:
    """Keep (``keep=True``) or drop rows whose label is in ``labels``.

    A list of any length is an ``IN`` predicate, pushed to the scan; a
    one-column DataFrame is a semi/anti join (Catalyst broadcasts it only if
    its estimated size is under the threshold).  The caller decides.
    """
    if isinstance(labels, DataFrame):
        right = labels.select(F.col(labels.columns[0]).alias("__label")).distinct()
        how = "left_semi" if keep else "left_anti"
        # Same NULL rule as ``isin``: a NULL label never survives.
        return df.where(qcol(label_col).isNotNull()).join(right, qcol(label_col) == F.col("__label"), how)
    cond = sql_in(label_col, labels)
    # As in the reference (and SQL NOT IN), a NULL label is dropped either way.
    # An empty list matches nothing: none are kept, or none are dropped.
    return df.where(cond) if keep else df.where(f"NOT ({cond})")


def exclude_groups(df: DataFrame, label_col: str, labels=INCOME_GROUPS) -> DataFrame:
    """Remove group rows by label (F3, F4: ``World``, income groups)."""
    return _label_filter(df, label_col, labels, keep=False)


def group_rows(df: DataFrame, label_col: str, groups=CONTINENTS) -> DataFrame:
    """Keep only the group rows, e.g. continents."""
    return _label_filter(df, label_col, groups, keep=True)


def country_rows(
    df: DataFrame,
    label_col: str,
    groups: Sequence[str] = CONTINENTS,
    keep: Sequence[str] = CONTINENT_ALSO_COUNTRY,
) -> DataFrame:
    """Remove group rows but keep labels that are both a group and a country.

    ``Australia`` is a continent and a country, so it is in both
    ``group_rows`` and ``country_rows``.
    """
    cond = f"NOT ({sql_in(label_col, groups)})"
    if keep:
        cond = f"{cond} OR {sql_in(label_col, keep)}"
    return df.where(cond)


def year_filter(df: DataFrame, year: int | None, year_col: str = "Year") -> DataFrame:
    """Keep one year (F1)."""
    if year is None:
        return df
    return df.where(f"{quote(year_col)} = {int(year)}")


def clean_indicator(
    df: DataFrame,
    columns: Sequence[str],
    renames: Mapping[str, str] | None = None,
    year: int | None = DEFAULT_YEAR,
    exclude: Sequence[str] | DataFrame | None = ("World",),
    label_col: str = "Country",
    year_col: str = "Year",
) -> DataFrame:
    """Select, rename, keep one year, drop incomplete rows, drop group labels.

    The order is the reference's: ``select -> rename -> year -> na.drop ->
    exclude``.  The null drop covers only the selected columns.  Catalyst
    reorders nothing that changes the result and pushes the year and label
    predicates down to the scan.
    """
    out = select_renamed(df, columns, renames)
    out = year_filter(out, year, year_col)
    out = drop_nulls(out)
    if exclude is not None:
        out = exclude_groups(out, label_col, exclude)
    return out
