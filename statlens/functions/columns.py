"""Column-level helpers: quoting, checked renames, value corrections.

Indicator files use column names with spaces, ``:``, ``$``, ``(`` and ``.``.
Only ``.`` (and a back-quote) changes how Spark parses a name, but quoting
every name is harmless, so every lookup here goes through ``qcol``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """Back-quote a column name so Spark reads it literally."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    """``F.col`` for a raw column name, whatever characters it holds."""
    return F.col(quote(name))


def sql_str(value: str) -> str:
    """A SQL string literal for ``value`` (backslash escapes, Spark's default)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_literal(value) -> str:
    """A SQL literal: strings quoted, floats as exact DOUBLEs (not DECIMALs)."""
    if isinstance(value, str):
        return sql_str(value)
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    if isinstance(value, int):
        return str(value)
    raise TypeError(f"unsupported literal {value!r}")


def sql_in(column: str, values) -> str:
    """``column IN (...)`` over literals; no literal matches nothing."""
    values = list(values)
    if not values:
        return "false"
    return f"{quote(column)} IN ({', '.join(sql_literal(v) for v in values)})"


def require_columns(df: DataFrame, names) -> None:
    """Raise if any of ``names`` is not a column of ``df``.

    Spark's ``withColumnRenamed`` silently ignores a missing source column;
    a typo in an indicator name would then surface much later as a missing
    column, so renames check first.
    """
    present = set(df.columns)
    missing = [n for n in names if n not in present]
    if missing:
        raise KeyError(f"columns not found: {missing}; have {df.columns}")


def rename_checked(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename raw column names (P3); every source name must exist."""
    require_columns(df, mapping.keys())
    return df.withColumnsRenamed(dict(mapping))


def select_renamed(df: DataFrame, columns, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Select raw column names (P1) and rename some of them (P3) in one projection."""
    renames = dict(renames or {})
    require_columns(df, list(columns) + list(renames))
    return df.selectExpr(*[f"{quote(c)} AS {quote(renames.get(c, c))}" for c in columns])


def override_value(
    df: DataFrame,
    key_col: str,
    value_col: str,
    corrections: Mapping[str, float] | DataFrame,
) -> DataFrame:
    """Replace ``value_col`` for the listed keys, keep it elsewhere.

    A mapping becomes one ``CASE`` expression, evaluated in the scan's
    codegen stage.  A DataFrame of ``(key, value)`` rows (a corrections
    table of any size) is left-joined instead; Catalyst broadcasts it when
    its estimated size is under the broadcast threshold and shuffles
    otherwise, so no size assumption is made here.  In both, a NULL value sets
    NULL and a NULL key matches nothing; a key that a table lists twice raises.
    """
    require_columns(df, [key_col, value_col])
    if isinstance(corrections, Mapping):
        if not corrections:
            return df
        expr = None
        for key, value in corrections.items():
            cond = qcol(key_col) == F.lit(key)
            expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
        new_value = expr.otherwise(qcol(value_col)).cast(df.schema[value_col].dataType)
        return df.withColumn(value_col, new_value)
    key_name, val_name = corrections.columns[:2]
    twice = F.raise_error(F.concat(F.lit("correction listed twice: "), F.first(qcol(key_name).cast("string"))))
    fix = corrections.where(qcol(key_name).isNotNull()).groupBy(qcol(key_name).alias("__fix_key")).agg(
        F.when(F.count(F.lit(1)) > 1, twice).otherwise(F.max(qcol(val_name))).alias("__fix_value"))
    joined = df.join(fix, qcol(key_col) == F.col("__fix_key"), "left")
    cols = [
        (F.when(F.col("__fix_key").isNotNull(), F.col("__fix_value").cast(df.schema[value_col].dataType))
         .otherwise(qcol(value_col)).alias(value_col)
         if c == value_col else qcol(c))
        for c in df.columns
    ]
    return joined.select(*cols)


def rescale(column: Column | str, divisor: float = 1.0, factor: float = 1.0) -> Column:
    """``column / divisor * factor`` as a double (P5: bubble sizes, common axes)."""
    c = qcol(column) if isinstance(column, str) else column
    out = c.cast("double")
    if divisor != 1.0:
        out = out / F.lit(float(divisor))
    if factor != 1.0:
        out = out * F.lit(float(factor))
    return out
