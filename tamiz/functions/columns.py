"""Column-role selection, type coercion and other projections."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET = "__target__"


@dataclass(frozen=True)
class Roles:
    """Which columns of a flat table play which part."""

    numerical: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    text: tuple[str, ...] = ()
    target: str | None = None
    key: str = "row_id"

    def __post_init__(self):
        named = [*self.numerical, *self.categorical, *self.text, self.key]
        if self.target:
            named.append(self.target)
        twice = sorted({c for c in named if named.count(c) > 1})
        if twice:
            raise ValueError(f"columns with more than one role: {twice}")


def quoted(name: str) -> Column:
    """Column by exact name; names may hold spaces and dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns_except(columns: Sequence[str], exceptions: Sequence[str]) -> list[str]:
    left_out = set(exceptions)
    return [c for c in columns if c not in left_out]


# Texts that are numbers.
NUMBER = r"(?i)^\s*[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[-+]?[0-9]+)?\s*$|^\s*[-+]?(?:inf|infinity|nan)\s*$"


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in columns])


def select_except(df: DataFrame, exceptions: Sequence[str]) -> DataFrame:
    return select_columns(df, columns_except(df.columns, exceptions))


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def epoch_seconds(column: Column, data_type: T.DataType) -> Column:
    """Seconds since 1970-01-01 UTC with fraction; independent of the session time zone for zone-less input."""
    if isinstance(data_type, T.TimestampNTZType):
        origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", origin, column) / F.lit(1e6)
    if isinstance(data_type, T.DateType):
        return F.unix_date(column) * F.lit(86400.0)
    return F.unix_micros(column) / F.lit(1e6)


def as_double(column: Column, data_type: T.DataType, lenient: bool = False) -> Column:
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return epoch_seconds(column, data_type)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return nan_to_null(column.cast("double"))
    if isinstance(data_type, T.StringType):
        # A cast alone would also take the type suffixes of Java.
        number = F.when(column.rlike(NUMBER), column)
        if not lenient:
            # Any other text is made one that the cast refuses.
            number = F.when(column.rlike(NUMBER), column).otherwise(F.concat(F.lit("no number: "), column))
        column = F.trim(number)
    if lenient:
        return nan_to_null(column.try_cast("double"))
    # ANSI cast: a value that is no number stops the job.
    return nan_to_null(column.cast("double"))


def standardise_types(df: DataFrame, roles: Roles, lenient: bool = False) -> DataFrame:
    """One projection: numeric and time columns to double, categorical and text columns to string.

    Missing stays NULL in every type; NaN becomes NULL.
    """
    numeric, stringy = set(roles.numerical), {*roles.categorical, *roles.text}
    missing = (numeric | stringy) - set(df.columns)
    if missing:
        raise ValueError(f"columns not in the table: {sorted(missing)}")
    out = []
    for field in df.schema.fields:
        column = quoted(field.name)
        if field.name in numeric:
            out.append(as_double(column, field.dataType, lenient).alias(field.name))
        elif field.name in stringy:
            out.append(column.cast("string").alias(field.name))
        else:
            out.append(column)
    return df.select(*out)


def drop_missing_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows whose listed columns are all present; NaN counts as missing."""
    return df.na.drop(subset=list(columns)) if columns else df


def preview(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """First rows by key; a per-partition top-n, not a full sort."""
    return df.orderBy(quoted(key)).limit(rows)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("long"))


def unused_name(columns: Sequence[str], name: str) -> str:
    """``name``, or with underscores behind it, whatever no column has (names compare without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def significant(column: Column, digits: int = 12) -> Column:
    """Rounded to so many significant digits, whatever the scale."""
    scale = F.pow(F.lit(10.0), F.lit(digits - 1.0) - F.floor(F.log10(F.abs(column))))
    inside = (F.abs(column) > 1e-280) & (F.abs(column) < 1e280)
    return F.when(inside, F.rint(column * scale) / scale).otherwise(column)


def literal_array(values: Sequence, sql_type: str) -> Column:
    """A constant array as one literal (a single parse instead of one call per element)."""

    def text(v):
        if v is None:
            return "NULL"
        if sql_type == "double":
            return f"double('{float(v)!r}')"
        if sql_type == "string":
            return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(int(v))

    return F.expr(f"array({', '.join(text(v) for v in values)})").cast(f"array<{sql_type}>")


def feature_array(features: Sequence[str]) -> Column:
    return F.array(*[quoted(c).cast("double") for c in features])
