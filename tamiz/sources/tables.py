"""Table scans: CSV with missing-value marks, named or stored tables with a declared schema, row caps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.columns import NUMBER, as_double, quoted
from tamiz.session import materialise

# Cell texts a CSV scan reads as missing (the documented defaults of pandas.read_csv).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
DECLARED_TYPES = ("double", "string", "long", "boolean", "timestamp")


def _infer(raw: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Narrowest of long, double, boolean, string that reads every present cell; one aggregate for all columns."""
    if not columns:
        return {}
    aggs = []
    for i, c in enumerate(columns):
        cell = quoted(c)
        aggs.append(F.count(cell).alias(f"n_{i}"))
        digits = cell.rlike(r"^\s*[-+]?[0-9]+\s*$")
        aggs.append(F.count(F.when(digits, cell.try_cast("long"))).alias(f"l_{i}"))
        aggs.append(F.count(F.when(digits, 1)).alias(f"i_{i}"))
        aggs.append(F.count(F.when(cell.rlike(NUMBER), cell.try_cast("double"))).alias(f"d_{i}"))
        aggs.append(F.count(F.when(F.lower(cell).isin("true", "false"), 1)).alias(f"b_{i}"))
    r = raw.agg(*aggs).first()
    out = {}
    for i, c in enumerate(columns):
        n = r[f"n_{i}"]
        if n and r[f"i_{i}"] == n:
            # Whole numbers beyond 64 bits stay text: a double would merge different ones.
            out[c] = "long" if r[f"l_{i}"] == n else "string"
        elif n == 0 or r[f"d_{i}"] == n:
            out[c] = "double"
        else:
            out[c] = "boolean" if r[f"b_{i}"] == n else "string"
    return out


def _reader(spark: SparkSession, sep: str, multiline: bool) -> DataFrameReader:
    """A quote inside a quoted cell is doubled."""
    options = {"header": True, "sep": sep, "quote": '"', "escape": '"', "multiLine": multiline}
    return spark.read.options(**options)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: Mapping[str, str] | None = None,
    sep: str = ",",
    na_tokens: Sequence[str] = NA_TOKENS,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header. Cells that are NA marks become NULL; any other cell must fit its type, or the job
    fails. Without a ``schema`` ({name: type}) one extra scan finds the types. Only with ``multiline`` may a
    quoted cell hold line ends; a file is then read by one task."""
    columns = _reader(spark, sep, multiline).csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    # All files must have this header.
    scan = _reader(spark, sep, multiline).option("enforceSchema", False).schema(text).csv(path)
    raw = scan.select(*[F.when(~quoted(c).isin(*na_tokens), quoted(c)).alias(c) for c in columns])
    if schema is None:
        schema = _infer(raw, columns)
    if missing := [c for c in schema if c not in columns]:
        raise ValueError(f"declared columns not in {path}: {missing}")
    return apply_schema(raw, {c: schema[c] for c in columns if c in schema})


def apply_schema(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Project to the declared columns and types."""
    unknown = set(schema.values()) - set(DECLARED_TYPES)
    if unknown:
        raise ValueError(f"unknown column types {sorted(unknown)}, one of {DECLARED_TYPES}")
    out = []
    for name, declared in schema.items():
        column = quoted(name)
        if declared == "double":
            column = as_double(column, df.schema[name].dataType)
        else:
            column = column.cast(declared)
        out.append(column.alias(name))
    return df.select(*out)


def read_dataset(
    spark: SparkSession, name: str, schema: Mapping[str, str] | None = None, limit: int | None = None, key: str | None = None
) -> DataFrame:
    """A catalogue table, or a parquet path, with a declared schema and an optional row cap."""
    is_path = "/" in name or name.endswith(".parquet")
    df = spark.read.parquet(name) if is_path else spark.table(name)
    if schema is not None:
        df = apply_schema(df, schema)
    return df if limit is None else cap_rows(df, limit, key)


def cap_rows(df: DataFrame, limit: int, key: str | None = None) -> DataFrame:
    """At most ``limit`` rows: the first by key (a per-partition top-n), or any without a key."""
    return (df if key is None else df.orderBy(quoted(key))).limit(limit)


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Give a table without key a stored row id, so that it never changes between uses. The ids of one
    input split increase in row order."""
    if name in df.columns:
        raise ValueError(f"column '{name}' exists already")
    return materialise(df.select(F.monotonically_increasing_id().alias(name), "*"), "keyed")
