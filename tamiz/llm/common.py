"""What the operators share: results appended to rows in Arrow batches, table reading, row hashes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tamiz.functions.columns import quoted
from tamiz.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes | None]:
    """The values of a string column as UTF-8, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def unused(columns: Sequence[str], name: str) -> str:
    """``name``, or with underscores behind it, whatever no column has (names compare without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def append(
    df: DataFrame, inputs: Sequence[str], make: Callable[[], Callable[..., list]], result: str, name: str
) -> DataFrame:
    """``df`` with one more column ``name`` of the Spark type ``result``.

    ``make()`` runs once per task; the function that it gives takes the Arrow columns ``inputs`` of a batch and
    returns one value per row.
    """
    kind = T._parse_datatype_string(result)
    arrow = to_arrow_type(kind)
    at = [df.columns.index(c) for c in inputs]
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                values = pa.array(step(*[batch.column(i) for i in at]), arrow)
                yield pa.RecordBatch.from_arrays([*batch.columns, values], names=schema.names)

    return df.mapInArrow(run, schema)


def total_bytes(df: DataFrame, column: str) -> int:
    return df.agg(F.sum(F.octet_length(quoted(column)))).first()[0] or 0


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of all columns of a row."""
    maps = [f.name for f in df.schema if isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*[F.to_json(quoted(c)) if c in maps else quoted(c) for c in df.columns])


class ScratchTables:
    """Tables of a database of its own in the shared scratch folder, each dropped with its files when it is done."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.database = spark, f"scratch_{uuid.uuid4().hex}"
        self.frames: list[DataFrame] = []
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{scratch_path(spark, 'tables')}'")

    def store(self, df: DataFrame, buckets: int = 0, by: Sequence[str] = ()) -> DataFrame:
        """``df`` written and read again, with ``buckets`` sorted in them by the columns ``by``."""
        name = f"{self.database}.t{len(self.frames)}"
        writer = df.write.bucketBy(buckets, *by).sortBy(*by) if buckets else df.write
        writer.saveAsTable(name)
        self.frames.append(self.spark.table(name))
        return self.frames[-1]

    def replace(self, old: DataFrame, df: DataFrame) -> DataFrame:
        """Stores ``df`` and drops ``old``, a table that it was made from."""
        found = self.store(df)
        self.remove(old)
        return found

    def remove(self, table: DataFrame) -> None:
        at = next(i for i, f in enumerate(self.frames) if f is table)
        self.spark.sql(f"DROP TABLE {self.database}.t{at}")

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.database} CASCADE")
