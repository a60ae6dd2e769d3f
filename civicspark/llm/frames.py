"""Small helpers on DataFrames that the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, NumericType, StringType, StructType

from ..session import drop_folder, shared_folder


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tidy(run: Callable) -> Callable:
    """A function of batches after which the worker gives back the memory that Arrow and the C library keep."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return over


def tidy_group(run: Callable) -> Callable:
    """The same for a function of one group."""

    def over(group):  # noqa: ANN001, ANN202
        try:
            return run(group)
        finally:
            give_back()

    return over


def tidy_groups(run: Callable) -> Callable:
    """The same for a function of two groups of one key."""

    def over(left, right):  # noqa: ANN001, ANN202
        try:
            return run(left, right)
        finally:
            give_back()

    return over


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def materialize(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and any executor can be lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def small_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A table of the driver's rows, by Arrow: rows as Python objects would go through Python workers of their own, which
    stay idle beside those of the next stages. Types that Arrow may convert otherwise than Spark go that way still."""
    schema = StructType.fromDDL(ddl)
    if not rows or not all(type(f.dataType) is StringType or isinstance(f.dataType, (BooleanType, NumericType)) for f in schema):
        return spark.createDataFrame(rows, schema)
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text).cast("long")).alias("n")).first()["n"] or 0


def discard(*tables: DataFrame) -> None:
    """Delete written tables that no result depends on any more."""
    for table in tables:
        drop_folder(table.sparkSession, table.written_to)
