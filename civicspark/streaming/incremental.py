"""Incremental landing to clean tables, once for each new file, and late duplicates within a horizon."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.timeseries import newest_by
from ..session import shared_folder
from ..sources.landing import write_partitions


def clean_new_files(
    spark: SparkSession,
    landed: str,
    schema: StructType,
    transform: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
    *,
    file_format: str = "json",
    partition: str = "date",
    keys: Sequence[str] = (),
    version: Sequence[str] = (),
) -> None:
    """Action: takes each file that has landed since the last run once, and replaces the partitions that it touches.

    With ``keys`` the rows that a partition already has are merged in, and the newest ``version`` of a key stays, so that
    a late revision never loses older rows of its day.
    """

    def merge(batch: DataFrame, _: int) -> None:
        rows = transform(batch)
        if keys and spark._jvm.org.apache.hadoop.fs.Path(table).getFileSystem(spark._jsc.hadoopConfiguration()).exists(
            spark._jvm.org.apache.hadoop.fs.Path(table)
        ):
            touched = rows.select(partition).distinct()
            held = spark.read.schema(rows.schema).parquet(table).join(touched, partition, "left_semi")
            rows = newest_by(held.unionByName(rows), keys, version)
            # the rows are read from the partitions that they replace
            shared_folder(spark)
            rows = rows.checkpoint()
        elif keys:
            rows = newest_by(rows, keys, version)
        write_partitions(rows, table, partition)

    stream = spark.readStream.schema(schema).format(file_format).load(landed)
    stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(merge).start().awaitTermination()


def first_seen(stream: DataFrame, time: str, keys: Sequence[str], horizon: str = "7 days") -> DataFrame:
    """Rows of a stream without those whose key has come within the horizon before; the first one seen stays."""
    return stream.withWatermark(time, horizon).dropDuplicatesWithinWatermark([*keys])

