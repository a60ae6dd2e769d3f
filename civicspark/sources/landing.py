"""Landing raw records in partitioned folders, manifests of what has landed, and reading it back."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators import checksums
from ..operators.quality import require
from ..operators.ranks import ranked
from ..session import drop_folder

CORRUPT = "_corrupt_record"


# --- reading ---------------------------------------------------------------------------------------------------------


def read_json(spark: SparkSession, path: str | list[str], schema: StructType | None) -> DataFrame:
    """One record a line, plain or compressed by the file's extension; a missing key is null. Without a schema it is inferred."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_days(spark: SparkSession, root: str, schema: StructType, start: date, end: date, absent: str = "error") -> DataFrame:
    """Records of the days [start, end) of a daily layout: month=YYYY-MM/date=YYYY-MM-DD folders.

    A day without a folder is an error; with ``absent`` "skip" it just has no records.
    """
    if absent == "skip":
        months = [F.lit(start.strftime("%Y-%m")), F.lit(end.strftime("%Y-%m"))]
        df = read_partitioned(spark, root, schema, ["month", "date"])
        return df.where(F.col("month").between(*months) & (F.col("date") >= start.isoformat()) & (F.col("date") < end.isoformat()))
    days = [start + timedelta(days=i) for i in range((end - start).days)]
    full = _with_keys(schema, ["month", "date"])
    if not days:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", root).json([f"{root}/month={d:%Y-%m}/date={d}" for d in days])


def read_snapshots(spark: SparkSession, root: str, schema: StructType, start: date | None = None, end: date | None = None) -> DataFrame:
    """Records of all collections of a snapshot layout, ingest_date=YYYY-MM-DD folders, with that date as a string and the
    file that each came from; only the folders of [start, end) are opened."""
    df = read_partitioned(spark, root, schema, ["ingest_date"]).withColumn("_source_file", F.col("_metadata.file_path"))
    if start is not None:
        df = df.where(F.col("ingest_date") >= start.isoformat())
    return df if end is None else df.where(F.col("ingest_date") < end.isoformat())


def read_partitioned(spark: SparkSession, root: str, schema: StructType, keys: list[str]) -> DataFrame:
    return spark.read.schema(_with_keys(schema, keys)).option("recursiveFileLookup", "false").json(root)


def _with_keys(schema: StructType, keys: list[str]) -> StructType:
    return StructType([*[f for f in schema.fields if f.name not in keys], *[StructField(k, StringType()) for k in keys]])


def collection_date(df: DataFrame, path: str = "_source_file", name: str = "ingest_date") -> DataFrame:
    """Action: adds the collection date that each row's file path tells; an error if a path tells none."""
    out = df.withColumn(name, F.regexp_extract(path, r"ingest_date=(\d{4}-\d{2}-\d{2})/", 1))
    bad = out.where(F.col(name) == "").select(path).take(1)
    if bad:
        raise ValueError(f"no collection date in path {bad[0][0]}")
    return out


def read_tagged(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The fields of each line, and ``_corrupt_record`` with the line where it can't be read; blank lines are left out."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return parse_tolerant(lines, "value", schema).drop("value")


def read_tolerant(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Readable records, and the lines that aren't (``_corrupt_record``); blank lines are neither. Whoever wants both in
    one scan takes ``read_tagged``."""
    parsed = read_tagged(spark, path, schema)
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT), parsed.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def parse_tolerant(df: DataFrame, column: str, schema: StructType) -> DataFrame:
    """The fields of a column of JSON text, and ``_corrupt_record`` where it can't be read."""
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return df.withColumn(
        "_r", F.from_json(column, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    ).select(*df.columns, "_r.*")


def read_manifests(spark: SparkSession, root: str, schema: StructType, pattern: str = "manifest*.json") -> DataFrame:
    """All manifest objects below a folder: a file is one object over any number of lines, or has an object on each line.
    What can't be read is left out; any selection of columns, none too, has all rows."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
    objects = F.when(F.try_parse_json(F.try_element_at(lines, F.lit(1))).isNotNull(), lines).otherwise(F.array("value"))
    # parsed before a selection is made, so that pruned columns don't make a broken object whole
    read = parse_tolerant(files.select(F.explode(objects).alias("_object")), "_object", schema)
    return read.where(F.col(CORRUPT).isNull() & F.try_parse_json("_object").isNotNull()).select(*[f.name for f in schema])


def sample_names(names: DataFrame, name: str, n: int = 3) -> DataFrame:
    """Action: up to ``n`` of the distinct names, spread evenly: all, or those at places 0, s, 2s, ... of the sorted list,
    where s is how often n goes into its length. Only the ranges of the list that hold them are read again."""
    listed = ranked(names.select(name).distinct(), [name])
    step = max(listed.total // n, 1)
    return listed.at([i * step for i in range(min(n, listed.total))], "_rank").select(name)


def flatten_series(df: DataFrame, keep: list[str], blocks: list[str], members: list[str], pad: bool = True) -> DataFrame:
    """One row for each step of parallel arrays: ``keep``, ``time`` and ``members``.

    ``blocks`` are struct columns with an array ``time`` and the members; the first whose ``time`` isn't empty counts.
    Shorter arrays are filled up with null, longer ones cut; rows without any time give none. With ``pad`` False a
    value beyond an array's end is told from null by ``has_<member>``.
    """
    chosen = F.coalesce(*[F.when(F.size(F.coalesce(F.col(f"{b}.time"), F.array())) > 0, _zip(b, members, pad)) for b in blocks])
    return df.select(*keep, F.explode(chosen).alias("_s")).select(*keep, "_s.*")


def _zip(block: str, members: list[str], pad: bool) -> Column:
    time = F.col(f"{block}.time")
    held = lambda m, i: F.coalesce(F.size(F.col(f"{block}.{m}")) > i, F.lit(False)).alias(f"has_{m}")
    value = lambda m, i: F.try_element_at(F.col(f"{block}.{m}"), i + 1).alias(m)
    fields = lambda i: [
        F.element_at(time, i + 1).alias("time"), *[value(m, i) for m in members], *[held(m, i) for m in members if not pad]
    ]
    return F.transform(F.sequence(F.lit(0), F.size(time) - 1), lambda i: F.struct(*fields(i)))


def explode_features(df: DataFrame, features: str) -> DataFrame:
    """Rows whose ``features`` array isn't null give one row for each feature; others pass through with a null feature."""
    return df.withColumn("feature", F.explode_outer(features)).drop(features)


def route(wanted: DataFrame, archive: DataFrame, recent: DataFrame, *, day: str, today: date, after_days: int = 92) -> DataFrame:
    """Rows for the wanted days, older ones from the archive and others from the recent source (more than ``after_days`` back)."""
    old = F.datediff(F.lit(today), F.col(day)) > after_days
    pick = lambda source, which, name: source.join(
        wanted.where(which).select(day).distinct(), day, "left_semi"
    ).withColumn("source", F.lit(name))
    return pick(archive, old, "archive").unionByName(pick(recent, ~old, "recent"))


def relative_window(start: date, end: date, today: date, *, past: int | None = None, ahead: int | None = None) -> tuple[int, int]:
    """Days back and days ahead of today that [start, end) needs; never negative. Where either is configured (``past``,
    ``ahead``) these win, and one that isn't is 0: a collection's own window says nothing of the days it asks for."""
    if past is not None or ahead is not None:
        return past or 0, ahead or 0
    return max((today - start).days, 0), max((end - today).days, 0)


# --- writing ---------------------------------------------------------------------------------------------------------


def by_record_day(records: DataFrame, timestamp: str) -> DataFrame:
    """Adds ``month`` and ``date`` of the record's own time; rows whose time is missing or unreadable are dropped."""
    day = F.to_date(F.try_to_timestamp(F.col(timestamp).cast("string")))
    out = records.withColumn("date", F.date_format(day, "yyyy-MM-dd")).where(F.col("date").isNotNull())
    return out.withColumn("month", F.substring("date", 1, 7))


def write_json(df: DataFrame, path: str, keys: list[str], compression: str = "gzip", keep_order: bool = False) -> None:
    """Action: one record a line, in folders by ``keys``; folders that get rows are replaced, others stay.

    Rows are dealt so that large keys go to several tasks and small ones share one (adaptive execution). With
    ``keep_order`` the records of a key stand in the order that they come in, over its files by name; the number that
    keeps it has a name that no field has.
    """
    if not keys:
        df.write.mode("overwrite").option("compression", compression).json(path)
        return
    if keep_order:
        at = free_name(df, "_at")
        numbered = df.withColumn(at, F.monotonically_increasing_id())
        out = numbered.repartitionByRange(*keys, at).sortWithinPartitions(*keys, at).drop(at)
    else:
        out = df.hint("rebalance", *keys)
    out.write.mode("overwrite").option("compression", compression).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).json(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def write_daily(records: DataFrame, path: str, timestamp: str) -> None:
    """Action: a folder for each day of the records' own time, records in the order that they come in."""
    write_json(by_record_day(records, timestamp), path, ["month", "date"], keep_order=True)


def write_monthly(records: DataFrame, path: str, timestamp: str) -> None:
    write_json(by_record_day(records, timestamp).drop("date"), path, ["month"])


def write_static(records: DataFrame, path: str) -> None:
    write_json(records.coalesce(1), path, [])


def write_snapshot(records: DataFrame, path: str, ingest_date: date, min_records: int = 1) -> int:
    """Action: replaces the collection of a day. With fewer than ``min_records`` nothing is touched and it is an error."""
    kept = records.persist()
    try:
        n = require(kept.count(), min_records, f"snapshot of {ingest_date}")
        write_json(kept.withColumn("ingest_date", F.lit(ingest_date.isoformat())), path, ["ingest_date"])
    finally:
        kept.unpersist()
    return n


def write_partitions(df: DataFrame, path: str, key: str = "date") -> None:
    """Action: Parquet in folders by ``key``; a rerun replaces only the folders that it writes to. A large folder is written
    by several tasks."""
    df.hint("rebalance", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def write_rejects(rejected: DataFrame, path: str, key: str | None = None) -> bool:
    """Action: writes rejected rows if there are any; where there are none nothing is written, and what an earlier run has
    left goes."""
    if rejected.isEmpty():
        drop_folder(rejected.sparkSession, path)
        return False
    writer = rejected.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(key) if key else writer).parquet(path)
    return True


def write_whole(df: DataFrame, path: str, files: int | None = None) -> None:
    """Action: replaces a whole table; ``files`` for small reference tables."""
    (df.coalesce(files) if files else df).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def manifest(records: DataFrame, keys: list[str], order: list[str], timestamp: str | None = None, *, ordered: bool = True) -> DataFrame:
    """A row for each partition: records, bytes of its lines as JSON, checksums, first and last record date.

    ``line_checksum`` adds up a hash of each line: in any order, for partitions of any size, and those of parts add up to
    that of the whole. ``sha256_checksum`` hashes the lines in ``order``, which takes the lines of a partition into one
    row: for partitions of a day's size; with ``ordered`` False it is left out. ``tree_manifest`` has an ordered checksum
    for partitions of any size.
    """
    fields = [c for c in records.columns if c not in keys]
    line = F.to_json(F.struct(*fields))
    rows = records.select(*keys, line.alias("_line"), _day(timestamp).alias("_day"), F.struct(*order, line).alias("_order"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("_order", "_line"))), lambda s: s["_line"])
    hashes = [_sha256(lines)] if ordered else []
    return rows.groupBy(*keys).agg(
        *_line_sums(), *hashes, F.min("_day").alias("data_date_min"), F.max("_day").alias("data_date_max")
    )


def tree_manifest(
    records: DataFrame, keys: list[str], order: list[str], timestamp: str | None = None, *, flat: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Action: a row for each partition as ``manifest`` has them, with ``tree_checksum``, the root of a hash tree over its
    lines in ``order``, in place of one hash of all; and the trees, by which ``checksums.differences`` finds changed lines.

    With ``flat`` the root stands right above the blocks of lines: one hash of theirs, however many, and no levels between.
    """
    fields = [c for c in records.columns if c not in keys]
    line, name = F.to_json(F.struct(*fields)), free_name(records, "_line")
    tree = checksums.hash_tree(records.withColumn(name, line), keys, order, name, height=1 if flat else None)
    found = checksums.flat_roots(tree, keys) if flat else checksums.roots(tree, keys)
    root = found.select(F.struct(*keys).alias("_key"), "tree_checksum")
    sums = manifest(records, keys, order, timestamp, ordered=False).withColumn("_key", F.struct(*keys))
    return sums.join(root, "_key").drop("_key"), tree


def _day(timestamp: str | None) -> Column:
    return F.to_date(F.try_to_timestamp(F.col(timestamp).cast("string"))) if timestamp else F.lit(None).cast("date")


def _line_sums() -> list[Column]:
    hashed = F.sum(F.xxhash64("_line").cast("decimal(20,0)")).alias("line_checksum")
    return [F.count("*").alias("record_count"), F.sum(F.octet_length("_line") + 1).alias("file_size_bytes"), hashed]


def _sha256(lines: Column) -> Column:
    return F.sha2(F.concat(F.array_join(lines, "\n"), F.lit("\n")), 256).alias("sha256_checksum")


def file_manifests(
    spark: SparkSession, root: str, *, source_id: str, dataset_name: str, timestamp_field: str, fetched: datetime
) -> DataFrame:
    """A manifest row for each file that has landed below ``root``, read from the files themselves.

    Besides names and times: its partition, records, bytes and SHA-256 of its lines as they stand, the mergeable
    ``line_checksum``, compression, stored bytes, first and last record date (of the field named). The lines of one file
    come together for its hash, so its memory is bounded by the writer's file size, however large a partition is.
    """
    text = spark.read.option("recursiveFileLookup", True).text(root)
    path, at = F.col("_metadata.file_path"), F.struct(
        "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"), F.col("value").alias("line")
    )
    day = F.to_date(F.try_to_timestamp(F.get_json_object("value", f"$.{timestamp_field}")))
    rows = text.select(
        path.alias("_path"),
        F.col("_metadata.file_name").alias("filename"),
        F.col("_metadata.file_size").alias("stored_bytes"),
        at.alias("_at"),
        F.col("value").alias("_line"),
        day.alias("_day"),
    )
    lines = F.transform(F.array_sort(F.collect_list("_at")), lambda s: s["line"])
    found = rows.groupBy("_path", "filename", "stored_bytes").agg(
        *_line_sums(), _sha256(lines), F.min("_day").alias("data_date_min"), F.max("_day").alias("data_date_max")
    )
    part = lambda key: F.nullif(F.regexp_extract("_path", rf"/{key}=([^/]+)/", 1), F.lit(""))
    fixed = {
        "source_id": source_id, "dataset_name": dataset_name, "ingest_date": fetched.date().isoformat(), "timestamp_field": timestamp_field
    }
    named = found.withColumns({k: F.lit(v) for k, v in fixed.items()})
    compression = F.when(F.col("filename").endswith(".gz"), "gzip")
    return named.withColumns(
        {
            "fetch_timestamp": F.lit(fetched.isoformat()),
            "compression": compression,
            "month_partition": part("month"),
            "date_partition": part("date"),
        }
    ).drop("_path")


def write_manifests(manifests: DataFrame, path: str, most: int = 10_000) -> None:
    """Action: manifest rows as JSON in a folder of their own, an object on each line and at most ``most`` in a file, under
    names that ``read_manifests`` looks for; a rerun replaces them."""
    spark = manifests.sparkSession
    manifests.write.mode("overwrite").option("maxRecordsPerFile", most).json(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("part-"):
            files.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(folder, f"manifest-{name}"))


def stable_page(df: DataFrame, keys: list[str], number: int, size: int) -> DataFrame:
    """Action: page ``number`` (from 0) of the rows in a total order: by ``keys``, and rows of equal keys by a hash of all
    columns, so that pages neither overlap nor leave rows out between runs. Whoever wants several pages takes ``ranked``
    once: a page reads the ranges that hold it, however deep it lies."""
    return ranked(df, keys).between(number * size, (number + 1) * size, "_rank").drop("_rank")


def stats(records: DataFrame, day: str, size: Column) -> DataFrame:
    """First and last day, number and bytes of records, in one pass."""
    return records.agg(
        F.min(day).alias("data_date_min"),
        F.max(day).alias("data_date_max"),
        F.count("*").alias("record_count"),
        F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
    )
