"""File sources and sinks: trips, metrics, fault logs, marts."""

from __future__ import annotations

import json
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow import schemas
from fareflow.sources import keyed

# The smallest input worth a run, the time format, the partitions of the marts.
MIN_INPUT_BYTES = 1_048_576
CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"

METRIC_FILES = "{metrics_*,part-*}.csv"
#: Table property: the newest run that the catalogue knows.
SYNCED = "marts.synced"
MART_PARTITIONS = {"driver_earnings": ("city_id", "date"), "zone_heatmap": ("city_id", "date"),
                   "surge_analysis": ("city_id", "date"), "city_stats": ("date",)}


# -- trips -------------------------------------------------------------------

def write_trips_csv(trips: DataFrame, root: str) -> None:
    """Header CSV under ``city=X/date=D``. The columns stay in the file too."""
    out = (trips.select(*schemas.TRIP.names)
           .withColumn("__city", F.col("city_id")).withColumn("__date", F.col("date"))
           .withColumnsRenamed({"date": "trip_date"})
           .withColumnsRenamed({"__city": "city", "__date": "date"}))
    (out.hint("rebalance", "city", "date").write.mode("overwrite").partitionBy("city", "date")
     .option("header", True).option("timestampFormat", CSV_TIME).csv(root))


def read_trips(spark: SparkSession, root: str, date: str | None = None) -> DataFrame:
    """Trips of one day, or of all days.

    For one day only that day's folders are listed. Columns are matched by
    position with an explicit schema.
    """
    in_file = ", ".join(f"{'trip_date' if f.name == 'date' else f.name} {f.dataType.simpleString()}"
                        for f in schemas.TRIP.fields)
    reader = (spark.read.schema(f"{in_file}, city STRING, date DATE").option("header", True)
              .option("enforceSchema", True).option("timestampFormat", CSV_TIME).option("basePath", root))
    if date is None:
        raw = reader.csv(root)
    else:
        raw = reader.csv(day_folders(root, date)).filter(F.col("date") == F.lit(date).cast("date"))
    return raw.select(*schemas.TRIP.names)


def day_folders(root: str, date: str) -> str:
    return f"{root}/city=*/date={date}"


def input_bytes(spark: SparkSession, root: str, date: str) -> DataFrame:
    """Total size of the day's files as one row. File content is not read."""
    try:
        files = spark.read.format("binaryFile").load(day_folders(root, date)).select("path", "length")
    except AnalysisException:
        return spark.range(1).select(F.lit(0).cast("bigint").alias("input_bytes"))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("input_bytes"))


def input_size_gate(spark: SparkSession, root: str, date: str, min_bytes: int = MIN_INPUT_BYTES) -> bool:
    """Whether the day has enough input to be worth a run."""
    return input_bytes(spark, root, date).first().input_bytes >= min_bytes


def empty_input_gate(df: DataFrame) -> bool:
    """Whether there is anything to process; stops at the first row."""
    return not df.isEmpty()


# -- marts -------------------------------------------------------------------

def write_marts(marts: dict[str, DataFrame], out: str, date: str | None = None) -> None:
    """Partitioned Parquet. Only the partitions present in a mart are replaced,
    so a day's run leaves the other days alone. With ``date`` the whole day is
    replaced: partitions of it that the run did not write again are removed.

    The rebalance hint gives each output partition few files and lets AQE split
    a city that is much larger than the others. The marts are independent jobs
    and are submitted together, so the small ones fill gaps of the large one.
    """
    def write(name: str) -> None:
        parts = MART_PARTITIONS[name]
        (marts[name].hint("rebalance", *parts).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(f"{out}/{name}"))
        if date is not None:
            _drop_stale(session, f"{out}/{name}", date, began[name])
        _note_partitions(session, marts[name], out, name, date)

    session = next(iter(marts.values())).sparkSession
    began = {name: _partition_files(session, f"{out}/{name}", date) if date else set() for name in marts}
    with ThreadPoolExecutor(max_workers=len(marts)) as pool:
        list(pool.map(inheritable_thread_target(session)(write), marts))


def _partition_files(spark: SparkSession, root: str, date: str) -> set[str]:
    """Files of a day's partitions, whatever comes before the date in the path."""
    fs, _ = keyed.hadoop_path(spark, root)
    found = [s for depth in (f"date={date}", f"*/date={date}")
             for s in fs.globStatus(keyed.hadoop_path(spark, f"{root}/{depth}/part-*")[1]) or []]
    return {s.getPath().toString() for s in found}


def _drop_stale(spark: SparkSession, root: str, date: str, before: set[str]) -> None:
    """Remove the day's files that were there before the run and that it did not replace."""
    fs, _ = keyed.hadoop_path(spark, root)
    for path in before & _partition_files(spark, root, date):
        fs.delete(keyed.hadoop_path(spark, path)[1], False)


def _note_partitions(spark: SparkSession, mart: DataFrame, out: str, name: str, date: str | None) -> None:
    """Add what a run wrote to the mart's log: its partitions and its schema. A day's partitions are
    found by listing that day alone."""
    parts = MART_PARTITIONS[name]
    if date is None:
        rows = mart.select(*[F.col(c).cast("string") for c in parts]).distinct()
        specs = rows.select(F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(c, F.lit("__HIVE_DEFAULT_PARTITION__"))) for c in parts]).alias("spec"))
    else:
        found = {"/".join(f.split("/")[-1 - len(parts):-1]) for f in _partition_files(spark, f"{out}/{name}", date)}
        specs = spark.createDataFrame([(f,) for f in sorted(found)], "spec string")
    run = time.time_ns() // 1000
    (specs.select("spec", F.lit(mart.schema.json()).alias("schema")).coalesce(1).write.mode("overwrite")
     .parquet(f"{out}/_log/{name}/run={run}"))


def sync_marts(spark: SparkSession, out: str, database: str, names=tuple(MART_PARTITIONS)) -> dict[str, int]:
    """Bring the catalogue up to date from the runs logged since the last call; returns the
    number of partitions added per mart.

    Nothing but the new entries of the log is listed or read. New columns are added to the table,
    where older partitions have nulls; a column that a run no longer writes stays, and so does
    a partition whose files are gone. How far a table is synchronised is one of its properties.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    return {name: _sync(spark, out, name, f"{database}.{name}") for name in names}


def _sync(spark: SparkSession, out: str, name: str, table: str) -> int:
    fs, marks = keyed.hadoop_path(spark, f"{out}/_log/{name}/*/_SUCCESS")
    runs = sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in fs.globStatus(marks) or [])
    exists = spark.catalog.tableExists(table)
    known = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == SYNCED).first() if exists else None
    new = [r for r in runs if known is None or r > int(known.value)]
    if not new:
        return 0
    entries = spark.read.parquet(*[f"{out}/_log/{name}/run={r}" for r in new]).distinct().collect()
    fields = {f.name: f for e in entries for f in T.StructType.fromJson(json.loads(e.schema))}
    parts = MART_PARTITIONS[name]
    if not exists:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.values())
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({', '.join(parts)}) LOCATION '{out}/{name}'")
    else:
        have = set(spark.table(table).columns)
        more = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.values() if f.name not in have)
        if more:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({more})")
    held = {r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    specs = sorted({e.spec for e in entries} - held)
    for at in range(0, len(specs), 500):
        listed = " ".join("PARTITION (" + ", ".join("{}='{}'".format(*p.split("=", 1)) for p in spec.split("/")) + ")" for spec in specs[at:at + 500])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {listed}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{SYNCED}' = '{new[-1]}')")
    spark.catalog.refreshTable(table)
    return len(specs)


def read_mart(spark: SparkSession, out: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{out}/{name}")


def register_marts(spark: SparkSession, out: str, names=tuple(MART_PARTITIONS), database: str | None = None
                   ) -> None:
    """Make marts available to SQL: as temporary views, or with ``database`` as
    external tables whose partitions are discovered."""
    for name in names:
        if database is None:
            read_mart(spark, out, name).createOrReplaceTempView(name)
            continue
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        table = f"{database}.{name}"
        if not spark.catalog.tableExists(table):
            spark.catalog.createTable(table, path=f"{out}/{name}", source="parquet")
        if spark.catalog.getTable(table).tableType == "EXTERNAL":
            spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)


# -- metrics and fault logs --------------------------------------------------

def write_metrics(samples: DataFrame, root: str) -> None:
    """Long-format CSV, one folder per experiment."""
    rows = samples.select(*schemas.METRIC.names)
    (rows.withColumn("experiment", F.col("experiment_name")).hint("rebalance", "experiment").write.mode("overwrite")
     .partitionBy("experiment").option("header", True).csv(root))


def metric_files(spark: SparkSession, path: str | list[str], names: str = METRIC_FILES) -> DataFrame:
    """One row per metric file under a path: ``file, bytes, accepted, reason``.

    A file is accepted if its first line names the columns of the metric schema in their
    order; the reason tells what else it is: unreadable, without a header, with columns
    missing, unknown or in another order. Spark passes over empty files, so these are not listed. First lines are found in one scan that
    keeps one line per file and task.
    """
    look = {"recursiveFileLookup": True, "pathGlobFilter": names}
    listed = spark.read.format("binaryFile").options(**look).load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))
    lines = spark.read.options(**look, ignoreCorruptFiles=True).text(path).select(
        "value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__at"),
        F.monotonically_increasing_id().alias("__line"))
    heads = lines.filter(F.col("__at") == 0).groupBy("__file").agg(
        F.min_by("value", "__line").alias("__head"))
    cells = F.transform(F.split(F.regexp_replace("__head", "^\ufeff", ""), ","), lambda c: F.lower(F.trim(F.replace(c, F.lit('"'), F.lit("")))))
    want = F.array(*[F.lit(n) for n in schemas.METRIC.names])
    listing = lambda text, some: F.concat(F.lit(text), F.array_join(some, ", "))
    missing, unknown = F.array_except(want, "__cells"), F.array_except("__cells", want)
    reason = (F.when(F.col("__head").isNull(), "unreadable")
              .when(F.size(missing) == len(schemas.METRIC.names), "no header")
              .when(F.size(missing) > 0, listing("missing columns: ", missing))
              .when(F.size(unknown) > 0, listing("unknown columns: ", unknown))
              .when(F.col("__cells") != want, listing("columns in another order: ", F.col("__cells"))))
    return (listed.join(heads, F.col("file") == F.col("__file"), "left").withColumn("__cells", cells)
            .withColumn("reason", reason).select("file", "bytes", F.col("reason").isNull().alias("accepted"), "reason"))


def read_metrics(spark: SparkSession, path: str | list[str], names: str = METRIC_FILES, check: bool = True) -> DataFrame:
    """All metric files under a path; unreadable files and those that ``metric_files`` does not
    accept are skipped, a bad time becomes null. ``names`` keeps fault logs of the same folder
    out; ``check=False`` trusts the headers and saves a scan."""
    reader = (spark.read.schema(schemas.METRIC).option("header", True).option("ignoreCorruptFiles", True)
              .option("recursiveFileLookup", True).option("pathGlobFilter", names))
    raw = reader.csv(path)
    if check:
        good = metric_files(spark, path, names).filter("accepted").select(F.col("file").alias("__file"))
        raw = raw.withColumn("__from", F.col("_metadata.file_path")).join(good, F.col("__from") == F.col("__file"), "left_semi").drop("__from")
    return raw.withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))


def union_experiments(frames: list[DataFrame]) -> DataFrame:
    """Metric sets as one; missing columns become null."""
    whole = frames[0]
    for df in frames[1:]:
        whole = whole.unionByName(df, allowMissingColumns=True)
    return whole


def read_fault_events(spark: SparkSession, path: str) -> DataFrame:
    """Header-less fault logs, one folder per experiment. ``row_id`` follows the
    line order of a file, also when it is read in several splits."""
    raw = spark.read.schema(schemas.FAULT_EVENT).csv(path)
    return raw.select("*", F.element_at(F.split("_metadata.file_path", "/"), -2).alias("experiment_name"),
                      F.struct(F.col("_metadata.file_block_start").alias("start"),
                               F.monotonically_increasing_id().alias("n")).alias("row_id"))


def write_summary(summary: DataFrame, path: str) -> None:
    """One CSV file; the summary has one row per experiment. Only its rows meet in one task."""
    summary.repartition(1).write.mode("overwrite").option("header", True).csv(path)
